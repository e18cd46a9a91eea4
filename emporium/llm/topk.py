"""Exact top-k inner products: vectors in descending length, rotated, pruned by residual bounds.

Vectors are rotated by the right singular vectors of all candidates (from the sum of their outer
products), so leading coordinates carry most of an inner product. Candidates are cut into blocks
in descending length. A query skips a block when the product of the lengths is below its k-th score, and a
vector when the partial sum over the leading coordinates plus the Cauchy-Schwarz bound of the
residuals is below it; where many pass, the sum over the other coordinates follows for the rows and columns
that have any. Sums are products of whole blocks; survivors are scored by integer arithmetic. Every query starts with the
k-th score of the longest block. Candidate groups and query groups form a grid whose cells are
tasks of bounded size; each cell returns at most k rows for a query. Where the bounds discard
nothing (directions spread evenly over all coordinates) each query still meets every candidate.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part, nor do rows
without an id; a missing trailing component counts as zero; rows that share the query's id are
its own and no candidates; a repeated row is one candidate for each time it occurs, and a repeated query
answers once; fewer candidates than k give them all; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import key_runs, materialize, to_batch

BLOCK = 4096          # candidates in a block
BLOCKS_PER_GROUP = 128  # most blocks of a candidate group
QUERY_BLOCK = 512     # queries scored together
BLOCKS_PER_QUERY_GROUP = 256
SLACK = 4 * 2.0 ** -24  # relative margin for each coordinate over rounding in the bounds, which are floats of 32 bits
FEW = 1 / 64          # share of a block's pairs that are scored without the other coordinates
CROWD = 16            # times k: rows above a floor that is worth raising


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of an Arrow list column, short ones filled with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(column), dim))
    out[np.arange(dim)[None, :] < lengths[:, None]] = flat
    return out


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``(id, v, norm2)``: floor(scale * x) of the vectors that take part."""
    x = F.col(vec_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c).cast("double"))
    return (vectors.filter(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0) & finite)
            .select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
            .withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)))


def rotation(rows: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of all rows, leading ones first."""
    schema = rows.sparkSession.createDataFrame([], "i int, j int, s double").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            x = matrix(batch.column(0), dim)
            total += x.T @ x
        i, j = np.indices((dim, dim)).reshape(2, -1)
        yield to_batch(schema, {"i": i, "j": j, "s": total.ravel()})

    gram = np.zeros((dim, dim))
    for r in rows.select("v").mapInArrow(run, schema).groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        gram[r["i"], r["j"]] = r["s"]
    values, vectors = np.linalg.eigh(gram)
    return vectors[:, np.argsort(values)[::-1]]


def packed(rows: DataFrame, order: list[Column], size: int, dim: int, label: str) -> DataFrame:
    """Blocks ``(part, nth, ids, vectors, longest)`` of consecutive rows in the given order."""
    schema = rows.sparkSession.createDataFrame(
        [], "part int, nth int, longest double, ids binary, vectors binary").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, nth = TaskContext.get().partitionId(), 0
        ids, x = np.zeros(0, np.int64), np.zeros((0, dim))

        def block(n: int) -> pa.RecordBatch:
            longest = float(np.sqrt((x[:n] ** 2).sum(1).max()))
            values = x[:n].astype(np.int16) if longest < 2 ** 15 else x[:n]
            return to_batch(schema, {"part": [part], "nth": [nth], "longest": [longest], "ids": [ids[:n].tobytes()],
                                     "vectors": [values.tobytes()]})

        for batch in batches:
            ids = np.concatenate([ids, batch.column(0).to_numpy()])
            x = np.concatenate([x, matrix(batch.column(1), dim)])
            while len(ids) >= size:
                yield block(size)
                ids, x, nth = ids[size:], x[size:], nth + 1
        if len(ids):
            yield block(len(ids))

    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ordered.select("id", "v").mapInArrow(run, schema), label)


def factors(y: np.ndarray, lead: int, scale: np.ndarray | float, sign: float) -> tuple[np.ndarray, np.ndarray]:
    """Scaled rotated rows as factors of two products: leading coordinates with the residual's length, which gives
    the bound, and the other coordinates with that length taken back, which makes the bound the score."""
    y = y / scale
    rest = np.sqrt((y[:, lead:] ** 2).sum(1))[:, None]
    return (np.hstack([y[:, :lead], rest]).astype(np.float32),
            np.hstack([y[:, lead:], sign * rest]).astype(np.float32))


class Block:
    """Consecutive candidates, rotated once for all queries that see them."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, longest: float, turn: np.ndarray, lead: int):
        self.ids, self.x, self.longest, self.scale = ids, x, longest, longest or 1.0
        self.lead, self.tail = factors(x @ turn, lead, self.scale, 1.0)


class Best:
    """The k best rows of each query of a block: higher score first, smaller id on ties."""

    def __init__(self, query_ids: np.ndarray, q: np.ndarray, k: int, turn: np.ndarray, lead: int, floor: np.ndarray):
        self.ids, self.q, self.k, self.floor = query_ids, q, k, floor.copy()
        self.length = np.sqrt((q.astype(np.float64) ** 2).sum(1))
        self.scale = np.where(self.length > 0, self.length, 1.0)
        self.lead, self.tail = factors(q @ turn, lead, self.scale[:, None], -1.0)
        self.slack = SLACK * (len(turn) + 4)
        self.found = np.zeros((0, 3), np.int64)  # query number, id, score

    def see(self, block: Block) -> None:
        scale = self.scale * block.scale
        margin = self.slack * scale + 0.25
        rows = np.flatnonzero(self.length * block.longest + margin >= self.floor)
        if not len(rows):
            return

        def least(r: np.ndarray) -> np.ndarray:
            return ((self.floor[r] - margin[r]) / scale[r]).astype(np.float32)[:, None]

        bound = self.lead[rows] @ block.lead.T
        both = np.flatnonzero(np.isin(block.ids, self.ids[rows]))
        i, j = np.nonzero(self.ids[rows][:, None] == block.ids[both][None, :])
        bound[i, both[j]] = -np.inf
        may = bound >= least(rows)
        columns = np.arange(len(block.ids))
        if np.count_nonzero(may) > may.size * FEW:
            r, c = np.flatnonzero(may.any(1)), np.flatnonzero(may.any(0))
            if len(r) * len(c) < may.size // 2:
                rows, columns, bound = rows[r], columns[c], bound[np.ix_(r, c)]
            bound += self.tail[rows] @ block.tail[columns].T
            may = bound >= least(rows)
            crowded = np.flatnonzero(np.count_nonzero(may, axis=1) > CROWD * self.k)
            if len(crowded) and len(columns) >= self.k:  # these are scores but for the margin: k of them raise the floor
                kth = np.partition(bound[crowded], len(columns) - self.k, axis=1)[:, len(columns) - self.k]
                r = rows[crowded]
                self.floor[r] = np.maximum(self.floor[r], kth * scale[r] - margin[r])
                may[crowded] = bound[crowded] >= least(r)
        hit = np.flatnonzero(may)
        hit = hit[bound.ravel()[hit] > -np.inf]
        if not len(hit):
            return
        qi, xi = rows[hit // len(columns)], columns[hit % len(columns)]
        score = np.empty(len(qi))
        for at in range(0, len(qi), 1 << 17):
            s = slice(at, at + (1 << 17))
            score[s] = np.einsum("ij,ij->i", self.q[qi[s]].astype(np.float64), block.x[xi[s]].astype(np.float64))
        self.keep(np.stack([qi, block.ids[xi], np.rint(score).astype(np.int64)], 1))

    def keep(self, more: np.ndarray) -> None:
        rows = np.concatenate([self.found, more])
        rows = rows[np.lexsort((rows[:, 1], -rows[:, 2], rows[:, 0]))]
        runs = key_runs(rows[:, 0])
        nth = np.arange(len(rows)) - np.repeat(runs[:-1], np.diff(runs))
        self.found = rows[nth < self.k]
        kth = rows[nth == self.k - 1]
        self.floor[kth[:, 0]] = np.maximum(self.floor[kth[:, 0]], kth[:, 2])


def top_inner_products(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
                       vec_col: str = "embedding", scale: int = 256, lead: int = 24) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best candidates of each query."""
    spark = vectors.sparkSession
    chosen = vectors.withColumn("_query", F.coalesce(is_query, F.lit(False)))
    rows = materialize(integer_vectors(chosen, id_col, vec_col, scale), "vectors")
    queries = integer_vectors(chosen.filter("_query"), id_col, vec_col, scale).dropDuplicates(["id", "v"])
    schema = spark.createDataFrame([], "query_id long, vec_id long, score long").schema
    dim = rows.agg(F.max(F.size("v"))).first()[0]
    if dim is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    turn = rotation(rows, dim)
    lead = min(lead, dim)
    cand = packed(rows, [F.col("norm2").desc(), F.col("id")], BLOCK, dim, "candidates")
    asked = packed(queries, [F.col("id")], QUERY_BLOCK, dim, "queries")

    def decode(ids: bytes, x: bytes) -> tuple[np.ndarray, np.ndarray]:
        numbers = np.frombuffer(ids, np.int64)
        small = len(x) == 2 * dim * len(numbers)
        return numbers, np.frombuffer(x, np.int16 if small else np.float64).reshape(-1, dim)

    # The longest block gives every query a first k-th score; it is one block, whatever the input.
    head = spark.sparkContext.broadcast([decode(r["ids"], r["vectors"]) + (r["longest"],) for r in
                                         cand.orderBy(F.col("longest").desc(), "part", "nth").limit(1).collect()])
    seeded_schema = spark.createDataFrame(
        [], "part int, nth int, longest double, ids binary, vectors binary, floor binary").schema

    def first_floor(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = batch.to_pydict()
            out["floor"] = []
            for packed_ids, packed_vectors in zip(out["ids"], out["vectors"]):
                ids, q = decode(packed_ids, packed_vectors)
                best = Best(ids, q, k, turn, lead, np.full(len(ids), -np.inf))
                for block in head.value:
                    best.see(Block(*block, turn, lead))
                out["floor"].append(best.floor.tobytes())
            yield to_batch(seeded_schema, out)

    # The grid: every query group meets every candidate group once. A group mixes blocks of all
    # lengths, so each cell sees long vectors first.
    seeded = asked.mapInArrow(first_floor, seeded_schema)
    blocks = cand.count()
    n_q = max(1, -(-asked.count() // BLOCKS_PER_QUERY_GROUP))
    n_c = max(-(-blocks // BLOCKS_PER_GROUP), min(blocks, -(-2 * spark.sparkContext.defaultParallelism // n_q)))
    block = F.xxhash64("part", "nth")
    cells = (seeded.select(F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))).alias("c"),
                           F.pmod(block, F.lit(n_q)).cast("int").alias("q"), F.lit(0).alias("kind"),
                           "longest", "ids", "vectors", "floor")
             .unionByName(cand.select(F.pmod(block, F.lit(n_c)).cast("int").alias("c"),
                                      F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("q"),
                                      F.lit(1).alias("kind"), "longest", "ids", "vectors",
                                      F.lit(None).cast("binary").alias("floor"))))
    dealt = (cells.withColumn("cell", F.xxhash64("c", "q")).repartition(2 * n_c * n_q, "cell")
             .sortWithinPartitions("cell", "c", "q", "kind", F.col("longest").desc()))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, bests = None, []

        def result() -> pa.RecordBatch:
            found = [np.stack([b.ids[b.found[:, 0]], b.found[:, 1], b.found[:, 2]], 1) for b in bests]
            rows = np.concatenate([np.zeros((0, 3), np.int64), *found])
            return to_batch(schema, {"query_id": rows[:, 0], "vec_id": rows[:, 1], "score": rows[:, 2]})

        for batch in batches:
            for r in batch.to_pylist():
                if (r["c"], r["q"]) != cell:
                    yield result()
                    cell, bests = (r["c"], r["q"]), []
                ids, x = decode(r["ids"], r["vectors"])
                if r["kind"] == 0:
                    bests.append(Best(ids, x, k, turn, lead, np.frombuffer(r["floor"], np.float64)))
                    continue
                seen = Block(ids, x, r["longest"], turn, lead)
                for best in bests:
                    best.see(seen)
        yield result()

    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (dealt.mapInArrow(search, schema).withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""
