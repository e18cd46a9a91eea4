"""Exact k-means over integer vectors by popcounts of bit planes.

Components are floored to integers and held as two's complement: bit j of all 64 components of a vector is one
64-bit word. With the planes V_j of a vector, C_k of a centroid and the weights w of the bits (the top one negative),
``v . c = sum of w_j w_k popcount(V_j & C_k)``, so dot products and squared distances are exact integers. The packed
vectors are written once; each round is one scan of them against a broadcast of the centroids (their number
is a parameter), and tasks send sums by cluster and component, not rows.

Defined cases: vectors that are null, of another length, or hold null, NaN or infinity take no part; a null ``vec_id`` hashes
as an empty number and stays null; repeated rows are vectors like any other, and repeated ids rank by their
components; with fewer vectors than clusters each starts a cluster; an empty table gives no rows; extra columns are
ignored. Components beyond 2**27 raise an error, because squared distances would pass 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, materialize, to_batch

DIMS = 64
LARGEST = 1 << 27
ROWS = 4096  # vectors compared at a time
SUMS = "cluster int, dim int, total long, members long"
ASSIGNED = "vec_id long, cluster int, distance long"


def plane_weights(bits: int) -> list[int]:
    return [1 << j for j in range(bits - 1)] + [-(1 << bits - 1)]


def pack(vectors: np.ndarray, bits: int) -> np.ndarray:
    """``(bits, n)`` words: bit i of word j is bit j of component i."""
    return np.stack([np.packbits(((vectors >> j) & 1).astype(np.uint8), axis=1, bitorder="little").view("<u8")[:, 0]
                     for j in range(bits)])


def unpack(planes: np.ndarray) -> np.ndarray:
    """The vectors ``(n, 64)`` of their planes."""
    out = np.zeros((planes.shape[1], DIMS), np.int64)
    for weight, words in zip(plane_weights(len(planes)), planes):
        bits = np.unpackbits(words.copy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out += weight * bits.astype(np.int64)
    return out


def dot(planes: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact dot products of the vectors of ``planes`` with one centroid ``(bits,)``."""
    bits, n = planes.shape
    top = bits - 1
    counts = np.zeros((2 * bits - 1, n), np.int16)  # by j + k; at most 64 * 29 each
    for j in range(bits):
        both = planes[j] & centroid[:, None]
        ones = np.bitwise_count(both)
        for k in range(bits):
            (np.subtract if (j == top) != (k == top) else np.add)(counts[j + k], ones[k], out=counts[j + k])
    out = np.zeros(n, np.int64)
    for s, c in enumerate(counts):
        out += c.astype(np.int64) << s
    return out


def nearest(planes: np.ndarray, norms: np.ndarray, centroids: np.ndarray,
            centroid_norms: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """``(cluster, squared distance)`` of each vector; the smaller number of equally near clusters."""
    best = np.full(len(norms), np.iinfo(np.int64).max)
    cluster = np.zeros(len(norms), np.int32)
    for c, norm in enumerate(centroid_norms):
        distance = norms + norm - 2 * dot(planes, centroids[:, c])
        closer = distance < best
        best[closer], cluster[closer] = distance[closer], c
    return cluster, best


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """``(vec_id, x)`` of the vectors that take part; ``x`` holds floor(256 * component) as double."""
    x = F.col("embedding")
    usable = (F.size(x) == DIMS) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))
                                            & (F.abs(v.cast("double")) < float("inf")))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x).filter(usable)
            .select("vec_id", F.transform(x, lambda v: v.cast("double") * 256.0).alias("x")))


def packed_vectors(kept: DataFrame, bits: int) -> DataFrame:
    """``(vec_id, planes, norm)``: the words of each vector and its squared length."""
    schema = kept.sparkSession.createDataFrame([], "vec_id long, planes binary, norm long").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.floor(batch.column(1).flatten().to_numpy().reshape(-1, DIMS)).astype(np.int64)
                words = np.ascontiguousarray(pack(x, bits).T)
                yield to_batch(schema, {"vec_id": batch.column(0), "planes": [w.tobytes() for w in words],
                                        "norm": (x * x).sum(1)})

    return kept.mapInArrow(run, schema)


def _blocks(batches: Iterable[pa.RecordBatch], bits: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            part = batch.slice(a, ROWS)
            words = np.frombuffer(b"".join(part.column(1).to_pylist()), "<u8").reshape(-1, bits)
            yield part.column(0), np.ascontiguousarray(words.T), part.column(2).to_numpy()


def cluster_sums(packed: DataFrame, bits: int, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Members and component sums of every non-empty cluster, 64 rows for each on the driver."""
    schema = packed.sparkSession.createDataFrame([], SUMS).schema
    shared = _shared(packed, bits, centroids)
    k = len(centroids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, members = np.zeros((k, DIMS), np.int64), np.zeros(k, np.int64)
        for _, planes, norms in _blocks(batches, bits):
            cluster, _ = nearest(planes, norms, *shared.value)
            order = np.argsort(cluster, kind="stable")
            some, first = np.unique(cluster[order], return_index=True)
            total[some] += np.add.reduceat(unpack(planes)[order], first, axis=0)
            members += np.bincount(cluster, minlength=k)
        some = np.flatnonzero(members)
        if len(some):
            yield to_batch(schema, {"cluster": np.repeat(some, DIMS).astype(np.int32),
                                    "dim": np.tile(np.arange(DIMS, dtype=np.int32), len(some)),
                                    "total": total[some].ravel(), "members": np.repeat(members[some], DIMS)})

    found: dict[int, tuple[int, list[int]]] = {}
    for r in (packed.mapInArrow(run, schema).groupBy("cluster", "dim")
              .agg(F.sum("total").alias("total"), F.sum("members").alias("members")).collect()):
        found.setdefault(r.cluster, (r.members, [0] * DIMS))[1][r.dim] = r.total
    shared.unpersist()
    return found


def _shared(packed: DataFrame, bits: int, centroids: list[list[int]]):
    """The centroids' planes and squared lengths on every executor: ``len(centroids) * bits`` words."""
    return packed.sparkSession.sparkContext.broadcast(
        (pack(np.array(centroids, np.int64), bits), [sum(x * x for x in c) for c in centroids]))


def assignments(packed: DataFrame, bits: int, centroids: list[list[int]]) -> DataFrame:
    """``(vec_id, cluster, distance)`` of every vector."""
    schema = packed.sparkSession.createDataFrame([], ASSIGNED).schema
    shared = _shared(packed, bits, centroids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, planes, norms in _blocks(batches, bits):
            cluster, distance = nearest(planes, norms, *shared.value)
            yield to_batch(schema, {"vec_id": ids, "cluster": cluster, "distance": distance})

    return packed.mapInArrow(run, schema)


def first_centroids(kept: DataFrame, k: int) -> list[list[int]]:
    """The ``k`` vectors whose ids hash lowest."""
    key = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    whole = F.transform("x", lambda v: F.floor(v))
    rows = kept.select(key.alias("key"), whole.alias("x")).orderBy("key", "x").limit(k).collect()
    return [[int(v) for v in r.x] for r in rows]


def bit_width(low: int, high: int) -> int:
    """Bits of the two's complement that holds both."""
    return max(high.bit_length(), (-low - 1).bit_length() if low < 0 else 0) + 1


def cluster_vectors(vectors: DataFrame, k: int = 40, rounds: int = 5) -> DataFrame:
    """Per vector ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``."""
    spark = vectors.sparkSession
    kept = integer_vectors(vectors)
    low, high = kept.agg(F.min(F.array_min("x")), F.max(F.array_max("x"))).first()
    if low is None:
        return spark.createDataFrame([], ASSIGNED + ", cluster_inertia long, inertia long, centroid_sha256 string")
    if max(-low, high) > LARGEST:
        raise ArithmeticError(f"components up to {max(-low, high) / 256:g}: squared distances would pass 64 bits")
    bits = bit_width(int(np.floor(low)), int(np.floor(high)))
    centroids = first_centroids(kept, k)
    packed = materialize(packed_vectors(kept, bits), "bit-planes")
    for _ in range(rounds):
        for c, (members, total) in cluster_sums(packed, bits, centroids).items():
            centroids[c] = [x // members for x in total]
    found = materialize(assignments(packed, bits, centroids), "clusters")
    drop_table(packed)
    inertia = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # one row a cluster
    whole = sum(inertia.values())
    facts = spark.createDataFrame(
        [(c, s, whole, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, s in inertia.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (found.join(F.broadcast(facts), "cluster")  # at most k rows
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def oracle(k: int = 40, rounds: int = 5) -> str:
    """DuckDB SQL of ``cluster_vectors``: every round written out, distances component by component."""
    near = ("SELECT r, c, d FROM (SELECT v.r, c.c, list_sum([(z[1] - z[2]) * (z[1] - z[2]) "
            "for z in list_zip(v.q, c.q)]) AS d FROM v CROSS JOIN {0} c) "
            "QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1")
    steps = []
    for i in range(rounds):
        steps.append(f"""a{i} AS MATERIALIZED ({near.format(f'c{i}')}),
s{i} AS MATERIALIZED (SELECT c, list(x ORDER BY d) AS q FROM (
  SELECT c, d, (sum(x) - ((sum(x) % count(*) + count(*)) % count(*))) // count(*) AS x
  FROM (SELECT a.c, unnest(v.q) AS x, unnest(range(64)) AS d FROM v JOIN a{i} a USING (r)) GROUP BY c, d) GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c, CAST(coalesce(s{i}.q, c{i}.q) AS BIGINT[]) AS q FROM c{i} LEFT JOIN s{i} USING (c))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS q
  FROM embeddings WHERE len(embedding) = 64
    AND len([x for x in embedding if x IS NOT NULL AND NOT isnan(x) AND NOT isinf(x)]) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q
  FROM (SELECT q, sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM v ORDER BY h, q LIMIT {k})),
{''.join(s + ',' for s in steps)}
f AS MATERIALIZED ({near.format(f'c{rounds}')})
SELECT v.vec_id, CAST(f.c AS INTEGER) AS "cluster", CAST(f.d AS BIGINT) AS distance,
       CAST(sum(f.d) OVER (PARTITION BY f.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(f.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM f JOIN v USING (r) JOIN c{rounds} c ON c.c = f.c
"""
