"""SimHash near-duplicates: bit-block buckets, a pivot distance table as filter, verified links.

A fingerprint bit is the majority of that bit over the hashes of all word shingles, repeats
included. Equal fingerprints are one node. Two fingerprints within ``max_bits`` agree on all but
``max_bits`` of ``blocks`` bit blocks, so they meet in a bucket of the blocks they share. In a
bucket, the distances to many reference fingerprints (the pivot table) discard every pair whose
coordinates differ by more than ``max_bits`` anywhere (triangle inequality), and survivors are
verified by their true distance. A bucket reports a spanning forest of its links, never all its
pairs; links found in all buckets are then joined to components.

Defined cases: a text without words (null, empty, blank) has fingerprint zero and links like any
other; fewer words than a shingle give one shingle of them all; a null doc_id ranks after every
id and a component without any id has a null component_id; repeated rows are repeated; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LAST_ID, byte_slices, id_and_text, key_runs, materialize, rank_id, text_bytes, to_batch
from .components import components

PIVOTS = 48


def fingerprint(text: bytes, shingle: int) -> int:
    """The SimHash of the lower-cased words, as a signed 64-bit number."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    joined, k = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())
    hashes = np.array([xxh64_intdigest(joined[a:b], 42) for a, b in spans], ">u8")
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        total += np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, text_key, fp)`` for every row; ``text_key`` tells rows of one id apart."""
    rows = id_and_text(docs).withColumn("text_key", F.xxhash64("text"))
    schema = rows.sparkSession.createDataFrame([], "doc_id long, text_key long, fp long").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(1))
            yield to_batch(schema, {"doc_id": batch.column(0), "text_key": batch.column(2),
                                    "fp": [fingerprint(t, shingle) for t in texts]})

    return rows.mapInArrow(run, schema)


def block_masks(max_bits: int, blocks: int) -> list[int]:
    """Masks (signed) of every choice of the blocks that a linked pair must share."""
    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    single = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    masks = (sum(c) for c in combinations(single, blocks - max_bits))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64)).astype(np.uint8)


def pivots() -> np.ndarray:
    return np.random.default_rng(8).integers(0, 1 << 64, PIVOTS, np.uint64)


def bucket_links(fps: np.ndarray, refs: np.ndarray, max_bits: int, rows: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs of distinct ``fps`` within ``max_bits``.

    The table is ordered by the first pivot's distance, so only a band of it is compared with a
    block of rows; the other coordinates are then checked one after the other."""
    table = popcount(fps[:, None] ^ refs[None, :])
    order = np.argsort(table[:, 0], kind="stable")
    fps, table = fps[order], table[order].astype(np.int16)
    n = len(fps)
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    left: list[int] = []
    right: list[int] = []
    for at in range(0, n, rows):
        upto = min(at + rows, n)
        end = int(np.searchsorted(table[:, 0], table[upto - 1, 0] + max_bits, "right"))
        for lo in range(at, end, 1 << 13):
            hi = min(lo + (1 << 13), end)
            i, j = np.nonzero(np.abs(table[at:upto, :1] - table[None, lo:hi, 0]) <= max_bits)
            i, j = i + at, j + lo
            keep = i < j
            i, j = i[keep], j[keep]
            for p in range(1, table.shape[1]):
                if not len(i):
                    break
                near = np.abs(table[i, p] - table[j, p]) <= max_bits
                i, j = i[near], j[near]
            close = popcount(fps[i] ^ fps[j]) <= max_bits
            for a, b in zip(i[close].tolist(), j[close].tolist()):
                ra, rb = find(a), find(b)
                if ra != rb:
                    root[rb] = ra
                    left.append(a)
                    right.append(b)
    return fps[left], fps[right]


def near_links(nodes: DataFrame, max_bits: int = 3, blocks: int = 6) -> DataFrame:
    """``(a, b)``: links that connect the distinct fingerprints ``fp`` of ``nodes``."""
    masks = block_masks(max_bits, blocks)
    keyed = nodes.select(F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks]))
                         .alias("t", "key"), "fp")
    # A bucket is of one choice of blocks; sorted partitions are read as a stream of buckets.
    dealt = (keyed.select(F.xxhash64("t", "key").alias("bucket"), "fp").repartition("bucket")
             .sortWithinPartitions("bucket", "fp"))
    schema = nodes.sparkSession.createDataFrame([], "a long, b long").schema

    def links(bucket: np.ndarray, fps: np.ndarray, refs: np.ndarray) -> pa.RecordBatch:
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        runs = key_runs(bucket)
        for k in np.flatnonzero(np.diff(runs) > 1):
            distinct = np.unique(fps[runs[k]:runs[k + 1]])
            if len(distinct) == 2:
                if popcount(distinct[:1] ^ distinct[1:])[0] <= max_bits:
                    a.append(distinct[:1])
                    b.append(distinct[1:])
                continue
            x, y = bucket_links(distinct.view(np.uint64), refs, max_bits)
            a.append(x.view(np.int64))
            b.append(y.view(np.int64))
        return to_batch(schema, {"a": np.concatenate(a), "b": np.concatenate(b)})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = pivots()
        bucket, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            bucket = np.concatenate([bucket, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy()])
            cut = int(np.searchsorted(bucket, bucket[-1])) if len(bucket) else 0  # the last bucket may go on
            yield links(bucket[:cut], fps[:cut], refs)
            bucket, fps = bucket[cut:], fps[cut:]
        yield links(bucket, fps, refs)

    return dealt.mapInArrow(run, schema)


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``, and ``first`` for the row that
    stands for its component (several rows only if they repeat both id and text)."""
    marked = materialize(fingerprints(docs, shingle), "simhash")
    me = F.struct(rank_id(F.col("doc_id")).alias("rank"), F.col("text_key"))
    nodes = materialize(marked.groupBy("fp").agg(F.min(me).alias("first")), "simhash-nodes")
    linked = components(near_links(nodes, max_bits))
    rooted = materialize(nodes.join(linked, nodes["fp"] == linked["node"], "left")
                         .select("fp", F.coalesce("root", "fp").alias("root"), "first"), "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    named = rooted.join(least, "root").select("fp", "least")
    return marked.join(named, "fp").select(
        "doc_id", hex16(F.col("fp")).alias("fingerprint"),
        F.nullif(F.col("least.rank"), F.lit(LAST_ID)).cast("long").alias("component_id"),
        (me == F.col("least")).alias("first"), "text_key")


def drop_near_copies(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One document of each component stays (the smallest id), with all its columns."""
    first = (simhash_groups(docs, shingle, max_bits).filter("first")
             .select(F.col("doc_id").alias("__first"), F.col("text_key").alias("__key")))
    marked = docs.withColumn("__text_key", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    found = marked.join(first, marked["doc_id"].cast("long").eqNullSafe(first["__first"])
                        & (marked["__text_key"] == first["__key"]))
    return found.dropDuplicates(["__first", "__key"]).select(*[docs[c] for c in docs.columns])
