"""A distributed count-min sketch that answers "at least two?" and never says no wrongly.

Tasks count their own keys in sparse partition sketches (sorted cell numbers per block of
cells); the sketches of a block are merged by adding counts that saturate at two. What remains is one bit per
cell, ``depth * 2**bits / 8`` bytes whatever the input: that fixed size is what is broadcast. An
estimate is never too small, so keys that occur twice always pass; a fuller sketch passes more
keys that occur once, which costs work later and no result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import to_batch

BLOCK_BITS = 20
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
SCHEMA = "block int, data binary"


def cells(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = (keys ^ (keys >> np.uint64(29))) * ODD[row]
        return ((mixed ^ (mixed >> np.uint64(32))) * ODD[(row + 1) % 4] >> np.uint64(64 - bits)).astype(np.uint32)


def pack_sorted(values: np.ndarray) -> bytes:
    """Differences of ascending numbers as 16-bit digits; 65535 stands for that much and goes on."""
    import zstandard

    gaps = np.diff(values, prepend=0).astype(np.int64)
    more = gaps // 65535
    digits = np.full(len(gaps) + int(more.sum()), 65535, np.uint16)
    digits[np.cumsum(more + 1) - 1] = gaps % 65535
    return zstandard.ZstdCompressor(level=1).compress(digits.tobytes())


def unpack_sorted(data: bytes) -> np.ndarray:
    import zstandard

    digits = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint16)
    return np.cumsum(digits, dtype=np.int64)[digits != 65535]


def partition_sketch(keys: np.ndarray, bits: int, depth: int) -> Iterator[tuple[int, bytes]]:
    """``(block, data)``: the cells that these keys fill, those filled twice apart."""
    per_row = max(1, 1 << (bits - BLOCK_BITS)) if bits > BLOCK_BITS else 1
    for row in range(depth):
        found = np.sort(cells(keys, row, bits))
        start = np.flatnonzero(np.diff(found, prepend=np.uint32(0xFFFFFFFF) if not len(found) or found[0] != 0xFFFFFFFF
                                       else np.uint32(0)))
        unique, twice = found[start], np.diff(start, append=len(found)) > 1
        cut = np.searchsorted(unique >> BLOCK_BITS, np.arange(per_row + 1))
        for b in np.flatnonzero(np.diff(cut)):
            part = unique[cut[b]:cut[b + 1]].astype(np.int64) & ((1 << BLOCK_BITS) - 1)
            once = pack_sorted(part)
            again = pack_sorted(part[twice[cut[b]:cut[b + 1]]])
            yield row * per_row + int(b), len(once).to_bytes(4, "little") + once + again


class Repeated:
    """The merged sketch: one bit per cell that holds at least two."""

    def __init__(self, bits: int, depth: int):
        self.bits, self.depth = bits, depth
        self.maps = np.zeros((depth, max(1, (1 << bits) // 8)), np.uint8)

    def put(self, block: int, packed: bytes) -> None:
        size = min(1 << BLOCK_BITS, 1 << self.bits) // 8
        per_row = self.maps.shape[1] // size
        row, at = divmod(block, per_row)
        self.maps[row, at * size:(at + 1) * size] = np.frombuffer(packed, np.uint8)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Which keys may occur twice."""
        out = np.ones(len(keys), bool)
        for row in range(self.depth):
            c = cells(keys, row, self.bits)
            out &= (self.maps[row][c >> 3] >> (c & 7).astype(np.uint8) & 1).astype(bool)
        return out


def count_repeated(rows: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterable[np.ndarray]], bits: int = 28,
                   depth: int = 2, flush: int = 2_000_000) -> Repeated:
    """Sketch the keys that ``keys_of`` makes of every batch of ``rows``; merge; return the merged sketch."""
    spark = rows.sparkSession
    schema = spark.createDataFrame([], SCHEMA).schema

    def batch_of(parts: list[tuple[int, bytes]]) -> pa.RecordBatch:
        return to_batch(schema, {"block": [p[0] for p in parts], "data": [p[1] for p in parts]})

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0
        for batch in batches:
            for keys in keys_of(batch):
                held.append(keys)
                n += len(keys)
                if n >= flush:
                    yield batch_of(list(partition_sketch(np.concatenate(held), bits, depth)))
                    held, n = [], 0
        if n:
            yield batch_of(list(partition_sketch(np.concatenate(held), bits, depth)))

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = min(1 << BLOCK_BITS, 1 << bits)
        block, counts = -1, np.zeros(size, np.uint8)

        def done() -> pa.RecordBatch:
            return batch_of([(block, np.packbits(counts >= 2, bitorder="little").tobytes())])

        for batch in batches:
            for b, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if b != block:
                    if block >= 0:
                        yield done()
                    block = b
                    counts[:] = 0
                cut = 4 + int.from_bytes(data[:4], "little")
                for part in (data[4:cut], data[cut:]):
                    at = unpack_sorted(part)
                    counts[at] = np.minimum(counts[at] + 1, 2)
        if block >= 0:
            yield done()

    merged = (rows.mapInArrow(sketch, schema).repartition("block").sortWithinPartitions("block")
              .mapInArrow(merge, schema))
    out = Repeated(bits, depth)
    for row in merged.toLocalIterator():  # block by block; the whole has the fixed size
        out.put(row["block"], row["data"])
    return out
