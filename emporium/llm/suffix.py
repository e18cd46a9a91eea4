"""Removal of repeated byte strings by external induced suffix sorting.

Texts are cut into segments by the minimizers of their windows (``minimizer``), so that equal windows
meet under one key. A sketch of the minimizer occurrences (never too small) leaves out segments
whose key occurs once in the corpus; the others go, each distinct text once with all its places,
to the shard of their key. A shard is sorted by as many keys at a time as ``SORT_BYTES`` hold. A key whose segments exceed ``KEY_BYTES`` (a footer with other text around it in
every document) first loses the windows that a sketch of whole windows knows to occur once: what is left of a
shared passage is the same text everywhere, one row with many places. A key that is still too large is
split: its segments are cut again by minimizers of longer grams, at last of the whole window, so equal windows still meet. A sort has all windows of its keys, so
windows whose hash occurs once among them need no sorting; it joins the stretches that are left and orders their suffixes by
external induction with common-prefix values (``induced``); windows with a common prefix of the full
width, and all windows of a segment with several places, are repeated. Covered bytes are removed from every place.

Defined cases: null and empty texts are empty and lose nothing; a text shorter than a window loses
nothing; a null doc_id is a document like any other; rows that repeat id and text are different
places of the same bytes, so both lose them; an empty table gives no rows; extra columns are ignored. A
segment shared by very many documents is one row per task; very long texts are cut into overlapping pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lm, rolling
from .common import byte_slices, id_and_text, materialize, rank_id, text_bytes, to_batch
from .induced import repeated_starts
from .minimizer import GRAM, PLACE_BITS, segments, starts_inside
from .sketch import count_repeated

LANE = rolling.Hasher(1001)
SHARD_BYTES = 12 << 20  # text for each shard
SORT_BYTES = 9 << 20  # segments and places sorted at a time, beyond the last key's
KEY_BYTES = 4 << 20  # text of a key before it is split
PIECE = 1 << 20  # sorted hashes looked at together
FEW = 64  # places from which on they are packed
RUNS_HELD = 500_000  # runs joined before they leave a task
HASH_BITS = 64 - PLACE_BITS
SEGMENT = "key long, size long, data binary, places binary"
RUNS = "rank long, text_key long, start long, count long"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def pieces(texts: list[bytes], width: int) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Slices of the texts: ``(texts, row, offset)``; a long text comes in pieces that overlap by width - 1."""
    for a, b in byte_slices([len(t) for t in texts], rolling.SLICE):
        while b - a > 1 and not texts[a]:  # empty texts may share a slice with one long text
            a += 1
        if b - a > 1 or len(texts[a]) <= rolling.SLICE:
            yield texts[a:b], np.arange(a, b), np.zeros(b - a, np.int64)
            continue
        for at in range(0, max(1, len(texts[a]) - width + 1), rolling.SLICE):
            yield [texts[a][at:at + rolling.SLICE + width - 1]], np.array([a]), np.array([at])


def longer_gram(gram: int, width: int) -> int:
    """A quarter of the grams in a window, at last the whole window."""
    return width + 1 - max(1, (width - gram + 1) // 4)


def cut_again(texts: list[bytes], width: int, gram: int):
    """Segments of all pieces of the texts: ``(their rows and offsets, keys of occurrences, key, text, start, windows)``."""
    for part, row, offset in pieces(texts, width):
        occurrences, key, *rest = segments(part, width, LANE, gram)
        mark = np.uint64(gram << HASH_BITS if gram > GRAM else 0)  # keys of each length of gram are others
        yield part, row, offset, occurrences + mark, key + mark, *rest


def kept_segments(rows: DataFrame, width: int, bits: int, gram: int = GRAM, flush: int = 12 << 20) -> DataFrame:
    """Segments whose key may occur twice, each distinct text of a task once, with its places.

    ``rows`` are documents ``(text, rank, text_key)`` or segments ``(data, places)``."""
    spark = rows.sparkSession
    again = "places" in rows.columns

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        texts = text_bytes(batch.column(0))
        for _, row, _, occurrences, key, text, _, _ in cut_again(texts, width, gram):
            yield occurrences
            if again:  # all keys of a text with several places occur twice
                several = np.array([n_places(batch.column(1)[int(r)].as_py()) > 1 for r in row], bool)
                yield key[several[text]]

    sketch = spark.sparkContext.broadcast(count_repeated(rows, keys, bits))
    schema = spark.createDataFrame([], SEGMENT).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Gathered(schema, flush)
        for batch in batches:
            texts = text_bytes(batch.column(0))
            if not again:
                rank, text_key = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for part, row, offset, _, key, text, start, windows in cut_again(texts, width, gram):
                may = np.flatnonzero(sketch.value(key))
                for k, t, s, n in zip(key[may].astype(np.int64).tolist(), text[may].tolist(), start[may].tolist(),
                                      windows[may].tolist()):
                    data = part[t][s:s + n + width - 1]
                    s += int(offset[t])
                    if again:
                        held.add(k, data, shifted(batch.column(1)[int(row[t])].as_py(), s))
                    else:
                        held.add(k, data, [(int(rank[row[t]]), int(text_key[row[t]]), s)])
                    if held.size >= flush:
                        yield held.done()
        if held.size:
            yield held.done()

    return rows.mapInArrow(run, schema)


class Gathered:
    """Segments of a task, each distinct text of a key once with all its places."""

    def __init__(self, schema, flush: int):
        self.schema, self.flush = schema, flush
        self.held: dict[tuple[int, bytes], list[tuple[int, int, int]]] = {}
        self.size = 0

    def add(self, key: int, data: bytes, places: list[tuple[int, int, int]]) -> None:
        found = self.held.get((key, data))
        if found is None:
            found = self.held[key, data] = []
            self.size += len(data)
        found.extend(places)
        self.size += 200 * len(places)  # a place as Python holds it

    def done(self) -> pa.RecordBatch:
        found = list(self.held.items())
        self.held, self.size = {}, 0
        return to_batch(self.schema, {
            "key": [k for (k, _), _ in found], "size": [len(d) for (_, d), _ in found], "data": [d for (_, d), _ in found],
            "places": [squeeze(*np.array(p, np.int64).T.copy()) for _, p in found]})


def shifted(places: bytes, by: int) -> list[tuple[int, int, int]]:
    return [(r, x, at + by) for r, x, at in zip(*(c.tolist() for c in expand(places)))]


def squeeze(*columns: np.ndarray) -> bytes:
    """Columns ``(rank, text_key, start)`` of places; few of them as they are, since packing costs more than it saves."""
    if len(columns[0]) < FEW:
        return b"\0" + np.stack(columns).astype(np.int64).tobytes()
    return b"\1" + lm.squeeze(*columns)


def expand(places: bytes) -> list[np.ndarray]:
    if places[:1] == b"\1":
        return lm.expand(places[1:])
    return list(np.frombuffer(places, np.int64, offset=1).reshape(3, -1))


def n_places(places: bytes) -> int:
    return len(expand(places)[0]) if places[:1] == b"\1" else (len(places) - 1) // 24


def window_keys(texts: list[bytes], width: int):
    """All windows of all pieces of the texts: ``(their texts, rows and offsets, hash, text, start)``."""
    for part, row, offset in pieces(texts, width):
        lengths = np.fromiter(map(len, part), np.int64, len(part))
        at, count = starts_inside(lengths, width)
        text = np.repeat(np.arange(len(part)), count)
        start = at - np.repeat(np.cumsum(lengths) - lengths, count)
        yield part, row, offset, LANE.every(np.frombuffer(b"".join(part), np.uint8), width)[at], text, start


def trimmed_segments(rows: DataFrame, width: int, bits: int, flush: int = 12 << 20) -> DataFrame:
    """The segments ``(key, data, places)`` without the windows that occur once: what is left in one stretch
    is a segment of the same key."""
    spark = rows.sparkSession
    schema = spark.createDataFrame([], SEGMENT).schema

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        several = np.array([n_places(p) > 1 for p in batch.column(2).to_pylist()], bool)
        for _, row, _, found, text, _ in window_keys(text_bytes(batch.column(1)), width):
            yield found
            yield found[several[row[text]]]  # a text with several places counts as two

    sketch = spark.sparkContext.broadcast(count_repeated(rows.select("key", "data", "places"), keys, bits))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Gathered(schema, flush)
        for batch in batches:
            key = batch.column(0).to_pylist()
            for part, row, offset, found, text, start in window_keys(text_bytes(batch.column(1)), width):
                may = sketch.value(found)
                edge = np.flatnonzero(may & np.append(True, ~may[:-1] | (text[1:] != text[:-1])))
                last = np.flatnonzero(may & np.append(~may[1:] | (text[1:] != text[:-1]), True))
                for t, s, e in zip(text[edge].tolist(), start[edge].tolist(), start[last].tolist()):
                    places = batch.column(2)[int(row[t])].as_py()
                    held.add(key[int(row[t])], part[t][s:e + width], shifted(places, s + int(offset[t])))
                    if held.size >= flush:
                        yield held.done()
        if held.size:
            yield held.done()

    return rows.select("key", "data", "places").mapInArrow(run, schema)


def split_segments(rows: DataFrame, width: int, bits: int, limit: int) -> DataFrame:
    """The kept segments of the documents, cut so that a key has at most ``limit`` bytes of them.

    Equal windows have equal keys at every length of gram, so all segments of a large key are cut again
    together. A key of whole windows holds a single text and is not cut further."""
    gram, trimmed = GRAM, False
    kept = materialize(kept_segments(rows, width, bits), "suffix-segments")
    small: list[DataFrame] = []
    while gram < width:
        large = materialize(kept.groupBy("key").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") > limit)
                            .select("key"), "suffix-large")
        if large.isEmpty():
            break
        small.append(kept.join(large, "key", "left_anti"))
        part = kept.join(large, "key", "left_semi")
        if trimmed:
            gram = longer_gram(gram, width)
            part = kept_segments(part.select("data", "places"), width, bits, gram)
        else:
            part, trimmed = trimmed_segments(part, width, bits), True
        kept = materialize(part, "suffix-segments")
    for part in small:
        kept = kept.unionByName(part)
    return kept


class Shard:
    """Distinct segments of a shard, read in order of key and text, with the places of each."""

    def __init__(self, width: int):
        self.width = width
        self.alone: list[tuple[int, list[bytes]]] = []  # (windows, places) of segments without others of their key
        self.several: list[tuple[int, list[bytes]]] = []  # of the other segments with several places
        self.once: list[list[bytes]] = []  # places of the segments with one
        self.texts: list[bytes] = []  # of ``once``, then of ``several``

    def read(self, rows: Iterator[tuple]) -> None:
        """A segment that has several places and no other of its key needs no sorting: all its windows are
        repeated, and no other segment holds them."""
        key, data, places, count, several = None, None, [], 0, False
        texts: list[bytes] = []

        def close(last: bool) -> None:
            if count == 1:
                self.once.append(places)
                self.texts.append(data)
                return
            (self.alone if last and not several else self.several).append((len(data) - self.width + 1, places))
            if not last or several:
                texts.append(data)

        for k, d, p in rows:
            if data is not None and (k != key or d != data):
                close(k != key)
                several = k == key
                places, count = [], 0
            key, data = k, d
            places.append(p)
            count += n_places(p)
        if data is not None:
            close(True)
        self.texts += texts

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(segment, start, windows)``: stretches to sort. Windows of a key are all here, so one whose hash no other has
        occurs once. Equal windows have equal hashes and all stay."""
        lengths = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        count = lengths - self.width + 1
        first = np.cumsum(count) - count
        bits = np.uint64(int(count.sum()).bit_length())
        hashes = np.empty(int(count.sum()), np.uint64)
        for _, row, offset, found, text, start in window_keys(self.texts, self.width):
            at = (first[row] + offset)[text] + start
            hashes[at] = found >> bits << bits | at.astype(np.uint64)
        hashes.sort()
        may = np.zeros(len(hashes) + 1, bool)
        for lo in range(0, len(hashes), PIECE):
            part = hashes[lo:lo + PIECE + 1]
            place = (part & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
            same = np.flatnonzero(part[1:] >> bits == part[:-1] >> bits)
            may[place[same]] = True
            may[place[same + 1]] = True
        del hashes
        may[first[len(self.once)] if self.several else len(may):] = True  # segments with several places
        may[-1] = False
        new = np.zeros(len(may), bool)
        new[first] = True
        edge = np.flatnonzero(may & np.append(True, ~may[:-1] | new[1:]))
        last = np.flatnonzero(may & np.append(~may[1:] | new[1:], True))
        segment = np.searchsorted(first, edge, "right") - 1
        return segment, edge - first[segment], last - edge + 1

    def runs(self, rows: Iterator[tuple]) -> Iterator[tuple[np.ndarray, ...]]:
        """``(rank, text_key, start, count)`` of all repeated windows, as runs."""
        self.read(rows)
        whole = np.zeros(1, np.int64)
        for windows, places in [*self.alone, *self.several]:
            yield from self._placed(places, whole, np.array([windows]))
        if not self.texts:
            return
        segment, start, windows = self.parts()
        if not len(segment):
            return
        marks = repeated_starts((self.texts[i][s:s + n + self.width - 1]
                                 for i, s, n in zip(segment.tolist(), start.tolist(), windows.tolist())), self.width)
        at = np.cumsum(windows + self.width) - windows - self.width  # a stretch has a separator behind it
        edge = np.flatnonzero(np.diff(marks.view(np.int8), prepend=0, append=0))
        begin, count = edge[0::2], edge[1::2] - edge[0::2]
        part = np.searchsorted(at, begin, "right") - 1
        begin = begin - at[part] + start[part]
        of = segment[part]
        mine = of < len(self.once)
        begin, count, of = begin[mine], count[mine], of[mine]
        if len(of):
            found = [np.concatenate(x) for x in zip(*(expand(self.once[i][0]) for i in np.unique(of).tolist()))]
            nth = np.unique(of, return_inverse=True)[1]
            rank, text_key, place = (x[nth] for x in found)
            yield rank, text_key, place + begin, count

    @staticmethod
    def _placed(places: list[bytes], start: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        for p in places if len(start) else ():
            rank, text_key, at = expand(p)
            yield (np.repeat(rank, len(start)), np.repeat(text_key, len(start)),
                   (at[:, None] + start[None, :]).ravel(), np.tile(count, len(at)))


def sorted_runs(rows: Iterator[tuple], width: int, limit: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of repeated windows of ``(shard, key, data, places)`` in order. Keys share no window, so each
    sort takes as many keys as ``limit`` bytes hold, beyond it the rest of the last one."""
    row = next(rows, None)

    def some() -> Iterator[tuple]:
        nonlocal row
        (shard, key, *_), size = row, 0
        while row is not None and row[0] == shard and (row[1] == key or size < limit):
            key = row[1]
            size += len(row[2]) + len(row[3])
            yield row[1:]
            row = next(rows, None)

    while row is not None:
        yield from Shard(width).runs(some())


def joined_runs(rank: np.ndarray, text_key: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """The runs with those joined that touch in one text."""
    order = np.lexsort((start, text_key, rank))
    rank, text_key, start, end = rank[order], text_key[order], start[order], (start + count)[order]
    apart = (rank[1:] != rank[:-1]) | (text_key[1:] != text_key[:-1]) | (start[1:] > end[:-1])
    first = np.flatnonzero(np.append(True, apart)) if len(rank) else np.zeros(0, np.int64)
    end = np.maximum.reduceat(end, first) if len(rank) else end
    return rank[first], text_key[first], start[first], end - start[first]


def repeated_runs(rows: DataFrame, width: int, bits: int) -> DataFrame:
    """``(rank, text_key, start, count)``: runs of byte windows that start elsewhere too."""
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, int(size) // SHARD_BYTES)
    schema = spark.createDataFrame([], RUNS).schema
    limit = SORT_BYTES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        held: list[tuple] = []
        n = 0

        def done() -> pa.RecordBatch:
            return to_batch(schema, dict(zip([f.name for f in schema], joined_runs(*map(np.concatenate, zip(*held))))))

        for found in sorted_runs(stream, width, limit):
            held.append(found)
            n += len(found[0])
            if n >= RUNS_HELD:
                yield done()
                held, n = [], 0
        if held:
            yield done()

    texts = rows.select("text", rank_id(F.col("doc_id")).alias("rank"), F.xxhash64("text").alias("text_key"))
    dealt = split_segments(texts, width, bits, KEY_BYTES).select(
        F.pmod("key", F.lit(shards)).alias("shard"), "key", "data", "places")
    return dealt.repartition("shard").sortWithinPartitions("shard", "key", "data").mapInArrow(run, schema)


def with_runs(docs: DataFrame, width: int, bits: int) -> DataFrame:
    """The documents, null text as empty in ``__text``, with ``__starts`` and ``__counts`` of their runs."""
    runs = (repeated_runs(id_and_text(docs), width, bits)
            .groupBy(F.col("rank").alias("__rank"), F.col("text_key").alias("__text_key"))
            .agg(F.collect_list("start").alias("__starts"), F.collect_list("count").alias("__counts")))
    named = docs.withColumn("__text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    keyed = named.withColumns({"__rank": rank_id(F.col("doc_id").cast("long")), "__text_key": F.xxhash64("__text")})
    return keyed.join(runs, ["__rank", "__text_key"], "left").drop("__rank", "__text_key")


def covered(size: int, starts: list[int] | None, counts: list[int] | None, width: int) -> np.ndarray:
    """Edges of the removed spans, begin and end in turn."""
    if starts is None or not len(starts):
        return np.zeros(0, np.int64)
    start = np.array(starts)
    end = start + np.array(counts) + width - 1
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.concatenate([[True], start[1:] > end[:-1]])
    return np.stack([start[first], end[np.append(np.flatnonzero(first)[1:] - 1, len(end) - 1)]], 1).ravel()


def kept_parts(text: bytes, edges: np.ndarray) -> list[bytes]:
    cut = [0, *edges.tolist(), len(text)]
    return [text[a:b] for a, b in zip(cut[0::2], cut[1::2])]


def remove_repeated_bytes(docs: DataFrame, width: int = 400, bits: int = 26) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    schema = docs.sparkSession.createDataFrame([], RESULT).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in schema}
            columns = [batch.column(i).to_pylist() for i in (0, 2, 3)]
            for doc_id, starts, counts, text in zip(*columns, text_bytes(batch.column(1))):
                edges = covered(len(text), starts, counts, width)
                kept = b"".join(kept_parts(text, edges))
                for name, value in zip(out, (doc_id, len(text), len(text) - len(kept), len(edges) // 2,
                                             hashlib.sha256(kept).hexdigest())):
                    out[name].append(value)
            yield to_batch(schema, out)

    return (with_runs(docs.select("doc_id", "text"), width, bits)
            .select(F.col("doc_id").cast("long").alias("doc_id"), "__text", "__starts", "__counts").mapInArrow(run, schema))


def cut_repeated_bytes(docs: DataFrame, width: int = 400, bits: int = 26) -> DataFrame:
    """The documents with the repeated bytes cut from ``text`` (and ``n_chars``, if there, counted anew).

    A character goes only if all its bytes are covered, so texts stay valid; null texts stay null."""
    spans = F.udf(lambda text, starts, counts: cut_characters(text, starts, counts, width), "string",
                  useArrow=True)
    found = with_runs(docs, width, bits)
    text = F.when(F.col("__starts").isNull(), F.col("text")).otherwise(spans("__text", "__starts", "__counts"))
    columns = {c: F.col(c) for c in docs.columns} | {"text": text}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col("__starts").isNull(), F.col("n_chars")).otherwise(
            F.length(text).cast(docs.schema["n_chars"].dataType))
    return found.select(*[c.alias(n) for n, c in columns.items()])


def cut_characters(text: str, starts: list[int] | None, counts: list[int] | None, width: int) -> str:
    if starts is None or not len(starts):
        return text
    raw = text.encode()
    edges = covered(len(raw), starts, counts, width)
    for i in range(0, len(edges), 2):  # shrink to whole characters
        while edges[i] < edges[i + 1] and raw[edges[i]] & 0xC0 == 0x80:
            edges[i] += 1
        while edges[i + 1] > edges[i] and edges[i + 1] < len(raw) and raw[edges[i + 1]] & 0xC0 == 0x80:
            edges[i + 1] -= 1
    return b"".join(kept_parts(raw, edges)).decode()
