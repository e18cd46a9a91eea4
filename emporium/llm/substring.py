"""Removal of repeated word windows: count-min prefilter, then exact groups of what may repeat.

Pass 1 sketches window counts (``sketch``) through the windows' minimizers: consecutive windows that
share one are counted once, so the sketch holds a small part of the windows, and a minimizer in
two documents is the least that a window in two documents needs. Pass 2 keeps only windows that the
merged sketch estimates to occur twice; the estimate is never too small, so no repeated window is lost. Those windows are grouped by a 128-bit hash of their
words (two independent 64-bit lanes): first inside the task, where a window that a smaller
document of the same task starts is decided at once, so that a hot window sends one row per task
(not one per document) into the second, global group. Covered words are removed and the rest is
joined by blanks.

Defined cases: null and empty texts have no words; a text with fewer words than a window loses
nothing; a null doc_id ranks after every id (and is not smaller than another null); rows that share a doc_id never
remove each other's words; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import rolling
from .common import byte_slices, id_and_text, key_runs, rank_id, text_bytes, to_batch
from .minimizer import sliding_min
from .sketch import count_repeated

LANES = (rolling.Hasher(301), rolling.Hasher(302))
FOUND = "h1 long, h2 long, decided boolean, rank long, text_key long, start int, count int"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def window_hashes(texts: list[bytes], width: int, lane: rolling.Hasher) -> tuple[np.ndarray, ...]:
    """``(hash, text number, word number, minimizer)`` of every window that lies in one text.

    The minimizer of a window is the least hash of its runs of a third of its words, so equal windows
    have equal minimizers and a minimizer occurs at least as often as each window it stands for."""
    items, count = rolling.word_hashes(texts, lane)
    text = np.repeat(np.arange(len(texts)), count)
    hashes = lane.windows(items, width)
    n = len(hashes)
    gram = max(1, width // 3)
    least = sliding_min(lane.windows(items, gram), width - gram + 1) if n else hashes
    inside = text[:n] == text[width - 1:width - 1 + n]
    first = np.concatenate([[0], np.cumsum(count)])
    at = np.flatnonzero(inside)
    return hashes[at], text[at], at - first[text[at]], least[at]


def run_starts(least: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Where a text's windows change their minimizer."""
    return key_runs(least, text)


def slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    return byte_slices([len(t) for t in texts], rolling.SLICE)


def merge_runs(row: np.ndarray, start: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of consecutive starts with equal ``row`` (and ``same``): index of the first, length."""
    at = key_runs(row, start - np.arange(len(start)), *same)
    return at[:-1], np.diff(at)


def decide(h1, h2, row, start, rank) -> dict[str, np.ndarray]:
    """Of one task's windows, in order of row and start: those with a smaller id here are decided
    (as runs); one row for each run of equal windows of the smallest id is left to the global group."""
    order = np.argsort(h1, kind="stable")
    a, b = h1[order], h2[order]
    if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
        order = np.lexsort((h2, h1))
        a, b = h1[order], h2[order]
    runs = key_runs(a, b)
    ranks = rank[row[order]]
    least = np.minimum.reduceat(ranks, runs[:-1]) if len(ranks) else ranks
    lost = np.empty(len(order), bool)
    lost[order] = ranks > np.repeat(least, np.diff(runs))
    parts = []
    for decided, pick in ((True, np.flatnonzero(lost)), (False, np.flatnonzero(~lost))):
        r, s, x, y = row[pick], start[pick], h1[pick], h2[pick]
        first, count = merge_runs(r, s) if decided else merge_runs(r, s, x, y)
        x, y = (first.astype(np.uint64), r[first].astype(np.uint64)) if decided else (x[first], y[first])
        parts.append((x, y, np.full(len(first), decided), r[first], s[first], count))
    return dict(zip(("h1", "h2", "decided", "row", "start", "count"), map(np.concatenate, zip(*parts))))


def repeated_windows(rows: DataFrame, width: int, bits: int, flush: int = 1_000_000) -> DataFrame:
    """``(rank, text_key, start, count)``: runs of windows that a smaller document also starts."""
    spark = rows.sparkSession

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        texts = text_bytes(batch.column(1))
        for a, b in slices(texts):
            _, text, _, least = window_hashes(texts[a:b], width, LANES[0])
            yield least[run_starts(least, text)[:-1]]

    sketch = spark.sparkContext.broadcast(count_repeated(rows.select("doc_id", "text"), keys, bits))
    schema = spark.createDataFrame([], FOUND).schema

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        ranks: list[np.ndarray] = []
        text_keys: list[np.ndarray] = []
        n = rows_held = 0

        def flushed() -> pa.RecordBatch:
            rank, key = np.concatenate(ranks), np.concatenate(text_keys)
            out = decide(*map(np.concatenate, zip(*held)), rank)
            row = out.pop("row")
            return to_batch(schema, {
                "h1": out["h1"].view(np.int64), "h2": out["h2"].view(np.int64), "decided": out["decided"],
                "rank": rank[row], "text_key": key[row], "start": out["start"].astype(np.int32),
                "count": out["count"].astype(np.int32)})

        for batch in batches:
            texts = text_bytes(batch.column(1))
            rank, key = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            for a, b in slices(texts):
                h1, text, start, least = window_hashes(texts[a:b], width, LANES[0])
                runs = run_starts(least, text)
                may = np.flatnonzero(np.repeat(sketch.value(least[runs[:-1]]), np.diff(runs)))
                if len(may):
                    h2 = window_hashes(texts[a:b], width, LANES[1])[0]
                    held.append((h1[may], h2[may], text[may] + rows_held, start[may]))
                    n += len(may)
                ranks.append(rank[a:b])
                text_keys.append(key[a:b])
                rows_held += b - a
                if n >= flush:
                    yield flushed()
                    held, ranks, text_keys, n, rows_held = [], [], [], 0, 0
        if n:
            yield flushed()

    keyed = rows.select("doc_id", "text", rank_id(F.col("doc_id")).alias("rank"),
                        F.xxhash64("text").alias("text_key"))
    least = F.min("rank").over(Window.partitionBy("h1", "h2", "decided"))
    return (keyed.mapInArrow(found, schema).withColumn("least", least)
            .filter("decided OR rank > least").select("rank", "text_key", "start", "count"))


def remove_repeated(docs: DataFrame, width: int = 50, bits: int = 27) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256``."""
    rows = id_and_text(docs)
    runs = (repeated_windows(rows, width, bits).groupBy("rank", "text_key")
            .agg(F.collect_list("start").alias("starts"), F.collect_list("count").alias("counts")))
    joined = (rows.withColumns({"rank": rank_id(F.col("doc_id")), "text_key": F.xxhash64("text")})
              .join(runs, ["rank", "text_key"], "left").select("doc_id", "text", "starts", "counts"))
    schema = docs.sparkSession.createDataFrame([], RESULT).schema

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in schema}
            columns = [batch.column(i).to_pylist() for i in (0, 2, 3)]
            for doc_id, starts, counts, text in zip(*columns, text_bytes(batch.column(1))):
                kept = words = text.split()
                if starts:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, np.array(starts) + np.array(counts) + width - 1, -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
                out["doc_id"].append(doc_id)
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(kept))
                out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield to_batch(schema, out)

    return joined.mapInArrow(cut, schema)
