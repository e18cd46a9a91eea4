"""Online packing of token sequences by the sum-of-squares rule.

Every input partition is packed by one packer over the documents in file order. A document is
its ids and one end id; whole windows are cut off first and the rest goes to the fill level that
minimises the sum of squared counts of partially filled windows, read from one array of counts by
level. When a partition ends (or holds ``max_open`` windows) the emptiest open windows are cut to
fill the others, so a partition leaves at most one window that needs padding.

Defined cases: null and empty texts are the end id alone; a null doc_id is packed like any other
and stays null; repeated rows are packed each; an empty table gives no rows; extra columns are
ignored. Nothing is shuffled, so hot keys play no part; a lost task packs its partition again.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, id_and_text, text_bytes, to_batch

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_tokens long")
Piece = tuple  # (doc_id, start, doc_tokens, ids as little-endian uint32 bytes)


class WordTokenizer:
    """Ids of a text through a tokenizers file that lower-cases and treats white space as a mere
    boundary, as its pre-tokenizer does the place between a letter and a sentence mark.

    Such a tokenizer encodes each word on its own, so words are encoded once and kept in two
    generations of a bounded table: words that are used again move to the younger one."""

    MARKS = b".,;:!?"

    def __init__(self, path: str, keep: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.keep, self.young, self.old = keep, {}, {}
        ids = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(ids.values()) + 1, bool)
        self.ends_word[[i for t, i in ids.items() if t.endswith("</w>")]] = True

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_new(self, words: list[bytes], together: int = 32) -> None:
        """Words of letters alone are one pre-token each: many go through in one text, and the ids
        that end a word cut them apart again. Other words go one by one."""
        texts = [w.decode() for w in words]
        letters = [i for i, t in enumerate(texts) if t.isalpha() and t.lower().isalpha()]
        joined = [letters[i:i + together] for i in range(0, len(letters), together)]
        for group, ids in zip(joined, self._ids([" ".join([texts[i] for i in g]) for g in joined])):
            raw = np.array(ids, "<u4")
            ends = ((np.flatnonzero(self.ends_word[raw]) + 1) * 4).tolist()
            if len(ends) != len(group):
                raise ValueError("the tokenizer does not end each word of letters with one id")
            raw = raw.tobytes()
            self.young.update((words[i], raw[a:b]) for i, a, b in zip(group, [0, *ends], ends))
        apart = sorted(set(range(len(words))).difference(letters))
        self.young.update((words[i], array("I", ids).tobytes())
                          for i, ids in zip(apart, self._ids([texts[i] for i in apart])))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        words = [t.lower().split() for t in texts]
        if len(self.young) > self.keep:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        new, split = [], []
        for w in {w for ws in words for w in ws if w not in young}:
            if w in old:
                young[w] = old[w]
                continue
            core = w.rstrip(self.MARKS)
            if len(core) < len(w) and core and core.decode()[-1].lower()[-1].isalpha():
                split.append((w, core, w[len(core):]))
            else:
                new.append(w)
        parts = {p for _, core, tail in split for p in (core, tail) if p not in young}
        young.update((p, old[p]) for p in parts if p in old)
        self._encode_new(list({*new, *(p for p in parts if p not in old)}))
        for w, core, tail in split:
            young[w] = young[core] + young[tail]
        get = young.__getitem__
        return [b"".join(map(get, ws)) for ws in words]


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One for each worker process and file."""
    return WordTokenizer(path)


class SumOfSquaresPacker:
    """Places sequences into windows of ``size`` tokens; yields closed windows as lists of pieces."""

    def __init__(self, size: int, max_open: int = 4096):
        self.size, self.max_open = size, max_open
        self.counts = np.zeros(size + 1, np.int64)  # partially filled windows by fill level
        self.open: list[list[list[Piece]]] = [[] for _ in range(size + 1)]

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[list[Piece]]:
        n, size = len(ids) // 4, self.size
        whole = n - n % size
        for at in range(0, whole, size):
            yield [(doc_id, at, n, ids[at * 4:(at + size) * 4])]
        if whole < n:
            yield from self._place((doc_id, whole, n, ids[whole * 4:]), n - whole)

    def _place(self, piece: Piece, length: int) -> Iterator[list[Piece]]:
        counts, top = self.counts, self.size - length
        # Change of the sum of squares when a window of level h (0: a new one) becomes h + length.
        change = 2 * counts[length:length + top + 1] + 1
        change[top] = 0  # a full window counts no more
        change[1:] -= 2 * counts[1:top + 1] - 1
        change[1:][counts[1:top + 1] == 0] = np.iinfo(np.int64).max
        level = top - int(np.argmin(change[::-1]))  # of equal ones the fullest
        window = [] if level == 0 else self.open[level].pop()
        counts[level] -= level > 0
        window.append(piece)
        if level == top:
            yield window
            return
        counts[level + length] += 1
        self.open[level + length].append(window)
        if counts.sum() > self.max_open:
            yield from self.consolidate()

    def consolidate(self) -> Iterator[list[Piece]]:
        """Cut the emptiest open windows to fill the fullest; at most one window stays open."""
        windows = [(level, w) for level in range(self.size, 0, -1) for w in self.open[level]]
        self.counts[:] = 0
        for level in range(self.size + 1):
            self.open[level] = []
        lo, hi = 0, len(windows) - 1
        fill, target = windows[0] if windows else (0, [])
        while lo < hi:
            level, source = windows[hi]
            while source and lo < hi:
                doc_id, start, total, ids = source.pop()
                take = min(len(ids) // 4, self.size - fill)
                target.append((doc_id, start, total, ids[:take * 4]))
                fill, level = fill + take, level - take
                if take * 4 < len(ids):
                    source.append((doc_id, start + take, total, ids[take * 4:]))
                if fill == self.size:
                    yield target
                    lo += 1
                    fill, target = windows[lo] if lo < hi else (level, source)
            if not source:
                hi -= 1
        if lo == hi and target:
            self.counts[fill] = 1
            self.open[fill].append(target)

    def finish(self) -> Iterator[list[Piece]]:
        yield from self.consolidate()
        for level in np.flatnonzero(self.counts):
            yield from self.open[level]
            self.open[level] = []
        self.counts[:] = 0


def pack(docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence."""
    rows = id_and_text(docs)
    schema = rows.sparkSession.createDataFrame([], SCHEMA).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, packer = word_tokenizer(tokenizer_path), SumOfSquaresPacker(window)
        end = np.array([end_id], "<u4").tobytes()
        sequence = (TaskContext.get().partitionId() << 32) - 1
        out: dict[str, list] = {f.name: [] for f in schema}

        def put(closed: Iterable[list[Piece]]) -> None:
            nonlocal sequence
            for pieces in closed:
                sequence += 1
                offset, total = 0, sum(len(p[3]) for p in pieces) // 4
                for doc_id, start, n, ids in pieces:
                    values = (doc_id, start, len(ids) // 4, zlib.crc32(ids), n, sequence, offset, total)
                    for column, value in zip(out.values(), values):
                        column.append(value)
                    offset += len(ids) // 4

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), text_bytes(batch.column(1))
            for a, b in byte_slices([len(t) for t in texts], 4 << 20):
                for doc_id, encoded in zip(ids[a:b], tokenizer.encode(texts[a:b])):
                    put(packer.add(doc_id, encoded + end))
            if len(out["doc_id"]) > 20_000:
                yield to_batch(schema, out)
                for column in out.values():
                    column.clear()
        put(packer.finish())
        yield to_batch(schema, out)

    return rows.mapInArrow(run, schema)
