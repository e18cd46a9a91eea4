"""Fill-in-the-middle forms of documents, cut at token boundaries kept in a Roaring-style set.

The ends of a text's tokens (runs of ASCII letters, or one other character) are a set of code-point
offsets. As in a Roaring bitmap, each block of 65,536 offsets has one container, whichever is smallest: a
sorted array of 16-bit offsets, a bitmap, or runs. The cumulative cardinalities of the containers
find the container of the k-th boundary by binary search, and a select inside it gives the
offset. Both cuts of a document come from its set.

Defined cases: null text is empty, has no tokens and the plain form; a null ``doc_id`` hashes as an empty number
and stays null; a text that holds a marker, or whose hash says so, stays plain; both cuts may fall on the same
boundary (an empty middle); repeated rows give repeated rows; an empty table gives no rows; extra columns are
ignored. A text is cut into containers block by block, so only its string and one block are held.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import byte_slices, id_and_text, text_bytes, to_batch

BLOCK = 1 << 16  # offsets in a container
WORDS = BLOCK // 64
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SCHEMA = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, "
          "output_sha256 string, restored_sha256 string")


class ArrayContainer:
    """Sorted 16-bit offsets."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """One bit for each offset, with the number of bits before each word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(BLOCK, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        word = int(self.words[at])
        for _ in range(k - int(self.before[at])):
            word &= word - 1  # drops the lowest bit
        return at * 64 + (word & -word).bit_length() - 1


class RunContainer:
    """Runs of consecutive offsets, with the number of offsets before each run."""

    def __init__(self, low: np.ndarray):
        first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
        self.start = low[first].astype(np.uint16)
        self.before = first

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.start[run]) + k - int(self.before[run])


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container of sorted offsets: 2 bytes an offset, 4 bytes a run, or one bitmap."""
    runs = 1 + int(np.count_nonzero(np.diff(low) != 1))
    if 4 * runs < min(2 * len(low), BLOCK // 8):
        return RunContainer(low)
    return ArrayContainer(low) if 2 * len(low) <= BLOCK // 8 else BitmapContainer(low)


class BoundarySet:
    """A set of non-negative offsets that answers select(k): the k-th smallest, counted from 0."""

    def __init__(self):
        self.blocks: list[int] = []
        self.containers: list[ArrayContainer | BitmapContainer | RunContainer] = []
        self.total: list[int] = []  # offsets up to the end of each container

    def __len__(self) -> int:
        return self.total[-1] if self.total else 0

    def add_block(self, block: int, low: np.ndarray) -> None:
        """Add the sorted offsets of the next block."""
        if len(low):
            self.blocks.append(block)
            self.containers.append(container(low))
            self.total.append(len(self) + len(low))

    def select(self, k: int) -> int:
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = bisect_left(self.total, k + 1)
        return self.blocks[at] * BLOCK + self.containers[at].select(k - (self.total[at - 1] if at else 0))


def letters(text: str) -> np.ndarray:
    """Which characters are ASCII letters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return (points | 32) - np.uint32(97) < 26


def token_ends(text: str) -> BoundarySet:
    """The ends of the tokens ``[A-Za-z]+|[^A-Za-z]``, as numbers of code points before them."""
    found = BoundarySet()
    for at in range(0, len(text), BLOCK):
        letter = letters(text[at:at + BLOCK + 1])  # one more: does a run go on?
        here = min(BLOCK, len(text) - at)
        ends = np.ones(here, bool)
        follow = letter[1:here + 1]
        ends[:len(follow)] = ~(letter[:len(follow)] & follow)
        # offset i is the boundary behind character i
        found.add_block(at // BLOCK, np.flatnonzero(ends))
    return found


def hash_groups(doc_id: int | None) -> list[int]:
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def transform(text: str, doc_id: int | None, plain_percent: int = 10,
              spm_percent: int = 20) -> tuple[int, str, int | None, int | None, str]:
    """``(n, form, prefix_chars, middle_chars, output)`` of one text."""
    ends = token_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = hash_groups(doc_id)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= 100 - plain_percent:
        return n, "plain", None, None, text
    a, b = (ends.select(k - 1) + 1 if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_percent:
        return n, "spm", a, b - a, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, "psm", a, b - a, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def restore(output: str, form: str) -> str:
    """The text of an output. No part holds a marker and no marker overlaps itself, so the first one is it."""
    if form == "plain":
        return output
    head, tail = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    if not output.startswith(head):
        raise ValueError(f"no {form} form")
    first, _, rest = output[len(head):].partition(tail)
    second, _, middle = rest.partition(MIDDLE)
    prefix, suffix = (first, second) if form == "psm" else (second, first)
    return prefix + middle + suffix


def fill_in_middle(docs: DataFrame, plain_percent: int = 10, spm_percent: int = 20,
                   with_output: bool = True) -> DataFrame:
    """Per document ``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` and,
    unless ``with_output`` is off, the ``output`` text for training."""
    rows = id_and_text(docs)
    schema = rows.sparkSession.createDataFrame([], SCHEMA + (", output string" if with_output else "")).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), text_bytes(batch.column(1))
            for a, b in byte_slices([len(t) for t in texts], 16 << 20):
                out: dict[str, list] = {f.name: [] for f in schema}
                for doc_id, raw in zip(ids[a:b], texts[a:b]):
                    n, form, prefix, middle, output = transform(raw.decode(), doc_id, plain_percent, spm_percent)
                    digests = (hashlib.sha256(t.encode()).hexdigest() for t in (output, restore(output, form)))
                    for name, value in zip(out, (doc_id, n, form, prefix, middle, *digests, output)):
                        out[name].append(value)
                yield to_batch(schema, out)

    return rows.mapInArrow(run, schema)


# Cuts by the token list itself.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce("text", '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
           FROM documents),
g AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS w,
             CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
             CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
k AS (SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a,
             greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
                  THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
c AS (SELECT doc_id, t, n, form, coalesce(array_to_string(w[1:a], ''), '') AS p,
             coalesce(array_to_string(w[a + 1:b], ''), '') AS m, coalesce(array_to_string(w[b + 1:], ''), '') AS s
      FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c
"""
