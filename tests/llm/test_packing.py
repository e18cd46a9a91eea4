import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from emporium.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \t\n\x0b\x1c\x85\xa0　.,;:!?'aAbBsStTéÉΣσςİıß1２½一😀…́<|endofxt|>"), max_size=40),
                min_size=1, max_size=5))
def test_words_encode_like_the_library(texts):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    mine = P.WordTokenizer(PATH, keep=3).encode([x.encode() for x in texts])
    assert [np.frombuffer(x, "<u4").tolist() for x in mine] == [
        t.encode(x, add_special_tokens=False).ids for x in texts]


def check_pieces(rows, expected, window):
    """Every id in one piece, gapless sequences, checksums, little padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id, r.doc_tokens].append(r)
        by_sequence[r.sequence_id].append(r)
    want = defaultdict(list)
    for doc_id, ids in expected:
        want[doc_id, len(ids)].append(ids)
    assert set(by_doc) == set(want)
    for k, pieces in by_doc.items():
        found = sorted((p.start, p.length, p.ids_crc32) for p in pieces)
        places = sorted((s, n) for s, n, _ in found)
        many = len(want[k])
        assert sum(n for _, n in places) == many * k[1]
        if many == 1:
            at = 0
            for s, n, crc in found:
                assert s == at and zlib.crc32(np.array(want[k][0][s:s + n], "<u4").tobytes()) == crc
                at += n
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= window and all(p.sequence_tokens == at for p in pieces)
    return by_sequence


def test_whole_table_is_packed(documents, library):
    df, rows = documents
    got = P.pack(df, PATH).collect()
    sequences = check_pieces(got, [(i, library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in rows], 2048)
    short = [s for s, p in sequences.items() if sum(x.length for x in p) < 2048]
    assert len(short) <= df.rdd.getNumPartitions()


def test_level_minimises_the_sum_of_squares():
    rng = np.random.default_rng(3)
    packer = P.SumOfSquaresPacker(20)
    for length in rng.integers(1, 20, 300).tolist():
        before = packer.counts.copy()
        best = None
        for h in range(0, 20 - length + 1):
            if h and not before[h]:
                continue
            after = before.copy()
            after[h] -= h > 0
            if h + length < 20:
                after[h + length] += 1
            best = min(best or (after ** 2).sum(), (after ** 2).sum()) if best is not None else (after ** 2).sum()
        list(packer._place((1, 0, length, bytes(4 * length)), length))
        assert (packer.counts ** 2).sum() == best
        assert all(len(packer.open[k]) == packer.counts[k] for k in range(21))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(1, 6))
def test_packer_keeps_every_id_and_leaves_one_short_window(lengths, max_open):
    packer = P.SumOfSquaresPacker(16, max_open)
    closed = []
    for i, n in enumerate(lengths):
        closed += packer.add(i, np.arange(n, dtype="<u4").tobytes())
    closed += packer.finish()
    totals = [sum(len(p[3]) // 4 for p in w) for w in closed]
    assert sum(totals) == sum(lengths) and sum(t < 16 for t in totals) <= 1 and max(totals, default=0) <= 16
    seen = sorted((p[0], p[1] + k) for w in closed for p in w for k in range(len(p[3]) // 4))
    assert seen == [(i, k) for i, n in enumerate(lengths) for k in range(n)]


def test_empty_table(no_documents):
    assert P.pack(no_documents, PATH).count() == 0
