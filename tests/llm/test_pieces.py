import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from emporium.llm import pieces as P

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(st.sampled_from(" ▁ab cde\n\tthe ingXé梦ң\x00<s>0x41ﬁ　😀  ́"), max_size=120)))
def test_ids_equal_the_library(text):
    c = P.codec(PATH)
    assert c.encode(text) == LIBRARY.encode(text)
    assert c.decode(c.encode(text)) == LIBRARY.decode(LIBRARY.encode(text))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31999), st.integers(3, 258)), max_size=12))
def test_any_ids_decode_like_the_library(ids):
    if 0 not in ids:  # what an unknown id stands for is a matter of the surface
        assert P.codec(PATH).decode(ids) == LIBRARY.decode(ids)


@pytest.mark.parametrize("text", ["a" * 50_000, "aéxq" * 60_000, "ab" * 400_000, " " * 3_000 + "x", "ab" * 20_000, "▁" * 100, "\n" * 1000])
def test_long_segments(text):
    assert P.codec(PATH).encode(text) == LIBRARY.encode(text)


def test_compatible_pairs_are_those_that_merge_to_themselves():
    c = P.codec(PATH)
    rng = random.Random(5)
    tokens = [c.id_of[p] for p in c.score if c.merge(p)[-1] == p]
    common = [t for t in tokens if c.rank[t] < 2_000]
    for k in range(40_000):
        a, b = rng.choice(tokens if k % 2 else common), rng.choice(common)
        x, y = c.names[a], c.names[b]
        parts, best = list(x + y), 0
        while best is not None:  # the plain rule: best score first, leftmost of equal ones
            found = [(c.score[p + q], -i) for i, (p, q) in enumerate(zip(parts, parts[1:])) if p + q in c.score]
            best = max(found, default=None)
            if best is not None:
                i = -best[1]
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
        assert c.compatible(a, b) == (parts == [x, y]), (x, y)


def test_small_tables_do_not_change_ids(library):
    c = P.PieceCodec(PATH, keep_segments=2, keep_pairs=2)
    text = "the quick brown fox and the quick brown dog " * 3
    assert c.encode(text) == library.encode(text)


def test_whole_table(documents, library):
    df, rows = documents
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in P.encode_decode(df, PATH).collect()), key=str)
    want = []
    for i, t in rows:
        ids = library.encode(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_empty_table(no_documents):
    assert P.encode_decode(no_documents, PATH).count() == 0
