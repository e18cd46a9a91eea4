import hashlib
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from emporium.llm import boundaries as B

TOKENS = re.compile("[A-Za-z]+|[^A-Za-z]")


def brute(doc_id, text):
    text = text or ""
    words = TOKENS.findall(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(words) + 1), h2 % (len(words) + 1)))
    p, m, s = "".join(words[:a]), "".join(words[a:b]), "".join(words[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        form, out = "plain", text
    elif h4 % 100 < 20:
        form, out = "spm", f"<S>{s}<P>{p}<M>{m}"
    else:
        form, out = "psm", f"<P>{p}<S>{s}<M>{m}"
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (out, text)]
    return (doc_id, len(words), form, *((len(p), len(m)) if form != "plain" else (None, None)), *sha)


def test_each_container_selects_every_offset():
    rng = np.random.default_rng(3)
    cases = {B.ArrayContainer: np.sort(rng.choice(B.BLOCK, 4000, replace=False)),
             B.BitmapContainer: np.sort(rng.choice(B.BLOCK, 30_000, replace=False)),
             B.RunContainer: np.concatenate([np.arange(5, 9_000), np.arange(20_000, B.BLOCK)])}
    for kind, low in cases.items():
        made = B.container(low)
        assert type(made) is kind
        picks = {0, len(low) - 1, *rng.integers(0, len(low), 500).tolist()}
        assert all(made.select(k) == low[k] for k in picks)
    single = B.container(np.array([B.BLOCK - 1]))
    assert single.select(0) == B.BLOCK - 1


def test_select_crosses_containers_and_empty_blocks():
    rng = np.random.default_rng(4)
    found, want = B.BoundarySet(), []
    for block, size in ((0, 10), (1, 0), (2, B.BLOCK), (5, 9_000), (6, 1)):
        low = np.sort(rng.choice(B.BLOCK, size, replace=False))
        found.add_block(block, low)
        want += (low + block * B.BLOCK).tolist()
    assert len(found) == len(want)
    for k in {0, 9, 10, len(want) - 1, *rng.integers(0, len(want), 800).tolist()}:
        assert found.select(k) == want[k]
    for k in (-1, len(want)):
        with pytest.raises(IndexError):
            found.select(k)


@pytest.mark.parametrize("text", ["a" * (B.BLOCK + 3), "a" * B.BLOCK + "1", "," * (2 * B.BLOCK), "é" * 70_000 + "b",
                                  ("word " * 40_000) + "𝄞x"])
def test_tokens_across_block_edges(text):
    ends = B.token_ends(text)
    want = [m.end() for m in TOKENS.finditer(text)]
    assert len(ends) == len(want)
    for k in {0, len(want) - 1, len(want) // 2, len(want) // 3}:
        assert ends.select(k) + 1 == want[k]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab<>PSM é\n1𝄞", max_size=40), st.integers(-5, 10**9))
def test_round_trip_and_brute_force(text, doc_id):
    n, form, prefix, middle, output = B.transform(text, doc_id)
    assert B.restore(output, form) == text
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (output, text)]
    assert (doc_id, n, form, prefix, middle, *sha) == brute(doc_id, text)


def test_documents_equal_brute_force(documents):
    df, rows = documents
    got = B.fill_in_middle(df).collect()
    assert sorted(map(repr, (tuple(r)[:7] for r in got))) == sorted(map(repr, (brute(*r) for r in rows)))
    assert all(hashlib.sha256(r.output.encode()).hexdigest() == r.output_sha256 for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_table(no_documents):
    assert B.fill_in_middle(no_documents).collect() == []


def test_sql_gives_the_same(spark, documents):
    df, rows = documents
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, \"text\" VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r for r in rows if r[1] is None or len(r[1]) < 20_000])
    want = con.execute(B.ORACLE).fetchall()
    assert sorted(map(repr, want)) == sorted(repr(brute(*r)) for r in rows if r[1] is None or len(r[1]) < 20_000)
