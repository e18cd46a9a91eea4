import math
import zlib
from collections import Counter

import numpy as np
import pytest

from emporium.llm import eliasfano as E
from emporium.llm import lm as L


@pytest.mark.parametrize(("n", "top"), [(0, 10), (1, 1), (1, 1 << 50), (1000, 10), (1000, 10**6), (30_000, 1 << 40), (900, 900)])
def test_elias_fano_access_and_successor(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n).astype(np.uint64))
    ef = E.EliasFano.encode(values)
    assert (ef.access(np.arange(n)) == values).all()
    asked = np.concatenate([values, rng.integers(0, top + 5, 300).astype(np.uint64), np.array([0, top, top + 3], np.uint64)])
    assert (ef.successor(asked) == np.searchsorted(values, asked)).all()


def test_trie_of_three_levels_from_a_mapped_file():
    rng = np.random.default_rng(1)
    w = np.sort(rng.choice(5000, 300, replace=False))
    g2 = np.unique(np.stack([rng.choice(w, 2000), rng.choice(6000, 2000)], 1), axis=0)
    g3 = np.unique(np.concatenate([g2[rng.integers(0, len(g2), 3000)], rng.integers(0, 6000, (3000, 1))], 1), axis=0)
    values = [np.arange(len(x)) % 256 for x in (w, g2, g3)]
    trie = E.NgramTrie.build([w[:, None], g2, g3], values, [np.zeros(len(w)), np.zeros(len(g2))], 6000).mapped()
    one = trie.find(0, np.zeros(len(w), np.int64), w)
    two = trie.find(1, np.searchsorted(w, g2[:, 0]), g2[:, 1])
    place = {tuple(r): i for i, r in enumerate(g2.tolist())}
    three = trie.find(2, np.array([place[tuple(r)] for r in g3[:, :2].tolist()]), g3[:, 2])
    for found, size in ((one, w), (two, g2), (three, g3)):
        assert (found == np.arange(len(size))).all()
    assert (trie.levels[2]["value"] == values[2]).all()
    assert (trie.find(1, np.array([0, -1]), np.array([7000, 3])) == -1).all()
    begin, end = trie.children(0, np.arange(len(w)))
    assert (end - begin == [(g2[:, 0] == x).sum() for x in w]).all()


def brute(rows, m):
    texts = [(i, [*(t or "").encode().lower().split(), None], i is not None and zlib.crc32(str(i).encode()) % 5 == 1)
             for i, t in rows]
    c, b = Counter(), Counter()
    for _, tokens, out in texts:
        if not out:
            c.update(tokens)
            b.update(zip([None, *tokens], tokens))
    n, v = sum(c.values()), len(c)
    base = lambda w: (c[w] + .5) / (n + .5 * (v + 1))
    return [(i, out, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10(base(w)) for w in t),
             sum(math.log10((b[u, w] + m * base(w)) / (c[u] + m)) for u, w in zip([None, *t], t))) for i, t, out in texts]


def compare(df, rows):
    got = sorted(map(tuple, L.score_texts(df).collect()), key=lambda r: (str(r[0]), r[2], r[5]))
    want = sorted(brute(rows, 100.0), key=lambda r: (str(r[0]), r[2], r[5]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], abs=1e-6)
        assert abs(g[6] - w[6]) <= 0.03 * w[2]  # half a step of the 8-bit codes, for each token
    return got


def test_scores_equal_brute_force(documents, monkeypatch):
    df, rows = documents
    got = compare(df, rows)
    held = [g for g in got if g[1] and g[2] > 50]
    assert held and sum(g[6] for g in held) > sum(g[5] for g in held)


def test_many_chunks_and_shards(documents, monkeypatch):
    df, rows = documents
    monkeypatch.setattr(L, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(L, "SHARD_BYTES", 60_000)
    compare(df, rows)


def test_only_held_out_texts_and_empty_table(spark, no_documents):
    out = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    df = spark.createDataFrame([(out, "a b")], "doc_id long, text string")
    r = L.score_texts(df).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, 3, 0, 0)
    assert r.base_score == pytest.approx(0.0) and r.score == pytest.approx(0.0, abs=0.01)
    assert L.score_texts(no_documents).count() == 0


def test_packed_arrays_round_trip():
    arrays = [np.array([], np.int64), np.arange(7, dtype=np.uint32), np.array([True, False]), np.array([-5, 9], np.int16)]
    for a, b in zip(arrays, L.expand(L.squeeze(*arrays))):
        assert a.dtype == b.dtype and a.tolist() == b.tolist()


def test_counts_beyond_32_bits():
    count = np.array([(1 << 32) + 7, 1 << 33, 12], np.int64)
    vocabulary = L.Vocabulary([(0, np.array([3, 3, count.sum()], np.int64).tobytes())], 100.0)
    u, w, n = np.array([0, 0, 2]), np.array([1, 2, 0]), np.array([5, 0, 1])
    asked = L.question(vocabulary, np.arange(3), count, u, w, n)
    (_, _, _, data), = L.answer_bigrams(vocabulary)(0, [(0, 0, 2, asked)])
    p = 10 ** vocabulary.base(count)
    want = np.log10((n + 100 * p[w]) / (count[u] + 100))
    assert np.abs(L.expand(data)[0] / 1000 - want).max() < 0.05
    assert L.expand(asked)[1].tolist() == count[[0, 2]].tolist()
    small = L.Vocabulary([(0, np.array([3, 3, 60], np.int64).tobytes())], 100.0)
    assert small.count is np.uint32
