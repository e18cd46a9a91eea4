import hashlib
from collections import defaultdict

import numpy as np
import pytest

from emporium.llm import rolling
from emporium.llm import sketch as K
from emporium.llm import substring as S

LAST = 2**63 - 1


def brute(rows, width):
    words = [(LAST if i is None else i, (t or "").encode().split()) for i, t in rows]
    least = defaultdict(lambda: LAST)
    for i, w in words:
        for k in range(len(w) - width + 1):
            key = hashlib.md5(b" ".join(w[k:k + width])).digest()
            least[key] = min(least[key], i)
    out = []
    for (doc_id, _), (i, w) in zip(rows, words):
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - width + 1):
            if least[hashlib.md5(b" ".join(w[k:k + width])).digest()] < i:
                gone[k:k + width] = True
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((doc_id, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize(("width", "bits"), [(50, 22), (3, 12)])
def test_equals_brute_force(documents, width, bits):
    """A sketch that is nearly full passes more windows and changes nothing."""
    df, rows = documents
    assert rows_of(S.remove_repeated(df, width, bits)) == brute(rows, width)


def test_small_flushes(documents, spark):
    df, rows = documents
    runs = S.repeated_windows(S.id_and_text(df), 20, 20, flush=500)
    gone = defaultdict(set)
    for r in runs.collect():
        gone[r["rank"]].update(range(r["start"], r["start"] + r["count"]))
    want = defaultdict(set)
    words = [(LAST if i is None else i, (t or "").split()) for i, t in rows]
    least = defaultdict(lambda: LAST)
    for i, w in words:
        for k in range(len(w) - 19):
            least[tuple(w[k:k + 20])] = min(least[tuple(w[k:k + 20])], i)
    for i, w in words:
        want[i].update(k for k in range(len(w) - 19) if least[tuple(w[k:k + 20])] < i)
    assert {k: v for k, v in gone.items() if v} == {k: v for k, v in want.items() if v}


def test_texts_longer_than_a_slice(spark, monkeypatch):
    monkeypatch.setattr(rolling, "SLICE", 5_000)
    rng = np.random.default_rng(1)
    text = " ".join(f"w{x}" for x in rng.integers(0, 40, 4_000))
    texts = [text.encode(), b"y" * 12_000 + b" tail"]
    a = [S.window_hashes([t], 8, S.LANES[0])[0] for t in texts]
    monkeypatch.setattr(rolling, "SLICE", 1 << 20)
    b = [S.window_hashes([t], 8, S.LANES[0])[0] for t in texts]
    assert all((x == y).all() for x, y in zip(a, b)) and len(a[0]) == 3_993


def test_sketch_never_says_once_of_a_repeated_key(spark):
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 3_000, 9_000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    df = spark.createDataFrame([(int(k.view(np.int64)),) for k in keys], "k long").repartition(6)
    for bits, flush in ((21, 1_000), (8, 100)):
        seen = K.count_repeated(df, lambda b: [b.column(0).to_numpy().view(np.uint64)], bits, flush=flush)
        distinct, counts = np.unique(keys, return_counts=True)
        assert seen(distinct[counts > 1]).all()
        if bits == 21:
            assert seen(distinct[counts == 1]).mean() < 0.05


@pytest.mark.parametrize("values", [[], [0], [0, 65_535, 65_536, 131_071, 400_000], list(range(0, 10**6, 70_001))])
def test_sorted_numbers_round_trip(values):
    assert K.unpack_sorted(K.pack_sorted(np.array(values, np.int64))).tolist() == values


def test_empty_table(no_documents):
    assert S.remove_repeated(no_documents).count() == 0
