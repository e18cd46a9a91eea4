import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from emporium.llm import topk as K

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, k):
    vectors = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
               if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for i, q in vectors:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in vectors if j != i)[:k]
            out.update((i, r + 1, j, -s) for r, (s, j) in enumerate(scores))
    return out


def got(df, every, k, **more):
    return {(r.query_id, r.rank, r.vec_id, r.score) for r in
            K.top_inner_products(df, F.col("vec_id") % every == 0, k, **more).collect()}


@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_equals_brute_force(spark, spread, monkeypatch):
    monkeypatch.setattr(K, "BLOCK", 64)
    monkeypatch.setattr(K, "QUERY_BLOCK", 7)
    monkeypatch.setattr(K, "BLOCKS_PER_GROUP", 2)
    monkeypatch.setattr(K, "BLOCKS_PER_QUERY_GROUP", 2)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 12)) @ np.diag(np.linspace(2, .1, 12)) * np.exp(rng.normal(size=(700, 1)) * spread)
    x[100:150] = x[100]  # equal vectors: ties go to the smaller id
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(5000, None), (5050, []), (5100, [1.0, None] + [0.0] * 10), (5150, [float("nan")] * 12),
             (None, [1.0] * 12), (5200, [float("inf")] * 12), (5250, [0.5] * 5), (5300, [0.0] * 12), (-50, [-1.0] * 12)]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(5)
    assert got(df, 50, 5, lead=4) == brute(rows, 50, 5)


def test_few_candidates_and_repeats(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    assert got(df, 50, 5) == {(0, 1, 1, 256 * 128), (0, 2, 2, 256 * 128)}


def test_empty_table(spark):
    assert got(spark.createDataFrame([], SCHEMA), 50, 5) == set()
    assert got(spark.createDataFrame([(1, [1.0], 0)], SCHEMA), 50, 5) == set()


def test_even_directions_are_not_scored_pair_by_pair(monkeypatch):
    """Where all directions hold as much, the bound over the leading coordinates discards nothing; the sum over the others does."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(5 * 1024, 32))
    x = np.floor(256 * x / np.linalg.norm(x, axis=1, keepdims=True))
    ids, q = np.arange(len(x)), x[::80]
    turn = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    kept = []
    monkeypatch.setattr(K.Best, "keep", lambda self, more, keep=K.Best.keep: (kept.append(len(more)), keep(self, more)))
    best = K.Best(ids[::80], q, 5, turn, 8, np.full(len(q), -np.inf))
    for at in range(0, len(x), 1024):
        part = x[at:at + 1024]
        best.see(K.Block(ids[at:at + 1024], part, float(np.sqrt((part ** 2).sum(1).max())), turn, 8))
    assert sum(kept) < len(q) * len(x) / 50
    want = set()
    for i, row in zip(ids[::80].tolist(), (q @ x.T).astype(int).tolist()):
        want.update((i, j, -s) for s, j in sorted((-s, j) for j, s in enumerate(row) if j != i)[:5])
    assert {(int(best.ids[n]), j, s) for n, j, s in best.found.tolist()} == want


def test_long_zero_and_equal_vectors(spark):
    """Components beyond 16 bits, queries without length, and more equal vectors than a floor is raised for."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 6)) * np.exp(rng.normal(size=(900, 1)))
    x[5:300] = x[5]
    x[[0, 100, 301, 302]] = 0.0
    x[400:420] *= 4000.0
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    assert got(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(3), 50, 5) == brute(rows, 50, 5)
    small = [(i, v) for i, v in rows if not 400 <= i < 420]
    assert got(spark.createDataFrame([(*r, 1) for r in small], SCHEMA), 50, 5, lead=6) == brute(small, 50, 5)
