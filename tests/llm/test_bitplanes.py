import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from emporium.llm import bitplanes as P

SCHEMA = "vec_id long, embedding array<float>, cluster int"


def brute(rows, k, rounds):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    centroids = [q for _, q in sorted((sha(f"2:{'' if i is None else i}"), q) for i, q in kept)[:k]]

    def near(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        of = {}
        for _, q in kept:
            of.setdefault(near(q)[1], []).append(q)
        for n, qs in of.items():
            centroids[n] = [sum(x) // len(qs) for x in zip(*qs)]
    found = [(i, *near(q)) for i, q in kept]
    inertia = {}
    for _, d, c in found:
        inertia[c] = inertia.get(c, 0) + d
    return [(i, c, d, inertia[c], sum(inertia.values()), sha(",".join(map(str, centroids[c])))) for i, d, c in found]


def vectors(n, scale=1.0, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(8, 64))[rng.integers(0, 8, n)] + rng.normal(size=(n, 64)) * scale
    x[n // 2:n // 2 + 20] = x[n // 2]
    return [(i, v.tolist()) for i, v in enumerate(x)]


ODD = [(9000, None), (9001, []), (9002, [1.0] * 63), (9003, [1.0] * 63 + [None]), (9004, [float("nan")] * 64),
       (9005, [float("inf")] + [0.0] * 63), (None, [0.25] * 64), (7, [0.5] * 64), (7, [0.5] * 64), (-3, [-1.0] * 64)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(3)


def test_planes_round_trip_and_dot_products():
    rng = np.random.default_rng(2)
    for bits in (1, 2, 9, 28):
        low, high = -(1 << bits - 1), (1 << bits - 1) - 1
        v, c = rng.integers(low, high + 1, (50, 64)), rng.integers(low, high + 1, (3, 64))
        v[0], v[1], c[0] = low, high, low
        planes, centroids = P.pack(v, bits), P.pack(c, bits)
        assert (P.unpack(planes) == v).all()
        for n in range(3):
            assert (P.dot(planes, centroids[:, n]) == v @ c[n]).all()
    assert [P.bit_width(*x) for x in ((0, 0), (-1, 0), (-2, 1), (-3, 3), (0, 128), (-129, 3))] == [1, 1, 2, 3, 9, 9]


@pytest.mark.parametrize("scale", [0.1, 30.0])
def test_equals_brute_force(spark, scale, monkeypatch):
    monkeypatch.setattr(P, "ROWS", 37)
    rows = vectors(300, scale) + ODD
    got = P.cluster_vectors(frame(spark, rows), 12, 3)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute(rows, 12, 3)))


def test_fewer_vectors_than_clusters_and_empty(spark):
    rows = vectors(5)
    assert sorted(map(tuple, P.cluster_vectors(frame(spark, rows)).collect())) == sorted(brute(rows, 40, 5))
    assert P.cluster_vectors(frame(spark, ODD[:6])).collect() == []
    assert P.cluster_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_too_large_components_are_an_error(spark):
    with pytest.raises(ArithmeticError):
        P.cluster_vectors(frame(spark, [(1, [1e7] * 64)]))


def test_sql_gives_the_same(spark):
    rows = vectors(120) + ODD
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    want = con.execute(P.oracle(10, 3)).fetchall()
    assert sorted(map(repr, want)) == sorted(map(repr, brute(rows, 10, 3)))


def test_registered_query_covers_the_table(spark):
    from emporium.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = QUERIES["op13_bit_plane_clusters"](spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/embeddings.parquet").count()
    assert got.agg(F.sum("distance")).first()[0] == got.first().inertia
