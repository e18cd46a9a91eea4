import numpy as np
import pytest
import xxhash

from emporium.llm import simhash as H
from emporium.llm.components import components

LAST = 2**63 - 1


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


class Groups:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, n):
        while self.up[n] != n:
            n = self.up[n]
        return n

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def test_equals_brute_force(documents):
    df, rows = documents
    fps = [fingerprint(t) for _, t in rows]
    groups = Groups(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                groups.join(i, j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        r = groups.find(i)
        least[r] = min(least.get(r, LAST), LAST if doc_id is None else doc_id)
    want = [(d, f"{fps[i]:016x}", least[groups.find(i)] if least[groups.find(i)] != LAST else None)
            for i, (d, _) in enumerate(rows)]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in H.simhash_groups(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = H.drop_near_copies(df)
    assert kept.columns == df.columns and kept.count() == len(least)


@pytest.mark.parametrize("near", [0.0, 0.5, 0.95])
def test_no_link_is_lost(spark, near):
    """Fingerprints around few centres: chains of near ones, and buckets of many."""
    rng = np.random.default_rng(11)
    centres = rng.integers(0, 1 << 64, 5, np.uint64)
    fps = rng.integers(0, 1 << 64, 1_500, np.uint64)
    for i in np.flatnonzero(rng.random(1_500) < near):
        fps[i] = centres[rng.integers(5)]
        for bit in rng.integers(0, 64, rng.integers(0, 6)):
            fps[i] ^= np.uint64(1) << np.uint64(bit)
    fps = np.unique(fps)
    want = Groups(range(len(fps)))
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= 3):
            want.join(i, int(j))
    nodes = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").repartition(3)
    at = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    got = Groups(range(len(fps)))
    for r in H.near_links(nodes).collect():
        assert ((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 3
        got.join(at[r.a], at[r.b])
    assert [got.find(i) for i in range(len(fps))] == [want.find(i) for i in range(len(fps))]


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 299), (299, 298)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, **{i: 298 for i in range(298, 301)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table(no_documents):
    assert H.simhash_groups(no_documents).count() == 0
