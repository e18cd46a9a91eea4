import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from emporium.llm import induced as I
from emporium.llm import minimizer as M
from emporium.llm import rolling
from emporium.llm import suffix as S


def marks(pieces, depth):
    count = Counter(p[i:i + depth] for p in pieces for i in range(len(p) - depth + 1))
    return [[i + depth <= len(p) and count[p[i:i + depth]] > 1 for i in range(len(p))] for p in pieces]


def brute(rows, width):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (doc_id, _), text, starts in zip(rows, texts, marks(texts, width)):
        gone = np.zeros(len(text), bool)
        for i in np.flatnonzero(starts):
            gone[i:i + width] = True
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((doc_id, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(6))
def test_induced_sorting_finds_all_repeats(seed, monkeypatch):
    """Small alphabets, several ranges of names, and queues that spill at once."""
    rng = random.Random(seed)
    for _ in range(60):
        monkeypatch.setattr(I, "RANGES", rng.choice([64, 4, 2]))
        monkeypatch.setattr(I, "PIECE", rng.choice([1 << 20, 7]))
        monkeypatch.setattr(I, "IN_MEMORY", rng.choice([1 << 20, 10]))
        letters = rng.choice([b"ab", b"abc", bytes(range(256)), b"a"])
        pieces = [bytes(rng.choice(letters) for _ in range(rng.randint(0, 70))) for _ in range(rng.randint(1, 8))]
        pieces.append(pieces[0][3:20] + b"xyz" + pieces[-1])
        depth = rng.randint(1, 12)
        want = [x for p in marks(pieces, depth) for x in [*p, False]]
        assert I.repeated_starts(pieces, depth, memory=rng.choice([1 << 20, 60])).tolist() == want


def test_seeds_are_in_suffix_order(tmpdir_path):
    rng = random.Random(9)
    words = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    text = np.frombuffer(b" ".join(rng.choice(words) for _ in range(4_000)), np.uint8).astype(np.uint16) + 2
    text = np.append(text, 0).astype(np.uint16)
    order = I.Inducer(text, tmpdir_path, 1 << 12, 50).sorted_seeds().tolist()
    raw = text.astype(">u2").tobytes()
    assert order == sorted(order, key=lambda p: raw[2 * p:])


def test_equal_windows_meet_under_one_key():
    rng = random.Random(4)
    base = bytes(rng.choice(b"abcdef ") for _ in range(900))
    texts = [base, b"x" * 77 + base[100:800] + b"y" * 300, b"of " * 400, b"", b"short"]
    lane = rolling.Hasher(1)
    occurrences, key, text, start, windows = M.segments(texts, 400, lane)
    found = {}
    for k, t, s, n in zip(key.tolist(), text.tolist(), start.tolist(), windows.tolist()):
        for i in range(s, s + n):
            assert found.setdefault(texts[t][i:i + 400], k) == k
    assert len(found) == len({t[i:i + 400] for t in texts for i in range(len(t) - 399)})
    assert windows.sum() == sum(max(0, len(t) - 399) for t in texts)
    x = np.array([5, 3, 9, 1, 4, 4, 8, 2], np.uint64)
    assert M.sliding_min(x, 3).tolist() == [3, 1, 1, 1, 4, 2]


@pytest.mark.parametrize("bits", [22, 9])
def test_equals_brute_force(documents, bits):
    df, rows = documents
    assert rows_of(S.remove_repeated_bytes(df, bits=bits)) == brute(rows, 400)


def test_long_texts_come_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(rolling, "SLICE", 2_000)
    rng = random.Random(6)
    text = bytes(rng.choice(b"abcdefgh ") for _ in range(9_000))
    seen = Counter()
    for part, row, offset in S.pieces([text, b"small"], 400):
        _, _, t, start, windows = M.segments(part, 400, S.LANE)
        for a, s, n in zip(t.tolist(), start.tolist(), windows.tolist()):
            seen.update((int(row[a]), s + int(offset[a]) + i) for i in range(n))
    assert seen == Counter((0, i) for i in range(9_000 - 399))


def test_an_empty_text_before_a_text_of_several_slices():
    rng = np.random.default_rng(3)
    text = rng.integers(97, 123, 5 << 20, np.uint8).tobytes()
    passage = text[(9 << 19):(9 << 19) + 3_000]  # beyond the places that a slice can number
    keys = []
    for texts in ([b"", text], [passage]):
        found = {}
        for part, row, offset in S.pieces(texts, 400):
            assert sum(map(len, part)) <= rolling.SLICE + 399
            _, key, t, start, windows = M.segments(part, 400, S.LANE)
            for k, a, s, n in zip(key.tolist(), t.tolist(), start.tolist(), windows.tolist()):
                if len(texts) == 1 or s + n + int(offset[a]) > 9 << 19 and s + int(offset[a]) < (9 << 19) + 2_601:
                    found.update((int(offset[a]) + s + i, k) for i in range(n))
        keys.append(found)
    assert [keys[0][(9 << 19) + i] for i in range(2_601)] == [keys[1][i] for i in range(2_601)]
    with pytest.raises(ValueError):
        M.segments([text], 400, S.LANE)


def test_a_passage_shared_by_many_documents_is_split(spark, monkeypatch):
    """Each document has its own text on either side of the passage, so its segments differ."""
    rng = random.Random(12)
    letters = "abcdefghij "
    passage = "".join(rng.choice(letters) for _ in range(450))
    rows = [(i, "".join(rng.choice(letters) for _ in range(500)) + passage[i % 7:] + "".join(
        rng.choice(letters) for _ in range(500))) for i in range(150)]
    rows += [(200 + i, rows[i][1][:700]) for i in range(40)] + [(300, "of " * 2_000), (301, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    texts = df.selectExpr("coalesce(text, '') text", "doc_id rank", "xxhash64(text) text_key")

    def largest(limit):
        kept = S.split_segments(texts, 400, 16, limit)
        return kept.groupBy("key").agg({"size": "sum", "data": "min"}).selectExpr("max(`sum(size)`)").first()[0]

    assert largest(1 << 40) > 60_000 and largest(8_000) <= 8_000
    assert S.repeated_runs(df, 400, 16).count() < 2 * len(rows)
    monkeypatch.setattr(S, "KEY_BYTES", 8_000)
    assert rows_of(S.remove_repeated_bytes(df, bits=16)) == brute(rows, 400)
    monkeypatch.setattr(S, "KEY_BYTES", 0)  # all keys, down to whole windows
    assert rows_of(S.remove_repeated_bytes(df, bits=16)) == brute(rows, 400)


@pytest.mark.parametrize("case", ["footer", "near copies"])
def test_rows_a_document_stay_level_when_keys_are_split(spark, case, monkeypatch):
    """Four times the documents, far above the size at which a key is split."""
    monkeypatch.setattr(S, "KEY_BYTES", 60_000)
    rng = random.Random(21)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(900)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = text(170)

    def document() -> str:
        if case == "footer":
            return text(60) + base
        near = base.split()
        for _ in range(3):
            near[rng.randrange(len(near))] = rng.choice(words)
        return " ".join(near)

    rate = []
    for n in (250, 1_000):
        rows = [(i, document()) for i in range(n)]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        rate.append(S.repeated_runs(df, 400, 20).count() / n)
        if n == 250:
            assert rows_of(S.remove_repeated_bytes(df, bits=20)) == brute(rows, 400)
    assert rate[1] <= 1.5 * rate[0] and rate[1] < 8, rate


def test_trimming_keeps_all_windows_that_repeat(spark):
    rng = random.Random(8)
    shared = bytes(rng.choice(b"abcdef ") for _ in range(700))
    data = [bytes(rng.choice(b"abcdef ") for _ in range(300)) + bytes([200 + i]) + shared + b"z" * (i % 3) for i in range(20)]
    rows = [(7, len(d), d, S.squeeze(np.array([i]), np.array([5]), np.array([10]))) for i, d in enumerate(data)]
    got = S.trimmed_segments(spark.createDataFrame(rows, S.SEGMENT).repartition(2), 400, 25).collect()
    places = {(int(r), int(at), g.data) for g in got for r, _, at in zip(*S.expand(g.places))}
    assert {g.key for g in got} == {7} and len({g.data for g in got}) <= 3
    for i, d in enumerate(data):
        assert any(r == i and at == 311 and x.startswith(shared) for r, at, x in places)


def test_touching_runs_are_joined():
    runs = np.array([(1, 5, 0, 10), (2, 5, 3, 4), (1, 5, 10, 2), (1, 6, 12, 1), (1, 5, 0, 10), (1, 5, 13, 1)]).T
    got = set(zip(*(c.tolist() for c in S.joined_runs(*runs))))
    assert got == {(1, 5, 0, 12), (1, 5, 13, 1), (1, 6, 12, 1), (2, 5, 3, 4)}


def test_a_sort_takes_no_more_than_its_bytes(spark, documents, monkeypatch, tmpdir_path):
    """One shard far above the bound is sorted in parts that end with a key."""
    monkeypatch.setattr(S, "SORT_BYTES", 20_000)
    monkeypatch.setattr(S, "KEY_BYTES", 10_000)
    df, rows = documents
    log = f"{tmpdir_path}/sorted"
    plain = S.Shard.read

    def read(self, taken):
        taken = list(taken)
        with open(log, "a") as f:
            f.write(f"{sum(len(d) + len(p) for k, d, p in taken if k != taken[-1][0])} {len({k for k, _, _ in taken})}\n")
        return plain(self, iter(taken))

    kept = S.split_segments(df.selectExpr("coalesce(text, '') text", "coalesce(doc_id, 0) rank",
                                           "xxhash64(text) text_key"), 400, 22, 10_000)
    taken = [(0, *r) for r in kept.select("key", "data", "places").orderBy("key", "data").collect()]
    assert sum(len(d) for _, _, d, _ in taken) > 60_000
    monkeypatch.setattr(S.Shard, "read", read)
    assert sum(len(r[0]) for r in S.sorted_runs(iter(taken), 400, 20_000)) > 0
    sizes = [tuple(map(int, x.split())) for x in open(log)]
    assert len(sizes) > 2 and all(size < 20_000 for size, _ in sizes)
    assert sum(n for _, n in sizes) == len({k for _, k, _, _ in taken})
    assert rows_of(S.remove_repeated_bytes(df, bits=22)) == brute(rows, 400)


def test_cut_texts_stay_valid_and_keep_columns(spark, documents):
    passage = "é" * 30 + "".join(random.Random(1).choice("abcdefghij ") for _ in range(420))
    rows = [(1, "ü" + passage + "end", "k", 9), (2, passage[1:] + "ö", "k", 9), (3, None, "k", 9), (4, "plain", None, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, n_chars long")
    got = {r.doc_id: r for r in S.cut_repeated_bytes(df).collect()}
    assert S.cut_repeated_bytes(df).columns == df.columns
    assert got[1].text == "üéend" and got[1].n_chars == 5
    assert got[2].text == "ö" and got[3].text is None and got[4].text == "plain" and got[4].n_chars == 9


def test_columns_with_the_names_used_inside_survive(spark):
    text = "".join(random.Random(2).choice("abcdefghij ") for _ in range(500))
    df = spark.createDataFrame([(1, text, 1, 2, "s", "c"), (2, text + "x", 3, 4, "s", "c")],
                               "doc_id long, text string, rank int, text_key int, starts string, counts string")
    got = {r.doc_id: tuple(r)[1:] for r in S.cut_repeated_bytes(df).collect()}
    assert got == {1: ("", 1, 2, "s", "c"), 2: ("x", 3, 4, "s", "c")}


def test_empty_table(no_documents):
    assert S.remove_repeated_bytes(no_documents).count() == 0
    assert S.cut_repeated_bytes(no_documents).count() == 0


def test_only_windows_that_may_repeat_are_sorted(monkeypatch):
    """Segments of one key share a passage; the rest of each occurs once and is not sorted."""
    rng = random.Random(31)
    text = lambda n: bytes(rng.choice(b"abcdefghij ") for _ in range(n))
    shared = text(700)
    data = sorted(text(600) + shared + text(600) for _ in range(12)) + [b"of " * 300]
    rows = [(0, 1 + (d[:3] == b"of "), d, S.squeeze(*np.array([[i], [9], [40]]))) for i, d in enumerate(data)]
    rows += [(0, 3, shared, S.squeeze(*np.array([[50, 150], [9, 9], [5, 7]])))]
    other = text(901)
    rows += [(0, 4, other[:900], S.squeeze(*np.array([list(range(200, 300)), [9] * 100, [0] * 100])))]
    rows += [(0, 4, other, S.squeeze(*np.array([[400], [9], [0]])))]
    taken = []
    monkeypatch.setattr(S, "repeated_starts", lambda pieces, width: I.repeated_starts(taken.append(list(pieces)) or taken[-1], width))
    got = {(r, at + i) for run in S.sorted_runs(iter(rows), 400, 1 << 20) for r, _, at, n in zip(*(c.tolist() for c in run))
           for i in range(n)}
    want = set()
    for key in (1, 2, 4):
        mine = [(d, S.expand(p)) for _, k, d, p in rows if k == key]
        count = Counter(d[i:i + 400] for d, (rank, _, _) in mine for i in range(len(d) - 399) for _ in rank)
        want |= {(int(r), int(at) + i) for d, (rank, _, start) in mine for r, at in zip(rank, start)
                 for i in range(len(d) - 399) if count[d[i:i + 400]] > 1}
    want |= {(r, at + i) for r, at in ((50, 5), (150, 7)) for i in range(301)}
    assert got == want
    assert sum(map(len, taken[0])) < 12 * 710 + 1_200 + 2 * 910  # of 12 * 1,900 and those


def test_common_prefixes_of_seeds_equal_a_plain_comparison(tmpdir_path):
    rng = random.Random(17)
    for depth in (1, 7, 40, 400):
        for letters in (b"ab", b"abcdefgh", b"a"):
            base = bytes(rng.choice(letters) for _ in range(600))
            raw = b"".join(rng.choice([base, base[:300], base[17:500]]) + bytes([rng.choice(letters)]) * rng.randint(0, 9)
                           for _ in range(6))
            text = np.append(np.frombuffer(raw, np.uint8).astype(np.uint16) + 2, 0).astype(np.uint16)
            order = I.Inducer(text, tmpdir_path, 1 << 20, depth).sorted_seeds()
            want = [0] + [next((i for i in range(depth) if text[a + i] != text[b + i]), depth)
                          for a, b in zip(order[:-1].tolist(), order[1:].tolist())]
            assert I.common_prefixes(text, order, depth).tolist() == want[:len(order)]


def test_hashes_of_all_strings_are_those_of_spans():
    buf = np.frombuffer(b"of the " * 90 + b"x", np.uint8)
    at = np.arange(len(buf) - 49)
    lane = rolling.Hasher(3)
    assert (lane.every(buf, 50) == lane.spans(buf, at, at + 50)).all() and not len(lane.every(buf[:9], 50))
