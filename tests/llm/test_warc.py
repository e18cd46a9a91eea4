import base64
import glob
import gzip
import hashlib
import io
import random
import uuid

import duckdb
import pytest

from emporium.llm import warc as W

PAGES = "page_id long, url string, html string, digest string, salt int, problem string"


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def brute(rows):
    first = {}
    for i, (page, _, html) in enumerate(rows):
        key = (2**63 - 1 if page is None else page, i)
        first[html or ""] = min(first.get(html or "", key), key)
    out = []
    for i, (page, _, html) in enumerate(rows):
        payload = (html or "").encode()
        lead = first[html or ""]
        out.append((page, len(payload), digest(payload), "response" if lead[1] == i else "revisit",
                    None if lead[1] == i else rows[lead[1]][0]))
    return sorted(map(repr, out))


def some_pages():
    rng = random.Random(5)
    rows = [(i, f"http://a.example/{i}", "".join(rng.choices("<p>é \n\r0a;", k=rng.choice([0, 3, 50, 900, 4000]))))
            for i in range(150)]
    rows += [(1000 + i, None, "same page") for i in range(120)]  # a large group
    rows += [(None, "x\r\nWARC-Type: revisit", None), (None, None, ""), (None, None, "only here"), (7, "a b", "same page"),
             (7, "c", "same page"), (2000, None, "0\r\n\r\n" * 30_000), (2001, None, "0\r\n\r\n" * 30_000)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", 1, "p") for r in rows], PAGES).repartition(4)


def folder(tmp_path):
    return f"file:{tmp_path}/{uuid.uuid4().hex}"


def result(df):
    return sorted(repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in df.collect())


@pytest.mark.parametrize("segment, archive", [(16 << 10, 64 << 20), (300, 20_000)])
def test_round_trip_equals_brute_force(spark, tmp_path, segment, archive):
    rows, at = some_pages(), folder(tmp_path)
    got = W.archived_pages(frame(spark, rows), at, segment_bytes=segment, archive_bytes=archive)
    assert result(got) == brute(rows)
    assert got.filter("problem is not null").count() == 0
    files = glob.glob(at[5:] + "/*.warc.gz")
    records = sum(data.count(b"WARC/1.1\r\n") for data in (gzip.open(f).read() for f in files))
    assert records >= len(rows) + sum(len((h or "").encode()) // segment for h in {h for _, _, h in rows})
    if segment == 300:
        assert len(files) > 4


def test_smaller_payloads_are_never_revisits(spark, tmp_path):
    rows = [(1, None, "abc"), (2, None, "abc"), (3, None, "abcd"), (4, None, "abcd")]
    got = W.archived_pages(frame(spark, rows), folder(tmp_path), least_bytes=4)
    assert {(r.page_id, r.record_type, r.refers_to) for r in got.collect()} == {
        (1, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3)}


def test_empty_table_and_missing_url(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, html string")
    assert W.archived_pages(empty, folder(tmp_path)).collect() == []
    one = spark.createDataFrame([(1, "é")], "page_id long, html string")
    assert W.archived_pages(one, folder(tmp_path)).first().payload_bytes == 2


def test_files_of_failed_attempts_are_not_read(spark, tmp_path):
    at = folder(tmp_path)
    archives = W.write_archives(frame(spark, [(1, None, "a")]), at)
    with open(f"{at[5:]}/stray.warc.gz", "wb") as f:
        f.write(W.record("response", "x", {"X-Page-ID": 9}, W.HTTP + b"0\r\n\r\n"))
    assert [r.page_id for r in W.read_archives(archives).collect()] == [1]


def segmented(origin, block, size, **change):
    """The records of a segmented response, as (number, bytes); ``change`` maps numbers to None or other blocks."""
    cuts = list(range(0, len(block), size))
    for n, at in enumerate(cuts, 1):
        part = change.get(f"n{n}", block[at:at + size])
        if part is None:
            continue
        fields = {"WARC-Segment-Number": n}
        if n > 1:
            fields["WARC-Segment-Origin-ID"] = f"<urn:uuid:{origin}>"
        else:
            fields["X-Page-ID"] = 5
        if n == len(cuts):
            fields["WARC-Segment-Total-Length"] = change.get("total", len(block))
        yield W.record("response" if n == 1 else "continuation", origin if n == 1 else str(uuid.uuid4()), fields, part)


@pytest.mark.parametrize("change, problem", [
    ({}, None), ({"n3": None}, "segment 3 is missing"), ({"n1": None}, "segment 1 is missing"),
    ({"total": 7}, "bytes in segments that should hold 7"), ({"last": None}, "the last segment is missing"),
    ({"n2": b"zz"}, "no size|longer|CR|bytes|end")])
def test_broken_segments_are_told(spark, tmp_path, change, problem):
    block = W.HTTP + b"".join(W.chunked(b"payload " * 90, 50))
    if change == {"last": None}:
        change = {f"n{len(range(0, len(block), 100))}": None}
    parts = list(segmented("o", block, 100, **change))
    random.Random(1).shuffle(parts)  # any order, over two archives
    names = []
    for k in range(2):
        names.append((f"{tmp_path}/{k}.warc.gz",))
        with open(names[-1][0], "wb") as f:
            f.write(b"".join(parts[k::2]))
    rows = W.read_archives(spark.createDataFrame(names, "archive string")).collect()
    assert len(rows) == 1
    if problem is None:
        assert (rows[0].payload_bytes, rows[0].payload_digest) == (720, digest(b"payload " * 90))
    else:
        import re
        assert rows[0].payload_bytes is None and re.search(problem, rows[0].problem), rows[0]


def test_repeated_segment_dangling_revisit_and_bad_digest(spark, tmp_path):
    block = W.HTTP + b"".join(W.chunked(b"x" * 300))
    parts = list(segmented("o", block, 100))
    body = W.HTTP + b"1\r\na\r\n0\r\n\r\n"
    parts += [parts[1], W.record("revisit", "r", {"X-Page-ID": 6, "WARC-Refers-To": "<urn:uuid:none>"}, W.HTTP),
              W.record("response", "b", {"X-Page-ID": 7, "WARC-Payload-Digest": "sha1:" + "A" * 32}, body),
              W.record("warcinfo", "i", {}, b"software: none"), W.record("response", "p", {"X-Page-ID": 8}, b"HTTP/1.1 200 OK\r\n\r\nplain"),
              W.record("response", "c", {"X-Page-ID": 9}, W.HTTP + b"5\r\nabc")]
    name = f"{tmp_path}/a.warc.gz"
    with open(name, "wb") as f:
        f.write(b"".join(parts) + W.record("response", "t", {}, body)[:-30])
    rows = {(r.record_type, r.page_id): r for r in W.read_archives(spark.createDataFrame([(name,)], "archive string")).collect()}
    assert rows["response", 5].problem == "segment 2 is repeated"
    assert rows["revisit", 6].problem == "the record it refers to is missing"
    assert rows["response", 7].problem == "payload differs from its digest"
    assert rows["response", 8].payload_digest == digest(b"plain")
    assert rows["response", 9].problem == "chunked body without its end"
    assert rows["archive", None].problem and rows["archive", None].url == name
    assert len(rows) == 6


def test_decoder_takes_any_cut_extensions_and_trailers():
    raw = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: Chunked\r\n\r\n3;name=v\r\nabc\r\nA \r\n0123456789\r\n0\r\nTrailer: x\r\n\r\n"
    rng = random.Random(2)
    for _ in range(200):
        reader, at = W.PayloadReader(keep=True), 0
        while at < len(raw):
            n = rng.randint(1, 9)
            reader.feed(raw[at:at + n])
            at += n
        assert reader.finish() == (13, digest(b"abc0123456789")) and b"".join(reader.kept) == b"abc0123456789"
    for bad in (b"3\r\nabcd\r\n", b"x\r\n", b"3\nabc", b"0\r\n\r\nmore"):
        with pytest.raises(W.Framing):
            reader = W.PayloadReader()
            reader.feed(W.HTTP + bad)
            reader.finish()


def test_members_and_truncation(monkeypatch):
    data = W.record("response", "a", {}, b"x" * 100_000) + W.record("response", "b", {}, random.Random(3).randbytes(200_000))
    for cut, ids in ((len(data), "ab"), (len(data) - 50_000, "a"), (60, "")):
        seen = []
        try:
            for fields, block in W.read_records(io.BufferedReader(W.Inflated(io.BytesIO(data[:cut])), 1 << 20)):
                if sum(map(len, block)):
                    seen.append(fields["warc-record-id"][-2])
            assert cut == len(data)
        except W.Truncated:
            assert cut < len(data)
        assert "".join(seen) == ids


def test_a_long_block_is_read_in_pieces(monkeypatch):
    monkeypatch.setattr(W, "PIECE", 1000)
    block = bytes(range(256)) * 40
    data = gzip.decompress(W.record("response", "a", {}, block) + W.record("response", "b", {}, b""))
    seen = [[len(p) for p in pieces] for _, pieces in W.read_records(io.BytesIO(data))]
    assert seen == [[1000] * 10 + [240], []]
    skipped = [f["warc-record-id"] for f, _ in W.read_records(io.BytesIO(data))]
    assert skipped == ["<urn:uuid:a>", "<urn:uuid:b>"]


def test_sql_gives_the_same():
    rows = [r for r in some_pages() if len(r[2] or "") < 10_000]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    assert sorted(map(repr, con.execute(W.ORACLE).fetchall())) == brute(rows)
