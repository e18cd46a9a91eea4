"""WARC archives: written with segmented records, read back by reassembly.

Writing: each page is a record, gzipped on its own. Of pages with equal payloads the one with the smallest id is
a response and the others revisit it. A response's block is an HTTP message with a chunked body; a block longer than
a segment goes on in continuation records that name their origin, count up, and end with the total length. Tasks roll
over to a new archive when one is full, so segments of a record may lie in several archives.

Reading: whole records are decoded where they are read. Segments are grouped by their origin and sorted by number;
each record is then decoded as a stream: the numbers must have no gap, the lengths must add up to the total, and
the chunked framing must end. At last revisits are joined to the record they refer to. Groups are salted:
any share of the pages may have one payload. A task holds one piece of a record, whatever its length.

Archives are named by the rows that their tasks return, so what a lost or repeated task leaves behind is not read.

Defined cases: null html is the empty payload; a null ``page_id`` ranks last and stays null; repeated rows are records
of their own, one of them the response; equal ids with other payloads are told apart; an empty table gives
no rows and no archives; extra columns are ignored. A record that can't be read has null payload columns and a ``problem``.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LAST_ID, drop_table, materialize, rank_id, scratch_path, text_bytes, to_batch

SALTS = 32  # parts of a group of equal payloads
PIECE = 1 << 20  # bytes of a record that are held at a time
CHUNK = 8192
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
MANIFEST = "archive string, records long, bytes long"
READ = "record_id string, record_type string, page_id long, url string, refers_to_id string, payload_bytes long, " \
       "payload_digest string, problem string"
SEGMENT = "origin string, number long, part long, total long, data binary, size long"


def base32_digest(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunked(payload: bytes, size: int = CHUNK) -> Iterator[bytes]:
    """The payload in chunked transfer framing."""
    for at in range(0, len(payload), size):
        part = payload[at:at + size]
        yield b"%x\r\n" % len(part)
        yield part
        yield b"\r\n"
    yield b"0\r\n\r\n"


class Framing(ValueError):
    """Bytes that are no HTTP message or no chunked body."""


class ChunkedDecoder:
    """Takes the framing off a body that comes in pieces cut anywhere."""

    def __init__(self):
        self.line = b""
        self.state = "size"  # size, data, end of data, trailer, done
        self.left = 0

    def feed(self, data: bytes) -> Iterator[bytes]:
        at = 0
        while at < len(data):
            if self.state == "done":
                raise Framing("bytes after the last chunk")
            if self.state == "data":
                part = data[at:at + self.left]
                yield part
                at += len(part)
                self.left -= len(part)
                if not self.left:
                    self.state = "end of data"
                continue
            end = data.find(b"\n", at)
            self.line += data[at:] if end < 0 else data[at:end + 1]
            if len(self.line) > 65_536:
                raise Framing("a line of chunked framing has no end")
            if end < 0:
                return
            at = end + 1
            self._line(self.line)
            self.line = b""

    def _line(self, line: bytes) -> None:
        if not line.endswith(b"\r\n"):
            raise Framing("a line of chunked framing ends without CR")
        line = line[:-2]
        if self.state == "end of data":
            if line:
                raise Framing("a chunk is longer than its size")
            self.state = "size"
        elif self.state == "trailer":
            if not line:
                self.state = "done"
        else:
            size = line.split(b";", 1)[0].strip()  # extensions follow a semicolon
            if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
                raise Framing("a chunk has no size")
            self.left = int(size, 16)
            self.state = "data" if self.left else "trailer"

    def finish(self) -> None:
        if self.state != "done":
            raise Framing("chunked body without its end")


class PayloadReader:
    """Digest and length of the payload of an HTTP message that comes in pieces; the payload too if kept."""

    def __init__(self, keep: bool = False):
        self.head = b""
        self.body: ChunkedDecoder | None = None
        self.in_body = False
        self.digest, self.size = hashlib.sha1(), 0
        self.kept: list[bytes] | None = [] if keep else None

    def feed(self, data: bytes) -> None:
        if not self.in_body:
            self.head += data
            end = self.head.find(b"\r\n\r\n")
            if end < 0:
                if len(self.head) > PIECE:
                    raise Framing("no end of the HTTP headers")
                return
            head, data = self.head[:end], self.head[end + 4:]
            self.in_body, self.head = True, b""
            codings = [v.strip().lower() for line in head.split(b"\r\n")[1:] for k, _, v in [line.partition(b":")]
                       if k.strip().lower() == b"transfer-encoding"]
            if codings:
                if codings != [b"chunked"]:
                    raise Framing("unknown transfer coding")
                self.body = ChunkedDecoder()
        for part in self.body.feed(data) if self.body else [data]:
            self.digest.update(part)
            self.size += len(part)
            if self.kept is not None:
                self.kept.append(part)

    def finish(self) -> tuple[int, str]:
        if not self.in_body:
            raise Framing("no end of the HTTP headers")
        if self.body:
            self.body.finish()
        return self.size, base32_digest(self.digest.digest())


# --- writing --------------------------------------------------------------------
def open_folder(path: str):
    """``(file system, folder)`` of a path or URI, made if it is not there; for tasks."""
    from pyarrow import fs

    found, folder = fs.FileSystem.from_uri(path) if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) else (
        fs.LocalFileSystem(), path)
    found.create_dir(folder, recursive=True)
    return found, folder


def record(kind: str, record_id: str, fields: dict[str, object], block: bytes) -> bytes:
    """One gzipped record."""
    lines = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{record_id}>", **fields, "Content-Length": len(block)}
    head = "".join(f"{k}: {v}\r\n" for k, v in lines.items() if v is not None)
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + z.flush()


def as_uri(url: str | None) -> str | None:
    """A header value: no control characters."""
    return None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def page_records(page_id: int | None, url: str | None, payload: bytes, digest: bytes, record_id: str,
                 first_id: str, date: str, segment: int) -> Iterator[bytes]:
    """The records of a page: a revisit, or a response with its continuations."""
    fields = {"WARC-Date": date, "WARC-Target-URI": as_uri(url), "X-Page-ID": page_id,
              "WARC-Payload-Digest": "sha1:" + base32_digest(digest), "Content-Type": "application/http;msgtype=response"}
    if record_id != first_id:
        yield record("revisit", record_id, {**fields, "WARC-Profile": REVISIT,
                                            "WARC-Refers-To": f"<urn:uuid:{first_id}>"}, HTTP)
        return
    block = HTTP + b"".join(chunked(payload))
    if len(block) <= segment:
        yield record("response", record_id, fields, block)
        return
    yield record("response", record_id, {**fields, "WARC-Segment-Number": 1}, block[:segment])
    for number, at in enumerate(range(segment, len(block), segment), 2):
        last = {"WARC-Segment-Total-Length": len(block)} if at + segment >= len(block) else {}
        yield record("continuation", str(uuid.uuid4()),
                     {"WARC-Date": date, "WARC-Target-URI": as_uri(url),
                      "WARC-Segment-Origin-ID": f"<urn:uuid:{record_id}>", "WARC-Segment-Number": number, **last},
                     block[at:at + segment])


def salt(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SALTS))


def with_first(pages: DataFrame, least_bytes: int) -> DataFrame:
    """The pages with ``first_id``, the record id of the page that has the same payload and the smallest id.

    The groups are cut by a salt, so no key holds more than a part of the copies."""
    of_salt = (pages.withColumn("salt", salt(F.col("record_id"))).groupBy("digest", "salt")
               .agg(F.min(F.struct(rank_id(F.col("page_id")).alias("rank"), F.col("record_id"))).alias("first")))
    of_all = of_salt.groupBy("digest").agg(F.min("first").alias("first"))
    dealt = (of_salt.select("digest", "salt").join(of_all, "digest")
             .select("digest", "salt", F.col("first.record_id").alias("first_id")))
    found = pages.withColumn("salt", salt(F.col("record_id"))).join(dealt, ["digest", "salt"]).drop("salt")
    small = F.octet_length("html") < least_bytes
    return found.withColumn("first_id", F.when(small, F.col("record_id")).otherwise(F.col("first_id")))


def write_archives(pages: DataFrame, folder: str, segment_bytes: int = 16 << 10, archive_bytes: int = 64 << 20,
                   least_bytes: int = 0) -> DataFrame:
    """Write the pages ``(page_id, url, html)`` as archives in ``folder`` (shared by all executors).

    Returns the archives written: ``archive, records, bytes``. Payloads of fewer than ``least_bytes`` bytes
    are never revisits."""
    spark = pages.sparkSession
    landed = materialize(
        pages.select(F.col("page_id").cast("long").alias("page_id"),
                     (F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")).alias("url"),
                     F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
        .withColumns({"digest": F.unhex(F.sha1("html")), "record_id": F.expr("uuid()")}), "warc-pages")
    schema = spark.createDataFrame([], MANIFEST).schema
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, records, size = None, None, 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return to_batch(schema, {"archive": [name], "records": [records], "bytes": [size]})

        for batch in batches:
            pages = zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5)), text_bytes(batch.column(2)))
            for page_id, url, digest, record_id, first_id, payload in pages:
                for data in page_records(page_id, url, payload, digest, record_id, first_id, date, segment_bytes):
                    if out is None:
                        files, at = open_folder(folder)
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out, records, size = files.open_output_stream(f"{at}/{name}", compression=None), 0, 0
                    out.write(data)
                    records += 1
                    size += len(data)
                    if size >= archive_bytes:
                        yield done()
                        out = None
        if out is not None:
            yield done()

    rows = with_first(landed, least_bytes).select("page_id", "url", "html", "digest", "record_id", "first_id")
    manifest = materialize(rows.mapInArrow(run, schema), "warc-manifest")
    drop_table(landed)
    return manifest.withColumn("archive", F.concat(F.lit(folder.rstrip("/") + "/"), "archive"))


# --- reading --------------------------------------------------------------------
class Truncated(ValueError):
    """An archive that ends inside a record."""


class Inflated(io.RawIOBase):
    """The bytes of gzip members that follow each other; all that came before a fault is read first."""

    def __init__(self, raw):
        self.raw, self.z = raw, None

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        out = b""
        while not out:
            if self.z is None or self.z.eof:
                data = (self.z.unused_data if self.z else b"") or self.raw.read(1 << 16)
                if not data:
                    return 0
                self.z = zlib.decompressobj(31)
            else:
                data = self.z.unconsumed_tail or self.raw.read(1 << 16)
            out = self.z.decompress(data, len(buffer))
            if not data and not out and not self.z.eof:
                raise Truncated("archive ends inside a compressed record")
        buffer[:len(out)] = out
        return len(out)


def read_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], Iterator[bytes]]]:
    """``(fields, pieces of the block)`` of each record; names of fields in lower case."""
    while line := stream.readline(PIECE):
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise Framing("no WARC record where one should begin")
        fields: dict[str, str] = {}
        while (line := stream.readline(PIECE)) not in (b"\r\n", b"\n"):
            if not line.endswith(b"\n"):
                raise Truncated("archive ends inside a header")
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        if not fields.get("content-length", "").isdigit():
            raise Framing("a record without its length")
        left = [int(fields["content-length"])]

        def pieces() -> Iterator[bytes]:
            while left[0]:
                part = stream.read(min(PIECE, left[0]))
                if not part:
                    raise Truncated("archive ends inside a block")
                left[0] -= len(part)
                yield part

        yield fields, pieces()
        while left[0]:  # what the reader left
            next(iter(pieces()))


def bare(record_id: str | None) -> str | None:
    return None if record_id is None else record_id.strip("<>")


def number(text: str | None) -> int | None:
    return int(text) if text is not None and re.fullmatch(r"-?[0-9]{1,18}", text) else None


def facts(fields: dict[str, str]) -> dict[str, object]:
    """The columns of a record that its header gives."""
    return {"record_id": bare(fields.get("warc-record-id")), "record_type": fields.get("warc-type"),
            "page_id": number(fields.get("x-page-id")), "url": fields.get("warc-target-uri"),
            "refers_to_id": bare(fields.get("warc-refers-to")), "declared": fields.get("warc-payload-digest")}


def checked(row: dict, size: int, digest: str) -> dict:
    """The row with its payload, or with a problem if the header names another digest."""
    declared = row.get("declared")
    if declared is not None and declared.lower().startswith("sha1:") and declared[5:].upper() != digest:
        return {**row, "problem": "payload differs from its digest"}
    return {**row, "payload_bytes": size, "payload_digest": digest}


def scan_archives(archives: DataFrame) -> DataFrame:
    """Every record of the archives: whole ones decoded, segments as rows of at most ``PIECE`` bytes."""
    spark = archives.sparkSession
    schema = spark.createDataFrame([], f"{READ}, declared string, {SEGMENT}").schema
    names = [f.name for f in schema]

    def rows_of(fields: dict[str, str], block: Iterator[bytes]) -> Iterator[dict]:
        kind, row = fields.get("warc-type"), facts(fields)
        segment = fields.get("warc-segment-number")
        if kind == "continuation" or segment is not None:
            origin = bare(fields.get("warc-segment-origin-id")) if kind == "continuation" else row["record_id"]
            place = {"origin": origin, "number": number(segment),
                     "total": number(fields.get("warc-segment-total-length"))}
            if origin is None or place["number"] is None:
                yield {**row, "problem": "a segment without origin or number"}
                return
            part = -1
            for part, data in enumerate(block):
                yield {**row, **place, "part": part, "data": data, "size": len(data)}
            if part < 0:
                yield {**row, **place, "part": 0, "data": b"", "size": 0}
        elif kind == "revisit":
            yield row
        elif kind == "response":
            reader = PayloadReader()
            try:
                for data in block:
                    reader.feed(data)
                yield checked(row, *reader.finish())
            except Framing as e:
                yield {**row, "problem": str(e)}

    def records(name: str) -> Iterator[dict]:
        files, path = _file(name)
        with files.open_input_stream(path, compression=None) as raw:
            stream = io.BufferedReader(Inflated(raw) if name.endswith(".gz") else raw, PIECE)
            try:
                for fields, block in read_records(stream):
                    yield from rows_of(fields, block)
            except (Framing, Truncated, zlib.error) as e:
                yield {"record_type": "archive", "url": name, "problem": str(e)}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for name in batch.column(0).to_pylist():
                for row in records(name):
                    held.append(row)
                    size += 500 + (row.get("size") or 0)
                    if size >= 8 << 20:
                        yield to_batch(schema, {c: [r.get(c) for r in held] for c in names})
                        held, size = [], 0
        if held:
            yield to_batch(schema, {c: [r.get(c) for r in held] for c in names})

    dealt = archives.select("archive").repartition(max(1, archives.count()))  # an archive is a task
    return materialize(dealt.mapInArrow(run, schema), "warc-records")


def _file(name: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(name) if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", name) else (fs.LocalFileSystem(), name)


class Assembly:
    """One segmented record, fed with its pieces in order of segment number."""

    def __init__(self, with_payload: bool = False):
        self.row: dict | None = None
        self.reader = PayloadReader(with_payload)
        self.number, self.part, self.length, self.total = 0, 0, 0, None
        self.problem: str | None = None

    def add(self, row: dict) -> None:
        if self.row is None:
            self.row = row
        if self.problem:
            return
        try:
            self._add(row)
        except Framing as e:
            self.problem = str(e)

    def _add(self, row: dict) -> None:
        if row["number"] == self.number + 1 and row["part"] == 0:
            if self.total is not None:
                raise Framing("segments after the last one")
            self.number, self.part = row["number"], 0
        elif row["number"] == self.number and row["part"] == self.part + 1:
            self.part += 1
        elif row["number"] <= self.number:
            raise Framing(f"segment {row['number']} is repeated")
        else:
            raise Framing(f"segment {self.number + 1} is missing")
        if row["number"] == 1 and row["record_type"] == "continuation":
            raise Framing("the first segment is a continuation")
        if row["total"] is not None:
            self.total = row["total"]
        self.length += len(row["data"])
        self.reader.feed(row["data"])

    def result(self) -> dict:
        row = {k: self.row[k] for k in ("record_id", "record_type", "page_id", "url", "refers_to_id", "declared")}
        if self.row["record_type"] == "continuation":
            row |= {"record_id": self.row["origin"], "page_id": None}
        problem = self.problem
        if problem is None and self.total is None:
            problem = "the last segment is missing"
        if problem is None and self.total != self.length:
            problem = f"{self.length} bytes in segments that should hold {self.total}"
        if problem is None:
            try:
                return checked(row, *self.reader.finish())
            except Framing as e:
                problem = str(e)
        return {**row, "problem": problem}


def assemble(rows: Iterable[dict]) -> Iterator[dict]:
    """Records of the pieces, which come sorted by origin, segment number and part."""
    found: Assembly | None = None
    origin = None
    for row in rows:
        if found is None or row["origin"] != origin:
            if found is not None:
                yield found.result()
            found, origin = Assembly(), row["origin"]
        found.add(row)
    if found is not None:
        yield found.result()


def reassembled(segments: DataFrame, target_bytes: int = 32 << 20) -> DataFrame:
    """Segmented records put together: grouped by origin, sorted by number, decoded as streams."""
    schema = segments.sparkSession.createDataFrame([], READ).schema
    names = [f.name for f in schema]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for row in assemble(r for b in batches for r in b.to_pylist()):
            held.append(row)
            if len(held) >= 10_000:
                yield to_batch(schema, {c: [r.get(c) for r in held] for c in names})
                held = []
        if held:
            yield to_batch(schema, {c: [r.get(c) for r in held] for c in names})

    size = segments.agg(F.sum("size")).first()[0] or 0
    dealt = segments.select("origin", "number", "part", "total", "data", "record_id", "record_type", "page_id", "url",
                            "refers_to_id", "declared")
    return (dealt.repartition(max(1, int(size) // target_bytes), "origin")
            .sortWithinPartitions("origin", "number", "part").mapInArrow(run, schema))


def read_archives(archives: DataFrame) -> DataFrame:
    """One row per response and revisit of the archives (column ``archive``), with what can't be read as well.

    ``record_id, record_type, page_id, url, payload_bytes, payload_digest, refers_to, refers_to_id, problem``; a revisit has the
    payload of the record it refers to."""
    records = scan_archives(archives)
    segments = records.filter(F.col("origin").isNotNull())
    fields = [F.col(c.split()[0]) for c in READ.split(", ")]
    whole = records.filter(F.col("origin").isNull())
    found = materialize(whole.filter(~F.col("record_type").eqNullSafe("revisit")).select(fields)
                        .unionByName(reassembled(segments)), "warc-responses")
    revisits = (whole.filter("record_type = 'revisit'").select(*fields, "declared")
                .withColumn("salt", salt(F.col("record_id"))))
    targets = found.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("bytes"),
        F.col("payload_digest").alias("digest"), F.lit(True).alias("there"))
    dealt = revisits.select("refers_to_id", "salt").distinct().join(targets, "refers_to_id")
    joined = revisits.join(dealt, ["refers_to_id", "salt"], "left")
    same = F.col("declared").isNull() | (F.upper("declared") == F.concat(F.lit("SHA1:"), F.col("digest")))
    resolved = joined.select(
        "record_id", "record_type", "page_id", "url", F.when(same, F.col("bytes")).alias("payload_bytes"),
        F.when(same, F.col("digest")).alias("payload_digest"), "refers_to", "refers_to_id",
        F.when(F.col("there").isNull(), F.lit("the record it refers to is missing"))
        .when(F.col("digest").isNull(), F.lit("the record it refers to can't be read"))
        .when(~same, F.lit("payload differs from its digest")).alias("problem"))
    return resolved.unionByName(found.withColumn("refers_to", F.lit(None).cast("long")).select(resolved.columns))


def archived_pages(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write the pages as archives, read the archives back: one row per page."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, **options)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "problem")


# Five hex digits of a digest are four base-32 digits.
_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || h[{5 * i + 1}:{5 * i + 5}] AS BIGINT)"
                      f" >> {s}) & 31), 1)" for i in range(8) for s in (15, 10, 5, 0))
ORACLE = f"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT *, sha1(t) AS h, first_value(r) OVER w AS first, first_value(page_id) OVER w AS first_page FROM p
      WINDOW w AS (PARTITION BY t ORDER BY coalesce(page_id, {LAST_ID}), r))
SELECT page_id, octet_length(encode(t)) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN r = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN r <> first THEN first_page END AS refers_to
FROM d
"""
