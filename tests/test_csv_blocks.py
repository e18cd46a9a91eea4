"""Quoted newlines read by many tasks, against the one-task read."""
import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from emporium.schema import SOURCE_COLUMNS
from emporium.sources import csv_blocks as B
from emporium.sources import csv_source as CS

HEAD = SOURCE_COLUMNS["order_reviews"]


def field(rng):
    kind = rng.randrange(9)
    if kind == 0:
        return ""
    if kind == 1:
        return "".join(rng.choice('a",\n é') for _ in range(rng.randint(0, 12)))
    if kind == 2:
        return "line\n" * rng.randint(1, 40)
    if kind == 3:
        return '"' * rng.randint(1, 4)
    if kind == 4:
        return rng.choice(["NULL", "nan", " x ", "\n", ","])
    return "word " * rng.randint(0, 5)


def text_of(rng, n, end="\n", quoting=csv.QUOTE_MINIMAL, last_newline=True):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end, quoting=quoting)
    w.writerow(HEAD)
    for i in range(n):
        w.writerow([f"r{i}", f"o{i % 7}", str(i % 5), field(rng), field(rng), "2018-01-01 00:00:00", "x"])
        if i % 50 == 49:
            out.write(end)  # an empty line
    s = out.getvalue()
    return s if last_newline else s.rstrip("\r\n")


@pytest.fixture()
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write(path, text):
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)
    return str(path)


def read(spark, path, multiline, name="order_reviews"):
    df = CS.read_csv_source(spark, name, path, multiline)
    rows = df.withColumn("src_ord", F.struct("src_ord.file", (F.col("src_ord.row") % F.lit(2**33)).alias("row"))).collect()
    return sorted(rows, key=lambda r: (r.src_ord.file, r.src_ord.row))


@pytest.mark.parametrize("seed", range(4))
def test_rows_and_order_equal_the_one_task_read(spark, small_blocks, tmp_path, seed):
    rng = random.Random(seed)
    text = text_of(rng, 160, quoting=[csv.QUOTE_MINIMAL, csv.QUOTE_ALL][seed % 2], last_newline=seed != 2)
    path = write(tmp_path / "order_reviews.csv", text)
    one, many = read(spark, path, True), read(spark, path, "blocks")
    assert len(one) == 160 and [tuple(r)[:-1] for r in one] == [tuple(r)[:-1] for r in many]
    assert [r.src_ord.row for r in many] == sorted(r.src_ord.row for r in many)
    blocks = B.block_table(B._lines(spark, path))
    assert blocks.count() >= len(text.encode()) // 700
    assert blocks.where("begins_inside").count() > 0
    assert B._lines(spark, path).rdd.getNumPartitions() > 10


def test_a_record_over_many_blocks_and_crlf(spark, small_blocks, tmp_path):
    rng = random.Random(9)
    long = "x\n" * 2_000 + '"",' + "y" * 3_000
    rows = [["r1", "o", "1", "t", long, "d", "d"], ["r2", "o", "1", "t", "", "d", "d"], ["r3", "o", "2", long, "m", "d", "d"]]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([HEAD, *rows])
    path = write(tmp_path / "order_reviews.csv", out.getvalue())
    got = read(spark, path, "blocks")
    assert [tuple(r)[:7] for r in got] == [tuple(v or None for v in r) for r in rows]
    flat = [[c.replace("\n", " ") for c in r] for r in csv.reader(io.StringIO(text_of(rng, 60), newline="")) if r]
    out = io.StringIO()
    csv.writer(out, lineterminator="\r\n").writerows(flat)
    path = write(tmp_path / "crlf.csv", out.getvalue())
    assert [tuple(r)[:-1] for r in read(spark, path, "blocks")] == [tuple(r)[:-1] for r in read(spark, path, True)]


def test_several_files_ragged_rows_and_headers(spark, small_blocks, tmp_path):
    folder = tmp_path / "order_reviews.csv"
    folder.mkdir()
    for k in range(3):
        write(folder / f"part-{k}.csv", text_of(random.Random(k), 40) + "too,few\n" + "a,b,c,d,e,f,g,h\n")
    one, many = read(spark, str(folder), True), read(spark, str(folder), "blocks")
    assert len(one) == 120 and [tuple(r)[:-1] for r in one] == [tuple(r)[:-1] for r in many]
    bad = [sorted(r.record for r in CS.corrupt_rows(spark, "order_reviews", str(folder), m).collect()) for m in (True, "blocks")]
    assert len(bad[1]) == 6 and [x.strip() for x in bad[0]] == bad[1]
    write(folder / "part-9.csv", ",".join(HEAD[::-1]) + "\na,b,c,d,e,f,g\n")
    with pytest.raises(Exception, match="header"):
        read(spark, str(folder), "blocks")


def test_quotes_inside_unquoted_fields_are_an_error(spark, small_blocks, tmp_path):
    path = write(tmp_path / "order_reviews.csv", ",".join(HEAD) + '\nr1,o1,5,a 5" pipe,b 6" pipe,d,d\n')
    with pytest.raises(Exception, match="quote inside an unquoted field"):
        read(spark, path, "blocks")
    ok = ['a,"b ""c"" d",e', '"",""""', 'plain', '"x\ny"']
    bad = ['a"b', '"a"b', 'a,"b" ,c', 'x,"y""']
    df = spark.createDataFrame([(t,) for t in ok + bad], "t string")
    assert [r.s for r in df.select(B.stray_quotes(F.col("t")).alias("s")).collect()] == [False] * 4 + [True] * 4


def test_no_rows_and_other_sources(spark, tmp_path):
    path = write(tmp_path / "sellers.csv", ",".join(SOURCE_COLUMNS["sellers"]) + "\n")
    assert CS.read_csv_source(spark, "sellers", path, "blocks").collect() == []
    path = write(tmp_path / "s2.csv", ",".join(SOURCE_COLUMNS["sellers"]) + '\n1,01037,"sao\npaulo",SP')
    got = CS.read_csv_source(spark, "sellers", path, "blocks")
    assert got.columns == SOURCE_COLUMNS["sellers"] and tuple(got.first()) == ("1", "01037", "sao\npaulo", "SP")
