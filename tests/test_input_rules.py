"""Rows and values off the beaten track: rejects, file order, CSV shapes, broken keys, locations."""
import csv
import datetime as dt
import logging
import os

import pytest
from pyspark.sql import functions as F

from emporium import session as S
from emporium.operators import dedup as D
from emporium.plans import clean as C
from emporium.plans import measures as M
from emporium.plans.elt import run_elt
from emporium.sources import csv_source as CS
from emporium.sources import warehouse as WH
from emporium.sources.driver_tables import marketplace_sources

from .conftest import SF_SMALL

ITEMS = "order_id string, order_item_id string, product_id string, seller_id string, shipping_limit_date string, price {}, freight_value string"


@pytest.mark.parametrize("kind", ["string", "double"])
def test_prices_that_do_not_fit_are_rejected_and_never_zero(spark, kind):
    prices = ["10.50", "150000000.00", "NaN", "Infinity", "0", None] + (["abc"] if kind == "string" else [])
    rows = [(str(i), "1", "p", "s", "2018-01-01 00:00:00", p if kind == "string" or p is None else float(p), "1")
            for i, p in enumerate(prices)]
    raw = spark.createDataFrame(rows, ITEMS.format(kind))
    keys = [spark.createDataFrame([(v,) for v in vs], f"{k} string") for k, vs in
            (("order_id", map(str, range(9))), ("product_id", "p"), ("seller_id", "s"))]
    got = C.clean_order_items(raw, *keys).collect()
    assert [(r.order_id, str(r.price)) for r in got] == [("0", "10.50")]
    marked = C.clean_order_items(raw, *keys, C.CleanOptions(keep_rejects=True))
    bad = WH.split_rejects(marked, WH.TABLES["fact_order_items"])[1].collect()
    assert sorted(r.columns for r in bad) == ["price", "price"] and all("price" in r._raw for r in bad)


def test_rejects_through_the_load(spark):
    src = dict(marketplace_sources(spark, SF_SMALL))
    items = src["order_items"].withColumn("price", F.when(F.col("order_id") == "3", F.lit(float("inf"))).otherwise(F.col("price")))
    res = run_elt(spark, sources=dict(src, order_items=items), db="mkt_rejects", pre_checks=False)
    fact = res.rejects.where("table_name = 'fact_order_items'")
    assert fact.count() == fact.where("columns = 'price'").count()
    assert res.tables["fact_order_items"].where("price <= 0 OR price IS NULL").count() == 0
    assert res.rejects.where("table_name = 'dim_payments'").count() > 0
    assert res.tables["dim_payments"].where("payment_value IS NULL").count() == 0


def write(path, header, rows, quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", newline="") as f:
        w = csv.writer(f, quoting=quoting)
        w.writerow(header)
        w.writerows(rows)


REVIEW = ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
          "review_creation_date", "review_answer_timestamp"]


def review(i, order, text="t" * 40):
    return [i, order, "5", "", text, "2018-01-01 00:00:00", "2018-01-02 00:00:00"]


@pytest.mark.parametrize("multiline", [True, False])
def test_first_row_of_the_first_file_wins(spark, tmpdir_path, multiline):
    """Spark deals large files first; file names and places decide all the same."""
    folder = os.path.join(tmpdir_path, "order_reviews.csv")
    os.makedirs(folder)
    write(f"{folder}/part-0.csv", REVIEW, [review("r1", "first")])
    write(f"{folder}/part-1.csv", REVIEW, [review("r1", "second")] + [review(f"x{i}", "o") for i in range(20_000)] + [review("x3", "late")])
    small = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        raw = CS.read_csv_source(spark, "order_reviews", folder, multiline)
        assert multiline or raw.rdd.getNumPartitions() > 3
        path = os.path.join(tmpdir_path, f"landed-{multiline}")
        raw.write.parquet(path)
        for source in (raw, spark.read.parquet(path)):
            got = {r.review_id: r.order_id for r in C.clean_reviews(source).where("review_id IN ('r1', 'x3')").collect()}
            assert got == {"r1": "first", "x3": "o"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", small)


SELLERS = ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]


def test_columns_are_bound_by_header_and_missing_text_is_null(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "sellers.csv")
    write(path, ["seller_state", "seller_id", "seller_city", "seller_zip_code_prefix"],
          [["SP", "s1", "NA", "01"], ["nan", "s2", 'disse "bom", ok', "null"]])
    got = CS.read_csv_source(spark, "sellers", path).orderBy("seller_id").collect()
    assert [tuple(r) for r in got] == [("s1", "01", None, "SP"), ("s2", None, 'disse "bom", ok', None)]
    write(path, ["seller_id", "town"], [["s", "x"]])
    frames, errors = CS.extract(spark, {"sellers": path})
    assert frames["sellers"] is None and "seller_city" in errors["sellers"] and "town" in errors["sellers"]


def test_ragged_rows_and_open_quotes_are_set_aside(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "sellers.csv")
    with open(path, "w") as f:
        f.write(",".join(SELLERS) + "\na,1,x,SP\nb,1,x,SP,more,still\nc,1\nd,1,y,RJ\n")
    good = CS.read_csv_source(spark, "sellers", path)
    assert sorted(r.seller_id for r in good.collect()) == ["a", "d"] and good.count() == 2
    bad = [r.record for r in CS.corrupt_rows(spark, "sellers", path).collect()]
    assert sorted(bad) == ["b,1,x,SP,more,still", "c,1"]
    with open(path, "w") as f:
        f.write(",".join(SELLERS) + '\na,1,x,SP\nb,1,"x,SP\nc,1,y,RJ\n')
    assert [r.seller_id for r in CS.read_csv_source(spark, "sellers", path).collect()] == ["a"]
    assert CS.corrupt_rows(spark, "sellers", path).count() == 1


def test_export_is_read_alike_by_another_reader(spark, tmpdir_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS quoted")
    texts = ['disse "bom", ok', "linha\nnova", "a,b", "simples"]
    spark.createDataFrame([(i, t, dt.datetime(2018, 1, 1)) for i, t in enumerate(texts)], "k int, text string, at timestamp_ntz") \
        .coalesce(1).write.mode("overwrite").saveAsTable("quoted.comments")
    out = os.path.join(tmpdir_path, "out")
    assert WH.export_csv(spark, "quoted", out, upper=True).first().status == "written"
    part = next(f"{out}/comments/{f}" for f in os.listdir(f"{out}/comments") if f.endswith(".csv"))
    with open(part, newline="") as f:
        rows = list(csv.reader(f))
    assert rows[0] == ["K", "TEXT", "AT"] and sorted(r[1] for r in rows[1:]) == sorted(texts)
    assert rows[1][2] == "2018-01-01 00:00:00"


def test_locations_and_session_settings(spark, monkeypatch):
    assert S.as_location("s3a://bucket/wh") == "s3a://bucket/wh" and S.as_location("hdfs:/x") == "hdfs:/x"
    assert S.as_location("wh") == os.path.abspath("wh") and S.join_location("s3a://b/wh/", "db") == "s3a://b/wh/db"
    assert S.location_exists(spark, SF_SMALL) and not S.location_exists(spark, SF_SMALL + "/none")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    again = S.build_session()  # neither a master nor a partition count of its own
    assert again.sparkContext.master == "local[4]" and again.conf.get("spark.sql.shuffle.partitions") == before


def test_no_local_checkpoint_folder_on_a_cluster():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):  # noqa: N802
            return None

        def getConf(self):  # noqa: N802
            return {}

    class Session:
        sparkContext = Context()  # noqa: N815
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.ensure_checkpoint_dir(Session())


def tables(spark, orders, items):
    at = lambda d: dt.datetime.fromisoformat(d)
    return {
        "dim_orders": spark.createDataFrame(
            [(o, c, "delivered", at(d), None, None, at(d), at(d)) for o, c, d in orders],
            "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
            "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
            "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"),
        "fact_order_items": spark.createDataFrame(
            [(o, i, p, "s", p_) for i, (o, p, p_) in enumerate(items)],
            "order_id string, order_item_id long, product_id string, seller_id string, price double")
        .withColumns({"price": F.col("price").cast("decimal(10,2)"), "freight_value": F.lit(0).cast("decimal(10,2)")}),
        "dim_customers": spark.createDataFrame([("c1", "SP", "x"), ("c2", "RJ", "y")],
                                               "customer_id string, customer_state string, customer_city string"),
        "dim_products": spark.createDataFrame([("p", "cama", "bed")], "product_id string, product_category_name string, "
                                              "product_category_name_english string"),
        "dim_sellers": spark.createDataFrame([("s", "sp", "SP", "1")], "seller_id string, seller_city string, "
                                             "seller_state string, seller_zip_code_prefix string"),
    }


def test_broken_order_keys_periods_without_items_and_null_customers(spark):
    t = tables(spark, [("1", "c1", "2018-01-01"), ("1", "c1", "2018-01-01"), ("2", None, "2019-01-01"),
                       ("3", None, "2018-06-01"), ("4", "c2", "2017-01-01")], [("1", "p", 2.0)])
    years = {r.year: (None if r.gmv is None else float(r.gmv), r["items"], r.total_orders) for r in M.gmv_by_year(t).collect()}
    assert years == {2017: (None, 0, 1), 2018: (2.0, 1, 2), 2019: (None, 0, 1)}
    states = {r.customer_state: (None if r.gmv is None else float(r.gmv), r.total_orders) for r in M.gmv_by_state(t).collect()}
    assert states == {"SP": (2.0, 1), "RJ": (None, 1), None: (None, 2)}
    first = {r.order_id: r.first_purchase_timestamp.year for r in M.orders_first_purchase(t).collect()}
    assert first == {"1": 2018, "2": 2018, "3": 2018, "4": 2017}
    frame = {(r.product_category_name, r.customer_state): (None if r.gmv is None else float(r.gmv), r.total_orders)
             for r in M.measure_frame(t, by=["product_category_name", "customer_state"]).collect()}
    assert frame == {("cama", "SP"): (2.0, 1), (None, "RJ"): (None, 1), (None, None): (None, 2)}
    only_items = M.measure_frame(t, by=["product_category_name"]).collect()
    assert [(r.product_category_name, r.total_orders, float(r.gmv)) for r in only_items] == [("cama", 4, 2.0)]


@pytest.mark.parametrize("copies", [0, 1, 99, 100, 101, 12_345])
def test_copies_are_expanded_block_by_block(spark, monkeypatch, copies):
    monkeypatch.setattr(D, "COPIES", 10)
    df = spark.createDataFrame([("a", copies), ("b", 3)], "k string, duplicate_count long")
    got = {r.k: r["count"] for r in D.expand_duplicates(df).groupBy("k").count().collect()}
    assert got == ({"a": copies} if copies else {}) | {"b": 3}


def test_gates_run_before_and_after_the_load(spark, caplog, monkeypatch):
    steps = []
    load = WH.load_tables
    monkeypatch.setattr(WH, "load_tables", lambda *a, **k: (steps.append("load"), load(*a, **k))[1])
    import emporium.plans.elt as elt
    real = elt.evaluate
    monkeypatch.setattr(elt, "evaluate", lambda r, phase: (steps.append(phase), real(r, phase))[1])
    with caplog.at_level(logging.INFO):
        res = elt.run_elt(spark, sources=dict(marketplace_sources(spark, SF_SMALL)), db="mkt_gates")
    assert steps[0] == "pre-load" and steps[-1] == "post-load" and "load" in steps[1:-1]
    said = [r.getMessage() for r in caplog.records]
    assert any(m.startswith("pre-load gate") for m in said) and any("source rows" in m for m in said)
    assert res.counts.count() == 8 and not spark._jsparkSession.sharedState().cacheManager().numCachedEntries()
