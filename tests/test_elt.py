"""CSV sources -> cleaned, checked, loaded warehouse -> views -> CSV export; twice."""
import os

from pyspark.sql import functions as F

from emporium.plans.elt import run_elt
from emporium.plans.warehouse import driver_warehouse
from emporium.sources import csv_source as CS  # noqa: I001
from emporium.sources import warehouse as WH
from emporium.sources.driver_tables import marketplace_sources

from .conftest import SF_SMALL


def test_extract_isolates_failures(spark, tmpdir_path):
    paths = CS.source_paths(tmpdir_path)
    frames, errors = CS.extract(spark, paths)
    assert set(errors) == set(CS.SOURCES)
    assert all(v is None for v in frames.values())
    try:
        CS.extract(spark, paths, require_all=True)
        raise AssertionError("expected ExtractError")
    except CS.ExtractError as e:
        assert set(e.errors) == set(CS.SOURCES)


def test_conform_rejects_bad_values(spark):
    df = spark.createDataFrame([("o1", "1", "NULL", "", "2018-01-01 00:00:00", "1.50", "0"),
                                ("o2", "x", "p", "s", "2018-01-01 00:00:00", "2.00", "0")],
                               "order_id string, order_item_id string, product_id string, seller_id string, "
                               "shipping_deadline string, price string, freight_value string")
    good, bad = WH.conform(df, WH.TABLES["fact_order_items"])
    g = good.collect()
    assert len(g) == 1 and g[0].product_id is None and g[0].seller_id is None
    assert [(r.table_name, r.columns) for r in bad.collect()] == [("fact_order_items", "order_item_id")]


def test_elt_end_to_end_twice(spark, tmpdir_path):
    src_dir = os.path.join(tmpdir_path, "sources")
    CS.write_csv_sources(dict(marketplace_sources(spark, SF_SMALL)), src_dir)
    expected = {k: v.count() for k, v in driver_warehouse(spark, SF_SMALL).items()}
    out_dir = os.path.join(tmpdir_path, "export")
    for _ in range(2):  # idempotent: the second run overwrites, it does not append
        res = run_elt(spark, source_dir=src_dir, db="mkt_test", export_dir=out_dir)
        got = {k: v.count() for k, v in res.tables.items()}
        assert got == expected
    post = {(r.check_name, r.table_name, r.column_name): r.bad_count for r in res.post_load.collect()}
    assert post[("orphan", "fact_order_items", "order_id")] == 0
    assert post[("pk_duplicate", "fact_order_items", None)] > 0   # driver data repeats (order, line)
    objects = [r.name for r in WH.list_objects(spark, "mkt_test").collect()]
    assert objects == sorted(objects) and "vw_seller_monthly" in objects and "fact_order_items" in objects
    assert spark.table("mkt_test.vw_seller_monthly").count() > 0
    written = {r.name: r.status for r in res.export.collect()}
    assert written["dim_orders"] == "written"
    back = spark.read.option("header", True).csv(os.path.join(out_dir, "dim_orders"))
    assert back.count() == expected["dim_orders"]
    # payment values that are no numbers (every 103rd order) are set aside once a run, not loaded as null
    raw = marketplace_sources(spark, SF_SMALL)["order_payments"]
    bad = raw.where("payment_value = 'abc' AND NOT payment_type <=> 'not_defined'").count()
    assert bad > 0 and res.rejects.where("table_name = 'dim_payments' AND columns = 'payment_value'").count() == bad
    assert res.rejects.count() == bad
    counts = {r.table_name: (r.source_rows, r.loaded_rows) for r in res.counts.collect()}
    assert counts["dim_orders"][0] > counts["dim_orders"][1] == expected["dim_orders"]


def test_bucketed_join_needs_no_fact_shuffle(spark, tmpdir_path):
    from emporium.plans.elt import load_warehouse
    load_warehouse(spark, marketplace_sources(spark, SF_SMALL), "mkt_bucketed", buckets=4)
    t = spark.table("mkt_bucketed.fact_order_items").join(spark.table("mkt_bucketed.dim_orders"), "order_id")
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(order_id" not in plan, plan


def test_csv_quotes_commas_and_newlines_survive(spark, tmpdir_path):
    from emporium.plans import clean as C
    rows = [("r1", "o1", "5", "Ótimo, recomendo", 'linha 1\nlinha "2", fim', "2018-01-01 00:00:00",
             "2018-01-02 00:00:00"),
            ("r2", "o2", "4", None, "", "2018-01-01 00:00:00", "2018-01-02 00:00:00")]
    df = spark.createDataFrame(rows, CS.SOURCE_SCHEMAS["order_reviews"])
    path = CS.write_csv_sources({"order_reviews": df}, tmpdir_path)["order_reviews"]
    back = CS.read_csv_source(spark, "order_reviews", path)
    got = {r.review_id: r for r in C.clean_reviews(back).collect()}
    assert got["r1"].review_comment_message == 'linha 1\nlinha "2", fim'
    assert got["r1"].review_comment_title == "Otimo, recomendo"
    assert got["r2"].review_comment_title is None


def test_missing_source_halts_before_transforming(spark, tmpdir_path):
    from emporium.plans.elt import run_elt
    try:
        run_elt(spark, source_dir=tmpdir_path, db="mkt_halt")
        raise AssertionError("expected ExtractError")
    except CS.ExtractError as e:
        assert "orders" in e.errors
    assert not spark.catalog.databaseExists("mkt_halt")


def test_recommended_conf_scales_partitions():
    from emporium.session import recommended_conf
    small = recommended_conf(10 * 1024**3, 64)
    big = recommended_conf(100 * 1024**4, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) > 100 * int(small["spark.sql.shuffle.partitions"]) // 100
    assert big["spark.sql.adaptive.autoBroadcastJoinThreshold"] == small["spark.sql.adaptive.autoBroadcastJoinThreshold"]


def test_strict_mode_stops_before_writing(spark, tmpdir_path):
    from emporium.operators.quality import QualityError
    from emporium.plans.elt import run_elt
    src = dict(marketplace_sources(spark, SF_SMALL))
    bad = src["order_reviews"].withColumn("review_score", F.lit(9))   # every score out of range
    try:
        run_elt(spark, sources=dict(src, order_reviews=bad), db="mkt_strict", strict=True)
        raise AssertionError("expected QualityError")
    except QualityError as e:
        assert "review_score" in str(e)
    assert not spark.catalog.databaseExists("mkt_strict")


def test_landing_keeps_rows_and_file_order(spark, tmpdir_path):
    from emporium.plans.elt import run_elt
    src_dir = os.path.join(tmpdir_path, "sources")
    CS.write_csv_sources(dict(marketplace_sources(spark, SF_SMALL)), src_dir)
    direct = run_elt(spark, source_dir=src_dir, db="mkt_direct", pre_checks=False)
    landed = run_elt(spark, source_dir=src_dir, db="mkt_landed", pre_checks=False,
                     landing_dir=os.path.join(tmpdir_path, "landed"))
    for t in ["dim_reviews", "fact_order_items", "dim_products"]:
        a = sorted(map(tuple, direct.tables[t].collect()), key=repr)
        b = sorted(map(tuple, landed.tables[t].collect()), key=repr)
        assert a == b, t
