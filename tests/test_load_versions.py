"""Loads as versions: one scan of each source, gates from the staging pass, one commit, nothing to do twice."""
import os

import pytest
from pyspark.sql import functions as F

from emporium.operators import quality as Q
from emporium.operators.quality import QualityError
from emporium.plans import elt
from emporium.plans.clean import CleanOptions, clean_all
from emporium.plans.elt import run_elt
from emporium.session import list_names
from emporium.sources import snapshots as SN
from emporium.sources import warehouse as WH
from emporium.sources.driver_tables import marketplace_sources

from .conftest import SF_SMALL


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(spark, db):
    out = {}
    for folder, _, names in os.walk(SN.db_location(spark, db).removeprefix("file:")):
        out |= {os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names}
    return out


@pytest.fixture(scope="module")
def sources(spark):
    return dict(marketplace_sources(spark, SF_SMALL))


def counted(spark, frames):
    """The frames, with the number of rows that each has been read for."""
    seen = {n: spark.sparkContext.accumulator(0) for n in frames}

    def wrap(df, n):
        acc = seen[n]

        def run(batches):
            for b in batches:
                acc.add(b.num_rows)
                yield b
        return df.mapInArrow(run, df.schema)

    return {n: wrap(df, n) for n, df in frames.items()}, seen


def test_each_source_is_scanned_once_and_the_report_is_the_same(spark, sources):
    watched, seen = counted(spark, sources)
    res = run_elt(spark, sources=watched, db="v_once")
    assert {n: a.value for n, a in seen.items()} == {n: df.count() for n, df in sources.items()}
    want = Q.gate_report(dict(clean_all(sources)), phase="pre_load")
    assert rows(res.pre_load.select(want.columns)) == rows(want)
    assert {r.table_name: r.source_rows for r in res.counts.collect()} == {
        t: sources[s].count() for t, s in elt.SOURCE_OF.items()}


def test_gates_count_good_rows_only(spark, sources):
    some = F.pmod(F.xxhash64("order_id"), F.lit(5))
    items = sources["order_items"].withColumns({
        "price": F.when(some == 0, F.lit("150000000.00")).otherwise(F.col("price").cast("string"))})
    reviews = sources["order_reviews"].withColumns({
        "review_score": F.when(some == 0, F.lit("x")).when(some == 1, F.lit("9"))
        .otherwise(F.col("review_score").cast("string"))})
    src = dict(sources, order_items=items, order_reviews=reviews)
    run = SN.new_run()
    staged = elt.stage_warehouse(spark, src, "v_gates", run)
    want = Q.gate_report(dict(clean_all(src)), phase="pre_load")
    got = elt.staged_report(spark, staged)
    assert rows(got.select(want.columns)) == rows(want)
    assert staged["fact_order_items"].rejected > 0 and staged["dim_reviews"].rejected > 0
    for t, v in staged.items():
        good, bad = WH.split_rejects(clean_all(src, CleanOptions(keep_rejects=True))[t], WH.TABLES[t]) if (
            t != "fact_order_items") else (None, None)
        if good is not None:
            assert rows(WH.staged_rows(spark, "v_gates", v)) == rows(good) and v.rejected == bad.count()
    SN.discard(spark, SN.db_location(spark, "v_gates"), run)
    assert not spark.catalog.databaseExists("v_gates")


def test_a_repeated_run_writes_nothing(spark, sources):
    first = run_elt(spark, sources=sources, db="v_twice")
    before, held = files(spark, "v_twice"), {t: rows(df) for t, df in first.tables.items()}
    second = run_elt(spark, sources=sources, db="v_twice")
    assert files(spark, "v_twice") == before
    assert rows(second.pre_load) == rows(first.pre_load) and rows(second.counts) == rows(first.counts)
    assert second.rejects.count() == first.rejects.count() > 0
    # one changed source: only the tables made of it are written
    payments = sources["order_payments"].withColumn("payment_installments", F.lit(1))
    run_elt(spark, sources=dict(sources, order_payments=payments), db="v_twice")
    new = {f.split("/versions/")[1].split("/")[1] for f in set(files(spark, "v_twice")) - set(before) if ".parquet" in f}
    assert new == {"dim_payments", "dim_orders", "fact_order_items"}
    assert rows(spark.table("v_twice.dim_customers")) == held["dim_customers"]
    assert spark.table("v_twice.dim_payments").where("payment_installments <> 1").isEmpty()
    # other options, or asked for: all tables again
    run_elt(spark, sources=sources, db="v_twice", opts=CleanOptions(enforce_chronology=True))
    assert spark.table("v_twice.dim_orders").count() < len(held["dim_orders"])


def test_a_failed_run_leaves_the_old_tables(spark, sources, monkeypatch):
    run_elt(spark, sources=sources, db="v_fail")
    held = {t: rows(df) for t, df in WH.warehouse_tables(spark, "v_fail").items()}
    before = files(spark, "v_fail")
    bad = sources["order_reviews"].withColumn("review_score", F.lit(9))
    with pytest.raises(QualityError):
        run_elt(spark, sources=dict(sources, order_reviews=bad), db="v_fail", strict=True)
    broken = sources["sellers"].withColumn("seller_city", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        run_elt(spark, sources=dict(sources, sellers=broken), db="v_fail")
    real = WH.stage_table
    monkeypatch.setattr(WH, "stage_table", lambda *a, **k: real(*a, **k) if a[3] != "dim_reviews" else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_elt(spark, sources=dict(sources, order_reviews=bad), db="v_fail", force=True)
    monkeypatch.undo()
    assert files(spark, "v_fail") == before
    assert {t: rows(df) for t, df in WH.warehouse_tables(spark, "v_fail").items()} == held


def test_commit_is_one_file_and_attach_follows_it(spark, sources, monkeypatch):
    run_elt(spark, sources=sources, db="v_commit")
    fewer = dict(sources, customers=sources["customers"].where("customer_id <> '1'"))
    monkeypatch.setattr(WH, "point_to", lambda *a: 1 / 0)  # ends between the commit and the catalog
    with pytest.raises(ZeroDivisionError):
        run_elt(spark, sources=fewer, db="v_commit")
    monkeypatch.undo()
    n = sources["customers"].count()
    assert spark.table("v_commit.dim_customers").count() == n
    WH.attach_warehouse(spark, "v_commit", SN.db_location(spark, "v_commit"))
    spark.catalog.refreshTable("v_commit.dim_customers")
    assert spark.table("v_commit.dim_customers").count() == n - 1


def test_old_versions_go_with_the_last_snapshot_that_names_them(spark, sources):
    small = {"sellers": sources["sellers"], "customers": sources["customers"]}
    location = SN.db_location(spark, "v_old")
    for k in range(4):
        sellers = small["sellers"].where(f"seller_id <> '{k}'")
        tables = dict(clean_all({"sellers": sellers, "customers": small["customers"] if k == 0 else None}))
        WH.load_tables(spark, tables, "v_old")
        assert spark.table("v_old.dim_sellers").where(f"seller_id = '{k}'").isEmpty()
    names = list_names(spark, f"{location}/versions")
    assert len([n for n in names if n.startswith("published-")]) == 2
    kept = [n for n in names if not n.startswith("published-")]
    assert len(kept) == 3  # the customers' one, and the last two of the sellers
    assert list_names(spark, f"{location}/versions/{kept[0]}") == ["dim_customers"]
    assert spark.table("v_old.dim_customers").count() == small["customers"].count()


def test_a_table_without_rows(spark, sources):
    none = {"customers": sources["customers"].where("false")}
    WH.load_tables(spark, dict(clean_all(none)), "v_none")
    assert spark.table("v_none.dim_customers").count() == 0
