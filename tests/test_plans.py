"""Plan shape: pushdown, pruning, anti joins, map-side limits, no Python workers."""
from emporium.operators import quality as Q
from emporium.plans.warehouse import driver_warehouse
from emporium.registry import QUERIES

from .conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_orphan_checks_are_anti_joins(spark):
    w = driver_warehouse(spark, SF_SMALL)
    assert "LeftAnti" in optimized(Q.orphans(w["fact_order_items"], w))


def test_review_dedup_uses_window_group_limit(spark):
    w = driver_warehouse(spark, SF_SMALL)
    assert "WindowGroupLimit" in plan(w["dim_reviews"])


def test_text_cleaning_stays_in_the_jvm(spark):
    w = driver_warehouse(spark, SF_SMALL)
    for t in ["dim_sellers", "dim_reviews", "dim_geolocation"]:
        p = plan(w[t])
        assert "EvalPython" not in p and "PythonUDF" not in p, t


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(QUERIES["dim_orders_chronology"](spark, SF_SMALL))
    assert "ReadSchema" in p
    fact = plan(driver_warehouse(spark, SF_SMALL)["fact_order_items"])
    assert "GreaterThan(l_extendedprice,0.0)" in fact  # the price bound itself, not only its null check
    assert "l_discount" not in fact.split("ReadSchema")[1].split("\n")[0]


def test_null_key_report_scans_each_table_once(spark):
    w = driver_warehouse(spark, SF_SMALL)
    fact = w["fact_order_items"]
    report = Q.null_key_report(w, {"fact_order_items": ["order_id", "order_item_id", "product_id"]})
    # three key columns, still the relations of exactly one pass over the fact's plan
    assert optimized(report).count("Relation [") == optimized(fact).count("Relation [")


def test_seller_monthly_scans_the_fact_once(spark):
    from emporium.plans import views as V
    w = driver_warehouse(spark, SF_SMALL)
    p = optimized(V.seller_monthly(w["fact_order_items"], w["dim_orders"], w["dim_reviews"]))
    assert p.count("l_extendedprice") >= 1
    assert sum(1 for line in p.split("\n") if "Relation [" in line and "l_orderkey" in line) == 1


def test_flagship_never_reads_review_text(spark):
    p = plan(QUERIES["v_seller_monthly"](spark, SF_SMALL))
    conv = [line for line in p.split("\n") if "FileScan" in line and "conv_id" in line]
    assert conv and all("text:" not in line.split("ReadSchema")[1] for line in conv)
    assert "translate(" not in p


def test_seller_rank_has_no_single_partition_window(spark):
    from emporium.plans import measures as M
    p = plan(M.seller_scorecard(driver_warehouse(spark, SF_SMALL)))
    windows = [line for line in p.split("\n") if "Window [" in line and "__n" in line]
    assert windows and all("__pid" in line.split("windowspecdefinition(")[1].split(",")[0] for line in windows)
    assert "rank(" not in p


def test_fact_keys_need_no_translation_and_orders_are_scanned_once_per_use(spark):
    fact = optimized(driver_warehouse(spark, SF_SMALL)["fact_order_items"])
    scans = [line for line in fact.split("\n") if "Relation [" in line]
    assert sum("p_partkey" in line for line in scans) == 1  # no translation source under the key filter
    assert sum("o_orderkey" in line for line in scans) == 2  # the orders, and their undefined payments
    assert "Window" not in fact
