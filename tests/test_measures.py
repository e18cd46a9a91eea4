"""measure_frame filter direction: item slicers never filter order measures."""
from emporium.plans import measures as M
from emporium.plans.warehouse import driver_warehouse

from .conftest import SF_SMALL


def test_item_only_grouping_keeps_order_totals(spark):
    t = driver_warehouse(spark, SF_SMALL)
    out = M.measure_frame(t, by=["seller_state"], item_where="product_category_name IS NOT NULL").collect()
    total_orders = t["dim_orders"].select("order_id").distinct().count()
    assert {r.total_orders for r in out} == {total_orders}
    gmv = sum(r.gmv for r in out)
    kpi = M.kpi_exec(t).first()
    assert gmv == kpi.gmv                      # every fact row falls in some seller state


def test_order_filter_reaches_item_measures(spark):
    t = driver_warehouse(spark, SF_SMALL)
    out = M.measure_frame(t, measures=["total_orders", "gmv"], where="order_status = 'delivered'").first()
    expect = (t["fact_order_items"].join(t["dim_orders"].where("order_status = 'delivered'"), "order_id")
              .selectExpr("CAST(SUM(price + freight_value) AS DECIMAL(38,2)) AS g").first().g)
    assert out.gmv == expect
    assert out.total_orders == t["dim_orders"].where("order_status = 'delivered'").count()


def test_results_do_not_depend_on_the_session_time_zone(spark):
    from emporium.registry import QUERIES
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        out = {}
        for tz in ["UTC", "America/Sao_Paulo"]:
            spark.conf.set("spark.sql.session.timeZone", tz)
            out[tz] = sorted(map(tuple, QUERIES["gmv_by_month"](spark, SF_SMALL).collect()), key=repr)
        assert out["UTC"] == out["America/Sao_Paulo"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
