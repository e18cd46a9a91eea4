"""Profile and measure operators on hand-made frames."""
from datetime import datetime
from decimal import Decimal

from emporium.operators import profile as P
from emporium.plans import measures as M


def test_single_entries_distinct_counts_and_review_profile(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), (None, 3), ("c", None)], "city string, n int")
    assert [r.value for r in P.single_entry_values(df, "city").collect()] == ["a", "c"]
    assert {r.column_name: r.distinct_count for r in P.column_distinct_counts(df).collect()} == {"city": 3, "n": 3}
    rv = spark.createDataFrame([("r1", "o1", 5, datetime(2018, 1, 1)), ("r1", "o2", 4, datetime(2018, 1, 1)),
                                ("r2", "o3", 5, datetime(2018, 1, 2)), (None, "o4", 1, None)],
                               "review_id string, order_id string, review_score long, review_creation_date timestamp_ntz")
    prof = [(r.review_id, r.n_orders, r.n_scores, r.n_creation_dates) for r in P.review_id_profile(rv).collect()]
    assert prof == [("r1", 2, 2, 1), ("r2", 1, 1, 1)]
    m = P.dedup_metrics(rv, rv.dropDuplicates(["review_id"])).first()
    assert (m.rows_before, m.rows_removed, m.rows_after) == (4, 1, 3)


def _tables(spark):
    orders = spark.createDataFrame([
        ("o1", "c1", "delivered", datetime(2018, 1, 1), datetime(2018, 1, 5), datetime(2018, 1, 10)),
        ("o2", "c1", "delivered", datetime(2018, 2, 1), datetime(2018, 2, 20), datetime(2018, 2, 10)),
        ("o3", "c2", "shipped", datetime(2018, 2, 3), None, datetime(2018, 2, 10)),
        ("o4", "c3", "canceled", datetime(2018, 3, 1), datetime(2018, 3, 2), None)],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz")
    fact = spark.createDataFrame([
        ("o1", 1, "p1", "s1", Decimal("10.00"), Decimal("1.00")),
        ("o1", 2, "p2", "s2", None, Decimal("2.00")),            # missing price adds 0 to GMV
        ("o2", 1, "p1", "s1", Decimal("20.00"), Decimal("0.00"))],
        "order_id string, order_item_id long, product_id string, seller_id string, "
        "price decimal(10,2), freight_value decimal(10,2)")
    customers = spark.createDataFrame([("c1", "SP", "sao paulo"), ("c2", "RJ", "rio")],
                                      "customer_id string, customer_state string, customer_city string")
    reviews = spark.createDataFrame([("r1", "o1", 5), ("r2", "o2", 1), ("r3", "o3", None)],
                                    "review_id string, order_id string, review_score long")
    return {"dim_orders": orders, "fact_order_items": fact, "dim_customers": customers, "dim_reviews": reviews}


def test_kpis_and_delivery_measures(spark):
    t = _tables(spark)
    k = M.kpi_exec(t).first()
    assert (k.gmv, k.total_orders, k.active_customers, k.active_sellers) == (Decimal("33.00"), 4, 3, 2)
    assert k.avg_order_value == 33.0 / 4
    ot = M.on_time_pct(t).first()        # o4 has no estimate: delivered but not on time (guarded)
    assert (ot.on_time_orders, ot.delivered_orders) == (1, 3)
    d = M.delivery_completion(t).first()
    assert (d.total_orders, d.delivered_orders, d.canceled_orders, d.completion_rate) == (4, 2, 1, 2 / 3)
    b = {r.delay_bucket: (r.reviews, r.avg_review_score) for r in M.delay_bucket_reviews(t).collect()}
    assert b == {"Early": (1, 5.0), "Very Late": (1, 1.0), "Not Delivered": (1, None)}   # -5 days, +10 days


def test_state_share_and_cohorts(spark):
    t = _tables(spark)
    s = {r.customer_state: r for r in M.gmv_by_state(t).collect()}
    assert s["SP"].gmv == Decimal("33.00") and s["SP"].gmv_share == 1.0 and s["SP"].gmv_rank == 1
    assert s["RJ"].gmv is None and s["RJ"].total_orders == 1
    assert s[None].total_orders == 1          # o4's customer is not in the customer table
    c = {r.cohort_month: (r.customers, r.orders, r.gmv) for r in M.first_purchase_cohort(t).collect()}
    assert c[datetime(2018, 1, 1)] == (1, 2, Decimal("33.00"))   # c1: first in January, two orders
    assert c[datetime(2018, 2, 1)] == (1, 1, None)
