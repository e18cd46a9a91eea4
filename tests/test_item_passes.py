"""Items are dealt by order once; gates, hot keys, the cube and the store read them no more often than they need."""
from pyspark.sql import functions as F

from emporium.operators import quality as Q
from emporium.operators import skewjoin as S
from emporium.plans import clean as C
from emporium.plans import cube as K
from emporium.plans import incremental as I
from emporium.plans import measures as M
from emporium.plans import views as V
from emporium.plans.warehouse import driver_warehouse

from .conftest import SF_SMALL


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plain_plan(spark, make):
    """The physical plan where nothing is small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return make()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_items_stay_dealt_by_order(spark):
    """F2, F3, F7, F8: no further exchange groups the items, and AQE may not merge their partitions."""
    plan = plain_plan(spark, lambda: V.items_per_order_seller(driver_warehouse(spark, SF_SMALL)["fact_order_items"]))
    top = plan[:plan.index("SortMergeJoin")]
    assert "Exchange" not in top and "REPARTITION_BY_NUM" in plan


def test_items_with_repeated_and_missing_keys(spark):
    """As semi joins: repeated ids of a dimension repeat no item, null ids match nothing."""
    raw = spark.createDataFrame(
        [("a", "1", "p", "s", 5.0, 1.0), ("a", "1", "p", "s", 5.0, 1.0), (None, "1", "p", "s", 5.0, 1.0),
         ("b", "2", None, "s", 5.0, 1.0), ("x", "2", "p", "s", 5.0, 1.0)],
        "order_id string, order_item_id string, product_id string, seller_id string, price double, freight_value double"
    ).withColumn("shipping_limit_date", F.lit("2020-01-01 00:00:00"))
    orders = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "order_id string")
    products = spark.createDataFrame([("p",), ("p",), (None,)], "product_id string")
    sellers = spark.createDataFrame([("s",), ("s",)], "seller_id string")
    got = C.clean_order_items(raw, orders, products, sellers)
    assert [r[:4] for r in rows(got)] == [("a", 1, "p", "s")] * 2


def _gate_tables(spark):
    fact = spark.createDataFrame(
        [("a", 1, "p", "s", 1, 1), ("a", 1, "q", "s", -1, 1), ("b", 1, None, "t", 1, -1), (None, None, "p", "s", 1, 1),
         (None, None, "p", "u", 1, 1)],
        "order_id string, order_item_id long, product_id string, seller_id string, price int, freight_value int")
    return {"fact_order_items": fact, "dim_orders": spark.createDataFrame([("a",), ("a",), (None,)], "order_id string"),
            "dim_sellers": spark.createDataFrame([("s",), ("s",)], "seller_id string"),
            "other": spark.range(3)}


def test_gate_report_reads_each_table_once(spark):
    """duplicates, orphans, null keys and ranges from one pass."""
    t = _gate_tables(spark)
    got = {r[:3]: r[3] for r in rows(Q.gate_report(t).select("check_name", "table_name", F.coalesce("column_name", F.lit("")), "bad_count"))}
    fact = "fact_order_items"
    assert got == {
        ("null_key", fact, "order_id"): 2, ("null_key", fact, "order_item_id"): 2, ("range negative", fact, "price"): 1,
        ("range negative", fact, "freight_value"): 1, ("pk_duplicate", fact, ""): 2, ("orphan", fact, "order_id"): 3,
        ("orphan", fact, "product_id"): 0, ("orphan", fact, "seller_id"): 2, ("null_key", "dim_orders", "order_id"): 1,
        ("pk_duplicate", "dim_orders", ""): 1, ("null_key", "dim_sellers", "seller_id"): 0,
        ("pk_duplicate", "dim_sellers", ""): 1, ("pk_duplicate", "other", ""): 0}
    empty = Q.gate_report({n: df.limit(0) for n, df in t.items()})
    assert empty.count() == len(got) and empty.where("bad_count != 0").count() == 0
    plan = Q.gate_report(dict(driver_warehouse(spark, SF_SMALL)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_linenumber") and plan.count("l_extendedprice#") and plan.count("Relation [l_orderkey") == 1


def test_hot_keys_of_several_columns_in_one_pass(spark, monkeypatch):
    """the view looks for hot orders and products together."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("a"),
                                  F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 5 > 0, F.col("id")).alias("b"),
                                  F.lit(None).cast("string").alias("c"))
    assert S.hot_keys_of(df, ["a", "b", "c"], 4) == {"a": ["hot"], "b": [7], "c": []}
    assert S.hot_keys_of(df.limit(0), ["a", "b"], 4) == {"a": [], "b": []}
    asked = []
    found = S._frequent
    monkeypatch.setattr(S, "_frequent", lambda df, keys, n: asked.append(list(keys)) or found(df, keys, n))
    w = driver_warehouse(spark, SF_SMALL)
    V.base_order_items(w["fact_order_items"], w["dim_orders"], w["dim_products"], hot_keys=True)
    assert asked == [["order_id", "product_id"]]


def test_first_batch_of_a_store_joins_once(spark, tmpdir_path, monkeypatch):
    """orders of which nothing is held have no part before."""
    w = driver_warehouse(spark, SF_SMALL)
    made = []
    part = I.contributions
    monkeypatch.setattr(I, "contributions", lambda **t: made.append(1) or part(**t))
    store = I.SellerMonthlyStore(spark, tmpdir_path + "/s")
    store.apply(I.Changes(w["fact_order_items"], w["dim_orders"]))
    assert len(made) == 1
    store.apply(I.Changes(reviews=w["dim_reviews"]))
    assert len(made) == 3
    assert rows(store.view()) == rows(V.seller_monthly(w["fact_order_items"], w["dim_orders"], w["dim_reviews"]))


def test_cube_makes_sums_and_bitmaps_in_one_pass(spark, tmpdir_path, monkeypatch):
    """the items are grouped once, with rows that have no seller or customer."""
    w = dict(driver_warehouse(spark, SF_SMALL))
    w["fact_order_items"] = w["fact_order_items"].withColumn(
        "seller_id", F.when(F.xxhash64("order_id") % 5 != 0, F.col("seller_id")))
    grouped = []
    items = M._item_attributes
    monkeypatch.setattr(M, "_item_attributes", lambda *a: grouped.append(1) or items(*a))
    jobs = []
    write = spark.createDataFrame([(1,)], "a int").write.__class__.parquet
    monkeypatch.setattr(spark.createDataFrame([(1,)], "a int").write.__class__, "parquet",
                        lambda self, path, *a, **k: jobs.append(path.rsplit("/", 1)[1]) or write(self, path, *a, **k))
    cube = K.MeasureCube.build(w, tmpdir_path + "/c", ["customer_state", "order_status"])
    assert jobs == ["_orders", "orders", "customers", "_items", "items", "sellers", "payments", "reviews"]
    monkeypatch.undo()
    assert rows(cube.frame(by=["order_status"])) == rows(M.measure_frame(w, by=["order_status"]))
    assert rows(cube.frame()) == rows(M.measure_frame(w))
