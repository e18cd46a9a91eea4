"""Joins with hot keys: the result of the plain join, and no task that gets a hot key."""
import pytest
from pyspark.sql import functions as F

from emporium.operators import skewjoin as S
from emporium.plans import views as V
from emporium.plans.warehouse import driver_warehouse

from .conftest import SF_SMALL
from .test_skew import _skewed_tables


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture()
def sides(spark):
    """A third of the left rows in one key, a tenth in another without a match, a tenth without a key."""
    left = spark.range(0, 30_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, "lost").when(F.col("id") % 10 == 4, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 4000)).alias("k"), F.col("id").alias("v"))
    right = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("w")).union(
        spark.createDataFrame([("hot", -1), ("hot", -2), (None, 7)], "k string, w long"))
    return left, right


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limit", [100_000, 1])
def test_equals_the_plain_join(spark, sides, how, limit, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_ROWS", limit)
    left, right = sides
    got = S.skew_join(left, right, "k", how)
    want = left.join(right, "k", how)
    assert got.columns == want.columns and rows(got) == rows(want)
    assert rows(S.skew_join(left, right, "k", how, hot=[])) == rows(want)
    assert rows(S.skew_join(left.limit(0), right, "k", how)) == rows(S.skew_join(left, right.limit(0), "k", "inner")) == []


def test_frequent_keys_are_all_found(spark, sides):
    left, _ = sides
    top = dict(S.frequent_keys(left, "k", 50))
    assert {"hot", "lost"} <= set(top) and abs(top["hot"] - 10_000) < 1200 and len(top) <= 50 and None not in top
    assert S.hot_keys(left, "k", 4) == ["hot"]  # over an eighth of all rows
    assert S.frequent_keys(left.limit(0), "k") == []
    # keys in turns, one of them a little over the share looked for
    turns = spark.range(0, 20_000, numPartitions=7).select(F.when(F.col("id") % 40 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert -1 in dict(S.frequent_keys(turns, "k", 50))


def test_no_task_gets_a_hot_order(spark):
    """One order with a third of all items, without AQE: every task of a join has at most twice the median's rows."""
    t = _skewed_tables(spark)
    orders = driver_warehouse(spark, SF_SMALL)["dim_orders"]
    one = orders.agg(F.min("order_id")).first()[0]
    fact = t["fact_order_items"].repartition(8).withColumn(
        "order_id", F.when(F.col("order_id") == "1", one).otherwise(F.col("order_id")))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def sizes(df, mark):
            found = (df.withColumn("hot", F.col("order_id") == mark).withColumn("task", F.spark_partition_id())
                     .groupBy("task").agg(F.count("*").alias("n"), F.max("hot").alias("hot")).collect())
            return [sorted(r.n for r in found if r.hot == h) for h in (True, False)]

        o = orders.select("order_id", "order_status")
        plain = sizes(fact.join(o, "order_id"), one)
        hot, cold = sizes(S.skew_join(fact, o, "order_id"), one)
        assert plain[0][0] > 1.3 * plain[1][-1]  # the task of the hot order
        for n in (hot, cold):
            assert len(n) >= 4 and n[-1] <= 2 * n[len(n) // 2], n
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = V.base_order_items(t["fact_order_items"], t["dim_orders"], t["dim_products"], hot_keys=True)
    assert rows(got) == rows(V.base_order_items(t["fact_order_items"], t["dim_orders"], t["dim_products"]))
