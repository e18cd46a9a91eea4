import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from emporium.operators import dedup as DD
from emporium.operators import quality as Q
from emporium.operators.profile import describe, value_counts
from emporium.operators.quantiles import exact_quantiles


def test_first_per_key_picks_min_ordinal_whatever_the_partitioning(spark):
    random.seed(7)
    rows = [(random.choice(["a", "b", "c", None]), i, random.random()) for i in range(300)]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, src_ord long, v double")
    expect = {}
    for k, o, v in sorted(rows, key=lambda r: r[1]):
        expect.setdefault(k, (o, v))
    for parts in (1, 5, 13):
        got = {r.k: (r.src_ord, r.v) for r in
               DD.first_per_key(df.repartition(parts), ["k"], ["src_ord"]).collect()}
        assert got == expect


def test_duplicate_rows_nulls_compare_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x"), (2, "y")], "a int, b string")
    out = DD.duplicate_rows(df).collect()
    assert [(r.a, r.b, r.duplicate_count) for r in out] == [(1, None, 2)]
    assert DD.expand_duplicates(DD.duplicate_rows(df)).count() == 2
    assert DD.repeated_value_count(df, "b").first().repeated_values == 2


def test_exact_quantiles_match_pandas_with_a_hot_value(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.normal(size=2000), "b": rng.integers(0, 9, 2000).astype(float)})
    pdf.loc[:700, "a"] = 1.25
    pdf.loc[::5, "b"] = np.nan
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    res = exact_quantiles(spark.createDataFrame(pdf), ["a", "b"], probs).collect()
    for r in res:
        assert abs(r.value - pdf[r.column_name].quantile(r.prob)) < 1e-12


def test_describe_matches_pandas(spark):
    pdf = pd.DataFrame({"x": [1.0, 2.0, 2.0, 5.0, None, 9.0]})
    d = describe(spark.createDataFrame(pdf), ["x"]).first()
    ref = pdf["x"].describe()
    assert d["count"] == ref["count"]
    for ours, theirs in [("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                         ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
        assert abs(d[ours] - ref[theirs]) < 1e-12


def test_value_counts_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "c string")
    assert [(r.value, r["count"]) for r in value_counts(df, "c").collect()] == [("b", 2), ("a", 1)]


def test_quality_reports(spark):
    fact = spark.createDataFrame([("o1", 1, "p1", "s1", -1.0, 0.0), ("o1", 1, "p1", "s2", 1.0, -2.0),
                                  ("o2", None, "p9", "s1", 1.0, 1.0), (None, 2, "p1", "s1", 1.0, 1.0)],
                                 "order_id string, order_item_id long, product_id string, seller_id string, "
                                 "price double, freight_value double")
    orders = spark.createDataFrame([("o1",)], "order_id string")
    products = spark.createDataFrame([("p1",)], "product_id string")
    sellers = spark.createDataFrame([("s1",)], "seller_id string")
    t = {"fact_order_items": fact, "dim_orders": orders, "dim_products": products, "dim_sellers": sellers}
    nulls = {(r.table_name, r.column_name): r.null_count
             for r in Q.null_key_report(t, {"fact_order_items": ["order_id", "order_item_id"]}).collect()}
    assert nulls == {("fact_order_items", "order_id"): 1, ("fact_order_items", "order_item_id"): 1}
    dups = Q.pk_duplicates(t, {"fact_order_items": ["order_id", "order_item_id"]}).collect()
    assert [(r.pk_value, r.duplicate_count) for r in dups] == [("o1|1", 2)]
    orph = sorted((r.fk_column, r.fk_value or "") for r in Q.orphans(fact, t).collect())
    assert orph == [("order_id", ""), ("order_id", "o2"), ("product_id", "p9"), ("seller_id", "s2")]
    rng = {r.column_name: r.bad_count for r in Q.range_report(t).collect()}
    assert rng == {"price": 1, "freight_value": 1}
    rep = Q.gate_report(t, "post_load")
    assert rep.where(F.col("status") == "fail").count() > 0


def test_global_rank_equals_sql_rank_with_ties_and_nulls(spark):
    from pyspark.sql import Window
    from emporium.operators.ranking import global_rank
    random.seed(11)
    rows = [(i, random.choice([None, 1.0, 2.0, 2.0, 3.5]) if i % 7 else 2.0) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, v double")
    order = [F.desc_nulls_last("v")]
    ours = {r.id: r.r for r in global_rank(df, [("v", True)], "r", partitions=7).collect()}
    ref = {r.id: r.r for r in df.withColumn("r", F.rank().over(Window.orderBy(*order))).collect()}
    assert ours == ref


def test_approximate_profiles_are_close(spark):
    from emporium.operators.profile import column_distinct_counts
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.integers(0, 5000, 20000).astype(float)})
    df = spark.createDataFrame(pdf)
    exact = column_distinct_counts(df).first().distinct_count
    approx = column_distinct_counts(df, approx_rsd=0.02).first().distinct_count
    assert abs(approx - exact) / exact < 0.1
    d = describe(df, ["a"], approx_accuracy=10000).first()
    assert abs(d.p50 - pdf["a"].median()) <= 50
