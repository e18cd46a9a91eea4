"""Slices of the stored cube against measure_frame over the tables."""
import random

import pytest
from pyspark.sql import functions as F

from emporium.plans import cube as K
from emporium.plans import measures as M
from emporium.plans.warehouse import driver_warehouse

from .conftest import SF_SMALL

BY = ["customer_state", "order_status", "purchase_year", "purchase_month", "delay_bucket"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    """With orders without a customer, a repeated order, and an order without items."""
    w = driver_warehouse(spark, SF_SMALL)
    t = {n: w[n] for n in ("dim_orders", "dim_customers", "dim_products", "dim_sellers", "dim_payments", "dim_reviews",
                           "fact_order_items")}
    t["dim_orders"] = t["dim_orders"].unionByName(t["dim_orders"].limit(3))
    return t


@pytest.fixture(scope="module")
def cube(spark, tables, tmp_path_factory):
    return K.MeasureCube.build(tables, str(tmp_path_factory.mktemp("cube")), BY, ["product_category_name_english", "seller_city"],
                               ["payment_type"], ["review_score"])


@pytest.mark.parametrize("by, where, item_where", [
    ([], None, None), (["customer_state", "order_status"], None, None), (["purchase_month"], "order_status = 'delivered'", None),
    (["purchase_year"], "customer_state = 'ASIA' OR customer_state IS NULL", "seller_city <> 'sao paulo'"),
    (["product_category_name_english", "customer_state"], None, None), (["seller_city"], "delay_bucket = 'Late'", None),
    (["delay_bucket"], "purchase_year = 1900", None)])
def test_slices_equal_the_measures_over_the_tables(cube, tables, by, where, item_where):
    got, want = cube.frame(by=by, where=where, item_where=item_where), M.measure_frame(tables, by=by, where=where, item_where=item_where)
    assert got.columns == want.columns and rows(got) == rows(want)


@pytest.mark.parametrize("by", [["payment_type", "customer_state"], ["review_score"], ["order_status"]])
def test_payment_and_review_slices(cube, tables, by):
    assert rows(cube.frame(M.ALL_MEASURES, by)) == rows(M.measure_frame(tables, M.ALL_MEASURES, by))


def test_fields_that_the_cube_lacks(cube):
    with pytest.raises(ValueError, match="purchase_weekday"):
        cube.frame(by=["purchase_weekday"])
    with pytest.raises(ValueError):
        cube.frame(by=["payment_type", "review_score"])
    with pytest.raises(ValueError):
        cube.frame(["nothing"])


def test_numbers_are_dense_and_unions_exact(spark):
    rng = random.Random(4)
    keys = [None, *map(str, range(90_000))]
    data = [(rng.choice("abc"), rng.choice("xyz"), rng.choice(keys)) for _ in range(60_000)]
    df = spark.createDataFrame(data, "g string, h string, k string").repartition(5)
    numbers = K.dense_numbers(df, "k", "n")
    found = numbers.agg(F.count("*"), F.count_distinct("n"), F.min("n"), F.max("n")).first()
    assert tuple(found) == (df.select("k").where("k IS NOT NULL").distinct().count(),) * 2 + (0, found[0] - 1)
    cells = K.bitmaps(df.join(numbers, "k"), ["g", "h"], "n")
    assert cells.select(K.CELL).distinct().count() == -(-found[0] // 32_768) > 1
    for by in (["g", "h"], ["g"], ["h"], []):
        want = df.groupBy(*by).agg(F.count_distinct("k").alias("n"))
        assert rows(K.united_counts(cells, by, "n")) == rows(want)
    assert K.dense_numbers(df.limit(0), "k", "n").count() == 0


def test_measure_frame_has_one_distinct(tables):
    plan = M.measure_frame(tables, ["total_orders", "active_customers"], by=["order_status"])._jdf.queryExecution().optimizedPlan()
    assert "Expand" not in plan.toString()
