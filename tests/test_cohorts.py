"""Stored cohorts against their computation from all rows."""
import os
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from emporium.plans import measures as M
from emporium.plans.cohorts import CohortStore
from emporium.plans.warehouse import driver_warehouse

from .conftest import SF_SMALL

ORDERS = "order_id string, customer_id string, order_purchase_timestamp timestamp_ntz"
FACT = "order_id string, price decimal(10,2), freight_value decimal(10,2)"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    w = driver_warehouse(spark, SF_SMALL)
    # a third of the orders is of one customer
    hot = F.when(F.pmod(F.xxhash64("order_id"), F.lit(3)) == 0, F.lit("hot")).otherwise(F.col("customer_id"))
    kept = [w["dim_orders"].withColumn("customer_id", hot).cache(), w["fact_order_items"].cache()]
    yield kept
    for df in kept:
        df.unpersist()


def test_shuffled_arrivals_equal_recomputation(spark, tables, tmpdir_path):
    orders, fact = tables
    store = CohortStore(spark, f"{tmpdir_path}/s", parts=4)
    assert rows(store.view()) == []

    def some(df, k, *by):
        return df.where(F.pmod(F.xxhash64(F.lit(11), *by), F.lit(2)) == k)

    batches = [(some(orders, 1, "order_id"), some(fact, 0, "order_id", "product_id")),
               (some(orders, 0, "order_id"), some(fact, 1, "order_id", "product_id"))]
    for i, (o, f) in enumerate(batches):
        assert store.apply(o, f, batch_id=str(i))
        assert not store.apply(o, f, batch_id=str(i))
        if i == 0:
            part = {"dim_orders": o, "fact_order_items": f}
            assert rows(store.view()) == rows(M.first_purchase_cohort(part))
    full = rows(M.first_purchase_cohort({"dim_orders": orders, "fact_order_items": fact}))
    assert rows(store.view()) == full and len(full) > 3
    again = CohortStore(spark, f"{tmpdir_path}/s")
    again.compact()
    assert rows(again.view()) == full and len(os.listdir(f"{tmpdir_path}/s")) == 3
    first = (orders.where("customer_id IS NOT NULL").groupBy("customer_id")
             .agg(F.min("order_purchase_timestamp").alias("t"), F.count("order_id").alias("n")))
    assert rows(again.customers().select("customer_id", "first_purchase", "orders")) == rows(first)


def test_a_late_order_moves_its_customer(spark, tmpdir_path):
    store = CohortStore(spark, f"{tmpdir_path}/s", parts=2)

    def orders(*r):
        return spark.createDataFrame(r, ORDERS)

    def items(*r):
        return spark.createDataFrame([(o, Decimal(p), Decimal("1.00")) for o, p in r], FACT)

    may, june = datetime(2018, 5, 3), datetime(2018, 6, 9)
    store.apply(orders(("a", "c1", june), ("b", "c2", june), ("z", None, may)), items(("a", "9.00")))
    assert rows(store.view()) == [(datetime(2018, 6, 1), 2, 2, Decimal("10.00"))]
    store.apply(orders(("c", "c1", may)))
    assert rows(store.view()) == [(datetime(2018, 5, 1), 1, 2, Decimal("10.00")), (datetime(2018, 6, 1), 1, 1, None)]
    store.apply(fact=items(("b", "4.00"), ("c", "2.00"), ("unknown", "7.00"), (None, "7.00")))
    store.apply(orders(("b", "c2", june), ("b", "c2", may)))  # the order again, once earlier: one order, the earlier time
    assert rows(store.view()) == [(datetime(2018, 5, 1), 2, 3, Decimal("18.00"))]
    store.apply(orders((None, "c3", june), ("d", "c4", None)))
    assert (None, 1, 1, None) in rows(store.view())
    assert (datetime(2018, 6, 1), 1, 0, None) in rows(store.view())


def test_empty_batches(spark, tmpdir_path):
    store = CohortStore(spark, f"{tmpdir_path}/s")
    assert store.apply() and store.apply(spark.createDataFrame([], ORDERS), spark.createDataFrame([], FACT))
    assert rows(store.view()) == rows(store.customers()) == []


def test_a_batch_reads_only_the_folders_it_touches(spark, tables, tmpdir_path):
    orders, fact = tables
    store = CohortStore(spark, f"{tmpdir_path}/s", parts=64)
    store.apply(orders, fact)
    one = orders.where("customer_id <> 'hot'").limit(1).select("order_id", "customer_id", "order_purchase_timestamp").collect()
    seen = []
    read = store._read
    store._read = lambda table, parts=None: seen.append((table, parts)) or read(table, parts)
    store.apply(spark.createDataFrame([("new", one[0].customer_id, datetime(1980, 1, 1))], ORDERS))
    assert seen and all(parts is not None and len(parts) <= 1 for _, parts in seen)
    assert (datetime(1980, 1, 1), 1) in [r[:2] for r in rows(store.view())]
