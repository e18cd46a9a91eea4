"""The stored seller-month view against the full view, batch by batch."""
import os
import random

import pytest
from pyspark.sql import functions as F

from emporium.plans import views as V
from emporium.plans.incremental import Changes, SellerMonthlyStore
from emporium.plans.warehouse import driver_warehouse

from .conftest import SF_SMALL

NAMES = ("fact_order_items", "dim_orders", "dim_reviews")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def full(fact, orders, reviews):
    return rows(V.seller_monthly(fact, orders, reviews))


@pytest.fixture(scope="module")
def tables(spark):
    w = driver_warehouse(spark, SF_SMALL)
    kept = [w[n].withColumn("u", F.expr("uuid()")).cache() for n in NAMES]
    yield [df.drop("u") for df in kept]
    for df in kept:
        df.unpersist()


def union(*frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def test_batches_in_any_order_equal_the_full_view(spark, tables, tmpdir_path):
    """Items, orders and reviews of one order arrive in different batches."""
    store = SellerMonthlyStore(spark, f"{tmpdir_path}/store", parts=4)
    assert rows(store.view()) == []
    so_far = [df.limit(0) for df in tables]
    for k in range(3):
        some = [df.where(F.pmod(F.xxhash64(F.lit(7 * i), "order_id", *df.columns[1:2]), F.lit(3)) == k)
                for i, df in enumerate(tables)]
        assert store.apply(Changes(*some), batch_id=str(k))
        assert not store.apply(Changes(*some), batch_id=str(k))
        so_far = [union(a, b) for a, b in zip(so_far, some)]
        assert rows(store.view()) == full(*so_far)
    assert rows(store.view()) == full(*tables)
    again = SellerMonthlyStore(spark, f"{tmpdir_path}/store")
    again.compact()
    assert rows(again.view()) == full(*tables) and len(os.listdir(f"{tmpdir_path}/store")) == 3  # run, state and its crc
    assert not again.apply(Changes(*tables), batch_id="1")


def test_removed_and_changed_rows(spark, tables, tmpdir_path):
    fact, orders, reviews = tables
    store = SellerMonthlyStore(spark, f"{tmpdir_path}/store", parts=3)
    store.apply(Changes(fact, orders, reviews))
    # a seller leaves, orders are delivered late, reviews are withdrawn
    gone = fact.where(F.col("seller_id") == fact.first().seller_id)
    old = orders.where(F.pmod(F.xxhash64("order_id"), F.lit(4)) == 0)
    new = old.withColumn("order_delivered_customer_date", F.expr("order_estimated_delivery_date + INTERVAL 3 DAYS"))
    withdrawn = reviews.where("review_score = 1")
    store.apply(Changes(orders=new), Changes(gone, old, withdrawn))
    left = [fact.where(F.col("seller_id") != fact.first().seller_id), orders.exceptAll(old).unionByName(new),
            reviews.where("review_score <> 1 OR review_score IS NULL")]
    assert rows(store.view()) == full(*left)
    store.apply(Changes(), Changes(*left))
    assert rows(store.view()) == []
    store.compact()
    assert rows(store.view()) == [] and rows(store._read("items")) == []


def test_broken_keys_and_nulls(spark, tmpdir_path):
    """Orders under several months, items without orders, null ids, reviews without scores, one hot order."""
    rng = random.Random(3)
    fact = [(rng.choice(["a", "b", "c", "d", None]), str(i), "p", rng.choice(["s", "t", None]), "1.10", "0.05")
            for i in range(60)] + [("hot", str(i), "p", "s", "2.00", "0.00") for i in range(40)]
    days = [None, "2020-01-05 00:00:00", "2020-01-20 00:00:00", "2020-03-01 00:00:00"]
    orders = [(rng.choice(["a", "b", "c", "hot", None]), rng.choice(days), rng.choice(days), days[2]) for _ in range(12)]
    reviews = [(str(i), rng.choice(["a", "b", "d", "hot", None]), rng.choice([1, 5, None])) for i in range(15)]
    frames = (spark.createDataFrame(fact, "order_id string, order_item_id string, product_id string, seller_id string, "
                                          "price string, freight_value string")
              .withColumns({c: F.col(c).cast("decimal(10,2)") for c in ("price", "freight_value")}),
              spark.createDataFrame(orders, "order_id string, order_purchase_timestamp string, "
                                            "order_delivered_customer_date string, order_estimated_delivery_date string")
              .select("order_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in (
                  "order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date")]),
              spark.createDataFrame(reviews, "review_id string, order_id string, review_score bigint"))
    store = SellerMonthlyStore(spark, f"{tmpdir_path}/store", parts=2)
    for i in range(3):
        one = [f if j == i else None for j, f in enumerate(frames)]
        store.apply(Changes(*one))
    assert rows(store.view()) == full(*frames)


def test_a_batch_reads_the_touched_orders_only(spark, tables, tmpdir_path, monkeypatch):
    fact, orders, reviews = tables
    store = SellerMonthlyStore(spark, f"{tmpdir_path}/store", parts=16)
    store.apply(Changes(fact, orders, reviews))
    one = orders.where(F.col("order_purchase_timestamp").isNotNull()).first().order_id
    read, real = [], store._read
    monkeypatch.setattr(store, "_read", lambda t, parts=None: (read.append((t, parts, real(t, parts).inputFiles())), real(t, parts))[1])
    more = fact.limit(1).withColumn("order_id", F.lit(one))
    store.apply(Changes(fact=more))
    assert {t for t, _, _ in read} == {"items", "orders", "reviews"} and all(len(p) == 1 for _, p, _ in read)
    assert all(len({f.rsplit("/", 2)[1] for f in files}) <= 1 for _, _, files in read)
    assert rows(store.view()) == full(fact.unionByName(more), orders, reviews)


def test_a_failed_batch_leaves_no_trace(spark, tables, tmpdir_path):
    fact, orders, reviews = tables
    store = SellerMonthlyStore(spark, f"{tmpdir_path}/store", parts=2)
    store.apply(Changes(fact, orders, reviews), batch_id="all")
    held = rows(store.view())
    bad = reviews.withColumn("review_score", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        store.apply(Changes(fact, orders, bad), batch_id="next")
    assert rows(SellerMonthlyStore(spark, f"{tmpdir_path}/store").view()) == held
