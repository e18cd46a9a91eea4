"""The two warehouse views.

``base_order_items`` (item grain, 13 columns) and ``seller_monthly`` (one row per
purchase month and seller). Both exist as DataFrame functions and as SQL views
registered in the session catalog (:func:`register_views`).

``seller_monthly`` is computed in a pre-aggregated form that gives the same
numbers as the item-grain SQL:

* items are first summed per (order, seller) -- map-side partial aggregation, so a
  hot order or hot seller is collapsed before any shuffle;
* orders are reduced to (order, month) with a multiplicity, so the join is
  at most one row per (order, seller, month) and never fans out;
* ``COUNT(DISTINCT order_id)`` becomes ``COUNT(*)`` of those unique rows, which
  removes the distinct-aggregation double shuffle;
* the review average joins reviews pre-summed per order to items pre-counted per
  (order, seller), i.e. the 1:N fan-out of the SQL is replaced by weights, and
  it is computed in the same pass as the monthly metrics (no second fact scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import temporal as TM
from ..operators.skewjoin import hot_keys_of, skew_join

BASE_COLUMNS = ["order_id", "product_id", "seller_id", "order_item_id", "price", "freight_value",
                "gmv_item", "order_status", "order_purchase_timestamp", "order_approved_at",
                "order_delivered_customer_date", "order_estimated_delivery_date",
                "product_category_name"]


def base_order_items(fact: DataFrame, orders: DataFrame, products: DataFrame, hot_keys: bool = False) -> DataFrame:
    """The item-grain view. A hot order or product is left to AQE; ``hot_keys`` looks for such keys first
    (``operators.skewjoin``) and joins their items without a shuffle."""
    o = orders.select("order_id", "order_status", "order_purchase_timestamp", "order_approved_at",
                      "order_delivered_customer_date", "order_estimated_delivery_date")
    p = products.select("product_id", "product_category_name")
    if hot_keys:
        hot = hot_keys_of(fact, ["order_id", "product_id"])
        items = skew_join(skew_join(fact, o, "order_id", hot=hot["order_id"]), p, "product_id", "left", hot["product_id"])
    else:
        items = fact.join(o, "order_id", "inner").join(p, "product_id", "left")
    return items.withColumn("gmv_item", F.col("price") + F.col("freight_value")).select(*BASE_COLUMNS)


def items_per_order_seller(fact: DataFrame) -> DataFrame:
    """(order_id, seller_id) -> n_items, gmv. The workhorse pre-aggregation."""
    return (fact.groupBy("order_id", "seller_id")
            .agg(F.count(F.lit(1)).alias("n_items"),
                 F.sum(F.col("price") + F.col("freight_value")).alias("gmv")))


def order_months(orders: DataFrame) -> DataFrame:
    """(order_id, month) -> multiplicity k and on-time count t (k = 1 when the PK holds)."""
    return (orders.select("order_id",
                          TM.month_start("order_purchase_timestamp").alias("month"),
                          TM.on_time_flag("order_delivered_customer_date",
                                          "order_estimated_delivery_date").alias("flag"))
            .groupBy("order_id", "month")
            .agg(F.count(F.lit(1)).alias("k"), F.sum("flag").alias("t")))


def review_sums_per_order(reviews: DataFrame) -> DataFrame:
    """order_id -> sum and count of non-null review scores (one row per order)."""
    return (reviews.where(F.col("order_id").isNotNull()).groupBy("order_id")
            .agg(F.sum("review_score").alias("s"), F.count("review_score").alias("c")))


def seller_monthly(fact: DataFrame, orders: DataFrame, reviews: DataFrame,
                   ordered: bool = True) -> DataFrame:
    """The seller-month view in one pass over the fact.

    Items per (order, seller) meet the order months and the per-order review sums
    on ``order_id`` (one key, one partitioning, no fan-out). One aggregation by
    (month, seller) yields the base metrics and each group's share of the review
    sums; the seller-level review average is then a window over those already
    aggregated rows (a few per seller). Fact rows whose order is missing still
    count for reviews, as in the SQL; an order listed under several months
    contributes its reviews once (on its first month).
    """
    per_os = items_per_order_seller(fact)
    om = order_months(orders)
    om = om.withColumn("first", F.col("month").eqNullSafe(F.min("month").over(Window.partitionBy("order_id"))))
    j = (per_os.join(om, "order_id", "left")
         .join(review_sums_per_order(reviews), "order_id", "left"))
    k, n = F.col("k"), F.col("n_items")
    once = F.col("k").isNull() | F.col("first")
    g = (j.groupBy("month", "seller_id")
         .agg(F.count("k").alias("orders"),
              F.sum(n * k).alias("items"),
              F.sum(F.col("gmv") * k).cast("decimal(38,2)").alias("gmv"),
              F.sum(n * F.col("t")).alias("on_time_items"),
              F.sum(F.when(once, n * F.col("s"))).alias("rs"),
              F.sum(F.when(once, n * F.col("c"))).alias("rc")))
    by_seller = Window.partitionBy("seller_id")
    out = (g.withColumn("avg_review", N.safe_divide(F.sum("rs").over(by_seller), F.sum("rc").over(by_seller)))
           .where(F.col("orders") > 0)
           .select("month", "seller_id", "orders", "items", "gmv",
                   N.safe_divide("on_time_items", "items").alias("on_time_rate"), "avg_review"))
    return out.orderBy("month", "seller_id") if ordered else out


# ---------------------------------------------------------------------------
# SQL form (catalog views over registered tables)
# ---------------------------------------------------------------------------
BASE_ORDER_ITEMS_SQL = """
CREATE OR REPLACE TEMP VIEW base_order_items AS
WITH sold AS (
  SELECT order_id, order_status, order_purchase_timestamp, order_approved_at,
         order_delivered_customer_date, order_estimated_delivery_date
  FROM dim_orders
), kinds AS (
  SELECT product_id, product_category_name FROM dim_products
)
SELECT order_id, product_id, seller_id, order_item_id, price, freight_value, price + freight_value AS gmv_item,
       order_status, order_purchase_timestamp, order_approved_at, order_delivered_customer_date,
       order_estimated_delivery_date, product_category_name
FROM fact_order_items
INNER JOIN sold USING (order_id) LEFT OUTER JOIN kinds USING (product_id)
"""

# The catalog view, in the same pre-aggregated form as ``seller_monthly``.
# (In SQL, WHERE runs before window functions, hence the outer filter.)
SELLER_MONTHLY_SQL = """
CREATE OR REPLACE TEMP VIEW vw_seller_monthly AS
WITH per_os AS (
  SELECT order_id, seller_id, COUNT(*) AS n_items, SUM(price + freight_value) AS gmv
  FROM fact_order_items GROUP BY order_id, seller_id
), om AS (
  SELECT order_id, month, k, t, month <=> MIN(month) OVER (PARTITION BY order_id) AS first
  FROM (SELECT order_id,
               CAST(trunc(CAST(order_purchase_timestamp AS DATE), 'MM') AS TIMESTAMP_NTZ) AS month,
               COUNT(*) AS k,
               SUM(CASE WHEN order_delivered_customer_date IS NOT NULL
                         AND order_delivered_customer_date <= order_estimated_delivery_date
                        THEN 1 ELSE 0 END) AS t
        FROM dim_orders GROUP BY 1, 2) m
), rv AS (
  SELECT order_id, SUM(review_score) AS s, COUNT(review_score) AS c
  FROM dim_reviews WHERE order_id IS NOT NULL GROUP BY order_id
), g AS (
  SELECT om.month, p.seller_id, COUNT(om.k) AS orders, SUM(p.n_items * om.k) AS items,
         CAST(SUM(p.gmv * om.k) AS DECIMAL(38,2)) AS gmv, SUM(p.n_items * om.t) AS on_time_items,
         SUM(CASE WHEN om.k IS NULL OR om.first THEN p.n_items * rv.s END) AS rs,
         SUM(CASE WHEN om.k IS NULL OR om.first THEN p.n_items * rv.c END) AS rc
  FROM per_os p LEFT JOIN om ON om.order_id = p.order_id LEFT JOIN rv ON rv.order_id = p.order_id
  GROUP BY om.month, p.seller_id
), w AS (
  SELECT month, seller_id, orders, items, gmv,
         try_divide(CAST(on_time_items AS DOUBLE), CAST(items AS DOUBLE)) AS on_time_rate,
         try_divide(CAST(SUM(rs) OVER (PARTITION BY seller_id) AS DOUBLE),
                    CAST(SUM(rc) OVER (PARTITION BY seller_id) AS DOUBLE)) AS avg_review
  FROM g
)
SELECT month, seller_id, orders, items, gmv, on_time_rate, avg_review
FROM w WHERE orders > 0
ORDER BY month, seller_id
"""


def register_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def register_views(spark: SparkSession) -> None:
    """Define both views in the session catalog (the tables must be registered)."""
    spark.sql(BASE_ORDER_ITEMS_SQL)
    spark.sql(SELLER_MONTHLY_SQL)
