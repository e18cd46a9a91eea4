"""Derive the nine marketplace sources from the driver's TPC-H-shaped tables.

The driver ships ``region nation customer supplier part orders lineitem
conversations`` as Parquet. This adapter re-labels them into the marketplace
source shapes (FIXTURES.md section 3) so the cleaning pipelines see realistic
input. The modulo expressions below *inject* edge cases (null categories,
chronology violations, repeated review ids ...) into every row range; they never
filter rows away, so every source keeps all rows of its driver table.

Output columns carry proper types already (timestamps, numbers); the cleaning
pipelines conform whatever arrives (strings from CSV or typed values from here)
to the warehouse schema with ``try_cast``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "conversations")

# nation (25 rows) and region (5 rows) have a fixed size by the TPC-H definition;
# they are the only frames we hint for broadcast explicitly.
FIXED_SIZE_TABLES = ("nation", "region")


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _days(n) -> Column:
    n = n if isinstance(n, Column) else F.lit(n)
    return F.make_dt_interval(days=n.cast("int"))


def _geo_of_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_driver_table(spark, sf_dir, "nation")
    region = read_driver_table(spark, sf_dir, "region")
    return F.broadcast(
        nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
        .select("n_nationkey", "n_name", "r_name"))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_driver_table(spark, sf_dir, "customer")
    return (c.join(_geo_of_nation(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"))
            .select(F.col("c_custkey").cast("string").alias("customer_id"),
                    F.col("c_name").alias("customer_unique_id"),
                    F.col("c_nationkey").cast("string").alias("customer_zip_code_prefix"),
                    F.col("n_name").alias("customer_city"),
                    F.col("r_name").alias("customer_state")))


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_driver_table(spark, sf_dir, "customer")
    return (c.join(_geo_of_nation(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"))
            .select(F.col("c_nationkey").cast("string").alias("geolocation_zip_code_prefix"),
                    (F.col("c_custkey") % 90).cast("double").alias("geolocation_lat"),
                    (F.col("c_custkey") % 7).cast("double").alias("geolocation_lng"),
                    F.col("n_name").alias("geolocation_city"),
                    F.col("r_name").alias("geolocation_state")))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_driver_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.cast("string").alias("product_id"),
        # A category only the hand-appended translations know, and one nobody knows.
        F.when(k % 53 == 0, F.lit(None).cast("string")).when(k % 41 == 0, F.lit("pc_gamer"))
        .when(k % 43 == 0, F.lit("unlisted_category")).otherwise(F.col("p_brand"))
        .alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_type").alias("product_description_lenght"),
        (F.col("p_size") % 6).alias("product_photos_qty"),
        F.when(k % 31 == 0, F.lit(None).cast("double"))
        .when(k % 37 == 0, F.lit(0.0)).otherwise(F.col("p_size").cast("double"))
        .alias("product_weight_g"),
        F.col("p_retailprice").alias("product_length_cm"),
        F.col("p_size").cast("double").alias("product_height_cm"),
        F.col("p_size").cast("double").alias("product_width_cm"))


def raw_product_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_driver_table(spark, sf_dir, "part")
    # A brand is named once for each of its part sizes: the first row of a category wins.
    return p.select(F.col("p_brand").alias("product_category_name"),
                    F.concat(F.lit("en_"), F.col("p_brand"), F.when(F.col("p_size") % 2 == 1, F.lit("_odd"))
                             .otherwise(F.lit(""))).alias("product_category_name_english"),
                    F.col("p_partkey").alias("src_ord"))


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_driver_table(spark, sf_dir, "supplier")
    n = F.broadcast(read_driver_table(spark, sf_dir, "nation"))
    m = F.col("s_suppkey") % 5
    # Messy city spellings exercised by the seller cleaning rules.
    city = (F.when(m == 0, F.lit(" São Paulo - SP "))
            .when(m == 1, F.lit("Rio de Janeiro / RJ"))
            .when(m == 2, F.lit("SAO MIGUEL"))
            .when(m == 3, F.lit("Brasília"))
            .otherwise(F.col("n_name")))
    return (s.join(n, s.s_nationkey == n.n_nationkey)
            .select(F.col("s_suppkey").cast("string").alias("seller_id"),
                    F.col("s_nationkey").cast("string").alias("seller_zip_code_prefix"),
                    city.alias("seller_city"),
                    F.col("n_name").alias("seller_state")))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_driver_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    # Every 71st order lies years ahead and has no valid item (raw_order_items): periods without items.
    d = F.when(k % 71 == 0, F.col("o_orderdate") + F.make_ym_interval(F.lit(20))).otherwise(F.col("o_orderdate"))
    status = (F.when(F.col("o_orderstatus") == "F", "delivered")
              .when(F.col("o_orderstatus") == "O", "shipped").otherwise("canceled"))
    return o.select(
        k.cast("string").alias("order_id"),
        F.when(k % 61 != 0, F.col("o_custkey").cast("string")).alias("customer_id"),
        status.alias("order_status"),
        d.alias("order_purchase_timestamp"),
        F.when(k % 97 == 0, d - _days(1)).otherwise(d + F.make_dt_interval(hours=F.lit(1).cast("int")))
        .alias("order_approved_at"),
        F.when(k % 89 == 0, d - _days(2)).otherwise(d + _days(1 + k % 4))
        .alias("order_delivered_carrier_date"),
        F.when(k % 17 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(d + _days(5 + k % 41))
        .alias("order_delivered_customer_date"),
        (d + _days(F.lit(24))).alias("order_estimated_delivery_date"))


def raw_order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_driver_table(spark, sf_dir, "orders")
    pr = F.col("o_orderpriority")
    # Priority -> payment type.
    ptype = (F.when(pr == "1-URGENT", "credit_card").when(pr == "2-HIGH", "boleto")
             .when(pr == "3-MEDIUM", "voucher").when(pr == "4-NOT SPECIFIED", "not_defined")
             .otherwise("debit_card"))
    ptype = F.when(F.col("o_orderkey") % 29 != 0, ptype)
    return o.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        ptype.alias("payment_type"),
        (1 + F.col("o_orderkey") % 12).alias("payment_installments"),
        # Text, as a CSV file has it; a value that is no number is rejected by the load.
        F.when(F.col("o_orderkey") % 103 == 0, F.lit("abc"))
        .otherwise(F.col("o_totalprice").cast("decimal(10,2)").cast("string")).alias("payment_value"))


def raw_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews keep ``src_ord`` (the file-order ordinal) so first-wins dedup is defined."""
    o = read_driver_table(spark, sf_dir, "orders")
    c = read_driver_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    turn = F.coalesce(F.col("turn"), F.lit(0))
    own = F.when(k % 50 == 1, k - 1).otherwise(k).cast("string")
    # Every turn of a conversation is a review of its order; the first one has the order's number.
    return (o.join(c, k == c.conv_id, "left")
            .select(F.when(turn == 0, own).otherwise(F.concat_ws("-", own, turn.cast("string"))).alias("review_id"),
                    k.cast("string").alias("order_id"),
                    (1 + (k + turn) % 5).alias("review_score"),
                    F.col("role").alias("review_comment_title"),
                    F.col("text").alias("review_comment_message"),
                    (d + _days(F.lit(30))).alias("review_creation_date"),
                    (d + _days(F.lit(31))).alias("review_answer_timestamp"),
                    (k * 1000 + turn).alias("src_ord")))


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_driver_table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    return li.select(
        k.cast("string").alias("order_id"),
        # Text, as a CSV file has it: a number that is none becomes 0, a date that is none is null.
        F.when(k % 101 == 0, F.lit("x")).otherwise(F.col("l_linenumber").cast("string")).alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.when(k % 83 == 0, F.lit("not a date"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("shipping_limit_date"),
        # The amounts stay as they are read, so the range filter reaches the scan.
        F.col("l_extendedprice").alias("price"),
        F.when(k % 71 == 0, F.lit(-1.0)).otherwise(F.col("l_quantity")).alias("freight_value"))


BUILDERS = {
    "customers": raw_customers,
    "geolocation": raw_geolocation,
    "order_items": raw_order_items,
    "order_payments": raw_order_payments,
    "order_reviews": raw_order_reviews,
    "orders": raw_orders,
    "products": raw_products,
    "sellers": raw_sellers,
    "product_category_translation": raw_product_category_translation,
}


class _LazySources(Mapping):
    """Builds a source DataFrame only when a pipeline asks for it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = BUILDERS[name](self._spark, self._dir)
        return self._built[name]

    def __iter__(self):
        return iter(BUILDERS)

    def __len__(self) -> int:
        return len(BUILDERS)

    def available(self, name: str) -> bool:
        return name in BUILDERS


def marketplace_sources(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """All nine sources, lazily defined over the driver tables of ``sf_dir``."""
    return _LazySources(spark, sf_dir)
