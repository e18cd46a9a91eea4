"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator group.

Every query reads the driver tables of ``sf_dir`` in full and runs the library
operator on them; ``ORACLE`` holds the matching DuckDB SQL (written at row
grain, independently of the Spark plans).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .operators import dedup as DD
from .operators import profile as P
from .operators import quality as Q
from .plans import clean as C
from .plans import measures as M
from .plans import views as V
from .plans.clean import CleanOptions
from .plans.cohorts import CohortStore
from .plans.cube import MeasureCube
from .plans.incremental import Changes, SellerMonthlyStore
from .plans.warehouse import driver_warehouse
from .schema import TABLES
from .session import ensure_checkpoint_dir
from .sources import csv_source as CS
from .sources import warehouse as WH
from .sources.driver_tables import marketplace_sources
from .sources.snapshots import new_run

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _table_query(name: str, opts: CleanOptions = CleanOptions()) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return driver_warehouse(spark, sf_dir, opts)[name]
    return run


# --- views (E10, E11) -------------------------------------------------------
@register("v_seller_monthly", O.seller_monthly())
def q_seller_monthly(spark, sf_dir):
    w = driver_warehouse(spark, sf_dir)
    return V.seller_monthly(w["fact_order_items"], w["dim_orders"], w["dim_reviews"])


# --- load and CSV (S1, S8-S10) ------------------------------------------------------
@register("load_rejects", O.with_ctes("""
SELECT 'dim_payments' AS table_name, 'payment_value' AS columns, order_id, payment_value
FROM raw_order_payments WHERE TRY_CAST(payment_value AS DOUBLE) IS NULL AND payment_value IS NOT NULL
  AND payment_type IS DISTINCT FROM 'not_defined'"""))
def q_load_rejects(spark, sf_dir):
    """The rows that a load of all tables sets aside, with the columns that did not convert."""
    tables = driver_warehouse(spark, sf_dir, CleanOptions(keep_rejects=True))
    bad = [WH.split_rejects(df, TABLES[t])[1] for t, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), bad).select(
        "table_name", "columns", *[F.get_json_object("_raw", f"$.{c}").alias(c) for c in ("order_id", "payment_value")])


@register("csv_blocks_reviews", O.table("dim_reviews"))
def q_csv_blocks_reviews(spark, sf_dir):
    """The reviews written as CSV (texts with commas, quotes and newlines), read back block by block, and cleaned."""
    reviews = marketplace_sources(spark, sf_dir)["order_reviews"]
    path = CS.write_csv_sources({"order_reviews": reviews}, f"{ensure_checkpoint_dir(spark)}/csv-{new_run()}")
    return C.clean_reviews(CS.read_csv_source(spark, "order_reviews", path["order_reviews"], CS.BLOCKS))


@register("v_seller_monthly_stored", O.seller_monthly())
def q_seller_monthly_stored(spark, sf_dir):
    """The view from a store that got the history first, then the orders of the last year, and the reviews last."""
    w = driver_warehouse(spark, sf_dir)
    fact, orders, reviews = w["fact_order_items"], w["dim_orders"], w["dim_reviews"]
    last = orders.agg(F.add_months(F.max("order_purchase_timestamp").cast("date"), -12).alias("since"))
    recent = orders.join(F.broadcast(last), F.col("order_purchase_timestamp") >= F.col("since")).select(*orders.columns)
    ids = recent.select("order_id")
    store = SellerMonthlyStore(spark, f"{ensure_checkpoint_dir(spark)}/seller-monthly-{new_run()}")
    store.apply(Changes(fact.join(ids, "order_id", "left_anti"), orders.join(ids, "order_id", "left_anti")), batch_id="history")
    store.apply(Changes(fact.join(ids, "order_id", "left_semi"), orders.join(ids, "order_id", "left_semi")), batch_id="recent")
    store.apply(Changes(reviews=reviews), batch_id="reviews")
    return store.view()


@register("v_base_order_items", O.table("base_order_items"))
def q_base_order_items(spark, sf_dir):
    w = driver_warehouse(spark, sf_dir)
    return V.base_order_items(w["fact_order_items"], w["dim_orders"], w["dim_products"])


@register("v_base_order_items_hot", O.table("base_order_items"))
def q_base_order_items_hot(spark, sf_dir):
    w = driver_warehouse(spark, sf_dir)
    return V.base_order_items(w["fact_order_items"], w["dim_orders"], w["dim_products"], hot_keys=True)


# --- cleaned tables (E1-E8) and option branches --------------------------------
for _t in TABLES:
    register(_t, O.table(_t))(_table_query(_t))

register("dim_orders_chronology", O.with_ctes(f"""
SELECT * FROM dim_orders WHERE NOT (
  (coalesce(order_approved_at < order_purchase_timestamp, false)
   OR coalesce(order_delivered_carrier_date < order_approved_at, false)
   OR coalesce(order_delivered_customer_date < order_delivered_carrier_date, false)
   OR coalesce(order_estimated_delivery_date < order_purchase_timestamp, false))
  AND order_delivered_customer_date IS NOT NULL)"""))(
    _table_query("dim_orders", CleanOptions(enforce_chronology=True)))

register("dim_products_imputed", O.with_ctes("""
, med AS (SELECT median(product_weight_g) AS w, median(product_length_cm) AS l, median(product_height_cm) AS h,
                 median(product_width_cm) AS wd FROM raw_products WHERE product_category_name IS NOT NULL),
filled AS (SELECT p.product_id, p.product_category_name, p.product_name_lenght, p.product_description_lenght,
             p.product_photos_qty, coalesce(p.product_weight_g, m.w) AS product_weight_g,
             coalesce(p.product_length_cm, m.l) AS product_length_cm, coalesce(p.product_height_cm, m.h) AS product_height_cm,
             coalesce(p.product_width_cm, m.wd) AS product_width_cm
           FROM raw_products p, med m WHERE p.product_category_name IS NOT NULL)
SELECT p.product_id, p.product_category_name,
  CAST(round(product_name_lenght) AS BIGINT) AS product_name_length,
  CAST(round(product_description_lenght) AS BIGINT) AS product_description_length,
  CAST(round(product_photos_qty) AS BIGINT) AS product_photos_qty,
  CAST(round(product_weight_g) AS BIGINT) AS product_weight_g, CAST(round(product_length_cm) AS BIGINT) AS product_length_cm,
  CAST(round(product_height_cm) AS BIGINT) AS product_height_cm, CAST(round(product_width_cm) AS BIGINT) AS product_width_cm,
  t.product_category_name_english
FROM filled p LEFT JOIN translation t ON t.product_category_name = p.product_category_name
WHERE product_weight_g > 0 AND product_length_cm > 0 AND product_height_cm > 0 AND product_width_cm > 0"""))(
    _table_query("dim_products", CleanOptions(impute="median")))


# --- data-quality gates (Q1-Q13) ----------------------------------------------
@register("dq_pre_null_keys", O.with_ctes(O.null_keys(Q.PRE_LOAD_NULL_KEYS)))
def q_dq_pre_null_keys(spark, sf_dir):
    return Q.null_key_report(driver_warehouse(spark, sf_dir), Q.PRE_LOAD_NULL_KEYS)


@register("dq_pk_nulls", O.with_ctes(O.null_keys(Q.POST_LOAD_NULL_KEYS)))
def q_dq_pk_nulls(spark, sf_dir):
    return Q.null_key_report(driver_warehouse(spark, sf_dir), Q.POST_LOAD_NULL_KEYS)


@register("dq_ranges", O.with_ctes(O.range_checks(Q.RANGE_RULES)))
def q_dq_ranges(spark, sf_dir):
    return Q.range_report(driver_warehouse(spark, sf_dir))


@register("dq_row_counts", O.with_ctes(O.row_counts(list(TABLES))))
def q_dq_row_counts(spark, sf_dir):
    return Q.row_counts(driver_warehouse(spark, sf_dir))


@register("dq_pk_duplicates", O.with_ctes(O.pk_dups({t: list(s.pk) for t, s in TABLES.items()})))
def q_dq_pk_duplicates(spark, sf_dir):
    return Q.pk_duplicates(driver_warehouse(spark, sf_dir))


@register("dq_pk_duplicate_examples", O.with_ctes(f"""
SELECT table_name, pk_value, duplicate_count
FROM (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY pk_value) AS n
      FROM ({O.pk_dups({t: list(s.pk) for t, s in TABLES.items()})}))
WHERE n <= 5"""))
def q_dq_pk_duplicate_examples(spark, sf_dir):
    return Q.duplicate_examples(Q.pk_duplicates(driver_warehouse(spark, sf_dir)))


@register("dq_orphans", O.with_ctes(O.orphans("fact_order_items")))
def q_dq_orphans(spark, sf_dir):
    w = driver_warehouse(spark, sf_dir)
    return Q.orphans(w["fact_order_items"], w)


@register("dq_orphans_raw_items", O.with_ctes(O.orphans(
    "(SELECT * FROM raw_order_items WHERE price > 0 AND freight_value >= 0)")))
def q_dq_orphans_raw_items(spark, sf_dir):
    w = driver_warehouse(spark, sf_dir)
    return Q.orphans(C.conform_order_items(marketplace_sources(spark, sf_dir)["order_items"]), w)


@register("dq_gate_report", O.with_ctes(O.gate_report(
    Q.POST_LOAD_NULL_KEYS, Q.RANGE_RULES, {t: list(s.pk) for t, s in TABLES.items()})))
def q_dq_gate_report(spark, sf_dir):
    return Q.gate_report(dict(driver_warehouse(spark, sf_dir)), "post_load")


# --- profiling (A9-A20, U4, W2) -------------------------------------------------
@register("untranslated_categories", O.with_ctes("""
SELECT DISTINCT p.product_category_name FROM dim_products p
WHERE NOT EXISTS (SELECT 1 FROM raw_product_category_translation t WHERE t.product_category_name = p.product_category_name)"""))
def q_untranslated(spark, sf_dir):
    src = marketplace_sources(spark, sf_dir)
    return C.untranslated_categories(C.filtered_products(src["products"]),
                                     src["product_category_translation"])


@register("review_id_profile", O.with_ctes("""
SELECT review_id, COUNT(DISTINCT order_id) AS n_orders, COUNT(DISTINCT review_score) AS n_scores,
  COUNT(DISTINCT review_creation_date) AS n_creation_dates
FROM raw_order_reviews WHERE review_id IS NOT NULL GROUP BY review_id"""))
def q_review_id_profile(spark, sf_dir):
    return P.review_id_profile(C.parse_reviews(marketplace_sources(spark, sf_dir)["order_reviews"]))


def _vc_oracle(table: str, col: str) -> str:
    return O.with_ctes(f"SELECT {col} AS value, COUNT(*) AS count FROM {table} WHERE {col} IS NOT NULL GROUP BY {col}")


for _name, _table, _col in [("value_counts_order_status", "dim_orders", "order_status"),
                            ("value_counts_payment_type", "dim_payments", "payment_type"),
                            ("value_counts_seller_city", "dim_sellers", "seller_city")]:
    def _q(spark, sf_dir, _table=_table, _col=_col):
        return P.value_counts(driver_warehouse(spark, sf_dir)[_table], _col)
    register(_name, _vc_oracle(_table, _col))(_q)


def _normalized_sellers(spark, sf_dir):
    return C.normalized_sellers(marketplace_sources(spark, sf_dir)["sellers"]).select("seller_city")


@register("single_entry_cities", O.with_ctes(
    "SELECT city AS value FROM seller_city_norm WHERE city IS NOT NULL GROUP BY city HAVING COUNT(*) = 1 ORDER BY 1"))
def q_single_entry_cities(spark, sf_dir):
    return P.single_entry_values(_normalized_sellers(spark, sf_dir), "seller_city")


@register("repeated_seller_cities", O.with_ctes("""
SELECT COUNT(*) - COUNT(DISTINCT city) - CASE WHEN COUNT(*) FILTER (WHERE city IS NULL) > 0 THEN 1 ELSE 0 END
  AS repeated_values FROM seller_city_norm"""))
def q_repeated_seller_cities(spark, sf_dir):
    return DD.repeated_value_count(_normalized_sellers(spark, sf_dir), "seller_city")


@register("column_nulls", O.with_ctes(O._union_all([
    f"SELECT 'dim_orders' AS table_name, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count "
    f"FROM dim_orders" for c in TABLES["dim_orders"].columns])))
def q_column_nulls(spark, sf_dir):
    return Q.column_null_counts(driver_warehouse(spark, sf_dir)["dim_orders"], "dim_orders")


@register("column_distinct", O.with_ctes(O._union_all([
    f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS distinct_count FROM dim_products"
    for c in TABLES["dim_products"].columns])))
def q_column_distinct(spark, sf_dir):
    return P.column_distinct_counts(driver_warehouse(spark, sf_dir)["dim_products"])


_NUMERIC_PRODUCT_COLS = [f.name for f in TABLES["dim_products"].schema.fields if f.dataType.typeName() == "long"]


@register("describe_products", O.with_ctes(O.describe("dim_products", _NUMERIC_PRODUCT_COLS)))
def q_describe_products(spark, sf_dir):
    d = P.describe(driver_warehouse(spark, sf_dir)["dim_products"], _NUMERIC_PRODUCT_COLS)
    return d.withColumn("std", F.round("std", 9))


@register("duplicate_rows", O.with_ctes(
    "SELECT *, COUNT(*) - 1 AS duplicate_count FROM dim_geolocation GROUP BY ALL HAVING COUNT(*) > 1"))
def q_duplicate_rows(spark, sf_dir):
    return DD.duplicate_rows(driver_warehouse(spark, sf_dir)["dim_geolocation"])


@register("review_dedup_metrics", O.with_ctes("""
SELECT b.n AS rows_before, b.n - a.n AS rows_removed, a.n AS rows_after
FROM (SELECT COUNT(*) AS n FROM raw_order_reviews) b, (SELECT COUNT(*) AS n FROM dim_reviews) a"""))
def q_review_dedup_metrics(spark, sf_dir):
    raw = marketplace_sources(spark, sf_dir)["order_reviews"]
    return P.dedup_metrics(raw, driver_warehouse(spark, sf_dir)["dim_reviews"])


# --- measures (M1-M20) ------------------------------------------------------------
def _measure(fn):
    def run(spark, sf_dir):
        return fn(driver_warehouse(spark, sf_dir))
    return run


register("kpi_exec", O.with_ctes(f"""
SELECT f.gmv, o.total_orders, o.active_customers, f.active_sellers,
  CAST(f.gmv AS DOUBLE) / NULLIF(o.total_orders, 0) AS avg_order_value
FROM (SELECT CAST(SUM({O.GMV}) AS DECIMAL(38,2)) AS gmv, COUNT(DISTINCT seller_id) AS active_sellers
      FROM fact_order_items f) f,
     (SELECT COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT customer_id) AS active_customers FROM dim_orders) o
"""))(_measure(M.kpi_exec))

register("gmv_by_month", O.with_ctes(f"""
SELECT month, monthname(month) AS month_name, gmv, items, total_orders, avg_order_value FROM ({O.by_order_attribute(
    "CAST(date_trunc('month', o.order_purchase_timestamp) AS TIMESTAMP)", "month")})"""))(_measure(M.gmv_by_month))
register("gmv_by_year", O.with_ctes(O.by_order_attribute(
    "CAST(year(o.order_purchase_timestamp) AS INTEGER)", "year")))(_measure(M.gmv_by_year))
register("gmv_by_weekday", O.with_ctes(f"""
SELECT weekday, ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][weekday + 1] AS day_name,
  weekday >= 5 AS is_weekend, gmv, items, total_orders, avg_order_value
FROM ({O.by_order_attribute("CAST(isodow(o.order_purchase_timestamp) - 1 AS INTEGER)", "weekday")})"""))(
    _measure(M.gmv_by_weekday))

register("gmv_by_state", O.with_ctes(f"""
SELECT customer_state, gmv, total_orders, active_customers,
  CAST(gmv AS DOUBLE) / NULLIF(CAST(SUM(gmv) OVER () AS DOUBLE), 0) AS gmv_share,
  CAST(RANK() OVER (ORDER BY gmv DESC NULLS LAST) AS INTEGER) AS gmv_rank
FROM (SELECT c.customer_state, CAST(SUM(t.gmv) AS DECIMAL(38,2)) AS gmv, COUNT(DISTINCT o.order_id) AS total_orders,
        COUNT(DISTINCT o.customer_id) AS active_customers
      FROM dim_orders o LEFT JOIN dim_customers c ON c.customer_id = o.customer_id
      LEFT JOIN {O.ORDER_TOTALS} t ON t.order_id = o.order_id GROUP BY c.customer_state)"""))(
    _measure(M.gmv_by_state))

register("order_status_mix", O.with_ctes("""
SELECT order_status, COUNT(DISTINCT order_id) AS total_orders,
  CAST(COUNT(DISTINCT order_id) AS DOUBLE) / CAST(SUM(COUNT(DISTINCT order_id)) OVER () AS DOUBLE) AS order_share
FROM dim_orders GROUP BY order_status"""))(_measure(M.order_status_mix))

register("payment_mix", O.with_ctes("""
SELECT payment_type, COUNT(*) AS payments,
  CAST(COUNT(*) AS DOUBLE) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS payment_share,
  CAST(SUM(payment_value) AS DECIMAL(38,2)) AS total_value,
  CAST(SUM(payment_value) AS DOUBLE) / NULLIF(COUNT(payment_value), 0) AS avg_value
FROM dim_payments GROUP BY payment_type"""))(_measure(M.payment_mix))

register("installments_value", O.with_ctes("""
SELECT payment_installments, COUNT(*) AS payments, CAST(SUM(payment_value) AS DECIMAL(38,2)) AS total_value,
  CAST(SUM(payment_value) AS DOUBLE) / NULLIF(COUNT(payment_value), 0) AS avg_value
FROM dim_payments GROUP BY payment_installments"""))(_measure(M.installments_value))


@register("installments_corr", O.with_ctes("""
SELECT round(corr(CAST(payment_installments AS DOUBLE), CAST(payment_value AS DOUBLE)), 9) AS installments_value_corr
FROM dim_payments"""))
def q_installments_corr(spark, sf_dir):
    return M.installments_correlation(driver_warehouse(spark, sf_dir)).select(
        F.round("installments_value_corr", 9).alias("installments_value_corr"))


register("delay_bucket_reviews", O.with_ctes(f"""
SELECT {O.DELAY_BUCKET} AS delay_bucket, COUNT(*) AS reviews,
  CAST(SUM(r.review_score) AS DOUBLE) / NULLIF(COUNT(r.review_score), 0) AS avg_review_score
FROM (SELECT order_id, date_diff('day', CAST(order_estimated_delivery_date AS DATE),
                                 CAST(order_delivered_customer_date AS DATE)) AS dd FROM dim_orders) o
JOIN dim_reviews r ON r.order_id = o.order_id GROUP BY 1"""))(_measure(M.delay_bucket_reviews))

register("delivery_completion", O.with_ctes("""
SELECT COUNT(*) AS total_orders, COUNT(*) FILTER (WHERE order_status = 'delivered') AS delivered_orders,
  COUNT(*) FILTER (WHERE order_status = 'canceled') AS canceled_orders,
  CAST(COUNT(*) FILTER (WHERE order_status = 'delivered') AS DOUBLE)
    / NULLIF(COUNT(*) - COUNT(*) FILTER (WHERE order_status = 'canceled'), 0) AS completion_rate
FROM dim_orders"""))(_measure(M.delivery_completion))

register("on_time_pct", O.with_ctes(f"""
SELECT COUNT(*) FILTER (WHERE {O.D_E}) AS on_time_orders,
  COUNT(*) FILTER (WHERE order_delivered_customer_date IS NOT NULL) AS delivered_orders,
  CAST(COUNT(*) FILTER (WHERE {O.D_E}) AS DOUBLE)
    / NULLIF(COUNT(*) FILTER (WHERE order_delivered_customer_date IS NOT NULL), 0) AS on_time_pct
FROM dim_orders"""))(_measure(M.on_time_pct))

_CATEGORY_GMV = f"""
SELECT p.product_category_name_english, CAST(SUM({O.GMV}) AS DECIMAL(38,2)) AS gmv, COUNT(*) AS items
FROM fact_order_items f LEFT JOIN dim_products p ON p.product_id = f.product_id GROUP BY 1"""

register("gmv_by_category", O.with_ctes(f"""
SELECT product_category_name_english, gmv, items,
  CAST(RANK() OVER (ORDER BY gmv DESC NULLS LAST) AS INTEGER) AS gmv_rank FROM ({_CATEGORY_GMV})"""))(
    _measure(M.gmv_by_category))


@register("top_categories", O.with_ctes(f"""
SELECT product_category_name_english, gmv FROM ({_CATEGORY_GMV})
ORDER BY gmv DESC NULLS LAST, product_category_name_english ASC NULLS FIRST LIMIT 5"""))
def q_top_categories(spark, sf_dir):
    g = M.gmv_by_category(driver_warehouse(spark, sf_dir)).select("product_category_name_english", "gmv")
    return M.top_k(g, 5, [F.desc_nulls_last("gmv"), F.asc_nulls_first("product_category_name_english")])


register("seller_scorecard", O.with_ctes("""
, os AS (SELECT f.seller_id, COUNT(DISTINCT f.order_id) AS orders, COUNT(*) AS items,
           CAST(SUM(f.price + f.freight_value) AS DECIMAL(38,2)) AS gmv,
           AVG(CASE WHEN o.order_delivered_customer_date IS NOT NULL
                     AND o.order_delivered_customer_date <= o.order_estimated_delivery_date THEN 1 ELSE 0 END) AS on_time_rate
         FROM fact_order_items f JOIN dim_orders o ON o.order_id = f.order_id GROUP BY f.seller_id),
rv AS (SELECT f.seller_id, AVG(r.review_score) AS avg_review
       FROM fact_order_items f JOIN dim_reviews r ON r.order_id = f.order_id GROUP BY f.seller_id)
SELECT os.seller_id, os.orders, os.items, os.gmv, os.on_time_rate, rv.avg_review,
  CAST(RANK() OVER (ORDER BY os.gmv DESC NULLS LAST) AS BIGINT) AS gmv_rank
FROM os LEFT JOIN rv ON rv.seller_id = os.seller_id"""))(_measure(M.seller_scorecard))

_COHORTS = O.with_ctes(f"""
, pc AS (SELECT o.customer_id, MIN(o.order_purchase_timestamp) AS fp, COUNT(DISTINCT o.order_id) AS orders,
           SUM(t.gmv) AS gmv
         FROM dim_orders o LEFT JOIN {O.ORDER_TOTALS} t ON t.order_id = o.order_id
         WHERE o.customer_id IS NOT NULL GROUP BY o.customer_id)
SELECT CAST(date_trunc('month', fp) AS TIMESTAMP) AS cohort_month, COUNT(*) AS customers,
  CAST(SUM(orders) AS BIGINT) AS orders, CAST(SUM(gmv) AS DECIMAL(38,2)) AS gmv
FROM pc GROUP BY 1""")
register("first_purchase_cohort", _COHORTS)(_measure(M.first_purchase_cohort))


@register("first_purchase_cohort_stored", _COHORTS)
def q_first_purchase_cohort_stored(spark, sf_dir):
    """Cohorts from a store that got the orders of the last year first, then all items, and the earlier orders last."""
    w = driver_warehouse(spark, sf_dir)
    orders = w["dim_orders"]
    last = orders.agg(F.add_months(F.max("order_purchase_timestamp").cast("date"), -12).alias("since"))
    late = F.coalesce(F.col("order_purchase_timestamp") >= F.col("since"), F.lit(False))
    since = F.broadcast(last)  # one row
    store = CohortStore(spark, f"{ensure_checkpoint_dir(spark)}/cohorts-{new_run()}")
    store.apply(orders.join(since, late).select(*orders.columns), batch_id="recent")
    store.apply(fact=w["fact_order_items"], batch_id="items")
    store.apply(orders.join(since, ~late).select(*orders.columns), batch_id="history")
    return store.view()


@register("measures_by_state_status", O.with_ctes(f"""
, oa AS (SELECT o.*, c.customer_state FROM dim_orders o LEFT JOIN dim_customers c ON c.customer_id = o.customer_id),
om AS (SELECT customer_state, order_status, COUNT(DISTINCT order_id) AS total_orders,
         COUNT(DISTINCT customer_id) AS active_customers,
         COUNT(*) FILTER (WHERE {O.D_E}) AS on_time,
         COUNT(*) FILTER (WHERE order_delivered_customer_date IS NOT NULL) AS delivered
       FROM oa GROUP BY 1, 2),
fm AS (SELECT oa.customer_state, oa.order_status, CAST(SUM({O.GMV}) AS DECIMAL(38,2)) AS gmv, COUNT(*) AS items,
         COUNT(DISTINCT f.seller_id) AS active_sellers
       FROM fact_order_items f JOIN oa ON oa.order_id = f.order_id GROUP BY 1, 2)
SELECT om.customer_state, om.order_status, om.total_orders, om.active_customers,
  CAST(om.on_time AS DOUBLE) / NULLIF(om.delivered, 0) AS on_time_pct, fm.gmv, fm.items, fm.active_sellers,
  CAST(fm.gmv AS DOUBLE) / NULLIF(om.total_orders, 0) AS avg_order_value
FROM om LEFT JOIN fm ON om.customer_state IS NOT DISTINCT FROM fm.customer_state
  AND om.order_status IS NOT DISTINCT FROM fm.order_status"""))
def q_measures_by_state_status(spark, sf_dir):
    return M.measure_frame(driver_warehouse(spark, sf_dir), by=["customer_state", "order_status"])


@register("cube_by_state_status", ORACLE["measures_by_state_status"])
def q_cube_by_state_status(spark, sf_dir):
    """A slice by two of the five fields of a stored cube."""
    cube = MeasureCube.build(driver_warehouse(spark, sf_dir), f"{ensure_checkpoint_dir(spark)}/cube-{new_run()}",
                             ["customer_state", "order_status", "purchase_year", "purchase_month", "delay_bucket"])
    return cube.frame(by=["customer_state", "order_status"])


register("customer_locations", O.with_ctes("""
SELECT c.customer_id, c.customer_zip_code_prefix, c.customer_city, c.customer_state, z.lat, z.lng, z.geolocation_rows
FROM dim_customers c LEFT JOIN (
  SELECT geolocation_zip_code_prefix, AVG(geolocation_lat) AS lat, AVG(geolocation_lng) AS lng,
    COUNT(*) AS geolocation_rows
  FROM dim_geolocation GROUP BY geolocation_zip_code_prefix) z
ON z.geolocation_zip_code_prefix = c.customer_zip_code_prefix"""))(_measure(M.customer_locations))


@register("undefined_payment_orders", O.with_ctes("""
SELECT COUNT(*) AS undefined_payment_orders FROM raw_orders
WHERE order_id IN (SELECT order_id FROM undefined_orders)"""))
def q_undefined_payment_orders(spark, sf_dir):
    src = marketplace_sources(spark, sf_dir)
    return C.undefined_payment_order_count(src["orders"], src["order_payments"])


@register("distinct_categories", O.with_ctes("""
SELECT DISTINCT product_category_name AS value FROM dim_products"""))
def q_distinct_categories(spark, sf_dir):
    products = driver_warehouse(spark, sf_dir)["dim_products"]
    return P.distinct_values(products, "product_category_name").withColumnRenamed("product_category_name", "value")


@register("measures_by_category_state", O.with_ctes(f"""
, oa AS (SELECT o.*, c.customer_state FROM dim_orders o LEFT JOIN dim_customers c ON c.customer_id = o.customer_id),
om AS (SELECT customer_state, COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT customer_id) AS active_customers,
         COUNT(*) FILTER (WHERE {O.D_E}) AS on_time,
         COUNT(*) FILTER (WHERE order_delivered_customer_date IS NOT NULL) AS delivered
       FROM oa GROUP BY 1),
fm AS (SELECT p.product_category_name_english, oa.customer_state, CAST(SUM({O.GMV}) AS DECIMAL(38,2)) AS gmv,
         COUNT(*) AS items, COUNT(DISTINCT f.seller_id) AS active_sellers
       FROM fact_order_items f JOIN oa ON oa.order_id = f.order_id
       LEFT JOIN dim_products p ON p.product_id = f.product_id
       LEFT JOIN dim_sellers s ON s.seller_id = f.seller_id
       WHERE s.seller_city <> 'sao paulo'
       GROUP BY 1, 2)
, cells AS (  -- every item group, and a blank item group for each state that has none
SELECT product_category_name_english, customer_state, gmv, items, active_sellers FROM fm
UNION ALL
SELECT NULL, customer_state, NULL, NULL, NULL FROM om
WHERE NOT EXISTS (SELECT 1 FROM fm WHERE fm.customer_state IS NOT DISTINCT FROM om.customer_state))
SELECT cells.product_category_name_english, cells.customer_state, om.total_orders, om.active_customers,
  CAST(om.on_time AS DOUBLE) / NULLIF(om.delivered, 0) AS on_time_pct, cells.gmv, cells.items, cells.active_sellers,
  CAST(cells.gmv AS DOUBLE) / NULLIF(om.total_orders, 0) AS avg_order_value
FROM cells, om WHERE om.customer_state IS NOT DISTINCT FROM cells.customer_state"""))
def q_measures_by_category_state(spark, sf_dir):
    """Slicers on both sides: customer state (reaches every measure) and category/seller
    city (reach the item measures only)."""
    return M.measure_frame(driver_warehouse(spark, sf_dir), by=["product_category_name_english", "customer_state"],
                           item_where="seller_city <> 'sao paulo'")


register("gmv_weekday_vs_weekend", O.with_ctes(O.by_order_attribute(
    "CASE WHEN isodow(o.order_purchase_timestamp) >= 6 THEN 'weekend' ELSE 'weekday' END", "day_type")))(
    _measure(M.gmv_weekday_vs_weekend))

register("orders_first_purchase", O.with_ctes("""
SELECT order_id, customer_id, order_purchase_timestamp,
  MIN(order_purchase_timestamp) OVER (PARTITION BY customer_id) AS first_purchase_timestamp,
  CAST(date_trunc('month', MIN(order_purchase_timestamp) OVER (PARTITION BY customer_id)) AS TIMESTAMP) AS cohort_month
FROM dim_orders"""))(_measure(M.orders_first_purchase))


_PAID = ("payments", "payment_total", "avg_payment", "total_orders", "gmv")


@register("measures_by_payment_state", O.with_ctes(f"""
, oa AS (SELECT o.order_id, c.customer_state FROM dim_orders o LEFT JOIN dim_customers c ON c.customer_id = o.customer_id),
states AS (SELECT customer_state, COUNT(DISTINCT order_id) AS total_orders FROM oa GROUP BY 1),
sold AS (SELECT oa.customer_state, CAST(SUM({O.GMV}) AS DECIMAL(38,2)) AS gmv
         FROM fact_order_items f JOIN oa ON oa.order_id = f.order_id GROUP BY 1),
paid AS (SELECT p.payment_type, oa.customer_state, TRUE AS any_paid, COUNT(*) AS payments,
           CAST(SUM(p.payment_value) AS DECIMAL(38,2)) AS payment_total, AVG(CAST(p.payment_value AS DECIMAL(38,2))) AS avg_payment
         FROM dim_payments p JOIN oa ON oa.order_id = p.order_id GROUP BY 1, 2)
SELECT paid.payment_type, st.customer_state, paid.payments, paid.payment_total,
  CAST(paid.payment_total AS DOUBLE) / paid.payments AS avg_payment, st.total_orders, sold.gmv
FROM states st LEFT JOIN paid ON paid.customer_state IS NOT DISTINCT FROM st.customer_state
LEFT JOIN sold ON sold.customer_state IS NOT DISTINCT FROM st.customer_state"""))
def q_measures_by_payment_state(spark, sf_dir):
    """A payment slicer beside a customer slicer: payment measures split, the others repeat."""
    return M.measure_frame(driver_warehouse(spark, sf_dir), _PAID, by=["payment_type", "customer_state"])


@register("measures_by_delay_day", O.with_ctes(f"""
, oa AS (SELECT order_id, dayname(order_purchase_timestamp) AS purchase_day_name, {O.DELAY_BUCKET} AS delay_bucket
         FROM (SELECT *, date_diff('day', CAST(order_estimated_delivery_date AS DATE),
                                   CAST(order_delivered_customer_date AS DATE)) AS dd FROM dim_orders)),
total AS (SELECT delay_bucket, purchase_day_name, COUNT(DISTINCT order_id) AS total_orders FROM oa GROUP BY 1, 2),
said AS (SELECT oa.delay_bucket, oa.purchase_day_name, COUNT(*) AS reviews, AVG(r.review_score) AS avg_review_score
         FROM dim_reviews r JOIN oa ON oa.order_id = r.order_id GROUP BY 1, 2)
SELECT delay_bucket, purchase_day_name, total_orders, reviews, avg_review_score
FROM total LEFT JOIN said USING (delay_bucket, purchase_day_name)"""))
def q_measures_by_delay_day(spark, sf_dir):
    """Review measures by delivery delay and day of purchase."""
    return M.measure_frame(driver_warehouse(spark, sf_dir), ["total_orders", "reviews", "avg_review_score"],
                           by=["delay_bucket", "purchase_day_name"])
