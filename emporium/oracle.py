"""DuckDB SQL oracles for the registered queries.

Each oracle is plain SQL over the driver's tables (``region nation customer
supplier part orders lineitem conversations`` as views). It first maps them to
the nine marketplace sources (the same mapping as ``sources.driver_tables``,
written as SQL), then states every cleaning rule, view and measure directly in
SQL at item/row grain -- independently of the pre-aggregated Spark plans -- so a
parity check compares two different formulations of the same semantics.
"""

from __future__ import annotations

RAW = {
    "raw_customers": """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
  CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix, n_name AS customer_city, r_name AS customer_state
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "raw_products": """
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
  CASE WHEN p_partkey % 53 = 0 THEN NULL WHEN p_partkey % 41 = 0 THEN 'pc_gamer'
    WHEN p_partkey % 43 = 0 THEN 'unlisted_category' ELSE p_brand END AS product_category_name,
  length(p_name) AS product_name_lenght, length(p_type) AS product_description_lenght, p_size % 6 AS product_photos_qty,
  CASE WHEN p_partkey % 31 = 0 THEN NULL WHEN p_partkey % 37 = 0 THEN 0.0E0 ELSE CAST(p_size AS DOUBLE) END AS product_weight_g,
  p_retailprice AS product_length_cm, CAST(p_size AS DOUBLE) AS product_height_cm, CAST(p_size AS DOUBLE) AS product_width_cm
FROM part""",
    "raw_product_category_translation": """
SELECT p_brand AS product_category_name,
  concat('en_', p_brand, CASE WHEN p_size % 2 = 1 THEN '_odd' ELSE '' END) AS product_category_name_english, p_partkey AS src_ord
FROM part""",
    "raw_sellers": """
SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, CAST(s_nationkey AS VARCHAR) AS seller_zip_code_prefix,
  CASE s_suppkey % 5 WHEN 0 THEN ' São Paulo - SP ' WHEN 1 THEN 'Rio de Janeiro / RJ' WHEN 2 THEN 'SAO MIGUEL'
    WHEN 3 THEN 'Brasília' ELSE n_name END AS seller_city,
  n_name AS seller_state
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "raw_orders": """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CASE WHEN o_orderkey % 61 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
  CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
  o_orderdate AS order_purchase_timestamp,
  CASE WHEN o_orderkey % 97 = 0 THEN o_orderdate - INTERVAL '1' DAY ELSE o_orderdate + INTERVAL '1' HOUR END AS order_approved_at,
  CASE WHEN o_orderkey % 89 = 0 THEN o_orderdate - INTERVAL '2' DAY ELSE o_orderdate + (1 + o_orderkey % 4) * INTERVAL '1' DAY END AS order_delivered_carrier_date,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderdate + (5 + o_orderkey % 41) * INTERVAL '1' DAY END AS order_delivered_customer_date,
  o_orderdate + INTERVAL '24' DAY AS order_estimated_delivery_date
FROM (SELECT * REPLACE (CASE WHEN o_orderkey % 71 = 0 THEN o_orderdate + INTERVAL '20' YEAR ELSE o_orderdate END AS o_orderdate)
      FROM orders)""",
    "raw_order_payments": """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 1 AS payment_sequential,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'boleto' WHEN '3-MEDIUM' THEN 'voucher'
    WHEN '4-NOT SPECIFIED' THEN 'not_defined' ELSE 'debit_card' END END AS payment_type,
  1 + o_orderkey % 12 AS payment_installments,
  CASE WHEN o_orderkey % 103 = 0 THEN 'abc' ELSE CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) END AS payment_value
FROM orders""",
    "raw_order_reviews": """
SELECT concat(CAST(CASE WHEN o_orderkey % 50 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS VARCHAR),
    CASE WHEN coalesce(c.turn, 0) > 0 THEN concat('-', CAST(c.turn AS VARCHAR)) ELSE '' END) AS review_id,
  CAST(o_orderkey AS VARCHAR) AS order_id, 1 + (o_orderkey + coalesce(c.turn, 0)) % 5 AS review_score,
  c.role AS review_comment_title, c.text AS review_comment_message,
  o_orderdate + INTERVAL '30' DAY AS review_creation_date, o_orderdate + INTERVAL '31' DAY AS review_answer_timestamp,
  o_orderkey * 1000 + coalesce(c.turn, 0) AS src_ord
FROM orders LEFT JOIN conversations c ON c.conv_id = o_orderkey""",
    "raw_geolocation": """
SELECT CAST(c_nationkey AS VARCHAR) AS geolocation_zip_code_prefix, CAST(c_custkey % 90 AS DOUBLE) AS geolocation_lat,
  CAST(c_custkey % 7 AS DOUBLE) AS geolocation_lng, n_name AS geolocation_city, r_name AS geolocation_state
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "raw_order_items": """
SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
  CASE WHEN l_orderkey % 101 = 0 THEN 'x' ELSE CAST(l_linenumber AS VARCHAR) END AS order_item_id, CAST(l_partkey AS VARCHAR) AS product_id,
  CAST(l_suppkey AS VARCHAR) AS seller_id, 
  CASE WHEN l_orderkey % 83 = 0 THEN 'not a date' ELSE CAST(l_shipdate AS VARCHAR) END AS shipping_limit_date,
  l_extendedprice AS price, CASE WHEN l_orderkey % 71 = 0 THEN -1.0 ELSE l_quantity END AS freight_value
FROM lineitem""",
}

WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _norm_place(col: str) -> str:
    return f"strip_accents(trim(lower({col}), {WS}))"


CLEAN = {
    "dim_customers": """
SELECT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state FROM raw_customers""",
    "translation": """
SELECT product_category_name, product_category_name_english FROM (
  SELECT *, row_number() OVER (PARTITION BY product_category_name ORDER BY src_rank, ord) AS rn FROM (
    SELECT product_category_name, product_category_name_english, 0 AS src_rank, src_ord AS ord FROM raw_product_category_translation
    UNION ALL SELECT 'portateis_cozinha_e_preparadores_de_alimentos', 'portable_kitchen_and_food_preparers', 1, 0
    UNION ALL SELECT 'pc_gamer', 'pc_gamer', 1, 1)) WHERE rn = 1""",
    "dim_products": """
SELECT p.product_id, p.product_category_name,
  CAST(round(product_name_lenght) AS BIGINT) AS product_name_length,
  CAST(round(product_description_lenght) AS BIGINT) AS product_description_length,
  CAST(round(product_photos_qty) AS BIGINT) AS product_photos_qty,
  CAST(round(product_weight_g) AS BIGINT) AS product_weight_g,
  CAST(round(product_length_cm) AS BIGINT) AS product_length_cm,
  CAST(round(product_height_cm) AS BIGINT) AS product_height_cm,
  CAST(round(product_width_cm) AS BIGINT) AS product_width_cm,
  t.product_category_name_english
FROM raw_products p LEFT JOIN translation t ON t.product_category_name = p.product_category_name
WHERE p.product_category_name IS NOT NULL AND product_weight_g > 0 AND product_length_cm > 0
  AND product_height_cm > 0 AND product_width_cm > 0""",
    "seller_city_norm": f"""
SELECT seller_id, seller_zip_code_prefix, {_norm_place('seller_city')} AS city, seller_state FROM raw_sellers""",
    "dim_sellers": """
SELECT seller_id, seller_zip_code_prefix,
  CASE WHEN lower(city) LIKE '%rio de janeiro%' THEN 'rio de janeiro'
       WHEN lower(city) LIKE '%sao miguel%' THEN 'sao miguel d''oeste'
       WHEN lower(city) LIKE '%sao pau%' THEN 'sao paulo' ELSE city END AS seller_city,
  seller_state
FROM seller_city_norm""",
    "undefined_orders": """
SELECT DISTINCT order_id FROM raw_order_payments WHERE payment_type = 'not_defined'""",
    "dim_orders": """
SELECT o.* FROM raw_orders o
WHERE NOT EXISTS (SELECT 1 FROM undefined_orders u WHERE u.order_id = o.order_id)""",
    "dim_payments": """
SELECT order_id, CAST(payment_sequential AS BIGINT) AS payment_sequential,
  CASE WHEN payment_type = 'boleto' THEN 'bank_slip' ELSE payment_type END AS payment_type,
  CAST(payment_installments AS BIGINT) AS payment_installments, TRY_CAST(payment_value AS DECIMAL(10,2)) AS payment_value
FROM raw_order_payments WHERE payment_type IS DISTINCT FROM 'not_defined'
  AND (payment_value IS NULL OR TRY_CAST(payment_value AS DECIMAL(10,2)) IS NOT NULL)""",
    "dim_reviews": """
SELECT review_id, order_id, CAST(review_score AS BIGINT) AS review_score,
  strip_accents(review_comment_title) AS review_comment_title,
  strip_accents(review_comment_message) AS review_comment_message,
  review_creation_date, review_answer_timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY src_ord) AS rn FROM raw_order_reviews)
WHERE rn = 1""",
    "dim_geolocation": f"""
SELECT geolocation_zip_code_prefix, geolocation_lat, geolocation_lng,
  {_norm_place('geolocation_city')} AS geolocation_city, geolocation_state FROM raw_geolocation""",
    "fact_order_items": """
SELECT i.order_id, coalesce(TRY_CAST(i.order_item_id AS BIGINT), 0) AS order_item_id, i.product_id, i.seller_id,
  TRY_CAST(i.shipping_limit_date AS TIMESTAMP) AS shipping_deadline,
  CAST(i.price AS DECIMAL(10,2)) AS price, CAST(i.freight_value AS DECIMAL(10,2)) AS freight_value
FROM raw_order_items i
WHERE i.price > 0 AND i.freight_value >= 0
  AND i.order_id IN (SELECT order_id FROM dim_orders)
  AND i.product_id IN (SELECT product_id FROM dim_products)
  AND i.seller_id IN (SELECT seller_id FROM dim_sellers)""",
    "base_order_items": """
WITH categories AS (SELECT product_id, product_category_name FROM dim_products),
purchases AS (SELECT order_id, order_status, order_purchase_timestamp, order_approved_at,
                order_delivered_customer_date, order_estimated_delivery_date FROM dim_orders),
money AS (SELECT order_id, product_id, seller_id, order_item_id, price, freight_value, freight_value + price AS gmv_item
          FROM fact_order_items)
SELECT * FROM (SELECT * FROM money NATURAL JOIN purchases) LEFT JOIN categories USING (product_id)""",
}


def with_ctes(final_sql: str) -> str:
    """Prefix ``final_sql`` with every raw and cleaned table as a CTE."""
    parts = [f"{name} AS ({sql.strip()})" for name, sql in {**RAW, **CLEAN}.items()]
    return "WITH " + ",\n".join(parts) + "\n" + final_sql.strip()


def table(name: str) -> str:
    return with_ctes(f"SELECT * FROM {name}")


SELLER_MONTHLY = """
, flagged AS (  -- one row per item: its month, and whether its order came in time
  SELECT strftime(b.order_purchase_timestamp, '%Y-%m-01 00:00:00')::TIMESTAMP AS month, b.seller_id, b.order_id,
    b.gmv_item, coalesce(b.order_delivered_customer_date <= b.order_estimated_delivery_date, FALSE) AS in_time
  FROM base_order_items b
), scores AS (  -- all review scores of a seller's items
  SELECT f.seller_id, list(r.review_score) AS given
  FROM dim_reviews r, fact_order_items f WHERE r.order_id = f.order_id GROUP BY f.seller_id
)
SELECT month, f.seller_id, count(DISTINCT f.order_id) AS orders, count(f.order_id) AS items,
  CAST(sum(f.gmv_item) AS DECIMAL(38,2)) AS gmv,
  CAST(count(*) FILTER (WHERE f.in_time) AS DOUBLE) / count(*) AS on_time_rate,
  (SELECT list_avg(s.given) FROM scores s WHERE s.seller_id = f.seller_id) AS avg_review
FROM flagged f GROUP BY month, f.seller_id
"""


def seller_monthly() -> str:
    # The view's CTEs extend the shared WITH list (hence the leading comma).
    parts = [f"{name} AS ({sql.strip()})" for name, sql in {**RAW, **CLEAN}.items()]
    return "WITH " + ",\n".join(parts) + SELLER_MONTHLY


# ---------------------------------------------------------------------------
# Final statements per registered query (each is prefixed with all CTEs).
# ---------------------------------------------------------------------------
def _union_all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def null_keys(checks: dict[str, list[str]]) -> str:
    return _union_all([f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
                       f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {t}"
                       for t, cols in checks.items() for c in cols])


def range_checks(rules) -> str:
    return _union_all([f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{n}' AS check_name, "
                       f"COUNT(*) FILTER (WHERE {p}) AS bad_count FROM {t}" for t, c, n, p in rules])


def row_counts(tables: list[str]) -> str:
    return _union_all([f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in tables])


def pk_dups(pks: dict[str, list[str]]) -> str:
    def key(cols):
        return "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols) + ")"
    return _union_all([f"SELECT '{t}' AS table_name, {key(cols)} AS pk_value, COUNT(*) AS duplicate_count "
                       f"FROM {t} GROUP BY {', '.join(cols)} HAVING COUNT(*) > 1" for t, cols in pks.items()])


def orphans(source: str) -> str:
    return _union_all([
        f"SELECT '{c}' AS fk_column, s.{c} AS fk_value FROM {source} s "
        f"WHERE NOT EXISTS (SELECT 1 FROM {d} x WHERE x.{c} = s.{c})"
        for c, d in [("order_id", "dim_orders"), ("product_id", "dim_products"), ("seller_id", "dim_sellers")]])


GMV = "coalesce(f.price, 0) + coalesce(f.freight_value, 0)"
ORDER_TOTALS = f"(SELECT f.order_id, SUM({GMV}) AS gmv, COUNT(*) AS items FROM fact_order_items f GROUP BY f.order_id)"


def by_order_attribute(expr: str, name: str) -> str:
    return f"""
SELECT {name}, gmv, items, total_orders, CAST(gmv AS DOUBLE) / NULLIF(total_orders, 0) AS avg_order_value FROM (
  SELECT {expr} AS {name}, CAST(SUM(t.gmv) AS DECIMAL(38,2)) AS gmv, CAST(coalesce(SUM(t.items), 0) AS BIGINT) AS items,
    COUNT(DISTINCT o.order_id) AS total_orders
  FROM dim_orders o LEFT JOIN {ORDER_TOTALS} t ON t.order_id = o.order_id
  GROUP BY 1)"""


def describe(table: str, cols: list[str]) -> str:
    return _union_all([
        f"SELECT '{c}' AS column_name, COUNT({c}) AS count, AVG({c}) AS mean, round(STDDEV_SAMP({c}), 9) AS std, "
        f"CAST(MIN({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, "
        f"quantile_cont({c}, 0.75) AS p75, CAST(MAX({c}) AS DOUBLE) AS max FROM {table}" for c in cols])


DELAY_BUCKET = """CASE WHEN dd IS NULL THEN 'Not Delivered' WHEN dd <= -7 THEN 'Very Early' WHEN dd <= -1 THEN 'Early'
  WHEN dd = 0 THEN 'On Time' WHEN dd <= 7 THEN 'Late' ELSE 'Very Late' END"""

D_E = "order_delivered_customer_date IS NOT NULL AND order_estimated_delivery_date IS NOT NULL AND order_delivered_customer_date <= order_estimated_delivery_date"


def gate_report(null_checks: dict[str, list[str]], rules, pks: dict[str, list[str]]) -> str:
    parts = [f"SELECT 'null_key' AS check_name, '{t}' AS table_name, '{c}' AS column_name, "
             f"COUNT(*) FILTER (WHERE {c} IS NULL) AS bad_count FROM {t}"
             for t, cols in null_checks.items() for c in cols]
    parts += [f"SELECT 'range {n}', '{t}', '{c}', COUNT(*) FILTER (WHERE {p}) FROM {t}" for t, c, n, p in rules]
    parts += [f"SELECT 'pk_duplicate', '{t}', CAST(NULL AS VARCHAR), "
              f"(SELECT COUNT(*) FROM (SELECT 1 FROM {t} GROUP BY {', '.join(cols)} HAVING COUNT(*) > 1))"
              for t, cols in pks.items()]
    parts += [f"SELECT 'orphan', 'fact_order_items', '{c}', (SELECT COUNT(*) FROM fact_order_items s "
              f"WHERE NOT EXISTS (SELECT 1 FROM {d} x WHERE x.{c} = s.{c}))"
              for c, d in [("order_id", "dim_orders"), ("product_id", "dim_products"), ("seller_id", "dim_sellers")]]
    return ("SELECT 'post_load' AS phase, check_name, table_name, column_name, CAST(bad_count AS BIGINT) AS bad_count, "
            "CASE WHEN bad_count > 0 THEN 'fail' ELSE 'ok' END AS status FROM (" + _union_all(parts) + ")")
