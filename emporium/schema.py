"""Source and warehouse table definitions.

Every source is read with an explicit all-string schema (no inference pass, no
lost leading zeros in zip prefixes); every warehouse table has a typed target
schema, a primary key and foreign keys. The keys are metadata: Spark does not
enforce them, the data-quality gates in ``operators.quality`` check them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
D = T.DoubleType()
TS = T.TimestampNTZType()
MONEY = T.DecimalType(10, 2)


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


def _strings(*names: str) -> T.StructType:
    return _struct(*[(n, S) for n in names])


# ---------------------------------------------------------------------------
# Sources: column names as they appear in the source files (fixed values,
# including the two misspelled product headers and the raw shipping column).
# ---------------------------------------------------------------------------
SOURCE_COLUMNS: dict[str, list[str]] = {
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix",
                  "customer_city", "customer_state"],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
                    "geolocation_city", "geolocation_state"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id",
                    "shipping_limit_date", "price", "freight_value"],
    "order_payments": ["order_id", "payment_sequential", "payment_type",
                       "payment_installments", "payment_value"],
    "order_reviews": ["review_id", "order_id", "review_score", "review_comment_title",
                      "review_comment_message", "review_creation_date", "review_answer_timestamp"],
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
               "order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date", "order_estimated_delivery_date"],
    "products": ["product_id", "product_category_name", "product_name_lenght",
                 "product_description_lenght", "product_photos_qty", "product_weight_g",
                 "product_length_cm", "product_height_cm", "product_width_cm"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "product_category_translation": ["product_category_name", "product_category_name_english"],
}

SOURCE_SCHEMAS: dict[str, T.StructType] = {k: _strings(*v) for k, v in SOURCE_COLUMNS.items()}


# ---------------------------------------------------------------------------
# Warehouse tables
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    pk: tuple[str, ...]
    fks: dict[str, str] = field(default_factory=dict)  # column -> referenced table
    # Column the table is bucketed on when written, so that the joins of the views
    # and measures on that key read co-partitioned files instead of shuffling.
    bucket_by: str | None = None

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


TABLES: dict[str, TableSpec] = {t.name: t for t in [
    TableSpec("dim_customers", _struct(
        ("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", S),
        ("customer_city", S), ("customer_state", S)), ("customer_id",),
        bucket_by="customer_id"),
    TableSpec("dim_products", _struct(
        ("product_id", S), ("product_category_name", S), ("product_name_length", L),
        ("product_description_length", L), ("product_photos_qty", L), ("product_weight_g", L),
        ("product_length_cm", L), ("product_height_cm", L), ("product_width_cm", L),
        ("product_category_name_english", S)), ("product_id",),
        bucket_by="product_id"),
    TableSpec("dim_sellers", _struct(
        ("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S), ("seller_state", S)),
        ("seller_id",)),
    TableSpec("dim_orders", _struct(
        ("order_id", S), ("customer_id", S), ("order_status", S),
        ("order_purchase_timestamp", TS), ("order_approved_at", TS),
        ("order_delivered_carrier_date", TS), ("order_delivered_customer_date", TS),
        ("order_estimated_delivery_date", TS)), ("order_id",),
        {"customer_id": "dim_customers"}, bucket_by="order_id"),
    TableSpec("dim_payments", _struct(
        ("order_id", S), ("payment_sequential", L), ("payment_type", S),
        ("payment_installments", L), ("payment_value", MONEY)), ("order_id", "payment_sequential"),
        {"order_id": "dim_orders"}, bucket_by="order_id"),
    TableSpec("dim_reviews", _struct(
        ("review_id", S), ("order_id", S), ("review_score", L), ("review_comment_title", S),
        ("review_comment_message", S), ("review_creation_date", TS),
        ("review_answer_timestamp", TS)), ("review_id",),
        {"order_id": "dim_orders"}, bucket_by="order_id"),
    TableSpec("dim_geolocation", _struct(
        ("geolocation_zip_code_prefix", S), ("geolocation_lat", D), ("geolocation_lng", D),
        ("geolocation_city", S), ("geolocation_state", S)),
        ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng")),
    TableSpec("fact_order_items", _struct(
        ("order_id", S), ("order_item_id", L), ("product_id", S), ("seller_id", S),
        ("shipping_deadline", TS), ("price", MONEY), ("freight_value", MONEY)),
        ("order_id", "order_item_id"),
        {"order_id": "dim_orders", "product_id": "dim_products", "seller_id": "dim_sellers"},
        bucket_by="order_id"),
]}


def load_order(specs: dict[str, TableSpec] | None = None) -> list[str]:
    """Tables in foreign-key order (referenced tables first); ties keep declaration order."""
    specs = specs or TABLES
    done: list[str] = []
    pending = list(specs)
    while pending:
        progressed = False
        for name in list(pending):
            deps = {d for d in specs[name].fks.values() if d in specs and d != name}
            if deps <= set(done):
                done.append(name)
                pending.remove(name)
                progressed = True
        if not progressed:
            raise ValueError(f"foreign-key cycle among {pending}")
    return done


def load_levels(specs: dict[str, TableSpec] | None = None) -> list[list[str]]:
    """Foreign-key levels: every table's referenced tables sit in an earlier level.

    Tables of one level do not reference each other and can be written concurrently.
    """
    specs = specs or TABLES
    level: dict[str, int] = {}
    for name in load_order(specs):
        deps = [d for d in specs[name].fks.values() if d in specs and d != name]
        level[name] = 1 + max((level[d] for d in deps), default=-1)
    out: list[list[str]] = [[] for _ in range(max(level.values(), default=-1) + 1)]
    for name in load_order(specs):
        out[level[name]].append(name)
    return out
