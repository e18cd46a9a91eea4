"""Entity cleaning pipelines: nine raw sources -> eight warehouse tables.

Every function is ``DataFrame(s) -> DataFrame`` and lazy; nothing is collected.
Inputs may carry text (CSV) or already typed values (Parquet); each pipeline
conforms its columns with ``try_cast`` so bad text becomes null instead of
failing the job (ANSI mode stays on).

Divergences of the source project are exposed as options (see ``CleanOptions``);
defaults follow what the source effectively loads where that is defensible.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import temporal as TM
from ..functions import text as TX
from ..operators.dedup import INGEST_ORDINAL, first_per_key, with_ingest_ordinal
from ..schema import TABLES

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class CleanOptions:
    # The source computes the order chronology filter and then overwrites the
    # cleaned orders with the raw frame, so effectively nothing is dropped.
    enforce_chronology: bool = False
    # The source's median imputation is discarded (no-op); 'median' applies it.
    impute: str | None = None
    # Null comment/city text loaded as the word 'nan' in the source.
    legacy_nan: bool = False
    # Zip prefixes read as integers lose leading zeros in the source.
    legacy_zip: bool = False
    # Keep rows with a value that does not convert, marked (REJECTED, RAW_ROW), for the load
    # to set aside; otherwise such rows are left out, as a load with ON_ERROR = continue does.
    keep_rejects: bool = False


ORDER_TS = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date"]
REVIEW_TS = ["review_creation_date", "review_answer_timestamp"]
PRODUCT_MEASURES = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]

# Category translations missing from the source file, appended by hand.
EXTRA_TRANSLATIONS: tuple[tuple[str, str], ...] = (
    ("portateis_cozinha_e_preparadores_de_alimentos", "portable_kitchen_and_food_preparers"),
    ("pc_gamer", "pc_gamer"),
)

# Payment-type spelling fix and the type that marks an unpaid order.
PAYMENT_TYPE_FIXES = {"boleto": "bank_slip"}
UNDEFINED_PAYMENT = "not_defined"


def _s(c: str) -> Column:
    return F.col(c).cast("string")


_INTEGRAL = {"tinyint", "smallint", "int", "bigint"}
_FRACTIONAL = {"float", "double"}


def _whole(df: DataFrame, c: str) -> Column:
    """NUMBER(38,0) semantics: fractional input rounds half away from zero.

    Integral input is cast directly; floating input is rounded (HALF_UP) in
    double arithmetic; text and decimals go through decimal(38,0).
    """
    t = dict(df.dtypes).get(c)
    if t in _INTEGRAL:
        return F.col(c).cast("long")
    if t in _FRACTIONAL:
        return F.round(F.col(c), 0).try_cast("long")
    return F.col(c).try_cast("decimal(38,0)").try_cast("long")


def _zip(c: str, legacy: bool) -> Column:
    return F.col(c).try_cast("long").cast("string") if legacy else _s(c)


# Columns of a marked row: names of the values that did not convert, and the source row as JSON.
REJECTED, RAW_ROW = "_rejected", "_raw_row"
# Text that loads as null.
NULL_TEXT = ("", "NULL")


def _mark(raw: DataFrame, parsed: dict[str, tuple[str, Column]], columns: Sequence[str] | None = None) -> list[Column]:
    """Marks for rows whose value is there but does not convert: ``target -> (source column, converted)``."""
    types = dict(raw.dtypes)
    flags = []
    for name, (source, converted) in parsed.items():
        value = F.col(source)
        there = value.isNotNull()
        if types[source] == "string":
            there = there & ~value.isin(*NULL_TEXT)
        if types[source] in ("float", "double"):
            there = there & ~F.isnan(value)  # NaN is a missing value
        flags.append(F.when(there & converted.isNull(), F.lit(name)))
    bad = F.array_compact(F.array(*flags))
    row = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns or raw.columns if types[c] != "binary"]))
    return [F.when(F.size(bad) > 0, bad).alias(REJECTED), F.when(F.size(bad) > 0, row).alias(RAW_ROW)]


def _select_target(df: DataFrame, table: str, opts: CleanOptions | None = None) -> DataFrame:
    columns = TABLES[table].columns
    if REJECTED not in df.columns:
        return df.select(*columns)
    if opts is not None and opts.keep_rejects:
        return df.select(*columns, REJECTED, RAW_ROW)
    return df.where(F.col(REJECTED).isNull()).select(*columns)


# ---------------------------------------------------------------------------
# E1 customers
# ---------------------------------------------------------------------------
def clean_customers(raw: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    return raw.select(_s("customer_id").alias("customer_id"),
                      _s("customer_unique_id").alias("customer_unique_id"),
                      _zip("customer_zip_code_prefix", opts.legacy_zip).alias("customer_zip_code_prefix"),
                      _s("customer_city").alias("customer_city"),
                      _s("customer_state").alias("customer_state"))


# ---------------------------------------------------------------------------
# E2 products (+ category translation)
# ---------------------------------------------------------------------------
def category_translation(raw_translation: DataFrame) -> DataFrame:
    """File rows, then the hand-appended rows; the first row of each category wins."""
    spark = raw_translation.sparkSession
    file_rows = (with_ingest_ordinal(raw_translation)
                 .select(_s("product_category_name").alias("product_category_name"),
                         _s("product_category_name_english").alias("product_category_name_english"),
                         F.lit(-1).alias("_appended"), F.col(INGEST_ORDINAL).alias("_ord")))
    extra = spark.createDataFrame(
        [(k, v, i) for i, (k, v) in enumerate(EXTRA_TRANSLATIONS)],
        "product_category_name string, product_category_name_english string, _appended int")
    both = file_rows.unionByName(extra, allowMissingColumns=True)
    return (first_per_key(both, ["product_category_name"], ["_appended", "_ord"])
            .drop("_appended", "_ord"))


def untranslated_categories(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Categories used by products that the translation table lacks (set difference)."""
    return (products.select("product_category_name").where(F.col("product_category_name").isNotNull())
            .distinct()
            .join(translation.select("product_category_name"), "product_category_name", "left_anti"))


def _renamed_products(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed({"product_name_lenght": "product_name_length",
                                   "product_description_lenght": "product_description_length"})


def filtered_products(raw: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    """Products with a category and positive weight and dimensions (before translation)."""
    p = _renamed_products(raw).where(F.col("product_category_name").isNotNull())
    number = {c: F.col(c).try_cast("double") for c in PRODUCT_MEASURES}
    p = p.withColumns({c: F.when(~F.isnan(x), x) for c, x in number.items()})  # NaN is a missing value
    if opts.impute == "median":
        from ..operators.quantiles import fill_with_median
        p = fill_with_median(p, PRODUCT_MEASURES)
    elif opts.impute is not None:
        raise ValueError(f"unknown impute mode {opts.impute!r}")
    return p.where(F.col("product_weight_g") > 0).where(
        (F.col("product_length_cm") > 0) & (F.col("product_height_cm") > 0)
        & (F.col("product_width_cm") > 0))


def clean_products(raw: DataFrame, raw_translation: DataFrame,
                   opts: CleanOptions = CleanOptions()) -> DataFrame:
    p = filtered_products(raw, opts)
    # Left join keeps every product; the translation side is one row per category
    # (a few hundred at most) and AQE broadcasts it from its measured size.
    joined = p.join(category_translation(raw_translation), "product_category_name", "left")
    counts = ["product_name_length", "product_description_length", "product_photos_qty", *PRODUCT_MEASURES]
    whole = {c: _whole(joined, c) for c in counts}
    return _select_target(joined.select(
        _s("product_id").alias("product_id"),
        _s("product_category_name").alias("product_category_name"),
        *[c.alias(n) for n, c in whole.items()],
        F.col("product_category_name_english"),
        *_mark(joined, {n: (n, c) for n, c in whole.items()})), "dim_products", opts)


# ---------------------------------------------------------------------------
# E3 sellers
# ---------------------------------------------------------------------------
def normalized_sellers(raw: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    """Sellers with ``seller_city`` lower-cased, stripped and accent-free (before the rules)."""
    return TX.with_normalized_place(raw, "seller_city", "seller_city", opts.legacy_nan)


def clean_sellers(raw: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    n = normalized_sellers(raw, opts)
    return n.select(_s("seller_id").alias("seller_id"),
                    _zip("seller_zip_code_prefix", opts.legacy_zip).alias("seller_zip_code_prefix"),
                    TX.apply_contains_rules("seller_city").alias("seller_city"),
                    _s("seller_state").alias("seller_state"))


# ---------------------------------------------------------------------------
# E4/E5 orders and payments
# ---------------------------------------------------------------------------
def parse_orders(raw: DataFrame) -> DataFrame:
    return raw.select(_s("order_id").alias("order_id"), _s("customer_id").alias("customer_id"),
                      _s("order_status").alias("order_status"),
                      *[TM.parse_timestamp(c).alias(c) for c in ORDER_TS])


def chronology_violation() -> Column:
    """approved < purchase OR carrier < approved OR delivered < carrier OR estimated < purchase.

    A comparison with a null timestamp is false, as with pandas NaT.
    """
    c = F.col
    pairs = [("order_approved_at", "order_purchase_timestamp"),
             ("order_delivered_carrier_date", "order_approved_at"),
             ("order_delivered_customer_date", "order_delivered_carrier_date"),
             ("order_estimated_delivery_date", "order_purchase_timestamp")]
    out = F.lit(False)
    for a, b in pairs:
        out = out | F.coalesce(c(a) < c(b), F.lit(False))
    return out


def undefined_payment_orders(raw_payments: DataFrame) -> DataFrame:
    """Order ids that have a payment of the undefined type (one row per payment; only for semi and anti joins)."""
    t = TX.replace_values(_s("payment_type"), PAYMENT_TYPE_FIXES)
    return raw_payments.where(t == UNDEFINED_PAYMENT).select(_s("order_id").alias("order_id"))


def undefined_payment_order_count(raw_orders: DataFrame, raw_payments: DataFrame) -> DataFrame:
    """How many orders carry an undefined payment (a semi join, then a count)."""
    return (parse_orders(raw_orders).join(undefined_payment_orders(raw_payments), "order_id", "left_semi")
            .agg(F.count(F.lit(1)).alias("undefined_payment_orders")))


def clean_orders(raw_orders: DataFrame, raw_payments: DataFrame | None,
                 opts: CleanOptions = CleanOptions()) -> DataFrame:
    o = parse_orders(raw_orders)
    if opts.enforce_chronology:
        # Drop violators unless their delivery date is missing.
        o = o.where(~(chronology_violation() & F.col("order_delivered_customer_date").isNotNull()))
    if raw_payments is not None:
        o = o.join(undefined_payment_orders(raw_payments), "order_id", "left_anti")
    return _select_target(o, "dim_orders")


def clean_payments(raw: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    t = TX.replace_values(_s("payment_type"), PAYMENT_TYPE_FIXES)
    parsed = {"payment_sequential": _whole(raw, "payment_sequential"),
              "payment_installments": _whole(raw, "payment_installments"),
              "payment_value": F.col("payment_value").try_cast("decimal(10,2)")}
    rows = raw.select(_s("order_id").alias("order_id"), t.alias("payment_type"),
                      *[c.alias(n) for n, c in parsed.items()], *_mark(raw, {n: (n, c) for n, c in parsed.items()}))
    return _select_target(rows.where(~F.col("payment_type").eqNullSafe(UNDEFINED_PAYMENT)), "dim_payments", opts)


# ---------------------------------------------------------------------------
# E6 reviews
# ---------------------------------------------------------------------------
def parse_reviews(raw: DataFrame) -> DataFrame:
    r = with_ingest_ordinal(raw)
    return r.select(_s("review_id").alias("review_id"), _s("order_id").alias("order_id"),
                    _whole(r, "review_score").alias("review_score"),
                    _s("review_comment_title").alias("review_comment_title"),
                    _s("review_comment_message").alias("review_comment_message"),
                    *[TM.parse_timestamp(c).alias(c) for c in REVIEW_TS],
                    F.col(INGEST_ORDINAL),
                    *_mark(r, {"review_score": ("review_score", _whole(r, "review_score"))}, raw.columns))


def clean_reviews(raw: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    r = first_per_key(parse_reviews(raw), ["review_id"], [INGEST_ORDINAL])
    strip = TX.strip_accents_legacy if opts.legacy_nan else TX.strip_accents
    r = r.withColumns({"review_comment_message": strip("review_comment_message"),
                       "review_comment_title": strip("review_comment_title")})
    return _select_target(r, "dim_reviews", opts)


# ---------------------------------------------------------------------------
# E7 geolocation
# ---------------------------------------------------------------------------
def clean_geolocation(raw: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    raw = TX.with_normalized_place(raw, "geolocation_city", "geolocation_city", opts.legacy_nan)
    place = {c: F.col(c).try_cast("double") for c in ("geolocation_lat", "geolocation_lng")}
    return _select_target(raw.select(
        _zip("geolocation_zip_code_prefix", opts.legacy_zip).alias("geolocation_zip_code_prefix"),
        *[c.alias(n) for n, c in place.items()],
        F.col("geolocation_city"),
        _s("geolocation_state").alias("geolocation_state"),
        *_mark(raw, {n: (n, c) for n, c in place.items()})), "dim_geolocation", opts)


# ---------------------------------------------------------------------------
# E8 fact
# ---------------------------------------------------------------------------
def conform_order_items(raw: DataFrame) -> DataFrame:
    """Range filter, parse, rename, numeric fill -- before the key filters.

    A missing price (null, NaN, text that is no number) fails the range filter. A price that does
    not fit the column (too large, infinite) is marked as rejected; it is never stored as another value.
    """
    types = dict(raw.dtypes)

    def number(c: str) -> Column:  # numbers are compared as they are, so the filter reaches the scan
        return F.col(c).try_cast("double") if types[c] == "string" else F.col(c)

    def there(c: str) -> Column:
        return ~F.isnan(number(c)) if types[c] in ("string", "float", "double") else F.lit(True)

    money = {c: F.col(c).try_cast("decimal(10,2)") for c in ("price", "freight_value")}
    return (raw.where((number("price") > 0) & (number("freight_value") >= 0))
            .where(there("price") & there("freight_value"))
            .select(_s("order_id").alias("order_id"),
                    F.coalesce(_whole(raw, "order_item_id"), F.lit(0).cast("long")).alias("order_item_id"),
                    _s("product_id").alias("product_id"),
                    _s("seller_id").alias("seller_id"),
                    TM.parse_timestamp("shipping_limit_date").alias("shipping_deadline"),
                    *[c.alias(n) for n, c in money.items()],
                    *_mark(raw, {n: (n, c) for n, c in money.items()})))


def clean_order_items(raw: DataFrame, dim_orders: DataFrame, dim_products: DataFrame,
                      dim_sellers: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    f = conform_order_items(raw)
    # Keep items whose order, product and seller survived cleaning. Semi joins never
    # duplicate fact rows; AQE picks broadcast or sort-merge per side from its size.
    f = f.join(dim_products.select("product_id"), "product_id", "left_semi")
    f = f.join(dim_sellers.select("seller_id"), "seller_id", "left_semi")
    # Orders last: what follows groups and joins items by order, and finds them dealt by order already. All
    # shuffle partitions are kept, so that a task's share of the items does not depend on how AQE merges them. An
    # inner join with distinct ids, since a semi join would move below the repartition and undo it.
    parts = int(f.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    f = f.repartition(parts, "order_id").join(dim_orders.select("order_id").distinct(), "order_id")
    return _select_target(f, "fact_order_items", opts)


# ---------------------------------------------------------------------------
# E9 driver
# ---------------------------------------------------------------------------
class LazyTables(Mapping):
    """Table name -> DataFrame, each built on first access.

    Building a DataFrame runs analysis; queries that need two tables should not
    pay for the other six (three of which carry large text-normalisation tables).
    """

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def _good(df: DataFrame) -> DataFrame:
    return df.where(F.col(REJECTED).isNull()) if REJECTED in df.columns else df


def _product_keys(raw: Mapping[str, DataFrame], opts: CleanOptions) -> DataFrame:
    """Ids of the products that stay, without the translation join that no key needs."""
    p = filtered_products(raw["products"], opts)
    counts = ["product_name_length", "product_description_length", "product_photos_qty", *PRODUCT_MEASURES]
    marks = _mark(p, {c: (c, _whole(p, c)) for c in counts})[0]
    return p.where(marks.isNull()).select(_s("product_id").alias("product_id"))


def clean_all(raw: dict[str, DataFrame | None], opts: CleanOptions = CleanOptions()) -> LazyTables:
    """Build every warehouse table whose sources are present; warn and skip the rest."""
    b: dict[str, Callable[[], DataFrame]] = {}

    def have(*names: str) -> bool:
        if hasattr(raw, "available"):
            return all(raw.available(n) for n in names)
        return all(raw.get(n) is not None for n in names)

    if have("customers"):
        b["dim_customers"] = lambda: clean_customers(raw["customers"], opts)
    if have("products", "product_category_translation"):
        b["dim_products"] = lambda: clean_products(raw["products"], raw["product_category_translation"], opts)
    if have("sellers"):
        b["dim_sellers"] = lambda: clean_sellers(raw["sellers"], opts)
    if have("orders"):
        b["dim_orders"] = lambda: clean_orders(raw["orders"], raw.get("order_payments"), opts)
    if have("order_payments"):
        b["dim_payments"] = lambda: clean_payments(raw["order_payments"], opts)
    if have("order_reviews"):
        b["dim_reviews"] = lambda: clean_reviews(raw["order_reviews"], opts)
    if have("geolocation"):
        b["dim_geolocation"] = lambda: clean_geolocation(raw["geolocation"], opts)
    tables = LazyTables(b)
    if have("order_items") and all(k in b for k in ("dim_orders", "dim_products", "dim_sellers")):
        b["fact_order_items"] = lambda: clean_order_items(
            raw["order_items"], _good(tables["dim_orders"]), _product_keys(raw, opts),
            _good(tables["dim_sellers"]), opts)
    for t in TABLES:
        if t not in b:
            log.warning("source data for %s not available; table skipped", t)
    return tables
