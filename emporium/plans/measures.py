"""The measure layer: dashboard KPIs as grouped DataFrames.

Semantics follow the measure definitions of the source dashboard:

* ``gmv``              = sum(price + freight) over order items (a missing part adds 0);
* ``total_orders``     = distinct dim_orders.order_id;
* ``active_customers`` = distinct dim_orders.customer_id;
* ``active_sellers``   = distinct fact.seller_id;
* ``avg_order_value``  = gmv / total_orders, blank when there are no orders;
* ``on_time_pct``      = orders delivered on or before the estimate / delivered orders
                         (undelivered orders are in neither count).

Filters and groupings on order or customer attributes reach the fact through the
order key (one direction: dimension -> fact); an order measure is never
filtered by fact rows.

Scale notes. The fact is always pre-aggregated to one row per order (or per
order and seller) before it meets a dimension, so a hot order, seller or
customer is collapsed by map-side partial aggregation before any shuffle and no
join fans out. Measure families computed from different tables are combined by
``unionByName`` + ``groupBy`` on the grouping keys (null-safe, no join). Windows
without a partition (shares, ranks) run only on aggregated results keyed by a
low-cardinality attribute (state, status, payment type, category).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import temporal as TM
from ..plans.views import items_per_order_seller

Tables = Mapping[str, DataFrame]


def _gmv_expr() -> Column:
    return F.coalesce(F.col("price"), F.lit(0)) + F.coalesce(F.col("freight_value"), F.lit(0))


def order_totals(fact: DataFrame) -> DataFrame:
    """order_id -> gmv, items (one row per order)."""
    return fact.groupBy("order_id").agg(F.sum(_gmv_expr()).alias("gmv"),
                                        F.count(F.lit(1)).alias("items"))


def _combine(frames: Sequence[DataFrame], keys: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """Outer-combine measure frames that share grouping keys (null keys group together)."""
    full = []
    for f in frames:
        missing = [c for c in value_cols if c not in f.columns]
        full.append(f.select(*keys, *[c for c in value_cols if c in f.columns],
                             *[F.lit(None).alias(c) for c in missing]))
    u = full[0]
    for f in full[1:]:
        u = u.unionByName(f, allowMissingColumns=False)
    return u.groupBy(*keys).agg(*[F.max(c).alias(c) for c in value_cols])


def _money(c: Column) -> Column:
    return c.cast("decimal(38,2)")


# ---------------------------------------------------------------------------
# M1-M5, M8 executive KPIs
# ---------------------------------------------------------------------------
def kpi_exec(t: Tables) -> DataFrame:
    fact, orders = t["fact_order_items"], t["dim_orders"]
    f = fact.agg(_money(F.sum(_gmv_expr())).alias("gmv"),
                 F.count_distinct("seller_id").alias("active_sellers"))
    o = orders.agg(F.count_distinct("order_id").alias("total_orders"),
                   F.count_distinct("customer_id").alias("active_customers"))
    both = (f.select("gmv", "active_sellers", F.lit(None).cast("long").alias("total_orders"),
                     F.lit(None).cast("long").alias("active_customers"))
            .unionByName(o.select(F.lit(None).cast("decimal(38,2)").alias("gmv"),
                                  F.lit(None).cast("long").alias("active_sellers"),
                                  "total_orders", "active_customers"))
            .agg(*[F.max(c).alias(c) for c in ["gmv", "active_sellers", "total_orders", "active_customers"]]))
    return both.select("gmv", "total_orders", "active_customers", "active_sellers",
                       N.safe_divide("gmv", "total_orders").alias("avg_order_value"))


# ---------------------------------------------------------------------------
# Time grouping (M9-M11)
# ---------------------------------------------------------------------------
def _gmv_by_order_attribute(t: Tables, attrs: dict[str, Column]) -> DataFrame:
    orders = one_row_per_order(t["dim_orders"])
    keyed = orders.select("order_id", *[c.alias(n) for n, c in attrs.items()])
    keys = list(attrs)
    g = (order_totals(t["fact_order_items"]).join(keyed, "order_id")
         .groupBy(*keys).agg(_money(F.sum("gmv")).alias("gmv"), F.sum("items").alias("items")))
    o = keyed.groupBy(*keys).agg(F.count_distinct("order_id").alias("total_orders"))
    out = _combine([g, o], keys, ["gmv", "items", "total_orders"])
    return out.select(*keys, "gmv", F.coalesce("items", F.lit(0)).cast("long").alias("items"), "total_orders",
                      N.safe_divide("gmv", "total_orders").alias("avg_order_value"))


def gmv_by_month(t: Tables) -> DataFrame:
    out = _gmv_by_order_attribute(t, {"month": TM.month_start("order_purchase_timestamp")})
    return out.select("month", TM.month_name("month").alias("month_name"),
                      *[c for c in out.columns if c != "month"])


def gmv_by_year(t: Tables) -> DataFrame:
    return _gmv_by_order_attribute(t, {"year": F.year("order_purchase_timestamp")})


# Day names, Monday first.
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def gmv_by_weekday(t: Tables) -> DataFrame:
    out = _gmv_by_order_attribute(t, {"weekday": TM.weekday("order_purchase_timestamp")})
    names = F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), F.col("weekday") + 1)
    return out.select("weekday", names.alias("day_name"), (F.col("weekday") >= 5).alias("is_weekend"),
                      "gmv", "items", "total_orders", "avg_order_value")


def gmv_weekday_vs_weekend(t: Tables) -> DataFrame:
    """Two rows: purchases Monday-Friday against Saturday-Sunday."""
    day_type = F.when(TM.weekday("order_purchase_timestamp") >= 5, "weekend").otherwise("weekday")
    return _gmv_by_order_attribute(t, {"day_type": day_type})


# ---------------------------------------------------------------------------
# M12 geography
# ---------------------------------------------------------------------------
def one_row_per_order(orders: DataFrame) -> DataFrame:
    """A broken key must not multiply money: of rows that share an order id the earliest purchase stays.

    Grouped with map-side combining; where the key holds, every group is one row."""
    rest = [c for c in orders.columns if c != "order_id"]
    first = F.struct("order_purchase_timestamp", *[c for c in rest if c != "order_purchase_timestamp"])
    one = orders.groupBy("order_id").agg(F.min(first).alias("o"))
    return one.select("order_id", *[F.col(f"o.{c}").alias(c) for c in rest])


def orders_with_customers(t: Tables) -> DataFrame:
    c = t["dim_customers"].select("customer_id", "customer_state", "customer_city")
    return one_row_per_order(t["dim_orders"]).join(c, "customer_id", "left")


def gmv_by_state(t: Tables) -> DataFrame:
    oc = orders_with_customers(t).select("order_id", "customer_id", "customer_state")
    per_state = (oc.join(order_totals(t["fact_order_items"]), "order_id", "left")
                 .groupBy("customer_state")
                 .agg(_money(F.sum("gmv")).alias("gmv"),
                      F.count("order_id").alias("total_orders"),
                      F.count_distinct("customer_id").alias("active_customers")))
    total = F.sum("gmv").over(Window.partitionBy())
    return per_state.select(
        "customer_state", "gmv", "total_orders", "active_customers",
        N.safe_divide("gmv", total).alias("gmv_share"),
        F.rank().over(Window.orderBy(F.desc_nulls_last("gmv"))).alias("gmv_rank"))


def zip_locations(geolocation: DataFrame) -> DataFrame:
    """One row per zip prefix: mean coordinates and the number of geolocation rows.

    Geolocation holds many rows per zip; reducing it first keeps the customer join
    one-to-one (no fan-out) and the reduction has map-side partial aggregation.
    """
    return (geolocation.groupBy("geolocation_zip_code_prefix")
            .agg(F.avg("geolocation_lat").alias("lat"), F.avg("geolocation_lng").alias("lng"),
                 F.count(F.lit(1)).alias("geolocation_rows")))


def customer_locations(t: Tables) -> DataFrame:
    """Customers with the mean coordinates of their zip prefix (null when unknown)."""
    z = zip_locations(t["dim_geolocation"])
    c = t["dim_customers"]
    return (c.join(z, c.customer_zip_code_prefix == z.geolocation_zip_code_prefix, "left")
            .select("customer_id", "customer_zip_code_prefix", "customer_city", "customer_state",
                    "lat", "lng", "geolocation_rows"))


# ---------------------------------------------------------------------------
# M13-M15 orders and payments
# ---------------------------------------------------------------------------
def order_status_mix(t: Tables) -> DataFrame:
    s = t["dim_orders"].groupBy("order_status").agg(F.count_distinct("order_id").alias("total_orders"))
    return s.select("order_status", "total_orders",
                    N.safe_divide("total_orders", F.sum("total_orders").over(Window.partitionBy()))
                    .alias("order_share"))


def payment_mix(t: Tables) -> DataFrame:
    p = (t["dim_payments"].groupBy("payment_type")
         .agg(F.count(F.lit(1)).alias("payments"),
              _money(F.sum("payment_value")).alias("total_value"),
              F.count("payment_value").alias("n_values")))
    return p.select("payment_type", "payments",
                    N.safe_divide("payments", F.sum("payments").over(Window.partitionBy())).alias("payment_share"),
                    "total_value", N.safe_divide("total_value", "n_values").alias("avg_value"))


def installments_value(t: Tables) -> DataFrame:
    p = (t["dim_payments"].groupBy("payment_installments")
         .agg(F.count(F.lit(1)).alias("payments"), _money(F.sum("payment_value")).alias("total_value"),
              F.count("payment_value").alias("n_values")))
    return p.select("payment_installments", "payments", "total_value",
                    N.safe_divide("total_value", "n_values").alias("avg_value"))


def installments_correlation(t: Tables) -> DataFrame:
    """Pearson correlation of installments and payment value (one row)."""
    return t["dim_payments"].agg(
        F.corr(F.col("payment_installments").cast("double"), F.col("payment_value").cast("double"))
        .alias("installments_value_corr"))


# ---------------------------------------------------------------------------
# M16-M17 delivery
# ---------------------------------------------------------------------------
def delay_bucket_reviews(t: Tables) -> DataFrame:
    rv = (t["dim_reviews"].where(F.col("order_id").isNotNull()).groupBy("order_id")
          .agg(F.count(F.lit(1)).alias("n"), F.sum("review_score").alias("s"),
               F.count("review_score").alias("c")))
    o = t["dim_orders"].select(
        "order_id",
        TM.delay_bucket(TM.delay_days("order_delivered_customer_date", "order_estimated_delivery_date"))
        .alias("delay_bucket"))
    return (o.join(rv, "order_id").groupBy("delay_bucket")
            .agg(F.sum("n").alias("reviews"),
                 N.safe_divide(F.sum("s"), F.sum("c")).alias("avg_review_score")))


def delivery_completion(t: Tables) -> DataFrame:
    """Delivered / (all - canceled); the source names the rate but not its formula."""
    s = F.col("order_status")
    o = t["dim_orders"].agg(F.count(F.lit(1)).alias("total_orders"),
                            F.count_if(s == "delivered").alias("delivered_orders"),
                            F.count_if(s == "canceled").alias("canceled_orders"))
    return o.select("total_orders", "delivered_orders", "canceled_orders",
                    N.safe_divide("delivered_orders", F.col("total_orders") - F.col("canceled_orders"))
                    .alias("completion_rate"))


def on_time_pct(t: Tables, by: Sequence[str] = ()) -> DataFrame:
    d, e = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    delivered = F.count_if(d.isNotNull())
    on_time = F.count_if(d.isNotNull() & e.isNotNull() & (d <= e))
    o = t["dim_orders"]
    agg = o.groupBy(*by).agg(on_time.alias("on_time_orders"), delivered.alias("delivered_orders"))
    return agg.select(*by, "on_time_orders", "delivered_orders",
                      N.safe_divide("on_time_orders", "delivered_orders").alias("on_time_pct"))


# ---------------------------------------------------------------------------
# M18-M19 products and sellers
# ---------------------------------------------------------------------------
def gmv_by_category(t: Tables) -> DataFrame:
    per_product = (t["fact_order_items"].groupBy("product_id")
                   .agg(F.sum(_gmv_expr()).alias("gmv"), F.count(F.lit(1)).alias("items")))
    p = t["dim_products"].select("product_id", "product_category_name_english")
    g = (per_product.join(p, "product_id", "left").groupBy("product_category_name_english")
         .agg(_money(F.sum("gmv")).alias("gmv"), F.sum("items").alias("items")))
    return g.select("product_category_name_english", "gmv", "items",
                    F.rank().over(Window.orderBy(F.desc_nulls_last("gmv"))).alias("gmv_rank"))


def top_k(df: DataFrame, k: int, order: Sequence[Column | str]) -> DataFrame:
    """The k first rows under ``order`` (TakeOrderedAndProject; the limit is the feature)."""
    return df.orderBy(*order).limit(k)


def seller_scorecard(t: Tables) -> DataFrame:
    """Per seller: orders, items, GMV, item-weighted on-time rate and review average, GMV rank.

    One pass: items per (order, seller) meet per-order on-time counts and
    per-order review sums on ``order_id``, then one aggregation by seller.
    """
    from ..plans.views import review_sums_per_order
    fact, orders = t["fact_order_items"], t["dim_orders"]
    per_os = items_per_order_seller(fact)
    o = (orders.select("order_id", TM.on_time_flag("order_delivered_customer_date",
                                                   "order_estimated_delivery_date").alias("flag"))
         .groupBy("order_id").agg(F.count(F.lit(1)).alias("k"), F.sum("flag").alias("t")))
    j = per_os.join(o, "order_id", "left").join(review_sums_per_order(t["dim_reviews"]), "order_id", "left")
    k, n = F.col("k"), F.col("n_items")
    s = (j.groupBy("seller_id")
         .agg(F.count("k").alias("orders"), F.sum(n * k).alias("items"),
              _money(F.sum(F.col("gmv") * k)).alias("gmv"),
              F.sum(n * F.col("t")).alias("on_time_items"),
              N.safe_divide(F.sum(n * F.col("s")), F.sum(n * F.col("c"))).alias("avg_review")))
    # Sellers grow with the data: rank them without a single-partition window.
    from ..operators.ranking import global_rank
    scored = (s.where(F.col("orders") > 0)
              .select("seller_id", "orders", "items", "gmv",
                      N.safe_divide("on_time_items", "items").alias("on_time_rate"), "avg_review"))
    return global_rank(scored, [("gmv", True)], "gmv_rank")


# ---------------------------------------------------------------------------
# M6 cohorts (W3)
# ---------------------------------------------------------------------------
def with_first_purchase(orders: DataFrame) -> DataFrame:
    """Attach each customer's first purchase, computed on the unfiltered orders.

    Filter *after* this call to keep the all-time first purchase (ALLEXCEPT semantics).
    """
    first = (orders.groupBy("customer_id")
             .agg(F.min("order_purchase_timestamp").alias("first_purchase_timestamp")))
    # Null-safe: orders without a customer share one first purchase. A join and not a window,
    # because a join on a hot customer can be split.
    first = first.withColumnRenamed("customer_id", "_customer")
    return orders.join(first, orders["customer_id"].eqNullSafe(first["_customer"]), "left").drop("_customer")


def orders_first_purchase(t: Tables) -> DataFrame:
    """Every order with its customer's all-time first purchase (the cohort date)."""
    o = with_first_purchase(t["dim_orders"].select("order_id", "customer_id", "order_purchase_timestamp"))
    return o.select("order_id", "customer_id", "order_purchase_timestamp", "first_purchase_timestamp",
                    TM.month_start("first_purchase_timestamp").alias("cohort_month"))


def first_purchase_cohort(t: Tables) -> DataFrame:
    o = t["dim_orders"].where(F.col("customer_id").isNotNull())
    per_customer = (o.select("order_id", "customer_id", "order_purchase_timestamp")
                    .join(order_totals(t["fact_order_items"]), "order_id", "left")
                    .groupBy("customer_id")
                    .agg(F.min("order_purchase_timestamp").alias("first_purchase"),
                         F.count_distinct("order_id").alias("orders"),
                         F.sum("gmv").alias("gmv")))
    return (per_customer.groupBy(TM.month_start("first_purchase").alias("cohort_month"))
            .agg(F.count(F.lit(1)).alias("customers"), F.sum("orders").alias("orders"),
                 _money(F.sum("gmv")).alias("gmv")))


# ---------------------------------------------------------------------------
# M20 any measures, any grouping, any filter
# ---------------------------------------------------------------------------
ORDER_MEASURES = ("total_orders", "active_customers", "on_time_pct")
FACT_MEASURES = ("gmv", "items", "active_sellers")
DERIVED = ("avg_order_value",)
MEASURES = ORDER_MEASURES + FACT_MEASURES + DERIVED
PAYMENT_MEASURES = ("payments", "payment_total", "avg_payment")
REVIEW_MEASURES = ("reviews", "avg_review_score")
ALL_MEASURES = MEASURES + PAYMENT_MEASURES + REVIEW_MEASURES

# Slicer fields reached through the fact only (product and seller attributes).
PRODUCT_ATTRS = ("product_category_name", "product_category_name_english")
SELLER_ATTRS = ("seller_city", "seller_state", "seller_zip_code_prefix")
# Slicer fields of the tables that hang on orders by order_id; each reaches its own measures only.
PAYMENT_ATTRS = ("payment_type", "payment_installments")
REVIEW_ATTRS = ("review_score",)


def order_attributes(t: Tables) -> DataFrame:
    """dim_orders + customer attributes + calendar, delay and cohort columns (the slicer fields)."""
    ts = F.col("order_purchase_timestamp")
    delay = TM.delay_bucket(TM.delay_days("order_delivered_customer_date", "order_estimated_delivery_date"))
    day = F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), TM.weekday(ts) + 1)
    return (orders_with_customers(t)
            .withColumns({"purchase_year": F.year(ts), "purchase_month": TM.month_start(ts),
                          "purchase_weekday": TM.weekday(ts), "purchase_day_name": day, "delay_bucket": delay}))


def _item_attributes(t: Tables, by_i: Sequence[str], item_where) -> DataFrame:
    """Fact pre-aggregated per (order, seller, product) with the product/seller fields needed."""
    fact = t["fact_order_items"].select(
        "order_id", "seller_id", "product_id",
        (F.coalesce("price", F.lit(0)) + F.coalesce("freight_value", F.lit(0))).alias("g"))
    f = fact.groupBy("order_id", "seller_id", "product_id").agg(
        F.sum("g").alias("gmv"), F.count(F.lit(1)).alias("n_items"))
    need = set(by_i) | ({"*"} if item_where is not None else set())
    if need & set(PRODUCT_ATTRS) or item_where is not None:
        f = f.join(t["dim_products"].select("product_id", *PRODUCT_ATTRS), "product_id", "left")
    if need & set(SELLER_ATTRS) or item_where is not None:
        f = f.join(t["dim_sellers"].select("seller_id", *SELLER_ATTRS), "seller_id", "left")
    return f.where(item_where) if item_where is not None else f


def _items_branch(t: Tables, o: DataFrame, by_o: list[str], own: list[str], item_where) -> DataFrame:
    return (_item_attributes(t, own, item_where).join(o.select("order_id", *by_o), "order_id")
            .groupBy(*by_o, *own).agg(_money(F.sum("gmv")).alias("gmv"), F.sum("n_items").alias("items"),
                                      F.count_distinct("seller_id").alias("active_sellers")))


def _payments_branch(t: Tables, o: DataFrame, by_o: list[str], own: list[str]) -> DataFrame:
    # One row per order (and slicer value) before the join: a hot order is summed up first.
    p = t["dim_payments"].groupBy("order_id", *own).agg(
        F.count(F.lit(1)).alias("n"), F.sum("payment_value").alias("v"), F.count("payment_value").alias("c"))
    return (p.join(o.select("order_id", *by_o), "order_id").groupBy(*by_o, *own)
            .agg(F.sum("n").alias("payments"), _money(F.sum("v")).alias("payment_total"), F.sum("c").alias("_valued")))


def _reviews_branch(t: Tables, o: DataFrame, by_o: list[str], own: list[str]) -> DataFrame:
    r = t["dim_reviews"].groupBy("order_id", *own).agg(
        F.count(F.lit(1)).alias("n"), F.sum("review_score").alias("v"), F.count("review_score").alias("c"))
    return (r.join(o.select("order_id", *by_o), "order_id").groupBy(*by_o, *own)
            .agg(F.sum("n").alias("reviews"), F.sum("v").alias("_score"), F.sum("c").alias("_scored")))


# The parts that measures are made of, by the table they come from.
ORDER_VALUES = ["total_orders", "active_customers", "_on_time", "_delivered"]
PART_VALUES = {"items": ["gmv", "items", "active_sellers"], "payments": ["payments", "payment_total", "_valued"],
               "reviews": ["reviews", "_score", "_scored"]}
SLICE_FIELDS = {"items": PRODUCT_ATTRS + SELLER_ATTRS, "payments": PAYMENT_ATTRS, "reviews": REVIEW_ATTRS}


def _parts_of(measures: Sequence[str], by: Sequence[str]) -> tuple[dict[str, list[str]], list[str], list[str], list[str]]:
    """``(fields of by of each table, the table that is sliced, order fields, tables needed)``."""
    asked = {"items": FACT_MEASURES + DERIVED, "payments": PAYMENT_MEASURES, "reviews": REVIEW_MEASURES}
    own = {k: [b for b in by if b in f] for k, f in SLICE_FIELDS.items()}
    sliced = [k for k, f in own.items() if f]
    if len(sliced) > 1:
        raise ValueError(f"slices of {sliced} can't be mixed: no key leads from one to the other")
    by_o = [b for b in by if not any(b in f for f in SLICE_FIELDS.values())]
    return own, sliced, by_o, [k for k in SLICE_FIELDS if k in sliced or set(measures) & set(asked[k])]


def measure_frame(t: Tables, measures: Sequence[str] = MEASURES, by: Sequence[str] = (),
                  where: str | Column | None = None, item_where: str | Column | None = None) -> DataFrame:
    """Evaluate ``measures`` grouped by ``by`` under the filters.

    ``by`` may mix order/customer fields (``order_attributes``) with the fields of one table that
    hangs on orders: items (``PRODUCT_ATTRS``, ``SELLER_ATTRS``), payments (``PAYMENT_ATTRS``) or
    reviews (``REVIEW_ATTRS``). ``where`` filters orders and customers and so reaches every
    measure; ``item_where`` filters products and sellers and reaches only the item measures.
    Filters and slices flow from a dimension to the tables that refer to it, never back:
    a slice by payment type splits the payment measures and repeats the others.
    """
    unknown = set(measures) - set(ALL_MEASURES)
    if unknown:
        raise ValueError(f"unknown measures {sorted(unknown)}")
    by = list(by)
    own, sliced, by_o, needed = _parts_of(measures, by)
    o = order_attributes(t)
    if where is not None:
        o = o.where(where)
    d, e = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    frames = [o.groupBy(*by_o).agg(
        F.count("order_id").alias("total_orders"),  # order_attributes has one row an order
        F.count_distinct("customer_id").alias("active_customers"),
        F.count_if(d.isNotNull() & e.isNotNull() & (d <= e)).alias("_on_time"),
        F.count_if(d.isNotNull()).alias("_delivered"))]
    split = None
    for k in needed:
        frame = {"items": lambda f: _items_branch(t, o, by_o, f, item_where),
                 "payments": lambda f: _payments_branch(t, o, by_o, f),
                 "reviews": lambda f: _reviews_branch(t, o, by_o, f)}[k](own[k])
        if k in sliced:
            split = frame
        else:
            frames.append(frame)
    return _answer(frames, split, measures, by, by_o, needed, sliced)


def _answer(frames: Sequence[DataFrame], split: DataFrame | None, measures: Sequence[str], by: Sequence[str],
            by_o: Sequence[str], needed: Sequence[str], sliced: Sequence[str]) -> DataFrame:
    """The measures from their parts: ``frames`` by the order fields, ``split`` by the sliced table's fields too."""
    values = PART_VALUES
    whole_vals = ORDER_VALUES + [v for k in needed if k not in sliced for v in values[k]]
    whole = _combine(frames, by_o, whole_vals) if by_o else _combine_global(frames, whole_vals)
    if split is None:
        out = whole
    else:
        split_vals = values[sliced[0]]
        if by_o:
            # Groups of the slice carry the other measures of their order slice, and an order slice
            # without any stays, with blank fields.
            cond = [F.col(f"i.{b}").eqNullSafe(F.col(f"o.{b}")) for b in by_o]
            out = (split.withColumn("_i", F.lit(1)).alias("i")
                   .join(whole.alias("o"), reduce(lambda a, b: a & b, cond), "full")
                   .select(*[F.when(F.col("i._i").isNotNull(), F.col(f"i.{b}")).otherwise(F.col(f"o.{b}")).alias(b)
                             if b in by_o else F.col(f"i.{b}").alias(b) for b in by],
                           *[F.col(f"o.{v}") for v in whole_vals], *[F.col(f"i.{v}") for v in split_vals]))
        else:
            # no order slice: the other measures are one row of totals, on every group
            out = split.join(F.broadcast(whole)).select(*by, *whole_vals, *split_vals)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    derived = {
        "total_orders": zero("total_orders"), "active_customers": zero("active_customers"),
        "on_time_pct": N.safe_divide("_on_time", "_delivered"),
        "gmv": F.col("gmv"), "items": F.col("items"), "active_sellers": F.col("active_sellers"),
        "avg_order_value": N.safe_divide("gmv", "total_orders"),
        "payments": F.col("payments"), "payment_total": F.col("payment_total"),
        "avg_payment": N.safe_divide("payment_total", "_valued"),
        "reviews": F.col("reviews"), "avg_review_score": N.safe_divide("_score", "_scored"),
    }
    return out.select(*by, *[derived[m].alias(m) for m in measures])


def _combine_global(frames: Sequence[DataFrame], value_cols: Sequence[str]) -> DataFrame:
    key = "__all"
    return _combine([f.withColumn(key, F.lit(0)) for f in frames], [key], value_cols).drop(key)
