"""Data-quality gates as report DataFrames.

Every gate scans each table once: all per-column counts of a table are one
``agg`` (then unpivoted), never one scan per column as a UNION ALL of COUNT(*)
queries would do. Orphan checks are authored as anti joins (Catalyst does not
turn LEFT JOIN ... IS NULL into one).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import TABLES

# The key columns checked for nulls before loading ...
PRE_LOAD_NULL_KEYS: dict[str, list[str]] = {
    "dim_customers": ["customer_id"],
    "dim_products": ["product_id"],
    "dim_sellers": ["seller_id"],
    "dim_orders": ["order_id", "customer_id"],
    "dim_payments": ["order_id"],
    "dim_reviews": ["review_id", "order_id"],
    "dim_geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"],
    "fact_order_items": ["order_id", "order_item_id", "product_id", "seller_id"],
}

# ... and the primary-key columns checked after loading.
POST_LOAD_NULL_KEYS: dict[str, list[str]] = {
    "dim_customers": ["customer_id"],
    "dim_products": ["product_id"],
    "dim_sellers": ["seller_id"],
    "dim_orders": ["order_id"],
    "dim_payments": ["order_id", "payment_sequential"],
    "dim_reviews": ["review_id"],
    "dim_geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"],
    "fact_order_items": ["order_id", "order_item_id"],
}

# Range rules (table, column, check name, predicate that marks a bad row).
RANGE_RULES: tuple[tuple[str, str, str, str], ...] = (
    ("fact_order_items", "price", "negative", "price < 0"),
    ("fact_order_items", "freight_value", "negative", "freight_value < 0"),
    ("dim_reviews", "review_score", "outside 1..5", "review_score < 1 OR review_score > 5"),
)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _unpivot_counts(df: DataFrame, table: str, exprs: dict[str, F.Column], value: str) -> DataFrame:
    """One aggregate over ``df`` with one count per key, returned as long rows."""
    row = df.agg(*[e.alias(f"c{i}") for i, e in enumerate(exprs.values())])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(k).alias("column_name"), F.col(f"c{i}").cast("long").alias(value))
        for i, k in enumerate(exprs)]))
    return row.select(F.lit(table).alias("table_name"), stacked.alias("s")).select(
        "table_name", "s.column_name", f"s.{value}")


def null_key_report(tables: Mapping[str, DataFrame], checks: Mapping[str, list[str]]) -> DataFrame:
    """(table_name, column_name, null_count) for every checked key column."""
    parts = [_unpivot_counts(tables[t], t, {c: F.count_if(F.col(c).isNull()) for c in cols}, "null_count")
             for t, cols in checks.items() if t in tables]
    return _union(parts)


def column_null_counts(df: DataFrame, table: str = "") -> DataFrame:
    """(table_name, column_name, null_count) for every column -- one scan."""
    return _unpivot_counts(df, table, {c: F.count_if(F.col(c).isNull()) for c in df.columns}, "null_count")


def range_report(tables: Mapping[str, DataFrame], rules=RANGE_RULES) -> DataFrame:
    """(table_name, column_name, check_name, bad_count); rules of one table share a scan."""
    by_table: dict[str, list[tuple[str, str, str]]] = {}
    for t, c, name, pred in rules:
        by_table.setdefault(t, []).append((c, name, pred))
    parts = []
    for t, rs in by_table.items():
        if t not in tables:
            continue
        row = tables[t].agg(*[F.count_if(F.expr(p)).alias(f"c{i}") for i, (_, _, p) in enumerate(rs)])
        stacked = F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.lit(n).alias("check_name"),
                     F.col(f"c{i}").cast("long").alias("bad_count")) for i, (c, n, _) in enumerate(rs)]))
        parts.append(row.select(F.lit(t).alias("table_name"), stacked.alias("s"))
                     .select("table_name", "s.column_name", "s.check_name", "s.bad_count"))
    return _union(parts)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) -- one count per table, unioned into one report."""
    return _union([df.agg(F.count(F.lit(1)).alias("row_count"))
                   .select(F.lit(t).alias("table_name"), "row_count") for t, df in tables.items()])


def pk_value(cols: Sequence[str]) -> F.Column:
    """Composite key rendered as text, parts joined by '|' (null parts as empty)."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def pk_duplicates(tables: Mapping[str, DataFrame], pks: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(table_name, pk_value, duplicate_count) for every key value seen more than once.

    Grouped counts with map-side partial aggregation: a key repeated in a third
    of all rows is collapsed before the shuffle.
    """
    pks = pks or {t: list(TABLES[t].pk) for t in tables if t in TABLES}
    parts = [tables[t].groupBy(*cols).agg(F.count(F.lit(1)).alias("duplicate_count"))
             .where(F.col("duplicate_count") > 1)
             .select(F.lit(t).alias("table_name"), pk_value(cols).alias("pk_value"), "duplicate_count")
             for t, cols in pks.items() if t in tables]
    return _union(parts)


def duplicate_examples(dups: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` duplicate keys per table (by key text) -- the console sample."""
    from pyspark.sql import Window
    w = Window.partitionBy("table_name").orderBy("pk_value")
    return dups.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


FK_CHECKS: tuple[tuple[str, str], ...] = (
    ("order_id", "dim_orders"),
    ("product_id", "dim_products"),
    ("seller_id", "dim_sellers"),
)


def orphans(fact: DataFrame, tables: Mapping[str, DataFrame], checks=FK_CHECKS) -> DataFrame:
    """(fk_column, fk_value): fact rows whose key is missing from its dimension.

    One row per orphaned fact row (null keys included, as with LEFT JOIN ... IS NULL).
    """
    parts = [fact.select(col).join(tables[dim].select(col), col, "left_anti")
             .select(F.lit(col).alias("fk_column"), F.col(col).alias("fk_value"))
             for col, dim in checks if dim in tables]
    return _union(parts)


def orphan_sample(fact: DataFrame, dim: DataFrame, col: str, n: int = 10) -> DataFrame:
    """Up to ``n`` orphaned values -- the LIMIT 10 listing of the post-load check."""
    return fact.select(col).join(dim.select(col), col, "left_anti").limit(n)


def _table_checks(df: DataFrame, table: str, keys: Sequence[str], rules) -> DataFrame:
    """Row count, null-key counts and range-rule counts of one table in ONE aggregate.

    Rows: (check_name, table_name, column_name, bad_count); the row count comes
    back as check 'row_count' and is used to list every table in the report.
    """
    checks = [("row_count", None, F.count(F.lit(1)))]
    checks += [("null_key", c, F.count_if(F.col(c).isNull())) for c in keys]
    checks += [(f"range {n}", c, F.count_if(F.expr(p))) for t, c, n, p in rules if t == table]
    row = df.agg(*[e.alias(f"c{i}") for i, (_, _, e) in enumerate(checks)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(n).alias("check_name"), F.lit(c).cast("string").alias("column_name"),
                 F.col(f"c{i}").cast("long").alias("bad_count")) for i, (n, c, _) in enumerate(checks)]))
    return row.select(F.lit(table).alias("table_name"), stacked.alias("s")).select(
        "s.check_name", "table_name", "s.column_name", "s.bad_count")


def _keyed_checks(df: DataFrame, table: str, keys: Sequence[str], rules, pk: Sequence[str],
                  parents: Mapping[str, DataFrame]) -> DataFrame:
    """``_table_checks`` with duplicate keys and orphans (``parents``: foreign key -> its dimension), in one pass.

    Rows are counted per primary key first, so the key's duplicates and all other counts come from the same groups.
    Each dimension's keys are joined once, as marks; the key that the rows are grouped by comes last and its
    partitions serve the grouping too.
    """
    per_key = {"row_count": F.count(F.lit(1))}
    labels: list[tuple[str, str, str | None]] = []  # (counted column, check, column)
    for c in keys:
        labels.append((f"null_{c}", "null_key", c))
        per_key[f"null_{c}"] = F.count_if(F.col(c).isNull())
    for i, (t, c, n, p) in enumerate(rules):
        if t == table:
            labels.append((f"range_{i}", f"range {n}", c))
            per_key[f"range_{i}"] = F.count_if(F.expr(p))
    for c in sorted(parents, key=lambda c: c in pk):
        mark = f"__has_{c}"
        df = df.join(parents[c].select(c).distinct().withColumn(mark, F.lit(True)), c, "left")
        labels.append((f"orphan_{c}", "orphan", c))
        per_key[f"orphan_{c}"] = F.count_if(F.col(mark).isNull())
    counted = df.groupBy(*pk).agg(*[e.alias(f"__{n}") for n, e in per_key.items()])
    labels.append(("dups", "pk_duplicate", None))
    row = counted.agg(*[F.coalesce(F.sum(f"__{n}"), F.lit(0)).alias(n) for n in per_key],
                      F.count_if(F.col("__row_count") > 1).alias("dups"))
    stacked = F.explode(F.array(*[
        F.struct(F.lit(n).alias("check_name"), F.lit(c).cast("string").alias("column_name"),
                 F.col(v).cast("long").alias("bad_count")) for v, n, c in labels]))
    return row.select(F.lit(table).alias("table_name"), stacked.alias("s")).select(
        "s.check_name", "table_name", "s.column_name", "s.bad_count")


def gate_report(tables: Mapping[str, DataFrame], phase: str = "post_load") -> DataFrame:
    """All gates as one report: (phase, check_name, table_name, column_name, bad_count, status).

    One aggregate per table covers its null keys and range rules; the post-load
    phase adds primary-key duplicates and orphans to the same pass over the table.
    """
    if phase == "pre_load":
        rep = _union([_table_checks(df, t, PRE_LOAD_NULL_KEYS.get(t, []), RANGE_RULES) for t, df in tables.items()])
        rep = rep.where(F.col("check_name") != "row_count")
    else:
        parts, zeros = [], []  # zeros: checks without anything to check
        for t, df in tables.items():
            keys = POST_LOAD_NULL_KEYS.get(t, [])
            parents = ({c: tables[d] for c, d in FK_CHECKS if d in tables} if t == "fact_order_items" else {})
            if t in TABLES:
                parts.append(_keyed_checks(df, t, keys, RANGE_RULES, TABLES[t].pk, parents))
            else:
                parts.append(_table_checks(df, t, keys, RANGE_RULES).where(F.col("check_name") != "row_count"))
                zeros.append(("pk_duplicate", t, None, 0))
            if t == "fact_order_items":
                zeros += [("orphan", t, c, 0) for c, d in FK_CHECKS if d not in tables]
        if zeros:
            parts.append(next(iter(tables.values())).sparkSession.createDataFrame(
                zeros, "check_name string, table_name string, column_name string, bad_count long"))
        rep = _union(parts)
    return rep.select(F.lit(phase).alias("phase"), "check_name", "table_name", "column_name", "bad_count",
                      F.when(F.col("bad_count") > 0, "fail").otherwise("ok").alias("status"))


class QualityError(RuntimeError):
    pass


def enforce(report: DataFrame) -> None:
    """Raise when any gate failed (strict mode); the failing rows are in the message."""
    bad = report.where(F.col("status") == "fail").collect()  # one row per check
    if bad:
        raise QualityError("; ".join(f"{r.table_name}.{r.column_name} {r.check_name}: {r.bad_count}"
                                     for r in bad))
