"""Profiling operators: what the source printed to the console, as DataFrames.

All are aggregations with map-side partial aggregation; none collects a column
to the driver. ``profile`` bundles them for one table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dedup import duplicate_rows, repeated_value_count
from .quality import column_null_counts
from .selection import narrowed_quantiles, stacked_values


def value_counts(df: DataFrame, col: str, ordered: bool = True) -> DataFrame:
    """(value, count) of non-null values, most frequent first (ties by value)."""
    out = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
           .agg(F.count(F.lit(1)).alias("count")))
    return out.orderBy(F.desc("count"), "value") if ordered else out


def single_entry_values(df: DataFrame, col: str) -> DataFrame:
    """Values that occur exactly once, sorted."""
    return value_counts(df, col, ordered=False).where(F.col("count") == 1).select("value").orderBy("value")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def column_distinct_counts(df: DataFrame, cols: Sequence[str] | None = None,
                           approx_rsd: float | None = None) -> DataFrame:
    """(column_name, distinct_count), nulls not counted (``nunique``).

    Exact by default (one aggregate; Spark expands the rows once per column and
    de-duplicates map-side). ``approx_rsd`` switches to HyperLogLog sketches
    (one pass, fixed-size state per column, no expansion) for very wide or very
    large tables.
    """
    cols = list(cols or df.columns)
    count = ((lambda c: F.approx_count_distinct(c, approx_rsd)) if approx_rsd is not None
             else F.count_distinct)
    row = df.agg(*[count(c).alias(f"c{i}") for i, c in enumerate(cols)])
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                           F.col(f"c{i}").cast("long").alias("distinct_count"))
                                  for i, c in enumerate(cols)]))
    return row.select(stacked.alias("s")).select("s.column_name", "s.distinct_count")


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def describe(df: DataFrame, cols: Sequence[str] | None = None,
             approx_accuracy: int | None = None) -> DataFrame:
    """count, mean, std (ddof 1), min, 25%, 50%, 75%, max per numeric column.

    Moments are one aggregate; exact quartiles (linear interpolation) come from ``selection``, so nothing that
    is shuffled grows with the values. ``approx_accuracy`` switches the quartiles to ``approx_percentile`` sketches (one
    pass for all; nearest-rank values, not interpolated).
    """
    cols = list(cols or numeric_columns(df))
    out = ["column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    if approx_accuracy is not None:
        # one pass: moments and quartile sketches in the same aggregate
        stacked = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in cols
        ])).alias("s")).select("s.*")
        moments = [F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
                   F.min("v").alias("min"), F.max("v").alias("max")]
        qs = F.percentile_approx("v", [0.25, 0.5, 0.75], approx_accuracy).alias("q")
        agg = stacked.groupBy("column_name").agg(*moments, qs)
        return agg.select("column_name", "count", "mean", "std", "min", F.col("q")[0].alias("p25"),
                          F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max")
    q = (narrowed_quantiles(df, cols, [0.25, 0.5, 0.75])
         .groupBy("column_name").pivot("prob", [0.25, 0.5, 0.75]).agg(F.first("value")))
    q = q.toDF("column_name", "p25", "p50", "p75")
    names = F.array(*[F.lit(c) for c in cols])
    moments = (stacked_values(df, cols).groupBy("column")
               .agg(F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
                    F.min("v").alias("min"), F.max("v").alias("max"))
               .withColumn("column_name", names[F.col("column")]))
    return (q.join(moments, "column_name", "left")
            .withColumn("count", F.coalesce("count", F.lit(0)).cast("long")).select(*out))


def review_id_profile(reviews: DataFrame) -> DataFrame:
    """Per review id: distinct orders, scores and creation dates; most orders first."""
    return (reviews.where(F.col("review_id").isNotNull()).groupBy("review_id")
            .agg(F.count_distinct("order_id").alias("n_orders"),
                 F.count_distinct("review_score").alias("n_scores"),
                 F.count_distinct("review_creation_date").alias("n_creation_dates"))
            .orderBy(F.desc("n_orders"), "review_id"))


def dedup_metrics(before: DataFrame, after: DataFrame) -> DataFrame:
    """(rows_before, rows_removed, rows_after) of a de-duplication step."""
    b = before.agg(F.count(F.lit(1)).alias("n")).select(F.col("n").alias("rows_before"), F.lit(None).cast("long").alias("rows_after"))
    a = after.agg(F.count(F.lit(1)).alias("n")).select(F.lit(None).cast("long").alias("rows_before"), F.col("n").alias("rows_after"))
    both = b.unionByName(a).agg(F.max("rows_before").alias("rows_before"), F.max("rows_after").alias("rows_after"))
    return both.select("rows_before", (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
                       "rows_after")


def profile(df: DataFrame, name: str = "") -> dict[str, DataFrame]:
    """The per-table profile: null counts, distinct counts, describe, duplicate rows."""
    return {
        "nulls": column_null_counts(df, name),
        "distinct": column_distinct_counts(df),
        "describe": describe(df) if numeric_columns(df) else None,
        "duplicates": duplicate_rows(df),
    }


__all__ = ["value_counts", "single_entry_values", "distinct_values", "column_distinct_counts",
           "describe", "review_id_profile", "dedup_metrics", "profile", "repeated_value_count"]
