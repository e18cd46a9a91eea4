"""Exact quantiles (linear interpolation, like pandas) without a single-task merge.

``percentile``/``median`` aggregates keep every distinct value of a group in one
buffer; for a global aggregate that is one task holding the whole column. Here
the ranking is distributed instead:

1. ``(column, value) -> count``: grouped with map-side partial aggregation, so
   a value repeated in a third of all rows becomes one row;
2. range-partition and sort those distinct values, then ``checkpoint()`` them to
   the shared checkpoint folder (lineage cut; both later uses read the same
   partitioning);
3. per partition, a running count (a window over the partition id -- the
   partitions are balanced by the range split); per-partition totals are a tiny
   table (one row per partition and column) whose prefix sums give every
   partition its global offset;
4. the rows whose rank interval contains a wanted position are picked by a join
   against the per-column target table (one row per requested probability).

All this shuffles the distinct values; ``medians`` needs one rank or two and takes them from ``selection``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .selection import narrowed_quantiles


def _value_counts_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in cols
    ])).alias("s")).select("s.column_name", "s.v")
    return (stacked.where(F.col("v").isNotNull() & ~F.isnan("v"))
            .groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("c")))


# Distinct values that one partition ranks.
VALUES_PER_PARTITION = 1_000_000


def value_counts_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column_name, v, c)``: each distinct value with its count, written once for several readers."""
    ensure_checkpoint_dir(df.sparkSession)
    return _value_counts_long(df, cols).checkpoint(eager=True)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    partitions: int | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Rows ``(column_name, prob, value)``; nulls and NaN are skipped, as in pandas.

    ``value`` is null for a column without values. ``counts`` gives a ``value_counts_long`` that
    is there already. The number of partitions follows the number of distinct values.
    """
    spark = df.sparkSession
    vc = value_counts_long(df, cols) if counts is None else counts
    n_parts = partitions or max(1, -(-vc.count() // VALUES_PER_PARTITION))
    ranged = (vc.repartitionByRange(n_parts, "column_name", "v")
              .sortWithinPartitions("column_name", "v")
              .checkpoint(eager=True))
    run = (Window.partitionBy("pid", "column_name").orderBy("v")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = (ranged.withColumn("pid", F.spark_partition_id())
             .withColumn("cum", F.sum("c").over(run)))
    part_tot = local.groupBy("column_name", "pid").agg(F.max("cum").alias("tot"))
    w = Window.partitionBy("column_name").orderBy("pid")
    offsets = (part_tot  # one row per (column, partition): bounded by columns x partitions
               .withColumn("offset", F.sum("tot").over(w) - F.col("tot"))
               .withColumn("n", F.sum("tot").over(Window.partitionBy("column_name"))))
    ranked = (local.join(F.broadcast(offsets), ["column_name", "pid"])
              .select("column_name", "v", "n",
                      (F.col("offset") + F.col("cum") - F.col("c")).alias("first_pos"),
                      (F.col("offset") + F.col("cum") - 1).alias("last_pos")))
    # Targets: per column and probability, the two neighbouring positions.
    totals = offsets.select("column_name", "n").distinct()
    targets = (totals.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
               .withColumn("h", (F.col("n") - 1) * F.col("prob"))
               .withColumn("lo", F.floor("h")).withColumn("hi", F.ceil("h"))
               .withColumn("frac", F.col("h") - F.col("lo")))
    t = F.broadcast(targets.alias("t"))
    r = ranked.alias("r")
    lo = (r.join(t, (F.col("r.column_name") == F.col("t.column_name"))
                 & (F.col("t.lo") >= F.col("r.first_pos")) & (F.col("t.lo") <= F.col("r.last_pos")))
          .select(F.col("t.column_name").alias("column_name"), "t.prob", "t.frac",
                  F.col("r.v").alias("v_lo")))
    hi = (r.join(t, (F.col("r.column_name") == F.col("t.column_name"))
                 & (F.col("t.hi") >= F.col("r.first_pos")) & (F.col("t.hi") <= F.col("r.last_pos")))
          .select(F.col("t.column_name").alias("column_name"), "t.prob", F.col("r.v").alias("v_hi")))
    picked = (lo.join(hi, ["column_name", "prob"])
              .select("column_name", "prob",
                      (F.col("v_lo") + F.col("frac") * (F.col("v_hi") - F.col("v_lo"))).alias("value")))
    every = spark.createDataFrame([(c, float(p)) for c in cols for p in probs],
                                  "column_name string, prob double")
    return every.join(picked, ["column_name", "prob"], "left")


def medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: ``(column_name, median)``."""
    return (narrowed_quantiles(df, cols, [0.5])
            .select("column_name", F.col("value").alias("median")))


def fill_with_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace nulls of ``cols`` with each column's exact median.

    The medians are one small row; they are pulled to the driver as literals
    (a bounded result: one number per column) so the fill stays a projection.
    """
    m = {r["column_name"]: r["median"] for r in medians(df, cols).collect()}
    return df.fillna({c: m[c] for c in cols if m.get(c) is not None})
