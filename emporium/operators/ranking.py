"""SQL ``RANK()`` over a whole frame without a single-partition window.

``rank() OVER (ORDER BY x)`` with no partition moves every row into one task. Here the frame is
reduced to its distinct sort values with their counts (map-side combined, so a value that a third
of all rows share is one row), only those are range-partitioned and written to the shared
checkpoint folder, and a table of one row per partition gives each the number of rows
ranked before it. The rank is joined back on the sort values, null-safe; AQE splits a hot value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Distinct sort values that one partition ranks.
VALUES_PER_PARTITION = 1_000_000


def global_rank(df: DataFrame, order: Sequence[tuple[str, bool]], name: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """``order`` holds (column, descending); nulls come last either way. The rank is a bigint."""
    ensure_checkpoint_dir(df.sparkSession)
    keys = [c for c, _ in order]
    sort = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in order]
    values = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).checkpoint(eager=False)
    n = partitions or max(1, -(-values.count() // VALUES_PER_PARTITION))
    ranged = (values.repartitionByRange(n, *sort).withColumn("__pid", F.spark_partition_id())
              .checkpoint(eager=False))
    in_order = Window.partitionBy("__pid").orderBy(*sort)
    before = F.sum("__n").over(in_order) - F.col("__n")
    counts = ranged.groupBy("__pid").agg(F.sum("__n").alias("__rows"))
    offsets = counts.select(  # one row per partition: a bounded, single-partition window
        "__pid", (F.sum("__rows").over(Window.orderBy("__pid")) - F.col("__rows")).alias("__off"))
    ranks = (ranged.withColumn("__before", before).join(F.broadcast(offsets), "__pid")
             .select(*[F.col(c).alias(f"__{c}") for c in keys],
                     (F.col("__off") + F.col("__before") + 1).cast("long").alias(name)))
    same = None
    for c in keys:
        eq = df[c].eqNullSafe(ranks[f"__{c}"])
        same = eq if same is None else same & eq
    return df.join(ranks, same).select(*[df[c] for c in df.columns], name)
