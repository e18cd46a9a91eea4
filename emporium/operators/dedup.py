"""First-per-key selection and duplicate detection.

Both are written so that a key holding a third of all rows never lands whole in
one task: ``first_per_key`` compiles to a window with a partial ``WindowGroupLimit``
before the shuffle (each map task forwards at most one row per key), and
``duplicate_rows`` is a grouped count with map-side partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INGEST_ORDINAL = "src_ord"
# Copies of a row that one array stands for.
COPIES = 10_000


def with_ingest_ordinal(df: DataFrame, name: str = INGEST_ORDINAL) -> DataFrame:
    """Attach a file-order ordinal when the source did not bring one.

    Spark deals file splits to tasks by size, so a row's place is its file, the
    start of its split in that file, and its position in the split (the last part
    of ``monotonically_increasing_id``, which grows inside a task). Frames that
    are not read from files are ordered by partition and position alone.
    """
    if name in df.columns:
        return df
    row = F.monotonically_increasing_id()
    try:
        return df.withColumn(name, F.struct(F.col("_metadata.file_path").alias("file"),
                                            F.col("_metadata.file_block_start").alias("block"), row.alias("row")))
    except AnalysisException:
        return df.withColumn(name, F.struct(F.lit("").alias("file"), F.lit(0).cast("long").alias("block"),
                                            row.alias("row")))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row of every key under ``order`` (like ``drop_duplicates(keep='first')``).

    Null keys form one group, as in pandas. ``order`` must be a total order within
    a key (e.g. an ingest ordinal) for the result to be deterministic.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    rn = "__first_rn"
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)


def duplicate_rows(df: DataFrame, count_col: str = "duplicate_count") -> DataFrame:
    """Rows that equal an earlier row in every column (nulls compare equal).

    Returned compactly: one row per repeated value with ``duplicate_count`` =
    number of extra copies (what ``df[df.duplicated()]`` would list).
    """
    cols = df.columns
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
            .where(F.col("__n") > 1)
            .select(*cols, (F.col("__n") - 1).alias(count_col)))


def expand_duplicates(dups: DataFrame, count_col: str = "duplicate_count") -> DataFrame:
    """Materialise one row per extra copy from :func:`duplicate_rows` output.

    A count is first cut into blocks of ``COPIES`` that are dealt out anew, so the copies of a
    hot row are made by many tasks and no array holds more than ``COPIES`` entries.
    """
    rest = [c for c in dups.columns if c != count_col]
    n = F.col(count_col).cast("long")
    # Blocks of blocks: two short arrays reach COPIES squared, each further level as much again.
    left = dups.withColumn("__n", n)
    for level in (COPIES ** 3, COPIES ** 2, COPIES):
        whole = F.floor(F.col("__n") / level).cast("int")
        left = (left.withColumn("__part", F.explode(F.concat(F.array_repeat(F.lit(level).cast("long"), whole),
                                                             F.array(F.col("__n") % level))))
                .where("__part > 0").withColumn("__n", F.col("__part")).drop("__part"))
        if level > COPIES:
            left = left.repartition(dups.sparkSession.sparkContext.defaultParallelism)
    return (left.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n")))).select(*rest))


def repeated_value_count(df: DataFrame, col: str) -> DataFrame:
    """How many values of ``col`` repeat an earlier one (``Series.duplicated().sum()``).

    = rows - distinct values, where null counts as one value.
    """
    c = F.col(col)
    return df.agg(
        (F.count(F.lit(1)) - F.count_distinct(c)
         - F.when(F.count_if(c.isNull()) > 0, 1).otherwise(0)).alias("repeated_values"))
