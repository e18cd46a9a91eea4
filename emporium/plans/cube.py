"""A stored cube that answers slices without reading the tables again, distinct counts included.

Sums and counts add up over any grouping; distinct customers and sellers do not. They are stored as bitmaps: every
key gets a dense number, a cell holds for each 32,768 numbers (a bucket) one bitmap of those it has seen, and a coarser
slice is the union of its cells' bitmaps. So one build answers every slice and filter over its fields, exactly
as ``measures.measure_frame`` does from the tables. Order fields (``by``) slice all measures; the fields of
items, payments and reviews (``item_by``, ``payment_by``, ``review_by``) slice their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import delete_path, ensure_checkpoint_dir, join_location
from . import measures as M

CELL, ONES = "__bucket", "__ones"


def dense_numbers(df: DataFrame, key: str, name: str) -> DataFrame:
    """``(key, name)``: a number from 0 without gaps for each distinct non-null key.

    Keys are numbered where they lie: their place in their partition, behind the sizes of the partitions before."""
    ensure_checkpoint_dir(df.sparkSession)
    place = F.monotonically_increasing_id()
    keys = df.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__place", place).checkpoint()
    part, index = F.shiftright("__place", 33), F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = keys.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select(  # one row per partition: a bounded, single-partition window
        "__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    return (keys.withColumn("__part", part).join(F.broadcast(before), "__part")
            .select(key, (F.col("__before") + index).alias(name)))


def bitmaps(df: DataFrame, by: Sequence[str], number: str) -> DataFrame:
    """Per cell and bucket the bitmap of the numbers seen; each task combines its own first."""
    # numbers count from 0, bitmap positions from 1
    n = F.col(number) + 1
    return (df.where(F.col(number).isNotNull()).groupBy(*by, F.bitmap_bucket_number(n).alias(CELL))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias(ONES)))


def united_counts(cells: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Distinct numbers of coarser cells: unions of bitmaps, then their ones."""
    united = cells.groupBy(*by, CELL).agg(F.bitmap_or_agg(ONES).alias(ONES))
    return united.groupBy(*by).agg(F.sum(F.bitmap_count(ONES)).alias(name))


class MeasureCube:
    """Cells by order fields (and those of one table that hangs on orders) in ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(join_location(self.path, table))

    @classmethod
    def build(cls, t: M.Tables, path: str, by: Sequence[str], item_by: Sequence[str] = (),
              payment_by: Sequence[str] = (), review_by: Sequence[str] = ()) -> MeasureCube:
        """Read the tables once and write the cells; the number of cells is what the fields' values make of it."""
        spark = t["dim_orders"].sparkSession
        by = list(by)

        def write(df: DataFrame, table: str) -> None:
            df.write.mode("overwrite").parquet(join_location(path, table))

        def write_cells(df: DataFrame, own: list[str], number: str, sums: dict[str, Column], table: str, distinct: str) -> None:
            """Sums and bitmaps of the cells from one pass over the rows: both are made per cell and bucket first."""
            n = F.col(number) + 1
            made = join_location(path, f"_{table}")
            (df.groupBy(*own, F.bitmap_bucket_number(n).alias(CELL))
             .agg(*[c.alias(v) for v, c in sums.items()], F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias(ONES))
             .write.mode("overwrite").parquet(made))
            cells = spark.read.parquet(made)
            kinds = dict(cells.dtypes)
            write(cells.groupBy(*own).agg(*[F.sum(v).cast(kinds[v]).alias(v) for v in sums]), table)
            write(cells.where(F.col(CELL).isNotNull()).select(*own, CELL, ONES), distinct)
            delete_path(spark, made)

        o = M.order_attributes(t)
        customers = dense_numbers(t["dim_orders"], "customer_id", "__customer")
        sellers = dense_numbers(t["fact_order_items"], "seller_id", "__seller")
        d, e = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
        write_cells(o.join(customers, "customer_id", "left"), by, "__customer",
                    {"total_orders": F.count("order_id"),
                     "_on_time": F.count_if(d.isNotNull() & e.isNotNull() & (d <= e)),
                     "_delivered": F.count_if(d.isNotNull())}, "orders", "customers")
        own = [*by, *item_by]
        items = M._item_attributes(t, item_by, None).join(o.select("order_id", *by), "order_id")
        write_cells(items.join(sellers, "seller_id", "left"), own, "__seller",
                    {"gmv": M._money(F.sum("gmv")), "items": F.sum("n_items")}, "items", "sellers")
        write(M._payments_branch(t, o, by, list(payment_by)), "payments")
        write(M._reviews_branch(t, o, by, list(review_by)), "reviews")
        return cls(spark, path)

    def frame(self, measures: Sequence[str] = M.MEASURES, by: Sequence[str] = (),
              where: str | Column | None = None, item_where: str | Column | None = None) -> DataFrame:
        """``measures.measure_frame`` from the cells; fields and filters are of those that the cube was built by."""
        by = list(by)
        unknown = set(measures) - set(M.ALL_MEASURES)
        if unknown:
            raise ValueError(f"unknown measures {sorted(unknown)}")
        own, sliced, by_o, needed = M._parts_of(measures, by)

        def cells(table: str, also: str | Column | None = None) -> DataFrame:
            df = self._read(table)
            missing = [b for b in by_o if b not in df.columns]
            if missing:
                raise ValueError(f"the cube was not built by {missing}")
            for condition in (where, also):
                df = df if condition is None else df.where(condition)
            return df

        def summed(df: DataFrame, keys: list[str], values: Sequence[str]) -> DataFrame:
            kinds = dict(df.dtypes)
            sums = {v: M._money(F.sum(v)) if kinds[v].startswith("decimal") else F.sum(v) for v in values}
            return df.groupBy(*keys).agg(*[c.alias(v) for v, c in sums.items()])

        def with_distinct(sums: DataFrame, distinct: DataFrame, keys: list[str], name: str) -> DataFrame:
            counts = united_counts(distinct, keys, name)
            if not keys:
                return sums.join(F.broadcast(counts))  # two single rows
            other = counts.select(*[F.col(k).alias(f"__{k}") for k in keys], name)
            same = None
            for k in keys:
                eq = F.col(k).eqNullSafe(F.col(f"__{k}"))
                same = eq if same is None else same & eq
            # a cell whose keys are all null has no bitmap: none distinct
            return (sums.join(other, same, "left").drop(*[f"__{k}" for k in keys])
                    .withColumn(name, F.coalesce(name, F.lit(0)).cast("long")))

        frames = [with_distinct(summed(cells("orders"), by_o, ["total_orders", "_on_time", "_delivered"]),
                                cells("customers"), by_o, "active_customers")]
        split = None
        for k in needed:
            keys = [*by_o, *own[k]]
            if k == "items":
                frame = with_distinct(summed(cells("items", item_where), keys, ["gmv", "items"]),
                                      cells("sellers", item_where), keys, "active_sellers")
            else:
                frame = summed(cells(k), keys, M.PART_VALUES[k])
            if k in sliced:
                split = frame
            else:
                frames.append(frame)
        return M._answer(frames, split, measures, by, by_o, needed, sliced)
