"""Exact quantiles by narrowing histograms of values: no sort, no shuffle that grows with the distinct values.

A wanted rank is found as a bisection would find it, by many cells at a time:

1. one pass counts the values of each column by sign and eighth of a binary order of magnitude, with the smallest and the
   largest value of each cell. There are at most 34,000 such cells a column whatever the data are, and they are
   summed map-side;
2. a rank in a cell whose smallest and largest value are equal is known, and so are the first and the last rank of any cell.
   The rows of the cells that hold other wanted ranks are written once, as they are dealt, in Parquet (a value that a third
   of all rows share takes next to no room there);
3. those cells are cut into ``BINS`` equal widths and counted again, until every rank is known. The smallest and the largest
   value of a cell fall into different bins, so each pass narrows it; doubles in one cell are told apart in at most five.

The driver sees the cells that hold wanted ranks and their neighbours: a number that depends on columns and probabilities alone. A hot
value is one count in its cell. ``quantiles.exact_quantiles`` ranks all distinct values instead, which pays
when hundreds of probabilities are asked for.

Defined cases: nulls and NaN are no values; ``-0.0`` counts as ``0.0``; infinities are values; a column without values (or an
empty table) has null quantiles; integers and decimals are taken as doubles.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import delete_path, ensure_checkpoint_dir, join_location
from ..sources.snapshots import new_run

# Widths that an open cell is cut into by one pass.
BINS = 4096
# Cells of the first pass for each doubling of the value; its exponents end before this one.
FINE, LAST_EXPONENT = 8, 1100.0


@dataclass(frozen=True)
class Cell:
    """``rows`` values of a column from ``low`` to ``high`` (both occur), after ``before`` smaller ones."""

    column: int
    low: float
    high: float
    before: int
    rows: int

    def holds(self) -> Column:
        return (F.col("column") == self.column) & (F.col("v") >= self.low) & (F.col("v") <= self.high)


def stacked_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, v)``: the values of all columns, by the column's place in ``cols``."""
    def value(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.when(v == 0, 0.0).when(~F.isnan(v), v)

    structs = [F.struct(F.lit(i).alias("column"), value(c).alias("v")) for i, c in enumerate(cols)]
    return df.select(F.explode(F.array(*structs)).alias("s")).select("s.column", "s.v").where("v IS NOT NULL")


def _counted(cells: DataFrame, *keys: str) -> DataFrame:
    return cells.groupBy(*keys).agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("rows"))


def _magnitudes(values: DataFrame) -> DataFrame:
    """The first cells: by sign and eighth of a power of two; zero and infinity have cells of their own."""
    exponent = F.least(F.log2(F.abs("v")), F.lit(LAST_EXPONENT))
    size = F.coalesce(F.floor(exponent * FINE), F.lit(-(2**31)))
    return _counted(values.withColumns({"sign": F.signum("v"), "size": size}), "column", "sign", "size")


def _bins(values: DataFrame, cells: Sequence[Cell]) -> DataFrame:
    """The open cells cut into equal widths; ``cell`` is the place in ``cells``."""
    def part(i: int, c: Cell) -> Column:
        place = F.floor((F.col("v") - c.low) / (c.high - c.low) * BINS)
        return F.when(c.holds(), F.struct(F.lit(i).alias("cell"), F.least(place, F.lit(BINS - 1)).alias("bin")))

    dealt = values.withColumn("to", F.coalesce(*[part(i, c) for i, c in enumerate(cells)]))
    return _counted(dealt.where("to IS NOT NULL").select("v", "to.cell", "to.bin"), "cell", "bin")


def _in_order(column: int, before: int, counted: Iterable) -> list[Cell]:
    """Cells in order of their values; cells that overlap (rounding at an edge) become one."""
    cells: list[Cell] = []
    for r in sorted(counted, key=lambda r: (r["low"], r["high"])):
        if cells and r["low"] <= cells[-1].high:
            last = cells.pop()
            cells.append(Cell(column, last.low, max(last.high, r["high"]), last.before, last.rows + r["rows"]))
        else:
            at = cells[-1].before + cells[-1].rows if cells else before
            cells.append(Cell(column, r["low"], r["high"], at, r["rows"]))
    return cells


def _settle(cells: Iterable[Cell], wanted: set[int], found: dict[int, float]) -> list[Cell]:
    """Note the ranks that the cells tell; the cells that hold others."""
    still = []
    for c in cells:
        first, last = c.before, c.before + c.rows - 1
        inside = {k for k in wanted if first <= k <= last}
        found |= {k: c.low if k == first or c.low == c.high else c.high
                  for k in inside if k in (first, last) or c.low == c.high}
        if inside - found.keys():
            still.append(c)
    return still


def _around(n: int, prob: float) -> tuple[int, int, float]:
    """The neighbouring ranks of a probability, and how far it lies between them."""
    at = (n - 1) * prob
    return math.floor(at), math.ceil(at), at - math.floor(at)


def narrowed_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Rows ``(column_name, prob, value)`` with linear interpolation, as ``quantiles.exact_quantiles`` gives them.

    ``df`` is read once or twice, by its columns ``cols`` alone."""
    spark, probs = df.sparkSession, [float(p) for p in probs]
    if not all(0 <= p <= 1 for p in probs):
        raise ValueError("probabilities lie between 0 and 1")
    if not cols or not probs:
        return spark.createDataFrame([], "column_name string, prob double, value double")
    values = stacked_values(df, cols)
    by_column: dict[int, list] = defaultdict(list)
    for r in _magnitudes(values).collect():  # at most 34,000 cells a column
        by_column[r["column"]].append(r)
    n = {c: sum(r["rows"] for r in rows) for c, rows in by_column.items()}
    wanted = {c: {k for p in probs for k in _around(n[c], p)[:2]} for c in n}
    found: dict[int, dict[int, float]] = {c: {} for c in n}
    still = [x for c, rows in by_column.items() for x in _settle(_in_order(c, 0, rows), wanted[c], found[c])]
    if still:
        kept = join_location(ensure_checkpoint_dir(spark), f"selection-{new_run()}")
        try:
            values.where(reduce(lambda a, b: a | b, [c.holds() for c in still])).write.parquet(kept)
            values = spark.read.schema("column int, v double").parquet(kept)
            while still:
                by_cell: dict[int, list] = defaultdict(list)
                for r in _bins(values, still).collect():  # at most BINS for each open cell
                    by_cell[r["cell"]].append(r)
                still = [x for i, rows in by_cell.items()
                         for x in _settle(_in_order(still[i].column, still[i].before, rows),
                                          wanted[still[i].column], found[still[i].column])]
        finally:
            delete_path(spark, kept)
    out = []
    for i, name in enumerate(cols):
        for p in probs:
            value = None
            if i in n:
                low, high, part = _around(n[i], p)
                a, b = found[i][low], found[i][high]
                value = a if a == b else a + part * (b - a)
            out.append((name, p, value))
    return spark.createDataFrame(out, "column_name string, prob double, value double")
