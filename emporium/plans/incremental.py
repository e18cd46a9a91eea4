"""The seller-month view kept up to date from added and removed rows.

What the view needs of a table is additive: items and sums by (order, seller), rows and on-time rows by
(order, month), review sums by order. ``SellerMonthlyStore`` keeps these partials and the view's own sums by
(month, seller). A batch of changes touches some orders; the part of the view that an order makes depends on that
order alone, so the difference between its part after and before is all that is added to the sums. A batch therefore reads
its own rows and the partials of the orders it touches, never the fact; removed rows count with a minus.

Partials lie in folders by hash of the order id. A batch adds files for the hashes it touches and reads earlier files
of those hashes only; ``compact`` sums the files up. One small file names the batches that are part of the store and is written
last, so a batch that fails leaves no trace, and a batch id that was applied is not applied twice.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..session import delete_path, join_location, list_names, read_text, write_text
from ..sources.snapshots import new_run
from .views import items_per_order_seller, order_months, review_sums_per_order

MONEY = "decimal(38,2)"
# Partials: table -> (keys, summed columns with their types).
PARTIALS = {
    "items": (["order_id", "seller_id"], {"n_items": "bigint", "gmv": MONEY}),
    "orders": (["order_id", "month"], {"k": "bigint", "t": "bigint"}),
    "reviews": (["order_id"], {"s": "bigint", "c": "bigint"}),
}
SUMS = {"orders": "bigint", "items": "bigint", "gmv": MONEY, "on_time_items": "bigint", "rs": "bigint", "rc": "bigint"}


@dataclass
class Changes:
    """Rows of the fact, orders and reviews that came or went; a table that did not change may be None."""

    fact: DataFrame | None = None
    orders: DataFrame | None = None
    reviews: DataFrame | None = None

    def partials(self) -> dict[str, DataFrame]:
        made = {"items": self.fact and items_per_order_seller(self.fact),
                "orders": self.orders and order_months(self.orders),
                "reviews": self.reviews and review_sums_per_order(self.reviews)}
        return {t: df for t, df in made.items() if df is not None}


def _summed(frames: Sequence[DataFrame], table: str, unique: bool = False) -> DataFrame:
    """The partials of several frames as one, one row a key. ``unique``: there is one frame, and it is so already."""
    keys, sums = PARTIALS[table]
    if unique:
        return frames[0].select(*keys, *[F.col(c).cast(t).alias(c) for c, t in sums.items()])
    return (reduce(lambda a, b: a.unionByName(b), frames).groupBy(*keys)
            .agg(*[F.sum(c).cast(t).alias(c) for c, t in sums.items()]))


def contributions(items: DataFrame, orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """What each (order, seller, month) adds to the sums of the view; as in ``views.seller_monthly``."""
    om = orders.where("k > 0")
    om = om.withColumn("first", F.col("month").eqNullSafe(F.min("month").over(Window.partitionBy("order_id"))))
    j = items.where("n_items > 0").join(om, "order_id", "left").join(reviews, "order_id", "left")
    n, k = F.col("n_items"), F.col("k")
    once = F.col("k").isNull() | F.col("first")
    made = {"orders": F.when(k.isNotNull(), 1), "items": n * k, "gmv": F.col("gmv") * k, "on_time_items": n * F.col("t"),
            "rs": F.when(once, n * F.col("s")), "rc": F.when(once, n * F.col("c"))}
    return j.select("month", "seller_id", *[F.coalesce(c, F.lit(0)).cast(SUMS[x]).alias(x) for x, c in made.items()])


class PartialStore:
    """Partials by key, in folders by hash of the key, and the file that names the batches. ``parts`` (folders) is fixed
    when the store is made."""

    # table -> (keys, other columns with their types); types of keys that are no text.
    tables: dict[str, tuple[list[str], dict[str, str]]] = {}
    kinds: dict[str, str] = {"month": "timestamp_ntz"}

    def __init__(self, spark: SparkSession, path: str, parts: int = 16):
        self.spark, self.path = spark, path
        states = [n for n in list_names(spark, path) if n.startswith("state-")]
        self.state = (json.loads(read_text(spark, join_location(path, states[-1]))) if states
                      else {"parts": parts, "runs": [], "applied": []})

    def _commit(self, run: str, runs: list[dict], applied: list[str]) -> None:
        self.state = {"parts": self.state["parts"], "runs": runs, "applied": applied}
        write_text(self.spark, join_location(self.path, f"state-{run}.json"), json.dumps(self.state))

    def _schema(self, table: str) -> str:
        keys, sums = self.tables[table]
        return ", ".join(f"{c} {t}" for c, t in {**{k: self.kinds.get(k, "string") for k in keys}, **sums}.items())

    def _part(self, key: str):
        return F.pmod(F.xxhash64(key), F.lit(self.state["parts"])).cast("int")

    def _read(self, table: str, parts: set[int] | None = None) -> DataFrame:
        """Stored partials of these parts (all, if None), from every batch that has some."""
        paths = [join_location(self.path, r["run"], table, f"part={p}") for r in self.state["runs"]
                 for p in r["parts"][table] if parts is None or p in parts]
        frame = self.spark.read.schema(self._schema(table))
        return frame.parquet(*paths) if paths else self.spark.createDataFrame([], self._schema(table))

    def _write(self, df: DataFrame, run: str, table: str, key: str) -> list[int]:
        """Write rows by part; the parts that there are."""
        path = join_location(self.path, run, table)
        # one task a part: a batch leaves one file for each; sums are small, one row a key
        (df.withColumn("part", self._part(key)).repartition(self.state["parts"], "part")
         .write.partitionBy("part").parquet(path))
        return sorted(int(n.removeprefix("part=")) for n in list_names(self.spark, path) if n.startswith("part="))

    def _written(self, run: str, table: str, parts: Sequence[int]) -> DataFrame:
        """What a batch wrote of a table."""
        paths = [join_location(self.path, run, table, f"part={p}") for p in parts]
        frame = self.spark.read.schema(self._schema(table))
        return frame.parquet(*paths) if paths else self.spark.createDataFrame([], self._schema(table))

    def _forget(self, run: str, former: set[str]) -> None:
        """Remove batches that ``run`` has summed up, and the states that name them."""
        for name in list_names(self.spark, self.path):
            if name in former or name.startswith("state-") and name != f"state-{run}.json":
                delete_path(self.spark, join_location(self.path, name))


class SellerMonthlyStore(PartialStore):
    """The stored view."""

    tables = PARTIALS

    def apply(self, added: Changes, removed: Changes = Changes(), batch_id: str | None = None) -> bool:
        """Add a batch of changes. False if its id was applied before. Rows without an order id make no part of the view."""
        if batch_id is not None and batch_id in self.state["applied"]:
            return False
        run = new_run()
        plus, minus = added.partials(), removed.partials()
        parts: dict[str, list[int]] = {t: [] for t in PARTIALS}
        for t, (_, sums) in PARTIALS.items():
            frames = [plus[t]] if t in plus else []
            if t in minus:
                frames.append(minus[t].withColumns({c: -F.col(c) for c in sums}))
            if frames:
                parts[t] = self._write(_summed(frames, t, len(frames) == 1).where("order_id IS NOT NULL"), run, t, "order_id")
        delta = {t: self._written(run, t, parts[t]) for t in PARTIALS}
        held = {p for ps in parts.values() for p in ps}
        batches = {t: sum(not held.isdisjoint(r["parts"][t]) for r in self.state["runs"]) for t in PARTIALS}
        if any(batches.values()):
            touched = reduce(lambda a, b: a.union(b), [delta[t].select("order_id") for t in PARTIALS if parts[t]]).distinct()
            before = {t: _summed([self._read(t, held).join(touched, "order_id", "left_semi")], t, n < 2)
                      for t, n in batches.items()}
            # what a table lacks on one side needs no sum
            after = {t: delta[t] if not batches[t] else _summed([before[t], delta[t]], t) if parts[t] else before[t] for t in PARTIALS}
            old = contributions(**before)
            change = contributions(**after).unionByName(old.withColumns({c: -F.col(c) for c in SUMS}))
        else:  # nothing is held of these orders
            change = contributions(**delta)
        change = change.groupBy("month", "seller_id").agg(*[F.sum(c).cast(t).alias(c) for c, t in SUMS.items()])
        some = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in SUMS])
        change.where(some).write.parquet(join_location(self.path, run, "view"))
        runs = [*self.state["runs"], {"run": run, "parts": parts}]
        self._commit(run, runs, self.state["applied"] + ([batch_id] if batch_id is not None else []))
        return True

    def sums(self) -> DataFrame:
        """The view's sums by (month, seller), from the differences of all batches."""
        paths = [join_location(self.path, r["run"], "view") for r in self.state["runs"]]
        schema = "month timestamp_ntz, seller_id string, " + ", ".join(f"{c} {t}" for c, t in SUMS.items())
        frame = self.spark.read.schema(schema)
        rows = frame.parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return rows.groupBy("month", "seller_id").agg(*[F.sum(c).cast(t).alias(c) for c, t in SUMS.items()])

    def view(self, ordered: bool = True) -> DataFrame:
        """``month, seller_id, orders, items, gmv, on_time_rate, avg_review``: the rows of ``views.seller_monthly``."""
        by_seller = Window.partitionBy("seller_id")
        out = (self.sums()
               .withColumn("avg_review", N.safe_divide(F.sum("rs").over(by_seller), F.sum("rc").over(by_seller)))
               .where("orders > 0")
               .select("month", "seller_id", "orders", "items", "gmv",
                       N.safe_divide("on_time_items", "items").alias("on_time_rate"), "avg_review"))
        return out.orderBy("month", "seller_id") if ordered else out

    def compact(self) -> None:
        """Sum all batches up to one and remove the files that this replaces."""
        run, former = new_run(), {r["run"] for r in self.state["runs"]}
        parts = {}
        for t, (_, sums) in PARTIALS.items():
            rows = _summed([self._read(t)], t).where(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in sums]))
            parts[t] = self._write(rows, run, t, "order_id")
        self.sums().where(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in SUMS])).write.parquet(
            join_location(self.path, run, "view"))
        self._commit(run, [{"run": run, "parts": parts}], self.state["applied"])
        self._forget(run, former)
