"""Purchase cohorts (M6, W3) kept up to date as orders and items arrive, in any order.

``CohortStore`` holds, by customer, what merges: the first purchase (a minimum), the number of orders and the GMV (sums). A
late order that is earlier than all before moves its customer, with all orders, to an earlier cohort: the batch takes the
customer's former part out of the old month and puts the new one into the other. Items and their order may come in different
batches; the GMV that a batch adds is that of its new orders with all items held, and that of orders held with its items.

A batch reads its own rows and the stored partials in the folders of the orders and customers it touches. Partials have one row a key
in each batch, so a customer or order that holds a third of all rows is summed map-side.

Defined cases: rows without a customer take no part; rows without an order id give their time only; an order that comes again for
the same customer (in a batch or later) is one order, its time counts; a batch id that was applied is not applied again;
customers without any time make the cohort null; a cohort without items has null GMV. Rows are added, never removed: a minimum can't be taken back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import temporal as TM
from ..session import join_location
from ..sources.snapshots import new_run
from .incremental import MONEY, PartialStore
from .measures import order_totals

TIME = "timestamp_ntz"
STATE = {"first_purchase": TIME, "orders": "bigint", "gmv": MONEY, "paid": "bigint"}
SUMS = {"customers": "bigint", "orders": "bigint", "gmv": MONEY, "paid": "bigint"}


def _added(sums: dict[str, str]) -> list[Column]:
    return [F.sum(c).cast(t).alias(c) for c, t in sums.items()]


def merged(states: DataFrame) -> DataFrame:
    """States of customers as one, one row a customer."""
    return states.groupBy("customer_id").agg(
        F.min("first_purchase").alias("first_purchase"), *_added({c: t for c, t in STATE.items() if c != "first_purchase"}))


def cohort_sums(customers: DataFrame) -> DataFrame:
    return (customers.groupBy(TM.month_start("first_purchase").cast(TIME).alias("cohort_month"))
            .agg(F.count(F.lit(1)).alias("customers"), *_added({c: t for c, t in SUMS.items() if c != "customers"})))


def _some() -> Column:
    return reduce(lambda a, b: a | b, [F.col(c) != 0 for c in SUMS])


class CohortStore(PartialStore):
    """The stored cohorts."""

    tables = {"orders": (["order_id", "customer_id"], {}), "items": (["order_id"], {"gmv": MONEY}),
              "customers": (["customer_id"], STATE)}

    def _orders(self, parts: set[int] | None = None) -> DataFrame:
        return self._read("orders", parts).distinct()

    def _items(self, parts: set[int] | None = None) -> DataFrame:
        return self._read("items", parts).groupBy("order_id").agg(F.sum("gmv").cast(MONEY).alias("gmv"))

    def apply(self, orders: DataFrame | None = None, fact: DataFrame | None = None, batch_id: str | None = None) -> bool:
        """Add rows of the orders and of the fact. False if the batch was applied before."""
        if batch_id is not None and batch_id in self.state["applied"]:
            return False
        run = new_run()
        parts: dict[str, list[int]] = {t: [] for t in self.tables}
        if orders is not None:
            orders = orders.where("customer_id IS NOT NULL").select("order_id", "customer_id", "order_purchase_timestamp")
            keys = orders.where("order_id IS NOT NULL").select("order_id", "customer_id").distinct()
            parts["orders"] = self._write(keys, run, "orders", "order_id")
        if fact is not None:
            totals = order_totals(fact).where("order_id IS NOT NULL").select("order_id", F.col("gmv").cast(MONEY).alias("gmv"))
            parts["items"] = self._write(totals, run, "items", "order_id")
        came, items = (self._written(run, t, parts[t]) for t in ("orders", "items"))
        held_orders = self._orders({*parts["orders"], *parts["items"]})
        new = came.join(held_orders, ["order_id", "customer_id"], "left_anti")
        paid = (new.join(self._items(set(parts["orders"])).unionByName(items), "order_id")
                .unionByName(held_orders.join(items, "order_id")))
        none, zero = F.lit(None).cast(TIME), F.lit(0).cast("bigint")

        def state(df: DataFrame, first: Column = none, n: Column = zero, gmv: Column | None = None) -> DataFrame:
            return df.select("customer_id", first.cast(TIME).alias("first_purchase"), n.cast("bigint").alias("orders"),
                             (F.lit(0) if gmv is None else F.coalesce(gmv, F.lit(0))).cast(MONEY).alias("gmv"),
                             (zero if gmv is None else gmv.isNotNull().cast("bigint")).alias("paid"))

        made = state(new, n=F.lit(1)).unionByName(state(paid, gmv=F.col("gmv")))
        if orders is not None:
            made = made.unionByName(state(orders, first=F.col("order_purchase_timestamp")))
        parts["customers"] = self._write(merged(made), run, "customers", "customer_id")
        delta = self._written(run, "customers", parts["customers"])
        before = merged(self._read("customers", set(parts["customers"])).join(delta, "customer_id", "left_semi"))
        after = merged(before.unionByName(delta))
        change = (cohort_sums(after).unionByName(cohort_sums(before).withColumns({c: -F.col(c) for c in SUMS}))
                  .groupBy("cohort_month").agg(*_added(SUMS)))
        change.where(_some()).write.parquet(join_location(self.path, run, "view"))
        self._commit(run, [*self.state["runs"], {"run": run, "parts": parts}],
                     self.state["applied"] + ([batch_id] if batch_id is not None else []))
        return True

    def sums(self) -> DataFrame:
        schema = f"cohort_month {TIME}, " + ", ".join(f"{c} {t}" for c, t in SUMS.items())
        paths = [join_location(self.path, r["run"], "view") for r in self.state["runs"]]
        frame = self.spark.read.schema(schema)
        rows = frame.parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return rows.groupBy("cohort_month").agg(*_added(SUMS))

    def view(self) -> DataFrame:
        """``cohort_month, customers, orders, gmv``: the rows of ``measures.first_purchase_cohort``."""
        return self.sums().where("customers > 0").select(
            "cohort_month", "customers", "orders", F.when(F.col("paid") > 0, F.col("gmv")).alias("gmv"))

    def customers(self) -> DataFrame:
        """``customer_id, first_purchase, orders, gmv``: the state of every customer."""
        return merged(self._read("customers")).select(
            "customer_id", "first_purchase", "orders", F.when(F.col("paid") > 0, F.col("gmv")).alias("gmv"))

    def compact(self) -> None:
        """Sum all batches up to one and remove the files that this replaces."""
        run, former = new_run(), {r["run"] for r in self.state["runs"]}
        parts = {"orders": self._write(self._orders(), run, "orders", "order_id"),
                 "items": self._write(self._items(), run, "items", "order_id"),
                 "customers": self._write(merged(self._read("customers")), run, "customers", "customer_id")}
        self.sums().where(_some()).write.parquet(join_location(self.path, run, "view"))
        self._commit(run, [{"run": run, "parts": parts}], self.state["applied"])
        self._forget(run, former)
