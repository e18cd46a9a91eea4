"""End-to-end ELT job: extract -> land -> clean and stage -> pre-load checks -> load -> post-load checks.

Only the table writes and the (small) gate reports are actions; everything
else is one lazy plan per table. The pre-load checks are counted by the pass that stages a table. Post-load checks read the loaded tables back
from the catalog, so they check what was stored, not the in-memory plan.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from ..operators import quality as Q
from ..session import delete_path, ensure_checkpoint_dir, join_location
from ..sources import csv_source as CS
from ..sources import warehouse as WH
from ..sources.snapshots import Snapshot, TableVersion, current_snapshot, db_location, discard, new_run
from .clean import CleanOptions, clean_all, clean_order_items

log = logging.getLogger(__name__)


@dataclass
class EltResult:
    tables: dict[str, DataFrame]
    pre_load: DataFrame | None
    post_load: DataFrame
    rejects: DataFrame | None
    export: DataFrame | None
    counts: DataFrame | None = None


FACT = "fact_order_items"
FACT_DIMS = ("dim_orders", "dim_products", "dim_sellers")
# Dimensions that reference orders but are not needed to build the fact.
DEPENDENT_DIMS = ("dim_payments", "dim_reviews")


# The sources that each table is made of.
INPUTS = {"dim_customers": ("customers",), "dim_products": ("products", "product_category_translation"),
          "dim_sellers": ("sellers",), "dim_orders": ("orders", "order_payments"), "dim_payments": ("order_payments",),
          "dim_reviews": ("order_reviews",), "dim_geolocation": ("geolocation",),
          "fact_order_items": ("order_items", "orders", "order_payments", "products", "product_category_translation",
                               "sellers")}


def input_marks(table: str, marks: dict[str, str], opts: CleanOptions) -> dict[str, str]:
    """What a table's rows depend on: the fingerprints of its sources and the cleaning options."""
    return {**{s: marks[s] for s in INPUTS[table] if s in marks}, "options": repr(opts)}


def stage_warehouse(spark: SparkSession, sources, db: str, run: str, opts: CleanOptions = CleanOptions(),
                    marks: dict[str, str] | None = None, former: Snapshot | None = None) -> dict[str, TableVersion]:
    """Clean every table and stage it as a version of ``run``; nothing that readers see changes.

    The dimensions the fact depends on are staged first. The fact's key filters then read those
    staged rows instead of re-running their cleaning plans -- less work, and the fact's lineage starts at
    stored files, so a lost executor re-runs only fact tasks. With the fingerprints of the sources (``marks``), a table
    whose inputs are those of its ``former`` version is not made again.
    """
    opts = replace(opts, keep_rejects=True)
    tables = clean_all(sources, opts)
    inputs = {t: input_marks(t, marks, opts) for t in tables} if marks is not None else {}
    staged = {t: former.tables[t] for t in tables
              if former and t in inputs and t in former.tables and former.tables[t].inputs == inputs[t]}
    # the staged dimensions must be there before the fact; payments and reviews go with the fact
    first = [t for t in tables if t not in (FACT, *DEPENDENT_DIMS) and t not in staged]
    staged |= WH.stage_tables(spark, {t: tables[t] for t in first}, db, run, inputs=inputs)
    rest = {t: tables[t] for t in DEPENDENT_DIMS if t in tables and t not in staged}
    if FACT in tables and FACT not in staged:
        dims = [WH.staged_rows(spark, db, staged[d]) for d in FACT_DIMS]
        rest[FACT] = clean_order_items(sources["order_items"], *dims, opts)
    return staged | WH.stage_tables(spark, rest, db, run, inputs=inputs)


def load_warehouse(spark: SparkSession, sources, db: str, opts: CleanOptions = CleanOptions(),
                   buckets: int | None = None) -> WH.LoadResult:
    """Clean and load every table (``stage_warehouse``, then all versions become current)."""
    run = new_run()
    return WH.load_tables(spark, stage_warehouse(spark, sources, db, run, opts), db, buckets, run=run)


def staged_report(spark: SparkSession, staged: dict[str, TableVersion], phase: str = "pre_load") -> DataFrame:
    """The gates before the load, from what the staging pass counted (the report of ``quality.gate_report``)."""
    rows = [(phase, check, t, column, bad, "fail" if bad else "ok") for t, v in staged.items()
            for check, column, bad in v.gates]
    return spark.createDataFrame(rows, "phase string, check_name string, table_name string, column_name string, "
                                       "bad_count long, status string")


def evaluate(report: DataFrame, phase: str) -> DataFrame:
    """Run a gate report (one row per check), log every check, and keep its rows."""
    rows = report.collect()
    for r in rows:
        (log.warning if r["status"] == "fail" else log.info)(
            "%s gate %s %s.%s: %s bad, %s", phase, r["check_name"], r["table_name"], r["column_name"], r["bad_count"],
            r["status"])
    return report.sparkSession.createDataFrame(rows, report.schema)


# The source of each table, for the row counts side by side.
SOURCE_OF = {"dim_customers": "customers", "dim_products": "products", "dim_sellers": "sellers", "dim_orders": "orders",
             "dim_payments": "order_payments", "dim_reviews": "order_reviews", "dim_geolocation": "geolocation",
             "fact_order_items": "order_items"}


def loaded_counts(spark: SparkSession, source_rows: dict[str, int], stored: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, source_rows, loaded_rows)``, logged."""
    loaded = {r["table_name"]: r["row_count"] for r in Q.row_counts(stored).collect()}
    rows = [(t, source_rows[SOURCE_OF[t]], n) for t, n in sorted(loaded.items())]
    for r in rows:
        log.info("%s: %d source rows, %d loaded", *r)
    return spark.createDataFrame(rows, "table_name string, source_rows long, loaded_rows long")


def run_elt(spark: SparkSession, source_dir: str | None = None, db: str = "marketplace",
                 sources: dict[str, DataFrame] | None = None, export_dir: str | None = None,
                 opts: CleanOptions = CleanOptions(), strict: bool = False,
                 buckets: int | None = None, pre_checks: bool = True,
                 landing_dir: str | None = None, multiline: bool | str = True, force: bool = False) -> EltResult:
    """Run the whole load. Give either ``source_dir`` (CSV files) or ready ``sources`` frames.

    Any source that fails to read halts the run before transforming (as the source pipeline does). Each
    source is scanned once: that pass lands it as Parquet (in ``landing_dir``, else in a scratch folder that is removed at the
    end) and takes its row count and fingerprint. ``multiline=False`` reads CSV files without quoted newlines by many tasks,
    ``"blocks"`` those with quoted newlines too. Each
    table is cleaned and staged in one pass, which also counts what the pre-load gates ask for; they
    are evaluated and logged before any table changes, the post-load gates and the row counts after. ``strict`` makes
    a failed gate raise, before the load with the old tables in place; by default failures are reported and the load continues. A
    table whose sources and options are those of its current version is left as it is (``force`` loads it anew).
    """
    if sources is None:
        if source_dir is None:
            raise ValueError("give source_dir or sources")
        sources, _ = CS.extract(spark, CS.source_paths(source_dir), multiline, require_all=True)
    landing = landing_dir or join_location(ensure_checkpoint_dir(spark), f"landing-{new_run()}")
    run, location = new_run(), db_location(spark, db)
    former = None if force or buckets else current_snapshot(spark, location)
    try:
        landed = CS.land_frames(spark, {n: sources[n] for n in sources if sources[n] is not None}, landing)
        staged = stage_warehouse(spark, CS.read_landed(spark, {n: x.path for n, x in landed.items()}), db, run, opts,
                                 {n: x.fingerprint for n, x in landed.items()}, former)
        pre = None
        if pre_checks:
            pre = evaluate(staged_report(spark, staged), "pre-load")
            if strict:
                Q.enforce(pre)
    except Exception:
        discard(spark, location, run)
        raise
    finally:
        if landing_dir is None:
            delete_path(spark, landing)
    changed = {t: v for t, v in staged.items() if f"/{run}/" in v.folder}
    facts = {n: {"rows": x.rows, "fingerprint": x.fingerprint} for n, x in landed.items()}
    if changed or former is None:
        rejects = WH.load_tables(spark, changed, db, buckets, run=run, sources=facts).rejects
    else:
        log.info("%s: sources and options as in the last load; nothing to write", db)
        rejects = spark.table(f"{WH.rejects_db(db)}.rejected_rows")
    WH.create_views(spark, db)
    stored = WH.warehouse_tables(spark, db)
    counts = loaded_counts(spark, {n: x.rows for n, x in landed.items()}, stored)
    post = evaluate(Q.gate_report(stored, phase="post_load"), "post-load")
    if strict:
        Q.enforce(post)
    export = WH.export_csv(spark, db, export_dir) if export_dir else None
    return EltResult(stored, pre, post, rejects, export, counts)
