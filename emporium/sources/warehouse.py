"""The warehouse catalog: create, conform, load, list and export tables.

* tables are Parquet catalog tables written by balanced tasks with size-capped
  files. Bucketing on the co-location keys of ``TableSpec.bucket_by`` (the fact
  and the order-keyed dimensions on ``order_id``) is opt-in via ``buckets=N``: it
  removes the join shuffles of the views, but a bucket holds *all* rows of its
  keys, so one hot order would make one bucket -- one writer task and one
  reader task per scan, which AQE cannot split. Without buckets the views rely on
  map-side partial aggregation before each shuffle and AQE skew splitting, which
  survive a key that holds a third of all rows;
* a load stages every table as a new version (``snapshots``), in one pass over its cleaning plan: good rows, rejected
  rows and the counts of the gates come from that pass. ``load_tables`` then points all tables to their new version, so a load
  that fails changes nothing;
* a value that does not convert to its column type is rejected with a reason
  (``ON_ERROR = continue``), the rest of the row set loads;
* export writes each object as a folder of CSV parts from the executors -- no
  table passes through the driver.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.temporal import format_timestamp
from ..operators import quality as Q
from ..plans import clean as C
from ..plans import views as V
from ..schema import TABLES, TableSpec, load_levels, load_order
from ..session import join_location, location_exists, make_folder
from .snapshots import (
    GOOD,
    REJECTED_PART,
    Snapshot,
    TableVersion,
    current_snapshot,
    db_location,
    discard,
    new_run,
    publish,
)

log = logging.getLogger(__name__)

# Tokens loaded as NULL.
NULL_TOKENS = ("", "NULL")


def create_database(spark: SparkSession, db: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")


def _ddl_type(dt) -> str:
    return dt.simpleString()


def create_table_sql(spec: TableSpec, db: str, buckets: int | None) -> str:
    cols = ", ".join(f"{f.name} {_ddl_type(f.dataType)}" for f in spec.schema.fields)
    props = {"primary_key": ",".join(spec.pk),
             "foreign_keys": ",".join(f"{c}->{t}" for c, t in spec.fks.items())}
    bucket = (f" CLUSTERED BY ({spec.bucket_by}) SORTED BY ({spec.bucket_by}) INTO {buckets} BUCKETS"
              if spec.bucket_by and buckets else "")
    tbl = ", ".join(f"'{k}'='{v}'" for k, v in props.items())
    return f"CREATE TABLE IF NOT EXISTS {db}.{spec.name} ({cols}) USING parquet{bucket} TBLPROPERTIES ({tbl})"


def create_tables(spark: SparkSession, db: str, buckets: int | None = None) -> None:
    for name in load_order():
        spark.sql(create_table_sql(TABLES[name], db, buckets))


def _typed(df: DataFrame, spec: TableSpec) -> tuple[list, list]:
    """The target columns, and a flag (the column's name) for each that may not convert."""
    in_types = dict(df.dtypes)
    casted, flags = [], []
    for f in spec.schema.fields:
        raw = F.col(f.name)
        src_type = in_types.get(f.name)
        nulled = raw
        if src_type == "string":
            nulled = F.when(raw.isin(*NULL_TOKENS), F.lit(None)).otherwise(raw)
        if src_type == f.dataType.simpleString():
            casted.append(nulled.alias(f.name))   # same type: only the NULL tokens change
            continue
        typed = nulled.try_cast(f.dataType)
        casted.append(typed.alias(f.name))
        flags.append(F.when(nulled.isNotNull() & typed.isNull(), F.lit(f.name)))
    return casted, flags


def _raw_json(spec: TableSpec):
    return F.to_json(F.struct(*[F.col(c).cast("string") for c in spec.columns]))


def conform(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """Cast to the target schema. Returns (rows that convert, rejected rows with a reason).

    A text value ``''`` or ``'NULL'`` loads as null; a non-null value whose cast
    fails rejects the row. Columns that already have their target type pass
    through untouched, so conforming a cleaned frame costs nothing; the raw-row
    JSON is only built on the reject path.
    """
    casted, flags = _typed(df, spec)
    all_ok = reduce(lambda a, b: a & b, [f.isNull() for f in flags]) if flags else F.lit(True)
    good = df.where(all_ok).select(*casted)
    rejects = df.where(~all_ok).select(
        F.lit(spec.name).alias("table_name"),
        F.concat_ws(",", *flags).alias("columns") if flags else F.lit("").alias("columns"),
        _raw_json(spec).alias("_raw"))
    return good, rejects


def marked_rows(df: DataFrame, spec: TableSpec) -> DataFrame:
    """All rows in the target types; ``columns`` and ``_raw`` tell of those that are rejected, else they are null.

    Rows that cleaning marked keep their mark and raw row; the others are conformed."""
    casted, flags = _typed(df, spec)
    names = F.concat_ws(",", *flags) if flags else F.lit("")
    found, raw = F.when(names != "", names), F.when(names != "", _raw_json(spec))
    if C.REJECTED in df.columns:
        marked = F.col(C.REJECTED).isNotNull()
        found = F.when(marked, F.concat_ws(",", C.REJECTED)).otherwise(found)
        raw = F.when(marked, F.col(C.RAW_ROW)).otherwise(raw)
    return df.select(*casted, found.alias("columns"), raw.alias("_raw"))


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


@dataclass
class LoadResult:
    loaded: list[str]
    rejects: DataFrame | None


# Rows per output file: keeps files near a few hundred MB at scale, whatever a task holds.
MAX_RECORDS_PER_FILE = 5_000_000


def split_rejects(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(rows to load, rejected rows): rows that cleaning marked, and those that ``conform`` finds."""
    rows = marked_rows(df, spec)
    return rows.where(F.col("columns").isNull()).select(*spec.columns), rows.where(F.col("columns").isNotNull()).select(
        F.lit(spec.name).alias("table_name"), "columns", "_raw")


def rejects_db(db: str) -> str:
    """Rejected rows lie beside the warehouse, so its own listing and export stay as they are."""
    return f"{db}_rejects"


@contextmanager
def _unsorted_parts(spark: SparkSession):
    """A write into two folders keeps both open instead of sorting its rows by folder."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, "4")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _gate_metrics(name: str) -> dict[tuple[str, str], Column]:
    """Counts of bad rows that the gates before the load ask for: null keys and ranges of the good rows."""
    checks = {("null_key", c): F.col(c).isNull() for c in Q.PRE_LOAD_NULL_KEYS.get(name, [])}
    checks |= {(f"range {n}", c): F.expr(p) for t, c, n, p in Q.RANGE_RULES if t == name}
    return checks


def stage_table(spark: SparkSession, df: DataFrame, db: str, name: str, run: str,
                inputs: dict[str, str] | None = None) -> TableVersion:
    """Write one table into its folder of this load; the pass that writes also counts.

    The counts are taken at the top of the plan, in the stage that writes: Spark counts each of its tasks once,
    also when tasks or executors are lost and run again."""
    spec = TABLES[name]
    checks = _gate_metrics(name)
    good = F.col(C.REJECTED).isNull() if C.REJECTED in df.columns else F.lit(True)
    before, seen = Observation(), Observation()
    counted = df.observe(before, F.count(F.lit(1)).alias("rows"),
                         *[F.count_if(good & bad).alias(f"g{i}") for i, bad in enumerate(checks.values())])
    rows = marked_rows(counted, spec).observe(seen, F.count_if(F.col("columns").isNotNull()).alias("rejected"))
    version = TableVersion(name, f"versions/{run}/{name}", inputs=inputs)
    path = join_location(db_location(spark, db), version.folder)
    (rows.withColumn("part", F.when(F.col("columns").isNull(), GOOD).otherwise(REJECTED_PART))
     .write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy("part").parquet(path))
    read, found = before.get, seen.get  # no metrics: an empty plan
    version.rejected = found.get("rejected", 0)
    version.rows = read.get("rows", 0) - version.rejected
    version.gates = [(check, column, read.get(f"g{i}", 0)) for i, (check, column) in enumerate(checks)]
    make_folder(spark, join_location(path, f"part={GOOD}"))  # there even without rows
    if version.rejected:
        log.warning("%s.%s: %d rows rejected", db, name, version.rejected)
    return version


def stage_tables(spark: SparkSession, tables: dict[str, DataFrame], db: str, run: str, parallel: int = 4,
                 inputs: dict[str, dict[str, str]] | None = None) -> dict[str, TableVersion]:
    """Stage tables as concurrent jobs, so small dimensions do not serialise their fixed costs."""
    if not tables:
        return {}
    with _unsorted_parts(spark), ThreadPoolExecutor(max_workers=min(parallel, len(tables))) as pool:
        futures = {n: pool.submit(stage_table, spark, df, db, n, run, (inputs or {}).get(n)) for n, df in tables.items()}
        return {n: f.result() for n, f in futures.items()}


def staged_rows(spark: SparkSession, db: str, version: TableVersion) -> DataFrame:
    """The good rows of a staged table."""
    path = join_location(db_location(spark, db), version.folder, f"part={GOOD}")
    return spark.read.schema(TABLES[version.table].schema).parquet(path)


def _keep_rejects(spark: SparkSession, db: str, version: TableVersion) -> None:
    if version.rejected:
        rows = (spark.read.schema("columns string, _raw string")
                .parquet(join_location(db_location(spark, db), version.folder, f"part={REJECTED_PART}")))
        (rows.select("columns", "_raw", F.lit(version.table).alias("table_name"))
         .write.mode("append").insertInto(f"{rejects_db(db)}.rejected_rows"))


def load_tables(spark: SparkSession, tables: dict[str, DataFrame | TableVersion], db: str,
                buckets: int | None = None, parallel: int = 4, run: str | None = None,
                sources: dict[str, dict] | None = None) -> LoadResult:
    """Make new versions of the given tables current, all at once; the other tables stay as they are.

    Frames are staged first, level by level in foreign-key order; versions are staged already. ``buckets`` opts
    into bucketed (co-located) tables, which are written from the staged rows; see the module notes.
    Tables are created on first load; to change bucketing, drop them first.
    """
    run = run or new_run()
    frames = {n: t for n, t in tables.items() if isinstance(t, DataFrame)}
    staged = {n: t for n, t in tables.items() if not isinstance(t, DataFrame)}
    for level in load_levels():
        staged |= stage_tables(spark, {n: frames[n] for n in level if n in frames}, db, run, parallel)
    create_database(spark, db)
    create_tables(spark, db, buckets)
    start_rejects(spark, db, list(tables))
    location = db_location(spark, db)
    former = current_snapshot(spark, location)
    names = [n for n in load_order() if n in tables]
    if buckets:
        for n in names:
            rows, key = staged_rows(spark, db, staged[n]), TABLES[n].bucket_by
            if key:
                # one task per bucket: each bucket is written as one file, not one per task
                rows = rows.repartition(buckets, key)
            rows.write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).insertInto(f"{db}.{n}", overwrite=True)
            _keep_rejects(spark, db, staged[n])
        discard(spark, location, run)
    else:
        snapshot = Snapshot(run, {**(former.tables if former else {}), **staged}, sources or {})
        publish(spark, location, snapshot)
        for n in names:
            point_to(spark, db, staged[n])
            _keep_rejects(spark, db, staged[n])
    for n in names:
        log.info("loaded %s.%s", db, n)
    return LoadResult(names, spark.table(f"{rejects_db(db)}.rejected_rows"))


def point_to(spark: SparkSession, db: str, version: TableVersion) -> None:
    """Let a catalog table read the good rows of a version."""
    path = join_location(db_location(spark, db), version.folder, f"part={GOOD}")
    spark.sql(f"ALTER TABLE {db}.{version.table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(f"{db}.{version.table}")


def start_rejects(spark: SparkSession, db: str, names: list[str]) -> None:
    """An empty place for the rejected rows of these tables (a partition of each table)."""
    create_database(spark, rejects_db(db))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {rejects_db(db)}.rejected_rows (columns string, _raw string, "
              "table_name string) USING parquet PARTITIONED BY (table_name)")
    for n in names:
        spark.sql(f"ALTER TABLE {rejects_db(db)}.rejected_rows DROP IF EXISTS PARTITION (table_name = '{n}')")


def attach_warehouse(spark: SparkSession, db: str, location: str) -> list[str]:
    """Register the current versions (or plain table folders) under ``location`` as tables of ``db``.

    For sessions whose catalog does not outlive the process (the default
    in-memory catalog): a later run attaches what an earlier run wrote, then
    re-creates the views. Returns the attached table names.
    """
    create_database(spark, db)
    attached = []
    snapshot = current_snapshot(spark, location)
    for name in load_order():
        path = join_location(location, name)
        if snapshot and name in snapshot.tables:
            path = join_location(location, snapshot.tables[name].folder, f"part={GOOD}")
        if spark.catalog.tableExists(f"{db}.{name}"):
            if snapshot and name in snapshot.tables:  # a load may have ended between its commit and the catalog
                spark.sql(f"ALTER TABLE {db}.{name} SET LOCATION '{path}'")
        elif location_exists(spark, path):
            spark.catalog.createTable(f"{db}.{name}", path=path, source="parquet", schema=TABLES[name].schema)
            attached.append(name)
    if {"fact_order_items", "dim_orders", "dim_products", "dim_reviews"} <= set(
            t.name for t in spark.catalog.listTables(db)):
        create_views(spark, db)
    return attached


def warehouse_tables(spark: SparkSession, db: str) -> dict[str, DataFrame]:
    return {name: spark.table(f"{db}.{name}") for name in TABLES
            if spark.catalog.tableExists(f"{db}.{name}")}


def create_views(spark: SparkSession, db: str) -> None:
    """Persist both views in ``db`` over its tables (CREATE OR REPLACE VIEW)."""
    base = V.BASE_ORDER_ITEMS_SQL.replace("CREATE OR REPLACE TEMP VIEW base_order_items",
                                          f"CREATE OR REPLACE VIEW {db}.base_order_items")
    monthly = V.SELLER_MONTHLY_SQL.replace("CREATE OR REPLACE TEMP VIEW vw_seller_monthly",
                                           f"CREATE OR REPLACE VIEW {db}.vw_seller_monthly")
    for t in ["fact_order_items", "dim_orders", "dim_products", "dim_reviews", "base_order_items"]:
        # table names appear after FROM / JOIN followed by an alias, space or newline
        base = base.replace(f" {t} ", f" {db}.{t} ").replace(f" {t}\n", f" {db}.{t}\n")
        monthly = monthly.replace(f" {t} ", f" {db}.{t} ").replace(f" {t}\n", f" {db}.{t}\n")
    spark.sql(base)
    spark.sql(monthly)


def list_objects(spark: SparkSession, db: str, types=("MANAGED", "EXTERNAL", "VIEW")) -> DataFrame:
    """(name, table_type) of the tables and views of ``db``, ordered by name.

    The catalog listing is metadata (one entry per object), not table data.
    """
    rows = [(t.name, t.tableType) for t in spark.catalog.listTables(db) if not t.isTemporary]
    df = spark.createDataFrame(rows, "name string, table_type string")
    return df.where(F.col("table_type").isin(*types)).orderBy("name")


def export_csv(spark: SparkSession, db: str, out_dir: str, upper: bool = False) -> DataFrame:
    """Write every table and view of ``db`` to ``out_dir/<name>`` as CSV with a header.

    Quotes in text are doubled, so any CSV reader finds the same values; ``upper`` writes column
    names in upper case. Empty objects are skipped; a failing object is reported and the rest go on.
    Returns ``(name, status, path)``.
    """
    report = []
    for r in list_objects(spark, db).collect():  # one row per catalog object
        name = r["name"]
        path = join_location(out_dir, name.lower())
        try:
            df = spark.table(f"{db}.{name}")
            if df.isEmpty():
                report.append((name, "empty", None))
                continue
            stamps = [f.name for f in df.schema if f.dataType.typeName() == "timestamp_ntz"]
            df = df.withColumns({c: format_timestamp(c) for c in stamps})
            (upper_columns(df) if upper else df).write.mode("overwrite").option("header", True).option(
                "quote", '"').option("escape", '"').csv(path)
            report.append((name, "written", path))
        except Exception as e:  # noqa: BLE001 -- one object's failure must not stop the rest
            log.error("export of %s failed: %s", name, e)
            report.append((name, f"error: {e}", None))
    return spark.createDataFrame(report, "name string, status string, path string")
