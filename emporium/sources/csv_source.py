"""Source registry and CSV extraction with per-source failure isolation.

Every source is read with its explicit all-string schema: no inference pass over
the data, no lost leading zeros, and a malformed value stays text until the
cleaning pipelines ``try_cast`` it. A missing or unreadable file does not stop
the other sources; ``require_all`` turns any failure into ``ExtractError``.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import INGEST_ORDINAL, with_ingest_ordinal
from ..schema import SOURCE_SCHEMAS
from ..session import join_location
from .csv_blocks import csv_records, parsed

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class SourceSpec:
    name: str
    filename: str
    # Sources whose first-wins de-duplication needs file order get an ordinal.
    ordinal: bool = False


SOURCES: dict[str, SourceSpec] = {s.name: s for s in [
    SourceSpec("customers", "customers.csv"),
    SourceSpec("geolocation", "geolocation.csv"),
    SourceSpec("order_items", "order_items.csv"),
    SourceSpec("order_payments", "order_payments.csv"),
    SourceSpec("order_reviews", "order_reviews.csv", ordinal=True),
    SourceSpec("orders", "orders.csv"),
    SourceSpec("products", "products.csv"),
    SourceSpec("sellers", "sellers.csv"),
    SourceSpec("product_category_translation", "product_category_translation.csv", ordinal=True),
]}


class ExtractError(RuntimeError):
    def __init__(self, errors: dict[str, str]):
        super().__init__("; ".join(f"{k}: {v}" for k, v in errors.items()))
        self.errors = errors


# Text that the source pipeline's CSV reader takes for a missing value.
MISSING_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)
CORRUPT = "_corrupt_record"


def source_paths(base_dir: str, specs: dict[str, SourceSpec] = SOURCES) -> dict[str, str]:
    return {name: join_location(base_dir, s.filename) for name, s in specs.items()}


# Value of ``multiline``: quoted newlines, read by many tasks.
BLOCKS = "blocks"


def _read(spark: SparkSession, name: str, path: str, multiline: bool | str) -> DataFrame:
    """All rows by header name, with the corrupt-record column; an unknown or missing column is an error."""
    options = {"header": True, "multiLine": multiline is True, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    header = spark.read.options(**options).csv(path).columns
    wanted = SOURCE_SCHEMAS[name].fieldNames()
    unknown, missing = sorted(set(header) - set(wanted)), sorted(set(wanted) - set(header))
    if unknown or missing:
        raise ValueError(f"columns of {name}: missing {missing}, unknown {unknown}")
    # enforceSchema off: every file's own header must agree with the names and order found.
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])
    if multiline == BLOCKS:
        told = {"multiLine": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        rows = parsed(csv_records(spark, path, header), schema, told)
        if name in SOURCES and SOURCES[name].ordinal:
            rows = rows.withColumn(INGEST_ORDINAL, F.struct("file", F.lit(0).cast("long").alias("block"),
                                                            F.col("number").alias("row")))
        return rows.drop("file", "number")
    return (spark.read.schema(schema).options(**options, enforceSchema=False, columnNameOfCorruptRecord=CORRUPT)
            .csv(path))


def _sound(field: str) -> Column:
    """Whether a row is no corrupt record. A field takes part, because Spark does not let the
    corrupt column be queried alone (a bare count)."""
    return F.concat_ws("", F.col(CORRUPT), F.substring(field, 1, 0)) == ""


def read_csv_source(spark: SparkSession, name: str, path: str, multiline: bool | str = True) -> DataFrame:
    """One source file (or folder of part files) with header, quotes and embedded newlines.

    Columns are bound by header name. Rows with too many or too few fields are left out
    (``corrupt_rows`` lists them). Text that stands for a missing value becomes null.
    ``multiline`` keeps quoted newlines inside a field; ``True`` makes each file one
    task, ``"blocks"`` reads a file by many (``csv_blocks``; two passes over its lines).
    """
    df = _read(spark, name, path, multiline)
    spec = SOURCES.get(name)
    columns = SOURCE_SCHEMAS[name].fieldNames()
    if spec is not None and spec.ordinal:
        df = with_ingest_ordinal(df)
    rest = [c for c in df.columns if c not in columns and c != CORRUPT]
    value = {c: F.when(~F.col(c).isin(*MISSING_TEXT), F.col(c)) for c in columns}
    return df.where(_sound(df.columns[0])).select(*[v.alias(c) for c, v in value.items()], *rest)


def corrupt_rows(spark: SparkSession, name: str, path: str, multiline: bool | str = True) -> DataFrame:
    """``(source, record)``: the raw text of every row that has not the header's number of fields."""
    df = _read(spark, name, path, multiline)
    return df.where(~_sound(df.columns[0])).select(F.lit(name).alias("source"), F.col(CORRUPT).alias("record"))


def extract(spark: SparkSession, paths: dict[str, str], multiline: bool | str = True,
            require_all: bool = False) -> tuple[dict[str, DataFrame | None], dict[str, str]]:
    """Read every source; a failed one maps to ``None`` and its error is returned.

    Path and header problems surface when the DataFrame is created; only headers are read here.
    """
    frames: dict[str, DataFrame | None] = {}
    errors: dict[str, str] = {}
    for name, path in paths.items():
        try:
            frames[name] = read_csv_source(spark, name, path, multiline)
            log.info("extracted %s from %s", name, path)
        except Exception as e:  # noqa: BLE001 -- isolate any reader failure per source
            frames[name] = None
            errors[name] = f"{type(e).__name__}: {e}"
            log.error("could not read %s (%s): %s", name, path, errors[name])
    if require_all and errors:
        raise ExtractError(errors)
    return frames, errors


def write_csv_sources(frames: dict[str, DataFrame], base_dir: str) -> dict[str, str]:
    """Write source frames as CSV folders (header, quoted) -- used to stage test inputs."""
    out = {}
    for name, df in frames.items():
        path = join_location(base_dir, SOURCES[name].filename)
        cols = [c for c in df.columns if c in SOURCE_SCHEMAS[name].fieldNames()]
        if INGEST_ORDINAL in df.columns:
            # keep file order = ordinal order, so a re-read assigns the same ranking
            df = df.orderBy(INGEST_ORDINAL)
        (df.select(*cols).write.mode("overwrite").option("header", True)
         .option("quote", '"').option("escape", '"')
         .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
        out[name] = path
    return out


@dataclass(frozen=True)
class Landed:
    """A source as Parquet, with the rows and the fingerprint that the landing pass counted."""

    path: str
    rows: int
    fingerprint: str


def _fingerprint_metrics(df: DataFrame) -> list[Column]:
    """Two sums of row hashes: equal for equal rows in any order (and equal ordinals, where there are some)."""
    columns = [F.col(c) for c in df.columns]
    return [F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("a"),
            F.sum(F.xxhash64(F.lit(1), *columns[::-1]).cast("decimal(38,0)")).alias("b")]


def land_frames(spark: SparkSession, frames: dict[str, DataFrame], landing_dir: str,
                parallel: int = 4) -> dict[str, Landed]:
    """Write every source to Parquet once, keeping the file-order ordinal where first-wins needs it.

    This is the only scan of a source: its rows and fingerprint are counted on the way, in the stage that writes."""

    def land(name: str) -> Landed:
        df = frames[name]
        if name in SOURCES and SOURCES[name].ordinal:
            df = with_ingest_ordinal(df)
        seen, path = Observation(), join_location(landing_dir, name)
        df.observe(seen, *_fingerprint_metrics(df)).write.mode("overwrite").parquet(path)
        found = seen.get
        mark = f"{found.get('rows', 0)}:{found.get('a')}:{found.get('b')}:{df.schema.simpleString()}"
        return Landed(path, found.get("rows", 0), mark)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return dict(zip(frames, pool.map(land, frames)))


def land_as_parquet(spark: SparkSession, paths: dict[str, str], landing_dir: str,
                    multiline: bool | str = True) -> dict[str, str]:
    """Convert each CSV source to Parquet once, keeping the file-order ordinal.

    Sources that need first-wins ordering carry ``src_ord`` into the Parquet files, so the ordering survives.
    Returns the Parquet path per source; raises ``ExtractError`` if any source
    cannot be read (nothing half-landed is reported as success).
    """
    frames, _ = extract(spark, paths, multiline, require_all=True)
    return {name: landed.path for name, landed in land_frames(spark, frames, landing_dir).items()}


def read_landed(spark: SparkSession, landed: dict[str, str]) -> dict[str, DataFrame]:
    """The landed sources as DataFrames (all-string columns plus ``src_ord`` where kept)."""
    return {name: spark.read.parquet(path) for name, path in landed.items()}
