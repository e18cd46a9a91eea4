"""Helpers shared by the training-data operators: scratch tables, Arrow batches, streamed groups."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

# A null doc_id ranks after every other id.
LAST_ID = 2**63 - 1


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder below the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back (cuts the lineage)."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the folder of a table made by ``materialize`` that nothing reads any more."""
    files = df.inputFiles()
    if files:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` with null text as the empty text; other columns are left out."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def rank_id(c: Column) -> Column:
    return F.coalesce(c, F.lit(LAST_ID))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def byte_slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to about ``limit``; a larger item stands alone."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def to_batch(schema: T.StructType, columns: dict) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow)


def key_runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows in sorted ``keys``, with the end appended."""
    n = len(keys[0])
    if n == 0:
        return np.zeros(1, np.int64)
    change = np.zeros(n - 1, bool)
    for k in keys:
        change |= k[1:] != k[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [n]])
