"""Exact deduplication with streaming state (DataFrame and SQL functions only).

``exact_dedup`` lands a narrow row per document (id, digest of the normalised text, content
locator), streams the landed files through a keyed aggregation whose state lives in RocksDB
without expiry, and keeps per digest the smallest id, its locator and the number of rows.
Digests hit more than once are then checked on their full normalised bytes; digests that stand
for several texts (collisions) are regrouped by the text itself, so the result is exact for any
digest function.

Defined cases: null text is the empty text and empty texts are equal to each other; a null
doc_id ranks after every id, so ``keep_id`` is null only if the whole group has no id; of rows
that repeat a doc_id with an equal text one is kept; an empty table gives an empty result; extra
columns are ignored. A hot group costs one state row: rows are combined before every shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import id_and_text, materialize, rank_id, scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Digests of 32 bytes that may be broadcast (under 64 MB in memory).
MOST_SENT = 400_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def first_seen_state(spark: SparkSession, landed: str, schema, files_per_batch: int) -> DataFrame:
    """Stream the landed files; return ``(digest, keep_rank, locator, n)``, one row per digest."""
    session = spark.newSession()
    for k in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        session.conf.set(k, spark.conf.get(k))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # Many small stores: no files set aside in advance, one bound on their memory together.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "256")
    out = scratch_path(spark, "dedup-state")
    state = (session.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landed)
             .groupBy("digest")
             .agg(F.min("rank").alias("keep_rank"), F.min_by("locator", "rank").alias("locator"),
                  F.count(F.lit(1)).alias("n")))

    def append(batch: DataFrame, batch_id: int) -> None:
        # One folder per batch: a batch that is run again replaces its own rows.
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    (state.writeStream.outputMode("update").foreachBatch(append)
     .option("checkpointLocation", scratch_path(spark, "dedup-stream"))
     .trigger(availableNow=True).start().awaitTermination())
    # A digest changed in several batches: its rank only falls and its count only grows.
    updates = spark.read.schema(state.schema).option("recursiveFileLookup", "true").parquet(out)
    return updates.groupBy("digest").agg(F.min("keep_rank").alias("keep_rank"),
                                         F.min_by("locator", "keep_rank").alias("locator"),
                                         F.max("n").alias("n"))


def exact_dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256,
                files_per_batch: int | None = None) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256, locator``.

    Unless ``files_per_batch`` says otherwise, the landed files make about eight micro-batches (of 24 files at least)."""
    spark = docs.sparkSession
    rows = (id_and_text(docs).withColumn("file", F.input_file_name())
            .withColumn("norm", normalised(F.col("text"))).drop("text"))
    narrow = rows.select("doc_id", rank_id(F.col("doc_id")).alias("rank"), digest(F.col("norm")).alias("digest"),
                         sha256(F.col("norm")).alias("sha"),
                         F.struct(F.col("file"), F.col("doc_id")).alias("locator"))
    landed = materialize(narrow, "dedup-landing")
    files = landed.inputFiles()
    if not files or landed.isEmpty():
        return _finish(narrow.withColumns({"keep_rank": F.col("rank"), "n": F.lit(1).cast("long")}))
    state = materialize(first_seen_state(spark, files[0].rsplit("/", 1)[0], narrow.schema,
                                         files_per_batch or max(24, len(files) // 8)), "dedup-groups")

    # Full bytes on hits. Equal texts of a partition are combined before they are moved; while the
    # hits are few enough to be sent to every task, no other text is moved at all.
    hits = state.filter("n > 1").select("digest")
    texts = rows.select("norm").withColumn("digest", digest(F.col("norm"))).select("digest", "norm")
    if hits.count() <= MOST_SENT:
        texts = texts.join(F.broadcast(hits), "digest", "left_semi").distinct()
    else:
        texts = texts.distinct().join(hits, "digest", "left_semi")
    clashes = materialize(texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
                          .select("digest"), "dedup-clashes")
    joined = landed.drop("locator").join(state, "digest")
    if clashes.isEmpty():
        return _finish(joined)

    # Different texts under one digest: group those rows by the text.
    clashing = rows.withColumn("digest", digest(F.col("norm"))).join(clashes, "digest", "left_semi")
    exact = (clashing.groupBy("digest", "norm")
             .agg(F.min(rank_id(F.col("doc_id"))).alias("keep_rank"), F.count(F.lit(1)).alias("n"),
                  F.min_by(F.struct("file", "doc_id"), rank_id(F.col("doc_id"))).alias("locator")))
    resolved = (clashing.select("digest", "norm", "doc_id").join(exact, ["digest", "norm"])
                .select("doc_id", rank_id(F.col("doc_id")).alias("rank"), "digest",
                        sha256(F.col("norm")).alias("sha"), "keep_rank", "locator", "n"))
    return _finish(joined.join(clashes, "digest", "left_anti").unionByName(resolved))


def _finish(rows: DataFrame) -> DataFrame:
    """Output columns; of rows that repeat both id and text the first is the one kept."""
    nth = F.row_number().over(Window.partitionBy("keep_rank", "digest", "sha", "rank").orderBy("n"))
    return rows.withColumn("nth", nth).select(
        "doc_id",
        F.nullif(F.col("keep_rank"), F.lit(2**63 - 1)).cast("long").alias("keep_id"),
        F.col("n").alias("group_size"),
        ((F.col("rank") == F.col("keep_rank")) & (F.col("nth") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "locator")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    kept = (exact_dedup(docs).filter("kept")
            .select(F.col("doc_id").alias("__kept_id"), F.unhex("text_sha256").alias("__kept_sha")))
    sha = sha256(normalised(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    marked = docs.withColumn("__sha", sha)
    found = marked.join(kept, marked["doc_id"].eqNullSafe(kept["__kept_id"]) & (marked["__sha"] == kept["__kept_sha"]))
    # After the join equal rows lie together; only repeats of one id and text are left to drop.
    return found.dropDuplicates(["__kept_id", "__kept_sha"]).select(*[docs[c] for c in docs.columns])


ORACLE = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, MIN(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       COUNT(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = MIN(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM d"""
