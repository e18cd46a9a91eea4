"""Session helpers.

Library functions never create a session themselves; they take the caller's
``SparkSession``. ``build_session`` is for tests, the bench and the CLI.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every entry point wants. AQE re-plans joins from runtime sizes (this is
# the size check behind every broadcast we do not hint ourselves), coalesces small
# shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "emporium",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A session with the defaults above. Master and partition count are set only if given:
    on a cluster spark-submit and its configuration decide both."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def recommended_conf(input_bytes: int, total_cores: int,
                     target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Sizing for a cluster run over ``input_bytes`` of compressed Parquet.

    * shuffle partitions: enough that a partition stays near the target size
      (Parquet expands several-fold in a shuffle), at least two waves of tasks;
      AQE coalesces the ones that turn out small;
    * file splits of the target size so scan tasks are balanced;
    * the broadcast threshold stays at a fixed, small size: AQE broadcasts a
      side only after measuring it below this bound;
    * skew splitting on, with thresholds tied to the target size;
    * reliable checkpoints are removed once their DataFrame is garbage.
    """
    expanded = input_bytes * 3
    parts = max(2 * total_cores, -(-expanded // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def as_location(path: str) -> str:
    """A location that means the same everywhere: URIs as they are, local paths made absolute."""
    return path if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) else os.path.abspath(path)


def join_location(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts])


def location_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any store that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    p, fs = _path(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def make_folder(spark: SparkSession, folder: str) -> None:
    p, fs = _path(spark, folder)
    fs.mkdirs(p)


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole: written beside its place, then renamed."""
    p, fs = _path(spark, path)
    beside, _ = _path(spark, f"{path.rsplit('/', 1)[0]}/.{path.rsplit('/', 1)[1]}.tmp")
    out = fs.create(beside, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if not fs.rename(beside, p):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used as
    is. Only when it is unset and the master is local (unit tests, a laptop) do we
    create one ourselves; on any other master that is an error.
    On a Spark Connect session (no SparkContext) the server's setting applies.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- Spark Connect: the server owns the checkpoint dir
        return configured or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = configured or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="emporium-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
