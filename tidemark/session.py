"""Session construction and cluster-facing helpers.

The library never picks storage locations on a cluster: lineage cuts and
streaming checkpoints live under the shared folder named by the session's
``spark.checkpoint.dir``. That value is set here only when it is unset: by
tests and the bench, and for a local-mode session (one machine, so a local
folder is shared by every executor thread).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the operators are written against. AQE re-plans joins from
# measured shuffle sizes (runtime broadcast, skew-split of hot partitions,
# coalescing of tiny partitions); UTC keeps timestamp text engine-neutral.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_settings(largest_shuffle_bytes: int, target_partition_bytes: int = 256 << 20,
                     scan_partition_bytes: int = 512 << 20) -> dict[str, str]:
    """Starting values for a large cluster, sized from the biggest shuffle.

    ``spark.sql.shuffle.partitions`` is set so a shuffle partition of the
    largest exchange is about ``target_partition_bytes`` (it must fit an
    executor's memory share with room to spill); AQE coalesces the
    partitions of smaller exchanges to the same advisory size and splits a
    partition that a hot key makes several times larger than the median.
    Scans read ``scan_partition_bytes`` per task. The count is capped at
    100,000 (map-output metadata grows with maps x reducers); past the cap,
    partitions grow larger and rely on spill.
    """
    partitions = min(100_000, max(200, -(-largest_shuffle_bytes // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(scan_partition_bytes),
    }


def build_session(
    master: str | None = None,
    app_name: str = "tidemark",
    shuffle_partitions: int | None = None,
    checkpoint_root: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the operators expect.

    ``checkpoint_root`` is applied only when the cluster has not already
    named a ``spark.checkpoint.dir``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if checkpoint_root and not _configured_checkpoint(spark):
        spark.sparkContext.setCheckpointDir(checkpoint_root)
        spark.conf.set("spark.checkpoint.dir", checkpoint_root)
    return spark


def _configured_checkpoint(spark: SparkSession) -> str | None:
    try:
        value = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - conf access can fail on remote sessions
        value = None
    if value:
        return value
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # pragma: no cover
        return None


def checkpoint_dir(spark: SparkSession, required: bool = True) -> str | None:
    """The shared folder for lineage cuts and streaming state.

    Read from the session; raises when ``required`` and the cluster names none,
    because a machine-local fallback would not survive executor loss.
    """
    value = _configured_checkpoint(spark)
    if value:
        try:
            if not spark.sparkContext.getCheckpointDir():
                spark.sparkContext.setCheckpointDir(value)
        except Exception:  # pragma: no cover
            pass
        return value.rstrip("/")
    if required:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for checkpoints"
        )
    return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The configured shared folder; in local mode only, a fresh one if unset.

    A local-mode session is a single machine, so a folder on it is shared by
    every executor thread; on a cluster the setting must come from the
    cluster and its absence is an error.
    """
    value = checkpoint_dir(spark, required=False)
    if value:
        return value
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        return checkpoint_dir(spark, required=True)
    import tempfile

    root = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(root)
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written tables)."""
    root = ensure_checkpoint_dir(spark)
    if root.startswith("file:"):
        root = root[len("file:"):]
    return os.path.join(root, *parts)


def lineage_root(spark: SparkSession) -> str:
    """This application's folder of lineage cuts, under the shared folder.

    The setting's own scheme is kept, so the folder is found by Spark's
    readers wherever the shared store is.
    """
    return f"{ensure_checkpoint_dir(spark)}/lineage/{spark.sparkContext.applicationId}"


def cut_lineage(df: DataFrame, name: str = "cut", compression: str | None = None) -> DataFrame:
    """Write ``df`` as a table under the shared checkpoint folder and read it back.

    One job computes and writes the rows (an RDD checkpoint of an unpersisted
    plan would compute them twice); the returned frame's lineage is just the
    file scan, so a lost executor re-reads files instead of recomputing
    earlier rounds. Always cuts: the folder is resolved the same way for every
    caller, and a cluster that names none is an error. ``compression`` packs a
    table of many digests tighter than the session's codec does.
    """
    import uuid

    spark = df.sparkSession
    path = f"{lineage_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def drop_lineage(spark: SparkSession) -> None:
    """Delete this application's lineage cuts. Call it when no frame that was
    built on them is still needed (the end of a job)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(lineage_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Spread an under-partitioned scan over the cluster's cores.

    A small table stored as one row group is read by one task, and all work
    before the first shuffle runs on that one core. When the scan has fewer
    partitions than the default parallelism, rows are redistributed
    round-robin (Spark sorts before a round-robin repartition, so a retried
    task sees the same rows). Large inputs already have enough partitions
    and are returned unchanged: no extra shuffle at scale.
    """
    spark = df.sparkSession
    try:
        cores = spark.sparkContext.defaultParallelism
        parts = df.rdd.getNumPartitions()
    except Exception:  # pragma: no cover - remote sessions
        return df
    return df.repartition(cores) if parts < cores else df


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only after proving it holds at most ``max_rows`` rows.

    The proof is a bounded count (``limit(max_rows + 1)``), so it never scans
    more than it needs. Beyond the bound the frame is returned unchanged and
    the join stays a shuffle join that AQE may still convert at runtime.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
