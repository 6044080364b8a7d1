"""Session defaults, the runtime settings the library's semantics rely on,
and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every kestrel session should carry. AQE coalesces small shuffle
# partitions, splits skewed sort-merge-join partitions and turns joins into
# broadcast joins only after it has measured the smaller side at runtime.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def cluster_conf(input_bytes: int, partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings for a large cluster, sized from the bytes a job reads.

    Shuffles start with about one partition per ``partition_bytes`` of input
    (at least 200) and AQE merges the small ones after measuring them, so
    partitions stay near the advisory size whatever the selectivity. Skewed join partitions over 5x the median (and 1 GiB) are
    split. Large streaming state goes to RocksDB instead of the JVM heap.
    ``spark.checkpoint.dir`` must also be set, to shared storage."""
    partitions = max(200, input_bytes // partition_bytes)
    return {
        **DEFAULT_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        # Merge to the advisory size, not to keep every core busy with tiny tasks.
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def build_session(app: str = "kestrel", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings query semantics depend on.

    Epoch seconds become calendar fields through the session time zone, so
    year, month, day and hour answers move with it; the library pins UTC.
    The setting stays with the session after the query: results are lazy, and
    are evaluated under the zone in force when they are read.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written scratch tables.

    Uses the folder the cluster names in ``spark.checkpoint.dir`` (or one
    already set on the SparkContext). Only a local-mode session without that
    setting (tests, a laptop) gets a fresh temporary folder; on a cluster a
    missing setting is an error, because a machine-local folder does not
    survive the loss of an executor."""
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "") or (sc.master if sc is not None else "")
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS, object store) before running iterative queries")
        configured = tempfile.mkdtemp(prefix="kestrel-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    return f"{checkpoint_dir(spark).rstrip('/')}/kestrel-{name}-{uuid.uuid4().hex}"


def materialize(df, name: str, metrics=None):
    """Write ``df`` as a Parquet table in the shared checkpoint folder and
    read it back: one job, and the returned frame's plan is a file scan, so
    iterative loops keep a constant-size plan. The table outlives executor
    loss, unlike a cache or a local checkpoint.

    ``metrics`` (a list of aggregate Columns) are computed by the same job
    through ``DataFrame.observe``; the call then returns ``(frame, values)``
    with ``values`` a dict by alias. This saves loops a separate job per
    round for their convergence check."""
    from pyspark.sql import Observation
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _written.add(path)
    observation = None
    if metrics:
        observation = Observation(f"{name}-metrics")
        df = df.observe(observation, *metrics)
    df.write.parquet(path)
    # The schema is known, so the read skips footer inference.
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    if observation is None:
        return out
    return out, observation.get


# Scratch tables this driver has written and not deleted.
_written: set[str] = set()


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    _written.discard(path)


def discard(*frames) -> None:
    """Delete the scratch tables behind frames that ``materialize`` returned.
    Only for tables that every later result was written from already."""
    for frame in frames:
        path = frame.__dict__.pop("_scratch_path", None)
        if path:
            _delete(frame.sparkSession, path)


def release_scratch(spark: SparkSession) -> int:
    """Delete all scratch tables still held, once their results have been
    read; returns how many there were."""
    held = sorted(_written)
    for path in held:
        _delete(spark, path)
    return len(held)
