"""Run a streaming query to completion and read back its final answer.

The reference prints each micro-batch to the console for a fixed time. Here
every micro-batch is written by ``foreachBatch`` to its own folder
``kestrel_batch=<id>`` of a Parquet table in the shared checkpoint folder, in
overwrite mode; the query's checkpoint makes a restart resume where it
stopped, and a batch re-run after a failure replaces its own folder, so
the sink is exactly-once. The final answer is read from that table:

- ``append``: every emitted row.
- ``update``: per key, the row from the latest batch that emitted it (ST6).
- ``complete``: the rows of the last batch (ST7).

The sink stays bounded: ``complete`` keeps the newest batch only, and
``update`` folds its folders in tiers of ``COMPACT_EVERY``.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from kestrel.session import scratch_path

BATCH_COL = "kestrel_batch"
COMPACT_EVERY = 16
EVENTS_S = 30.0  # most that is waited for a stopped run's last events


@dataclass
class StreamRun:
    """``finished`` is false for a run that was stopped with input possibly
    left (by the clock, or after a number of batches): its result covers the
    batches up to then. ``dropped`` and ``watermarks`` (ISO text) are by batch."""
    result: DataFrame
    sink_path: str
    checkpoint_path: str
    progress: list
    dropped: dict[int, int]
    finished: bool
    watermarks: dict[int, str] = field(default_factory=dict)

    def rows_dropped_by_watermark(self) -> int:
        """Late rows the engine dropped (ST10), over all batches of the run."""
        return sum(self.dropped.values())


class _Progress(StreamingQueryListener):
    """Every progress event of one query, as it comes: rows dropped by the
    watermark and the watermark in force by batch, and whether the query has
    found its input used up. A handle's own ``recentProgress`` forgets."""

    def __init__(self, name: str):
        self.name = name
        self.run_id: str | None = None
        self.dropped: dict[int, int] = {}
        self.watermarks: dict[int, str] = {}
        self.idle = threading.Event()
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        # Called before start() returns, so the name tells the run.
        if event.name == self.name:
            self.run_id = str(event.runId)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        if str(p.runId) != self.run_id:
            return
        batch = int(p.batchId)
        total = sum(op.numRowsDroppedByWatermark or 0 for op in p.stateOperators or [])
        self.dropped[batch] = max(total, self.dropped.get(batch, 0))
        if p.eventTime and p.eventTime.get("watermark"):
            self.watermarks[batch] = p.eventTime["watermark"]

    def onQueryIdle(self, event) -> None:  # noqa: N802
        if str(event.runId) == self.run_id:
            self.idle.set()

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        # Comes after all other events of the run.
        if str(event.runId) == self.run_id:
            self.ended.set()


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of a run, put back afterwards."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# State on local disk instead of the executors' heap; a checkpoint uploads the
# changes of a batch, not the whole store.
DISK_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _batch_folders(spark: SparkSession, sink: str) -> dict[float, str]:
    """Batch label -> folder of the sink."""
    root = spark._jvm.org.apache.hadoop.fs.Path(sink)
    found = {}
    for status in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root):
        name = status.getPath().getName()
        if name.startswith(f"{BATCH_COL}="):
            found[float(name.split("=", 1)[1])] = status.getPath().toString()
    return found


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _bound_sink(spark: SparkSession, sink: str, mode: str, keys: Sequence[str], batch_id: int) -> None:
    """Drop what later readers cannot need, after batch ``batch_id`` is written.

    ``update`` is compacted in tiers: every ``COMPACT_EVERY`` batches those are
    folded into one folder of the latest row per key, every ``COMPACT_EVERY``
    such folders into one of the next tier, and so on. A row is rewritten once
    a tier, so the work per batch grows with the logarithm of their number,
    and no compaction touches folders outside its span. The folded rows go
    under ``<id>.001``, which is later than every batch it covers, and only
    then those are removed: a crash in between leaves rows twice, and readers
    take the later ones. A label belongs to the batch of its whole part, so the
    fold of the span before stays outside. A repeated batch finds what an
    earlier attempt has folded and folds it again under the next free label,
    never over a folder that it reads."""
    if mode == "complete":
        for label, folder in _batch_folders(spark, sink).items():
            if label < batch_id:
                _remove(spark, folder)
    elif mode == "update":
        span = 1
        while (batch_id + 1) % (span * COMPACT_EVERY) == 0:
            span *= COMPACT_EVERY
        if span == 1:
            return
        covered = {label: f for label, f in _batch_folders(spark, sink).items() if batch_id - span < int(label) <= batch_id}
        again = max((round((label - batch_id) * 1000) for label in covered if label > batch_id), default=0)
        rows = _with_label(spark.read.option("basePath", sink).parquet(*covered.values()))
        final_answer(rows, mode, keys).write.mode("overwrite").parquet(f"{sink}/{BATCH_COL}={batch_id}.{again + 1:03d}")
        for folder in covered.values():
            _remove(spark, folder)


def _with_label(rows: DataFrame) -> DataFrame:
    return rows.withColumn(BATCH_COL, F.col(BATCH_COL).cast("double"))


def _read_sink(spark: SparkSession, sink: str) -> DataFrame:
    return _with_label(spark.read.parquet(sink))


def run_stream(spark: SparkSession, query: DataFrame, mode: str, keys: Sequence[str] = (),
               name: str = "stream", processing_time: str | None = None,
               timeout_s: float | None = None, sink_path: str | None = None,
               checkpoint_path: str | None = None, stop_after_batches: int | None = None,
               until_idle: bool = False, conf: dict[str, str] | None = None) -> StreamRun:
    """Run ``query`` (a streaming DataFrame) until its input is used up.

    Without ``processing_time`` the trigger is ``availableNow``: all input
    present at start is processed in as many micro-batches as the source's
    rate limits make, then the query stops; if ``timeout_s`` passes before
    that, ``TimeoutError`` is raised (a rerun with the same two paths goes on
    from the last batch). With ``processing_time`` (ST8) the query runs on
    that trigger until ``timeout_s`` elapses (ST9) or, with ``until_idle``,
    until the query reports a trigger that found no input left (then
    ``timeout_s`` passing first raises).

    ``stop_after_batches`` interrupts the run inside the batch that makes up
    the number: its rows are in the sink, but it is not yet committed. A rerun
    with the same two paths repeats that batch, which replaces its folder.

    Fresh sink and checkpoint folders are made in the shared folder unless
    given; calling again with the same two paths resumes from the
    checkpoint, processing only input that arrived since (after a failure,
    or for the next files of a growing folder). ``conf`` holds session
    settings for this run, such as ``DISK_STATE``; a checkpoint keeps to the
    state store it was made with."""
    sink = sink_path or scratch_path(spark, f"{name}-sink")
    ckpt = checkpoint_path or scratch_path(spark, f"{name}-ckpt")
    written_batches: list[int] = []
    cut = threading.Event()

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # One folder per batch, overwritten: a batch re-run after a failure
        # (same id) replaces its own output instead of adding to it.
        batch.write.mode("overwrite").parquet(f"{sink}/{BATCH_COL}={batch_id}")
        _bound_sink(spark, sink, mode, keys, batch_id)
        written_batches.append(batch_id)
        if stop_after_batches is not None and len(written_batches) >= stop_after_batches:
            cut.set()
            raise InterruptedError(f"stopped in batch {batch_id}")  # before its commit

    label = f"{name}-{scratch_path(spark, 'run').rsplit('-', 1)[1]}"
    seen = _Progress(label)
    spark.streams.addListener(seen)
    handle = None
    try:
        with _settings(spark, conf or {}):
            writer = (query.writeStream.queryName(label).outputMode(mode).foreachBatch(write_batch)
                      .option("checkpointLocation", ckpt))
            trigger = {"processingTime": processing_time} if processing_time else {"availableNow": True}
            handle = writer.trigger(**trigger).start()
        # A run that interrupts itself ends by an error, which is not awaited.
        stop = cut if stop_after_batches is not None else seen.idle if until_idle else None
        ended = _wait(handle, timeout_s, stop)
    finally:
        if handle is not None and handle.isActive:
            handle.stop()
        if handle is not None:
            seen.ended.wait(EVENTS_S)  # events come asynchronously
        spark.streams.removeListener(seen)
    if handle.exception() is not None and not cut.is_set():
        raise RuntimeError(f"stream {name} failed: {handle.exception()}")
    if not ended and (until_idle or not processing_time):
        raise TimeoutError(f"stream {name} had input left after {timeout_s} s; rerun with sink {sink} and checkpoint {ckpt}")
    finished = not cut.is_set() and (until_idle or not processing_time)
    columns = list(query.columns)
    try:
        result = final_answer(_read_sink(spark, sink), mode, keys).select(*columns)
    except AnalysisException:  # no batch was written: an empty result
        result = spark.createDataFrame([], query.schema)
    return StreamRun(result, sink, ckpt, list(handle.recentProgress), seen.dropped, finished, seen.watermarks)


def _wait(handle, timeout_s: float | None, stop: threading.Event | None) -> bool:
    """Until the query ends or ``stop`` is set; false if the time ran out."""
    if stop is None:
        return handle.awaitTermination(timeout_s) if timeout_s is not None else handle.awaitTermination() or True
    waited, step = 0.0, 0.05
    while timeout_s is None or waited < timeout_s:
        if not handle.isActive or (stop.wait(step) and handle.exception() is None and not handle.status["isTriggerActive"]):
            return True
        waited += step
    return False


def final_answer(written: DataFrame, mode: str, keys: Sequence[str] = ()) -> DataFrame:
    if mode == "append":
        return written.drop(BATCH_COL)
    if mode == "complete":
        last = written.agg(F.max(BATCH_COL)).scalar()
        return written.filter(F.col(BATCH_COL) == last).drop(BATCH_COL)
    if mode == "update":
        if not keys:
            raise ValueError("update mode needs the result's key columns")
        latest = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(BATCH_COL).desc()))
        return written.withColumn("_rn", latest).filter(F.col("_rn") == 1).drop("_rn", BATCH_COL)
    raise ValueError(f"unknown output mode {mode}")
