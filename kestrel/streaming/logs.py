"""The log queries as streams (S4, ST1-ST10).

Lines arrive from a replayable file source instead of a socket: the events
table itself (or replay files written from it) is read as a stream, turned
into log lines, watermarked on arrival time, and aggregated with the same
functions the batch queries use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.plans import fixtures, logs
from kestrel.session import scratch_path
from kestrel.sources.raw_inputs import log_line_stream, write_log_lines
from kestrel.sources.stream import read_file_stream
from kestrel.sources.tables import read_table, stream_glob
from kestrel.streaming.runner import DISK_STATE, StreamRun, run_stream

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]


def event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Events read as a stream from Parquet file(s) at ``path``."""
    schema = spark.read.parquet(path).select(*EVENT_COLUMNS).schema
    return read_file_stream(spark, path, schema, "parquet", max_files_per_trigger).select(*EVENT_COLUMNS)


def line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Watermarked ``(value, timestamp)`` log lines streamed from event files."""
    events = event_stream(spark, path, max_files_per_trigger)
    return logs.with_watermark(fixtures.log_lines(spark, "", events=events))


def stream_datanode_windows(spark: SparkSession, path: str, mode: str = "update",
                            max_files_per_trigger: int | None = None) -> StreamRun:
    q = logs.datanode_windows(line_stream(spark, path, max_files_per_trigger))
    return run_stream(spark, q, mode, keys=["window_start", "window_end"], name="datanode-windows")


def stream_bytes_per_host(spark: SparkSession, path: str,
                          max_files_per_trigger: int | None = None) -> StreamRun:
    q = logs.ranked_hosts(logs.bytes_per_host(line_stream(spark, path, max_files_per_trigger)))
    return run_stream(spark, q, "complete", name="bytes-per-host")


def stream_info_block_counts(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                             timed_s: float | None = None,
                             trigger: str = logs.PATTERN_TRIGGER) -> StreamRun:
    """INFO/blk_ counts per host. With ``timed_s`` the query runs for so many
    seconds on its processing-time trigger (ST8, ST9) instead of until the
    input is used up."""
    q = logs.info_block_counts(line_stream(spark, path, max_files_per_trigger))
    timed = {"processing_time": trigger, "timeout_s": timed_s} if timed_s else {}
    return run_stream(spark, q, "complete", name="info-block-counts", **timed)


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> StreamRun:
    """Pass-through of the watermarked lines in append mode (ST5)."""
    return run_stream(spark, line_stream(spark, path, max_files_per_trigger), "append", name="lines")


# --- replay in several arrivals, the last one late ---------------------------------

REPLAY_SLICES = 4
LATE_ONE_IN = 40
WINDOW_KEYS = ["window_start", "window_end"]


def replay_arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The events table in the order it arrives: time slices, then rows that
    were held back (every ``LATE_ONE_IN``-th event of the first half). The
    table is read for its extent and once more to be written by arrival; an
    arrival is one partition of that copy."""
    events = read_table(spark, sf_dir, "events", EVENT_COLUMNS)
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = events.agg(F.min(micros), F.max(micros)).first()
    if lo is None:
        return [events]
    share = (micros - lo) / F.lit(float(hi - lo + 1))
    late = (share < 0.5) & (F.col("event_id") % LATE_ONE_IN == 0)
    arrival = F.when(late, F.lit(REPLAY_SLICES)).otherwise(F.floor(share * REPLAY_SLICES)).cast("int")
    staged = scratch_path(spark, "log-arrivals")
    events.withColumn("arrival", arrival).write.partitionBy("arrival").parquet(staged)
    schema = events.withColumn("arrival", arrival).schema
    return [spark.read.schema(schema).parquet(staged).filter(F.col("arrival") == n).drop("arrival") for n in range(REPLAY_SLICES + 1)]


replay_slices = replay_arrivals  # its name before the text replay


def _replay(spark: SparkSession, sf_dir: str, write, read, **options) -> tuple[StreamRun, list[StreamRun]]:
    """DataNode windows over events that arrive slice by slice, in update
    mode: ``write`` adds an arrival's files to a folder, and the query over
    ``read`` of that folder is resumed from its checkpoint. Returns the last
    run and the runs of all arrivals."""
    folder, sink, ckpt = (scratch_path(spark, f"log-replay{part}") for part in ("", "-sink", "-ckpt"))
    runs = []
    for n, part in enumerate(replay_arrivals(spark, sf_dir)):
        write(part, f"{folder}/slice={n}")
        query = logs.datanode_windows(read(f"{folder}/slice=*"))
        runs.append(run_stream(spark, query, "update", keys=WINDOW_KEYS, name="log-replay",
                               sink_path=sink, checkpoint_path=ckpt, **options))
    return runs[-1], runs


def replay_datanode_windows(spark: SparkSession, sf_dir: str) -> StreamRun:
    """The replay over Parquet event files: windows are emitted again as later
    arrivals add to them, and the late rows meet a watermark that has moved
    past them (ST1, ST6, ST10)."""
    run, runs = _replay(spark, sf_dir, lambda part, path: part.write.parquet(path), lambda path: line_stream(spark, path))
    for earlier in runs:
        run.dropped = earlier.dropped | run.dropped
    return run


def text_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                     delay: str = logs.WATERMARK_DELAY) -> DataFrame:
    """Watermarked lines streamed from text files; the time of a line is the
    stamp it starts with (S4, ST1)."""
    return logs.with_watermark(log_line_stream(spark, path, max_files_per_trigger, event_time=True), delay)


def _write_text(spark: SparkSession):
    return lambda part, path: write_log_lines(fixtures.log_lines(spark, "", events=part), path)


def replay_text_windows(spark: SparkSession, sf_dir: str) -> StreamRun:
    """The replay over text files, with event time parsed out of the lines and
    state in RocksDB (S4, ST1, ST2, ST6)."""
    return _replay(spark, sf_dir, _write_text(spark), lambda path: text_line_stream(spark, path), conf=DISK_STATE)[0]


def replay_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the watermark dropped, by arrival of the text replay (ST10):
    ``arrival``, the ``watermark`` in force when it came (null at first) and
    ``dropped``, late windows that the state refused. The counts are collected
    from every progress event of the runs."""
    _, runs = _replay(spark, sf_dir, _write_text(spark), lambda path: text_line_stream(spark, path))
    rows = []
    for n, run in enumerate(runs):
        mark = run.watermarks.get(min(run.watermarks, default=-1))
        rows.append((n, None if mark is None or mark.startswith("1970") else mark, sum(run.dropped.values())))
    return (spark.createDataFrame(rows, "arrival int, watermark string, dropped long")
            .withColumn("watermark", F.col("watermark").cast("timestamp")))


# --- stopped in mid-input, and on a clock -------------------------------------------------

SLICE_FILES = 2
STOP_AFTER = 3


def _slices_of_text(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Text files of all on-time and late lines, slice after slice, and the
    lateness that the order of files within a slice can bring about."""
    folder = scratch_path(spark, "log-slices")
    events = read_table(spark, sf_dir, "events", EVENT_COLUMNS)
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    for n, part in enumerate(replay_arrivals(spark, sf_dir)):
        write_log_lines(fixtures.log_lines(spark, "", events=part.repartition(SLICE_FILES)), f"{folder}/slice={n}")
    extent = 0 if lo is None else int((hi - lo).total_seconds())
    return f"{folder}/slice=*", f"{extent + 60} seconds"


def interrupted_text_windows(spark: SparkSession, sf_dir: str) -> StreamRun:
    """DataNode windows, stopped in the middle of the input and resumed (ST9).

    One file a micro-batch. The first run is stopped inside its third batch,
    whose rows are in the sink but not committed; the second goes on from the
    checkpoint, repeats that batch over its own folder and reads the rest. The
    watermark allows for the whole extent, so the answer is the batch one."""
    path, delay = _slices_of_text(spark, sf_dir)
    query = lambda: logs.datanode_windows(text_line_stream(spark, path, 1, delay))
    first = run_stream(spark, query(), "update", keys=WINDOW_KEYS, name="interrupted", stop_after_batches=STOP_AFTER)
    return run_stream(spark, query(), "update", keys=WINDOW_KEYS, name="resumed",
                      sink_path=first.sink_path, checkpoint_path=first.checkpoint_path)


def triggered_info_block_counts(spark: SparkSession, sf_dir: str, trigger: str = "1 second",
                                timeout_s: float = 600.0) -> StreamRun:
    """INFO/blk_ counts per host on a processing-time trigger (ST8), one text
    file a trigger, until the query itself reports that no input is left."""
    path, delay = _slices_of_text(spark, sf_dir)
    query = logs.info_block_counts(text_line_stream(spark, path, 1, delay))
    return run_stream(spark, query, "complete", name="triggered", processing_time=trigger, timeout_s=timeout_s, until_idle=True)


def events_path(sf_dir: str) -> str:
    """Stream source path of the events table under ``sf_dir``."""
    return stream_glob(sf_dir, "events")
