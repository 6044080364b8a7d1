"""Streaming log queries over replayed files: ordered replay matches the
batch answer; replaying late files makes the watermark drop rows."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from kestrel.plans import fixtures, logs
from kestrel.sources.tables import read_table
from kestrel.streaming import logs as stream_logs
from tests.conftest import SMALL_DIR

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value"]


def _write_replay(spark, order):
    """Split events into 4 time slices, written one by one in ``order`` so
    file modification times follow it. Returns the folder."""
    folder = tempfile.mkdtemp(prefix="kestrel-replay-")
    ev = read_table(spark, SMALL_DIR, "events", EVENT_COLS)
    bounds = ev.agg(F.min("ts"), F.max("ts")).first()
    lo, hi = bounds[0], bounds[1]
    step = (hi - lo) / 4
    for n, i in enumerate(order):
        start, end = lo + step * i, lo + step * (i + 1)
        part = ev.filter((F.col("ts") >= start) & ((F.col("ts") < end) if i < 3 else F.lit(True)))
        part.coalesce(1).write.parquet(os.path.join(folder, f"slice={n}"))
        # Spark names files by task; give each slice a distinct, increasing mtime.
        for root, _dirs, files in os.walk(os.path.join(folder, f"slice={n}")):
            for f in files:
                os.utime(os.path.join(root, f), (1_700_000_000 + n * 10, 1_700_000_000 + n * 10))
    return folder + "/slice=*/*.parquet"


def _batch_windows(spark):
    lines = fixtures.log_lines(spark, SMALL_DIR)
    return {(r.window_start, r.window_end): r.datanode_count
            for r in logs.datanode_windows(lines).collect()}


@pytest.fixture(scope="module")
def utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def test_ordered_replay_update_equals_batch(utc):
    spark = utc
    path = _write_replay(spark, [0, 1, 2, 3])
    run = stream_logs.stream_datanode_windows(spark, path, "update", max_files_per_trigger=1)
    got = {(r.window_start, r.window_end): r.datanode_count for r in run.result.collect()}
    assert got == _batch_windows(spark)
    assert run.rows_dropped_by_watermark() == 0
    assert len(run.progress) >= 4


def test_late_replay_drops_rows(utc):
    spark = utc
    path = _write_replay(spark, [3, 2, 1, 0])
    run = stream_logs.stream_datanode_windows(spark, path, "update", max_files_per_trigger=1)
    got = {(r.window_start, r.window_end): r.datanode_count for r in run.result.collect()}
    assert run.rows_dropped_by_watermark() > 0
    assert len(got) < len(_batch_windows(spark))


def test_append_holds_back_open_windows(utc):
    spark = utc
    path = _write_replay(spark, [0, 1, 2, 3])
    run = stream_logs.stream_datanode_windows(spark, path, "append", max_files_per_trigger=1)
    batch = _batch_windows(spark)
    got = {(r.window_start, r.window_end): r.datanode_count for r in run.result.collect()}
    # Windows the final watermark has not passed are never emitted in append mode.
    assert 0 < len(got) < len(batch)
    assert all(batch[k] == v for k, v in got.items())


def test_complete_mode_ignores_order(utc):
    spark = utc
    path = _write_replay(spark, [3, 2, 1, 0])
    run = stream_logs.stream_bytes_per_host(spark, path, max_files_per_trigger=1)
    got = {r.hostname: r.total_bytes for r in run.result.collect()}
    lines = fixtures.log_lines(spark, SMALL_DIR)
    want = {r.hostname: r.total_bytes for r in logs.bytes_per_host(lines).collect()}
    assert got == want
    counts = {r.hostname: r["count"] for r in stream_logs.stream_info_block_counts(spark, path, 1).result.collect()}
    assert counts == {r.hostname: r["count"] for r in logs.info_block_counts(lines).collect()}


def test_sliding_windows_count_each_row_twice(utc):
    spark = utc
    lines = fixtures.log_lines(spark, SMALL_DIR)
    rows = lines.filter(F.col("value").contains("DataNode")).count()
    assert sum(_batch_windows(spark).values()) == 2 * rows


def test_processing_time_trigger_with_timed_stop(utc):
    """ST8/ST9: a processing-time trigger, stopped after a fixed time."""
    from kestrel.streaming.runner import run_stream
    spark = utc
    path = _write_replay(spark, [0, 1, 2, 3])
    q = logs.info_block_counts(stream_logs.line_stream(spark, path, max_files_per_trigger=1))
    run = run_stream(spark, q, "complete", name="timed", processing_time="1 second", timeout_s=12)
    got = {r.hostname: r["count"] for r in run.result.collect()}
    lines = fixtures.log_lines(spark, SMALL_DIR)
    assert got == {r.hostname: r["count"] for r in logs.info_block_counts(lines).collect()}


def test_final_answer_reads_batch_folders(spark):
    """Each micro-batch lives in its own folder, so a re-run batch replaces
    its output; readers pick the last batch (complete) or latest per key."""
    from kestrel.streaming.runner import BATCH_COL, final_answer
    folder = tempfile.mkdtemp(prefix="kestrel-sink-")
    spark.createDataFrame([("a", 1), ("b", 1)], "k string, n int").write.parquet(f"{folder}/{BATCH_COL}=0")
    spark.createDataFrame([("a", 2)], "k string, n int").write.parquet(f"{folder}/{BATCH_COL}=1")
    # batch 1 written again (a retry): overwrite, not append
    spark.createDataFrame([("a", 2)], "k string, n int").write.mode("overwrite").parquet(f"{folder}/{BATCH_COL}=1")
    written = spark.read.parquet(folder)
    assert sorted(tuple(r) for r in final_answer(written, "complete").collect()) == [("a", 2)]
    assert sorted(tuple(r) for r in final_answer(written, "update", ["k"]).collect()) == [("a", 2), ("b", 1)]
    assert final_answer(written, "append").count() == 3


def test_text_line_stream_with_arrival_time(utc):
    from kestrel.sources.raw_inputs import log_line_stream
    from kestrel.streaming.runner import run_stream
    spark = utc
    folder = tempfile.mkdtemp(prefix="kestrel-text-")
    with open(os.path.join(folder, "part-0.log"), "w") as f:
        f.write("INFO dfs.DataNode$DataXceiver: Receiving block blk_1 src: /10.0.0.5:50010 of size 10\n")
        f.write("INFO dfs.DataNode$DataXceiver: Receiving block blk_2 src: /10.0.0.5:50010 of size 20\n")
        f.write("WARN nothing here\n")
    lines = logs.with_watermark(log_line_stream(spark, folder))
    run = run_stream(spark, logs.bytes_per_host(lines), "complete", name="text-lines")
    assert {r.hostname: r.total_bytes for r in run.result.collect()} == {"10.0.0.5": 30, "": None}


def test_rerun_with_same_checkpoint_resumes(utc):
    """A second run with the same sink and checkpoint processes only the new
    files; the final complete answer covers all of them."""
    import shutil
    from kestrel.session import scratch_path
    from kestrel.streaming.runner import run_stream
    spark = utc
    src = _write_replay(spark, [0, 1, 2, 3]).split("/slice=")[0]
    live = tempfile.mkdtemp(prefix="kestrel-live-")
    sink, ckpt = scratch_path(spark, "resume-sink"), scratch_path(spark, "resume-ckpt")

    def run():
        q = logs.info_block_counts(stream_logs.line_stream(spark, live + "/slice=*/*.parquet", 1))
        return run_stream(spark, q, "complete", name="resume", sink_path=sink, checkpoint_path=ckpt)

    for n in (0, 1):
        shutil.copytree(f"{src}/slice={n}", f"{live}/slice={n}")
    first = run()
    assert len(first.progress) >= 2
    for n in (2, 3):
        shutil.copytree(f"{src}/slice={n}", f"{live}/slice={n}")
    second = run()
    got = {r.hostname: r["count"] for r in second.result.collect()}
    lines = fixtures.log_lines(spark, SMALL_DIR)
    assert got == {r.hostname: r["count"] for r in logs.info_block_counts(lines).collect()}
    # The second run saw only the two new files.
    assert sum(p["numInputRows"] for p in second.progress) < lines.count()


def test_sinks_stay_bounded(utc, monkeypatch):
    from kestrel.streaming import runner
    spark = utc
    monkeypatch.setattr(runner, "COMPACT_EVERY", 2)
    path = _write_replay(spark, [0, 1, 2, 3])
    run = stream_logs.stream_datanode_windows(spark, path, "update", max_files_per_trigger=1)
    got = {(r.window_start, r.window_end): r.datanode_count for r in run.result.collect()}
    assert got == _batch_windows(spark)
    assert len([d for d in os.listdir(run.sink_path.removeprefix("file:")) if d.startswith(runner.BATCH_COL)]) <= 2
    run = stream_logs.stream_bytes_per_host(spark, path, max_files_per_trigger=1)
    assert len([d for d in os.listdir(run.sink_path.removeprefix("file:")) if d.startswith(runner.BATCH_COL)]) == 1
    assert run.finished


def test_a_run_that_is_cut_short_raises(utc):
    from kestrel.streaming.runner import run_stream
    spark = utc
    path = _write_replay(spark, [0, 1, 2, 3])
    query = logs.datanode_windows(stream_logs.line_stream(spark, path, 1))
    with pytest.raises(TimeoutError):
        run_stream(spark, query, "update", keys=["window_start", "window_end"], timeout_s=0.01)


def _commits(run):
    """Batches that the run's checkpoint planned, and those it committed."""
    names = lambda part: {int(f) for f in os.listdir(f"{run.checkpoint_path.removeprefix('file:')}/{part}") if f.isdigit()}
    return names("offsets"), names("commits")


def test_interrupted_run_resumes_and_counts_no_window_twice(utc, monkeypatch):
    spark = utc
    runs = []
    run_stream = stream_logs.run_stream

    def noted(*args, **kwargs):
        runs.append(run_stream(*args, **kwargs))
        if len(runs) == 1:
            planned, committed = _commits(runs[0])
            assert planned - committed == {max(planned)} and len(planned) == stream_logs.STOP_AFTER
        return runs[-1]
    monkeypatch.setattr(stream_logs, "run_stream", noted)
    got = stream_logs.interrupted_text_windows(spark, SMALL_DIR).result.collect()
    assert len({(r.window_start, r.window_end) for r in got}) == len(got)
    assert {(r.window_start, r.window_end): r.datanode_count for r in got} == _batch_windows(spark)
    assert [r.finished for r in runs] == [False, True]
    # The batch that was cut off is planned again under its number.
    assert min(int(p["batchId"]) for p in runs[1].progress) == stream_logs.STOP_AFTER - 1


def test_trigger_run_ends_when_its_input_is_used_up(utc):
    spark = utc
    run = stream_logs.triggered_info_block_counts(spark, SMALL_DIR, trigger="200 milliseconds")
    assert run.finished and sum(p["numInputRows"] for p in run.progress) == 1000
    lines = fixtures.log_lines(spark, SMALL_DIR)
    assert {r.hostname: r["count"] for r in run.result.collect()} == {
        r.hostname: r["count"] for r in logs.info_block_counts(lines).collect()}


def test_trigger_run_that_times_out_raises(utc):
    from kestrel.streaming.runner import run_stream
    spark = utc
    query = logs.info_block_counts(stream_logs.line_stream(spark, _write_replay(spark, [0, 1, 2, 3]), 1))
    with pytest.raises(TimeoutError):
        run_stream(spark, query, "complete", processing_time="1 hour", timeout_s=3, until_idle=True)


def test_state_on_disk_gives_the_same_windows(utc):
    """The text replay on RocksDB state with changelog checkpoints, against the
    event replay on memory state; the session's setting is put back."""
    spark = utc
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    disk = stream_logs.replay_text_windows(spark, SMALL_DIR)
    memory = stream_logs.replay_datanode_windows(spark, SMALL_DIR)
    read = lambda run: {(r.window_start, r.window_end): r.datanode_count for r in run.result.collect()}
    assert read(disk) == read(memory) != {}
    assert spark.conf.get(key) == before
    state = {f.rsplit(".", 1)[-1] for _, _, files in os.walk(f"{disk.checkpoint_path.removeprefix('file:')}/state") for f in files}
    assert "changelog" in state or "zip" in state


def test_dropped_windows_are_counted_over_all_batches(utc):
    """The listener keeps what the handle's own list has forgotten."""
    spark = utc
    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, "2")
    try:
        run = stream_logs.stream_datanode_windows(spark, _write_replay(spark, [3, 2, 1, 0]), "update", max_files_per_trigger=1)
    finally:
        spark.conf.unset(key)
    assert len(run.progress) <= 2 and len(run.dropped) >= 4
    assert sum(n > 0 for n in run.dropped.values()) >= 2
    whole, got = _batch_windows(spark), run.result.count()
    assert run.rows_dropped_by_watermark() >= len(whole) - got > 0
    rows = stream_logs.replay_dropped(spark, SMALL_DIR).orderBy("arrival").collect()
    assert [r.arrival for r in rows] == [0, 1, 2, 3, 4] and rows[0].watermark is None
    assert [r.dropped > 0 for r in rows] == [False] * 4 + [True]


def test_compaction_rewrites_a_row_once_a_tier(spark, monkeypatch):
    """64 batches of ten new keys and one old one in tiers of four."""
    from kestrel.streaming import runner
    monkeypatch.setattr(runner, "COMPACT_EVERY", 4)
    sink = tempfile.mkdtemp(prefix="kestrel-tiers-")
    folders = lambda: {float(d.split("=")[1]) for d in os.listdir(sink) if d.startswith(runner.BATCH_COL)}
    rewritten = []
    for n in range(64):
        spark.createDataFrame([(f"{n}-{k}", n) for k in range(10)] + [("hot", n)], "k string, n int").coalesce(1).write.parquet(
            f"{sink}/{runner.BATCH_COL}={n}")
        before = folders()
        runner._bound_sink(spark, sink, "update", ["k"], n)
        made = folders() - before
        rewritten.append(sum(spark.read.parquet(f"{sink}/{runner.BATCH_COL}={label:.3f}").count() for label in made))
        assert len(folders()) <= 3 * 4
    # 16 foldings of 41 rows, 4 of 161 (in one go with the first tier), one of 641.
    assert sum(rewritten) <= 12 * 41 + 3 * 161 + 641 and sorted(rewritten)[-2] == 161
    got = {r.k: r.n for r in runner.final_answer(runner._read_sink(spark, sink), "update", ["k"]).collect()}
    assert got == {f"{n}-{k}": n for n in range(64) for k in range(10)} | {"hot": 63}


def test_a_repeated_batch_keeps_what_was_folded_before(spark, monkeypatch):
    """A crash between folding and the batch's commit loses nothing."""
    from kestrel.streaming import runner
    monkeypatch.setattr(runner, "COMPACT_EVERY", 2)
    sink = tempfile.mkdtemp(prefix="kestrel-again-")
    put = lambda n, rows: spark.createDataFrame(rows, "k string, n int").write.mode("overwrite").parquet(f"{sink}/{runner.BATCH_COL}={n}")
    put(0, [("a", 0), ("b", 0)])
    for _ in range(3):
        put(1, [("b", 1)])
        runner._bound_sink(spark, sink, "update", ["k"], 1)
    got = runner.final_answer(runner._read_sink(spark, sink), "update", ["k"]).collect()
    assert sorted(tuple(r) for r in got) == [("a", 0), ("b", 1)] and len(os.listdir(sink)) == 1
