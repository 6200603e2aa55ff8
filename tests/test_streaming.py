import json
import os
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from oxbow.operators import replay
from oxbow.sinks import messages
from oxbow.streaming import replay as streaming
from oxbow.streaming import source


def history(spark, n=40, step_ms=250):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(milliseconds=step_ms * i), float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, ts timestamp_ntz, v double"), start


def test_file_stream_replay_in_order(spark, workdir):
    h, start = history(spark, n=60, step_ms=1000)
    r = replay.Replay(start=start, end=start + timedelta(seconds=60), replay_start=start,
                      rate=0.5, batch_seconds=15, ts_field="ts")
    out = streaming.stream_replay_files(spark, h, r, workdir=f"file:{workdir}")
    assert out.startswith("file:")
    out = out.removeprefix("file:")
    batches = sorted(os.listdir(out))
    assert len([b for b in batches if b.startswith("batch_id=")]) == 4
    got = spark.read.parquet(f"{out}/*").collect()
    assert sorted(x.id for x in got) == list(range(60))
    # A second run finds every batch exported and the stream up to date.
    streaming.stream_replay_files(spark, h, r, workdir=f"file:{workdir}")
    assert spark.read.parquet(f"{out}/*").count() == 60
    seconds = [[x.ts for x in spark.read.parquet(f"{out}/{b}").collect()] for b in batches if b.startswith("batch")]
    assert all(max(a) < min(b) for a, b in zip(seconds, seconds[1:]))


def test_restart_between_batches_goes_by_the_offset_log(spark, workdir, monkeypatch):
    """Killed in batch 2 of 6: batches 0 and 1 are not read again, none is lost."""
    h, start = history(spark, n=120, step_ms=500)
    r = replay.Replay(start=start, end=start + timedelta(seconds=60), replay_start=start, rate=0.5, batch_seconds=10,
                      ts_field="ts")
    monkeypatch.setattr(streaming, "EXPORT_ROWS", 7)    # several files, so several input partitions, per batch
    emitted, emit = [], streaming._emit

    def failing(rows, sink, out, batch_id, *rest):
        if batch_id == 2 and emitted.count(2) == 0:
            emitted.append(2)
            raise RuntimeError("lost")
        emitted.append(batch_id)
        assert rows.rdd.getNumPartitions() >= 3
        emit(rows, sink, out, batch_id, *rest)
    monkeypatch.setattr(streaming, "_emit", failing)
    with pytest.raises(Exception, match="lost"):
        streaming.stream_replay_files(spark, h, r, workdir=workdir)
    assert emitted == [0, 1, 2] and source.newest_offset(spark, f"{workdir}/checkpoint") == 3
    out = streaming.stream_replay_files(spark, h, r, workdir=workdir)
    assert emitted == [0, 1, 2, 2, 3, 4, 5]
    assert sorted(x.id for x in spark.read.parquet(f"{out}/*").collect()) == list(range(120))
    streaming.stream_replay_files(spark, h, r, workdir=workdir)
    assert len(emitted) == 7 and source.newest_offset(spark, f"{workdir}/checkpoint") == 6


def test_empty_batches_and_empty_history(spark, workdir):
    h, start = history(spark, n=4, step_ms=15_000)      # batches 1, 3, 5 of 10 s hold nothing
    r = replay.Replay(start=start, end=start + timedelta(seconds=60), replay_start=start, rate=0, batch_seconds=10, ts_field="ts")
    out = streaming.stream_replay_files(spark, h, r, workdir=f"{workdir}/a")
    assert sorted(x.id for x in spark.read.parquet(f"{out}/*").collect()) == list(range(4))
    out = streaming.stream_replay_files(spark, h.limit(0), r, workdir=f"{workdir}/b")
    assert spark.read.schema(h.schema).parquet(f"{out}/*").count() == 0


def test_paced_replay_emits_everything_once(spark, workdir):
    h, start = history(spark, n=20, step_ms=250)       # 5 s of history
    now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    # Map the series so that half is already late and half is paced.
    r = replay.Replay(start=start, end=start + timedelta(seconds=5),
                      replay_start=start + (now - start) - timedelta(seconds=2), rate=1.0, ts_field="ts")
    ck, out = os.path.join(workdir, "ck"), os.path.join(workdir, "out")
    done = streaming.stream_replay(spark, h, r, checkpoint=ck, out=out, timeout=60)
    got = spark.read.parquet(f"{out}/*")
    assert sorted(x.id for x in got.collect()) == list(range(20))
    assert done["emitted_batches"] >= 2
    # Emitted batch folders each hold rows whose replay time is past.
    assert got.where(F.col("_publish_timestamp") < F.col("_replay_timestamp")).count() == 0


def test_restart_keeps_bounds(spark, workdir):
    h, start = history(spark, n=16, step_ms=500)       # 8 s of history
    now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    r = replay.Replay(start=start, end=start + timedelta(seconds=8),
                      replay_start=start + (now - start) + timedelta(seconds=1), rate=1.0, ts_field="ts")
    ck, out = os.path.join(workdir, "ck"), os.path.join(workdir, "out")
    with pytest.raises(TimeoutError):
        streaming.stream_replay(spark, h, r, checkpoint=ck, out=out, timeout=3)
    streaming.stream_replay(spark, h, r, checkpoint=ck, out=out, timeout=60)
    ids = [x.id for x in spark.read.parquet(f"{out}/*").collect()]
    assert sorted(ids) == list(range(16))


def test_timeout_raises_and_writes_nothing_by_halves(spark, workdir):
    h, start = history(spark, n=10)
    far = replay.Replay(start=start, end=start + timedelta(seconds=5), replay_start=datetime(2900, 1, 1), ts_field="ts")
    with pytest.raises(TimeoutError):
        streaming.stream_replay(spark, h, far, checkpoint=f"{workdir}/ck", out=f"{workdir}/out", timeout=0.1)
    assert not os.path.exists(f"{workdir}/out")


@pytest.mark.parametrize("rate", [0, 0.0001, 1.0])
@pytest.mark.parametrize("sink", ["messages", "json"])
def test_backlog_at_any_rate(spark, workdir, rate, sink):
    h, start = history(spark, n=12)
    r = replay.Replay(start=start, end=start + timedelta(seconds=60), replay_start=start, rate=rate, ts_field="ts")
    out = f"file:{workdir}/out"
    done = streaming.stream_replay(spark, h, r, checkpoint=f"file:{workdir}/ck", out=out, sink=sink,
                                   attributes=["id"], trigger_seconds=0.2)
    assert done["emitted_batches"] == 1
    if sink == "messages":
        got = messages.read_messages(spark, out).collect()
        assert sorted(int(r.attributes["id"]) for r in got) == list(range(12))
        assert all(json.loads(r.data)["_replay_timestamp"].endswith(" UTC") for r in got)
    else:
        payload = h.schema.add("_offset", "double").add("_replay_timestamp", "string").add("_publish_timestamp", "string")
        assert streaming.read_replay_output(spark, out, payload, "json").count() == 12


def test_console_sink(spark, workdir):
    h, start = history(spark, n=3)
    r = replay.Replay(start=start, end=start + timedelta(seconds=60), replay_start=start, rate=0, ts_field="ts")
    done = streaming.stream_replay(spark, h, r, checkpoint=f"{workdir}/ck", sink="console", trigger_seconds=0.2)
    assert done["emitted_batches"] == 1


def test_missing_timestamp_stops_the_replay(spark, workdir):
    h, start = history(spark, n=3)
    bad = h.unionByName(h.limit(1).withColumn("ts", F.lit(None).cast("timestamp_ntz")))
    r = replay.Replay(start=start, end=start + timedelta(seconds=60), replay_start=start, ts_field="ts")
    with pytest.raises(ValueError):
        streaming.stream_replay(spark, bad, r, checkpoint=f"{workdir}/ck", out=f"{workdir}/out")
    with pytest.raises(ValueError):
        streaming.stream_replay_files(spark, bad, r, workdir=workdir)


def test_timers_kill_and_resume(spark, workdir):
    """Backlog at once, the rest held until its second is over; killed half way, nothing is lost or repeated."""
    h, start = history(spark, n=40, step_ms=750)       # 30 s of history, in two batches
    now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    r = replay.Replay(start=start, end=start + timedelta(seconds=30), replay_start=now + timedelta(seconds=2),
                      rate=1.0, ts_field="ts", batch_seconds=15)
    with pytest.raises(TimeoutError):
        streaming.stream_replay_timers(spark, h, r, workdir=workdir, timeout=14, trigger_seconds=0.5)
    out = streaming.stream_replay_timers(spark, h, r, workdir=workdir, timeout=120, trigger_seconds=0.5)
    got = spark.read.parquet(f"{out}/*")
    assert sorted(x.id for x in got.collect()) == list(range(40))
    assert got.where(F.col("_publish_timestamp") < F.col("_replay_timestamp")).count() == 0


def test_timers_on_backlog_and_nothing(spark, workdir):
    h, start = history(spark, n=12)
    r = replay.Replay(start=start, end=start + timedelta(seconds=60), replay_start=start, rate=0.5, ts_field="ts")
    out = streaming.stream_replay_timers(spark, h, r, workdir=f"{workdir}/a", timeout=100, trigger_seconds=0.2)
    assert sorted(x.id for x in spark.read.parquet(f"{out}/*").collect()) == list(range(12))
    streaming.stream_replay_timers(spark, h.limit(0), r, workdir=f"{workdir}/b", timeout=100, trigger_seconds=0.2)
    assert not os.path.exists(f"{workdir}/b/out")


def test_clock_bounds_meet(spark, workdir):
    """The bounds of the clock's micro-batches follow on one another without a gap, also over a restart."""
    seen = []

    def each(clock, batch_id):
        if (b := streaming.clock_bounds(clock)) is not None:
            seen.append(b)

    for wanted in (3, 6):
        q = (spark.readStream.format("rate").option("rowsPerSecond", 1).load().writeStream.foreachBatch(each)
             .option("checkpointLocation", f"{workdir}/clock").trigger(processingTime="1 seconds").start())
        while len(seen) < wanted and q.isActive:
            time.sleep(0.1)
        streaming._stop_when_idle(q)
    assert seen[0][0] is None
    assert all(a[1] == b[0] for a, b in zip(seen, seen[1:]))
