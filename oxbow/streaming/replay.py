"""Replay as Structured Streaming jobs (ST3, ST4, ST7, SNK6, JOB4).

``stream_replay`` -- paced replay. A ``rate`` stream is the clock. In
micro-batch k the history rows with ``lo < replay time <= hi`` go out, where
``hi`` is the newest clock tick in the batch and ``lo`` the tick before its first
one. With no ``lo`` yet there is no lower bound, so rows whose replay time has
already passed (the backlog) go out at once; nothing is dropped. Which ticks belong
to a batch is in the stream's offset log, so a batch run again after a failure emits
the same rows. Sinks write one folder per batch id in overwrite mode, so a re-run
replaces rather than duplicates.

Each micro-batch reads only its slice of the history: the replay-time window
is mapped back to a source-time window (rate > 0), which reaches the scan as
a pushed filter; the exact replay-time test follows.

``stream_replay_files`` -- bounded replay of a finite slice. The slice is
exported once as JSON lines, partitioned by batch; then a streaming source whose
offsets are batch numbers (``streaming.source``) reads batch after batch, and each
micro-batch is emitted in order. A restart keeps the finished export and goes on at
the offset log of the stream's checkpoint.

``stream_replay_timers`` -- paced replay of exported batches by keyed state and
processing-time timers.

All fail before they start when a row of the history has no valid timestamp.
"""

from __future__ import annotations

import re
import time
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from oxbow.functions.messages import JSON_READ_OPTIONS, JSON_WRITE_OPTIONS, envelope, row_json
from oxbow.functions.timefmt import EPOCH, replay_time, ts_lit
from oxbow.operators.replay import ENRICH_COLUMNS, Replay, assign_batches, check_timestamps, enrich
from oxbow.plans.ordering import PREFIX
from oxbow.session import hadoop_path
from oxbow.sinks import messages as msg_sink
from oxbow.sources.files import read_jsonl
from oxbow.streaming.source import parse_lines, read_batches

_BATCH = ("_batch_id", "_batch_start", "_batch_end")
#: Rows of an exported file.
EXPORT_ROWS = 200_000


def _epoch_micros(c) -> F.Column:
    """Microseconds since the epoch of a ``timestamp_ntz`` read as UTC."""
    return F.timestamp_diff("MICROSECOND", ts_lit(EPOCH), c)


def _us(t: datetime) -> int:
    return (t - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def clock_bounds(clock: DataFrame) -> tuple[int | None, int] | None:
    """(lo, hi) of a micro-batch of the clock, which ticks once a second: ``lo`` is
    the tick before its first one, so the ``hi`` of the batch before, and None if
    that is the clock's first tick. A batch that runs again has the same ticks, by
    the offset log, so the same bounds. None for a batch without ticks."""
    first, lo, hi = clock.agg(F.min("value"), F.min(F.unix_micros("timestamp")), F.max(F.unix_micros("timestamp"))).first()
    if hi is None:
        return None
    return (None if first == 0 else lo - 1_000_000), hi


def _emit(rows: DataFrame, sink: str, out: str | None, batch_id: int, payload: list[str],
          attributes: list[str]) -> None:
    """Write one micro-batch in emission order to the chosen sink: partitions are
    ranges of the time and a prefix of the text, and whole texts are compared within."""
    text = rows.withColumn("_json", row_json(rows, payload))
    ordered = (text.repartitionByRange("_replay_ts", F.substring("_json", 1, PREFIX))
               .sortWithinPartitions("_replay_ts", "_json").select(*payload))
    name = f"{batch_id:08d}"
    if sink == "parquet":
        ordered.write.mode("overwrite").parquet(f"{out}/batch_id={name}")
    elif sink == "json":
        ordered.write.mode("overwrite").options(**JSON_WRITE_OPTIONS).json(f"{out}/batch_id={name}")
    elif sink == "messages":
        msg_sink.publish(envelope(ordered, attributes), out, batch=name)
    elif sink == "console":
        msg_sink.publish(envelope(ordered, attributes), None)
    else:
        raise ValueError(f"unknown sink {sink!r}")


def source_window(r: Replay, lo_us: int | None, hi_us: int) -> tuple[datetime, datetime]:
    """Source times (both ends included) that cover the replay times in
    (lo, hi], one second wider on each side for rounding and never outside the
    series. At rate 0 every source time has the same replay time."""
    if r.rate == 0:
        return r.start, r.end

    def back(us: int, pad: int) -> datetime:
        seconds = (us - _us(r.replay_start)) / 1e6 / r.rate + pad
        return r.start + timedelta(seconds=min(max(seconds, 0.0), (r.end - r.start).total_seconds()))
    return (r.start if lo_us is None else back(lo_us, -1)), back(hi_us, 1)


def stream_replay(spark: SparkSession, history: DataFrame, r: Replay, *, checkpoint: str,
                  out: str | None = None, sink: str = "parquet",
                  attributes: list[str] | tuple[str, ...] = (), trigger_seconds: float = 1.0, timeout: float | None = None,
                  poll_seconds: float = 0.2) -> dict:
    """ST3/ST4: paced replay until every row of the slice has gone out.

    ``sink``: "parquet", "json" or "messages" (a folder per batch under ``out``),
    or "console". Returns the number of micro-batches that emitted and the last
    clock time. With ``timeout`` (seconds), rows that are left then raise
    ``TimeoutError``; a later call with the same checkpoint goes on from there.
    """
    ts = r.ts_field
    check_timestamps(history, ts)
    payload = list(history.columns) + list(ENRICH_COLUMNS)
    sliced = assign_batches(history, r, ts).drop(*_BATCH)
    last_us = (enrich(sliced, r, ts, publish=False, keep_replay_ts=True)
               .select(F.max(_epoch_micros(F.col("_replay_ts"))).alias("m")).first()["m"])
    done = {"emitted_batches": 0, "last_hi": None}

    def each(clock: DataFrame, batch_id: int) -> None:
        bounds = clock_bounds(clock)
        if bounds is None:
            return                          # the rate source's first batch is empty
        lo, hi = bounds
        first = _us(r.replay_start)
        if last_us is not None and hi >= first and (lo is None or lo < last_us):
            a, z = source_window(r, lo, hi)
            src = sliced.where((F.col(ts) >= ts_lit(a)) & (F.col(ts) <= ts_lit(z)))
            rows = enrich(src, r, ts, publish=True, keep_replay_ts=True)
            us = _epoch_micros(F.col("_replay_ts"))
            cond = us <= F.lit(hi) if lo is None else (us <= F.lit(hi)) & (us > F.lit(lo))
            _emit(rows.where(cond), sink, out, batch_id, payload, list(attributes))
            done["emitted_batches"] += 1
        done["last_hi"] = hi

    def finished() -> bool:
        return last_us is None or (done["last_hi"] is not None and done["last_hi"] >= last_us)

    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    q = (clock.writeStream.foreachBatch(each).option("checkpointLocation", f"{checkpoint}/clock")
         .trigger(processingTime=f"{trigger_seconds} seconds").start())
    started = time.time()
    try:
        while not finished():
            if not q.isActive:
                raise q.exception() or RuntimeError("the replay stream ended before its last row")
            if timeout is not None and time.time() - started > timeout:
                raise TimeoutError(f"rows are left to replay after {timeout} s")
            time.sleep(poll_seconds)
    finally:
        _stop_when_idle(q)
    return done


def _stop_when_idle(q) -> None:
    """Stop between micro-batches, however long the running one takes."""
    while q.isActive and q.status.get("isTriggerActive"):
        time.sleep(0.02)
    q.stop()


def _export(spark: SparkSession, history: DataFrame, r: Replay, path: str) -> None:
    """The slice as JSON lines by batch, once; a finished export is kept."""
    fs, finished = hadoop_path(spark, f"{path}/_SUCCESS")
    if fs.exists(finished):
        return
    check_timestamps(history, r.ts_field)
    # By time, so that a task writes few batches and a batch comes from few tasks.
    (assign_batches(history, r, r.ts_field).drop("_batch_start", "_batch_end").repartitionByRange(F.col(r.ts_field))
     .write.mode("overwrite").partitionBy("_batch_id").option("maxRecordsPerFile", EXPORT_ROWS)
     .options(**JSON_WRITE_OPTIONS).json(path))


def stream_replay_files(spark: SparkSession, history: DataFrame, r: Replay, *, workdir: str,
                        sink: str = "parquet", attributes: list[str] | tuple[str, ...] = ()) -> str:
    """ST7: bounded replay through exported files, batch after batch; returns
    the output folder (one folder per micro-batch, ordered within)."""
    ts, out = r.ts_field, f"{workdir}/out"
    _export(spark, history, r, f"{workdir}/export")
    payload = list(history.columns) + list(ENRICH_COLUMNS)
    lines = read_batches(spark, f"{workdir}/export", r.n_batches(), f"{workdir}/checkpoint")

    def each(batch: DataFrame, batch_id: int) -> None:
        # a micro-batch is one batch, so its number is the batch's
        rows = parse_lines(batch, history.schema, JSON_READ_OPTIONS)
        _emit(enrich(rows, r, ts, publish=True, keep_replay_ts=True), sink, out, batch_id, payload, list(attributes))

    q = lines.writeStream.foreachBatch(each).option("checkpointLocation", f"{workdir}/checkpoint").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return out


class _Hold(StatefulProcessor):
    """Holds the lines of one second of replay time until that second is over."""

    def init(self, handle) -> None:
        self.handle = handle
        self.lines = handle.getListState("lines", "line string")

    def handleInputRows(self, key, rows, timerValues):
        self.lines.appendList([(r["line"],) for r in rows])
        self.handle.registerTimer((key[0] + 1) * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        for (line,) in self.lines.get():
            yield Row(line=line)
        self.lines.clear()

    def close(self) -> None:
        pass


def stream_replay_timers(spark: SparkSession, history: DataFrame, r: Replay, *, workdir: str, sink: str = "parquet",
                         attributes: list[str] | tuple[str, ...] = (), spread_keys: int = 8, trigger_seconds: float = 1.0,
                         timeout: float | None = None, poll_seconds: float = 0.2) -> str:
    """ST3/ST4 with state and timers: paced replay of exported batches; returns the
    output folder (one folder per micro-batch, ordered within).

    The source gives out a batch when the replay time of its first row comes, so
    state holds a batch or two, never the whole history. Rows whose time is past go
    out at once; the others are held in state, by second of replay time and
    ``spread_keys`` parts (so a busy second is spread), until a processing-time timer
    at the second's end lets them go: never early, at most a second and a trigger
    late. Offsets, state and timers are the engine's, so a killed replay goes on
    where it was. With ``timeout``, rows that are left then raise ``TimeoutError``.
    """
    ts, out, checkpoint = r.ts_field, f"{workdir}/out", f"{workdir}/checkpoint"
    _export(spark, history, r, f"{workdir}/export")
    payload = list(history.columns) + list(ENRICH_COLUMNS)
    batches, step = r.n_batches(), round(r.batch_seconds * r.rate * 1e6)
    lines = read_batches(spark, f"{workdir}/export", batches, checkpoint, _us(r.replay_start), step).select("line")
    time_of = F.from_json("line", T.StructType([history.schema[ts]]), {**JSON_READ_OPTIONS, "mode": "FAILFAST"})[ts]
    due = _epoch_micros(replay_time(time_of, r.start, r.replay_start, r.rate))
    timed = lines.withColumn("second", F.floor(due / 1_000_000)).withColumn("past", due <= F.unix_micros(F.current_timestamp()))
    held = (timed.where("NOT past").withColumn("part", F.pmod(F.xxhash64("line"), F.lit(spread_keys)))
            .groupBy("second", "part").transformWithState(_Hold(), "line string", "Append", "ProcessingTime"))

    def each(batch: DataFrame, batch_id: int) -> None:
        rows = parse_lines(batch, history.schema, JSON_READ_OPTIONS)
        if not rows.isEmpty():
            _emit(enrich(rows, r, ts, publish=True, keep_replay_ts=True), sink, out, batch_id, payload, list(attributes))

    old = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        q = (timed.where("past").select("line").unionByName(held).writeStream.foreachBatch(each)
             .option("checkpointLocation", checkpoint).trigger(processingTime=f"{trigger_seconds} seconds").start())
    finally:
        spark.conf.set(_PROVIDER, old) if old else spark.conf.unset(_PROVIDER)
    started = time.time()
    try:
        while not _all_out(q, batches):
            if not q.isActive:
                raise q.exception() or RuntimeError("the replay stream ended before its last row")
            if timeout is not None and time.time() - started > timeout:
                raise TimeoutError(f"rows are left to replay after {timeout} s")
            time.sleep(poll_seconds)
    finally:
        q.stop()    # a micro-batch that is cut short runs again, into the same folder
    return out


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _all_out(q, batches: int) -> bool:
    """Whether the last micro-batch began behind the last batch and left no state."""
    progress = q.lastProgress
    if not batches or progress is None:
        return not batches
    begun = [re.search(r"batch\W+(\d+)", str(s["startOffset"])) for s in progress["sources"]]
    return (all(m and int(m[1]) == batches for m in begun)
            and all(s["numRowsTotal"] == 0 for s in progress["stateOperators"]))


def read_replay_output(spark: SparkSession, out: str, schema, sink: str = "parquet") -> DataFrame:
    """Read back a replay's file output (all batch folders)."""
    if sink == "json":
        return read_jsonl(spark, out, schema, recursive=True)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(out)
