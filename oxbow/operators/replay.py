"""Time-series replay, batch side (SRC5, FLT4, FLT5, ST1, ST2, ST5, ST6, SO2).

A replay takes the rows of a table with ``start <= ts < end``, cuts the span
into consecutive half-open batches of N seconds (the last one clamped at
``end``), gives each row its replay time

    replay_start + (ts - series_start) x rate

and emits batch after batch in (ts, row JSON) order, each row enriched with
``_offset`` (unscaled seconds), ``_replay_timestamp`` and
``_publish_timestamp`` (text, microseconds, ' UTC').

Rate is a time factor: 0.1 replays ten times faster, 0 emits everything at
once, 2 at half speed. Only a negative rate is rejected.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from oxbow.functions.messages import row_json
from oxbow.functions.timefmt import (elapsed_micros, format_ts, now_text, offset_seconds,
                                     parse_ts, replay_time, ts_lit)
from oxbow.plans.ordering import text_key, with_ordinal_by_text, with_ordinal_within
from oxbow.sources.tables import time_slice

ENRICH_COLUMNS = ("_offset", "_replay_timestamp", "_publish_timestamp")


@dataclass(frozen=True)
class Replay:
    """Parameters of one replay; checked before any job starts (FLT5)."""

    start: datetime                 # series start (first batch starts here)
    end: datetime                   # exclusive end of the slice
    replay_start: datetime          # wall-clock time that ``start`` maps to
    rate: float = 1.0
    batch_seconds: int = 3600
    ts_field: str = "timestamp"

    def __post_init__(self):
        if self.replay_start < self.start:
            raise ValueError(f"replay cannot begin at {self.replay_start}, before its series at {self.start}")
        if self.rate < 0:
            raise ValueError("rate must not be negative")
        if self.batch_seconds <= 0:
            raise ValueError("batch_seconds must be positive")

    def batches(self) -> list[tuple[datetime, datetime]]:
        """ST1 on the driver: (batch_start, batch_end) pairs tiling [start, end)."""
        out, b = [], self.start
        step = timedelta(seconds=self.batch_seconds)
        while b < self.end:
            e = min(self.end, b + step)
            out.append((b, e))
            b = e
        return out

    def n_batches(self) -> int:
        span = (self.end - self.start).total_seconds()
        return max(0, math.ceil(span / self.batch_seconds))


def batch_table(spark: SparkSession, r: Replay) -> DataFrame:
    """ST1 as a table: (batch_id, batch_start, batch_end); the last clamped."""
    step = r.batch_seconds
    return (spark.range(r.n_batches()).select(
        F.col("id").alias("batch_id"),
        F.timestamp_add("SECOND", F.col("id") * step, ts_lit(r.start)).alias("batch_start"),
        F.least(F.timestamp_add("SECOND", (F.col("id") + 1) * step, ts_lit(r.start)),
                ts_lit(r.end)).alias("batch_end")))


def batch_id(ts: Column | str, r: Replay) -> Column:
    """Batch of a row: floor(offset / N), the tumbling window anchored at start."""
    return F.floor(elapsed_micros(ts, r.start) / F.lit(r.batch_seconds * 1_000_000)).cast("long")


def assign_batches(df: DataFrame, r: Replay, ts_col: str | None = None) -> DataFrame:
    """Rows of the slice with ``_batch_id``, ``_batch_start``, ``_batch_end``."""
    ts = ts_col or r.ts_field
    b = batch_id(ts, r)
    start = F.timestamp_add("SECOND", b * r.batch_seconds, ts_lit(r.start))
    end = F.least(F.timestamp_add("SECOND", (b + 1) * r.batch_seconds, ts_lit(r.start)),
                  ts_lit(r.end))
    return (time_slice(df, ts, r.start, r.end)
            .withColumn("_batch_id", b).withColumn("_batch_start", start)
            .withColumn("_batch_end", end))


def batch_sizes(df: DataFrame, r: Replay, ts_col: str | None = None) -> DataFrame:
    """Rows per batch (what each batch export would hold)."""
    ts = ts_col or r.ts_field
    return (assign_batches(df, r, ts)
            .groupBy(F.col("_batch_id").alias("batch_id"), F.col("_batch_start").alias("batch_start"),
                     F.col("_batch_end").alias("batch_end"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"),
                 F.max(ts).alias("last_ts")))


def _tagged(df: DataFrame, ts_col: str) -> DataFrame:
    """``df`` with ``_ts`` (parsed) and ``_error`` (null for a good row)."""
    is_text = dict(df.dtypes)[ts_col] == "string"
    parsed = parse_ts(ts_col) if is_text else F.col(ts_col)
    raw = F.col(ts_col)
    missing = raw.isNull() | (F.trim(raw.cast("string")) == "") if is_text else raw.isNull()
    err = F.when(missing, F.lit("missing timestamp")).when(parsed.isNull(),
                                                           F.lit("unparseable timestamp"))
    return df.withColumn("_ts", parsed).withColumn("_error", err)


def split_bad_rows(df: DataFrame, ts_col: str) -> tuple[DataFrame, DataFrame]:
    """FLT4: (good, bad). A row is bad when its timestamp is missing, empty or
    unparseable; bad rows carry ``_error``. Text timestamps are parsed. Each of the
    two reads ``df`` on its own; ``quarantine`` reads it once."""
    tagged = _tagged(df, ts_col)
    good = tagged.where(F.col("_error").isNull()).drop("_error")
    bad = tagged.where(F.col("_error").isNotNull()).drop("_ts")
    return good, bad


def quarantine(df: DataFrame, ts_col: str, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """FLT4 in one pass: (good, bad, counts). ``df`` is read once, and its rows are
    written to ``path`` by verdict; the counts ("good", "bad") are observed on the way.
    Reading one side back opens only its folder."""
    tagged = _tagged(df, ts_col).withColumn("_verdict", F.when(F.col("_error").isNull(), "good").otherwise("bad"))
    seen = Observation()
    (tagged.observe(seen, F.count_if(F.col("_verdict") == "good").alias("good"), F.count_if(F.col("_verdict") == "bad").alias("bad"))
     .write.mode("overwrite").partitionBy("_verdict").parquet(path))
    written = df.sparkSession.read.schema(tagged.schema).parquet(path)
    good = written.where(F.col("_verdict") == "good").drop("_error", "_verdict")
    bad = written.where(F.col("_verdict") == "bad").drop("_ts", "_verdict")
    return good, bad, dict(seen.get)


def require_timestamps(df: DataFrame, ts_col: str) -> DataFrame:
    """FLT4, strict and lazy: a query fails on the first row whose timestamp is
    missing or cannot be parsed; the column becomes a timestamp."""
    parsed = parse_ts(ts_col) if dict(df.dtypes)[ts_col] == "string" else F.col(ts_col)
    msg = F.concat(F.lit(f"no valid {ts_col} in row "), F.to_json(F.struct("*")))
    return df.withColumn(ts_col, F.when(parsed.isNull(), F.raise_error(msg)).otherwise(parsed))


def check_timestamps(df: DataFrame, ts_col: str) -> None:
    """FLT4, strict and eager: raise ``ValueError`` when a row has no valid
    timestamp. Kept apart from the replay, whose time filters then still reach
    the scan; on a typed column the test is a pushed IS NULL."""
    _, bad = split_bad_rows(df, ts_col)
    first = bad.first()
    if first is not None:
        raise ValueError(f"{first['_error']}: {first.asDict()}")


def enrich(df: DataFrame, r: Replay, ts_col: str | None = None, publish: bool = True,
           keep_replay_ts: bool = False) -> DataFrame:
    """ST2 + ST5: add ``_offset``, ``_replay_timestamp`` (and
    ``_publish_timestamp``). ``keep_replay_ts`` also keeps ``_replay_ts``
    (timestamp_ntz) for pacing and ordering."""
    ts = ts_col or r.ts_field
    rts = replay_time(ts, r.start, r.replay_start, r.rate)
    out = (df.withColumn("_offset", offset_seconds(ts, r.start))
             .withColumn("_replay_ts", rts)
             .withColumn("_replay_timestamp", format_ts("_replay_ts")))
    if publish:
        out = out.withColumn("_publish_timestamp", now_text())
    return out if keep_replay_ts else out.drop("_replay_ts")


def replay_schedule(df: DataFrame, r: Replay, ts_col: str | None = None,
                    publish: bool = True) -> DataFrame:
    """The slice with batch ids and replay columns (no waiting, no sink)."""
    ts = ts_col or r.ts_field
    return enrich(assign_batches(df, r, ts), r, ts, publish=publish, keep_replay_ts=True)


def emission_order(df: DataFrame, ts_col: str, payload: list[str] | None = None) -> list[Column]:
    """SO2: by timestamp, ties broken by the row's JSON text."""
    return [F.col(ts_col).asc_nulls_first(), row_json(df, payload).asc_nulls_first()]


def replay_order(df: DataFrame, r: Replay, ts_col: str | None = None, keep: list[str] | None = None,
                 stable_input: bool = False) -> DataFrame:
    """ST6: each row's position ``_seq`` inside its batch in emission order.

    Numbered with a distributed range sort (``plans.ordering``), so a batch
    holding a large share of all rows is still spread over many tasks. ``keep``
    names the columns to return (all by default); the others are only sorted by.
    ``stable_input``: see ``plans.ordering.with_ordinal``.
    """
    ts = ts_col or r.ts_field
    payload = df.columns
    b = assign_batches(df, r, ts)
    rows = b.select(*(b.columns if keep is None else keep), F.col(ts).alias("_sort_ts"),
                    row_json(b, payload).alias("_json"))
    return with_ordinal_within(rows, "_batch_id", ["_sort_ts"], "_seq", text="_json",
                               stable_input=stable_input, drop=("_sort_ts", "_json"))


def sort_json_lines(lines: DataFrame, field: str, text_col: str = "value",
                    name: str = "_line_no", stable_input: bool = False) -> DataFrame:
    """SO2 + SC20 on raw JSON-lines text: order by the field's text
    (``get_json_object``), ties broken by the whole line, numbered 1..n with
    the distributed ordinal (no single-task sort). Field and line may be long:
    only a prefix of them takes part in range partitioning."""
    key = F.get_json_object(F.col(text_col), f"$.{field}")
    line = F.coalesce(F.col(text_col), F.lit(""))
    sortable = (lines.withColumn("_sort_key", text_key(F.coalesce(key, F.lit("")), line))
                .withColumn("_sort_has", key.isNotNull()))
    return with_ordinal_by_text(sortable, ["_sort_has"], "_sort_key", name, stable_input=stable_input,
                                drop=("_sort_key", "_sort_has"))
