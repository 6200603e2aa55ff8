"""Timestamp text and replay-time arithmetic (SC11-SC15).

All timestamps here are ``timestamp_ntz`` (zone-free); differences and shifts
use ``timestampdiff`` / ``timestampadd`` in microseconds, which do not depend
on the session time zone.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The item timestamp text, 6 fraction digits on output, the
# fraction optional on input, always a literal ' UTC' suffix.
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS 'UTC'"
TS_TEXT_FORMAT_SECONDS = "yyyy-MM-dd HH:mm:ss 'UTC'"
TS_PARSE_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS] 'UTC'"
# Fixed value: the argument format of replay bounds, e.g. 2019-10-23T00:00:00.
ARG_FORMAT = "%Y-%m-%dT%H:%M:%S"
EPOCH = "1970-01-01 00:00:00"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(value: datetime | str) -> Column:
    """A ``timestamp_ntz`` literal from a datetime or text."""
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp_ntz")


def parse_arg(text: str) -> datetime:
    """Parse a replay bound argument (``%Y-%m-%dT%H:%M:%S``)."""
    return datetime.strptime(text, ARG_FORMAT)


def format_ts(ts: Column | str, seconds_only: bool = False) -> Column:
    """SC12: ``YYYY-MM-DD HH:MM:SS.ffffff UTC``.

    Built from the zone-free text of the ``timestamp_ntz`` and its
    microseconds; ``date_format`` would first cast to a zoned timestamp and
    shift wall-clock times that fall in the session zone's DST gap.
    """
    c = _col(ts)
    head = F.substring(c.cast("string"), 1, 19)
    if seconds_only:
        return F.concat(head, F.lit(" UTC"))
    frac = F.lpad(F.pmod(elapsed_micros(c, EPOCH), F.lit(1_000_000)).cast("string"), 6, "0")
    return F.concat(head, F.lit("."), frac, F.lit(" UTC"))


def parse_ts(text: Column | str) -> Column:
    """SC11: item timestamp text -> ``timestamp_ntz``; the fraction is
    optional. Empty, NULL or malformed text gives NULL (callers decide
    whether that is an error). Parsed straight to ``timestamp_ntz`` (no zone);
    the tolerant parse only guards the strict one."""
    c = _col(text)
    fmt = F.lit(TS_PARSE_FORMAT)
    return F.when(F.try_to_timestamp(c, fmt).isNotNull(), F.to_timestamp_ntz(c, fmt))


def elapsed_micros(ts: Column | str, start: datetime | str) -> Column:
    return F.timestamp_diff("MICROSECOND", ts_lit(start), _col(ts))


def offset_seconds(ts: Column | str, start: datetime | str) -> Column:
    """SC13: seconds since the series start, as double."""
    return elapsed_micros(ts, start) / F.lit(1e6)


def replay_time(ts: Column | str, series_start: datetime | str, replay_start: datetime | str,
                rate: float) -> Column:
    """SC14: replay_start + offset x rate, to the microsecond.

    Done in float seconds like a timedelta built from float seconds: whole
    seconds, then the fraction rounded half to even (``rint``) to micros.
    """
    scaled = offset_seconds(ts, series_start) * F.lit(float(rate))
    whole = F.floor(scaled)
    micros = whole * F.lit(1_000_000) + F.rint((scaled - whole) * F.lit(1e6)).cast("long")
    return F.timestamp_add("MICROSECOND", micros, ts_lit(replay_start))


def now_text() -> Column:
    """SC15: wall-clock now (UTC, whatever the session zone) as item text;
    fixed per query / micro-batch."""
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(F.current_timestamp()), ts_lit(EPOCH))
    return format_ts(utc)
