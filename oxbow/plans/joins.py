"""Join-side sizing.

A side is broadcast only after one aggregate row (its row count and an estimate
of its bytes) shows it small; otherwise the join is left to the planner
(sort-merge / shuffled hash, with AQE's skew-join splitting). Nothing is
broadcast on faith, and nothing stays cached: the side is read again by the
join, so a call always sees the data as it is then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oxbow.session import broadcast_byte_bound, broadcast_row_bound

# Bytes assumed for a value that is not text or binary.
_FIXED_BYTES = 16


def is_small(df: DataFrame, max_rows: int | None = None) -> bool:
    """Whether ``df`` holds at most ``max_rows`` rows and fits the byte bound.

    Meant for small aggregates: it runs ``df`` once, down to one row.
    """
    spark = df.sparkSession
    text = [c.name for c in df.schema if isinstance(c.dataType, (T.StringType, T.BinaryType))]
    width = F.lit(_FIXED_BYTES * len(df.columns))
    for name in text:
        width = width + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    rows, size = df.agg(F.count(F.lit(1)), F.sum(width.cast("long"))).first()
    bound = max_rows if max_rows is not None else broadcast_row_bound(spark)
    return rows <= bound and (size or 0) <= broadcast_byte_bound(spark)


def maybe_broadcast(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def bounded_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` if ``df`` is small (``is_small``), else ``df``."""
    return maybe_broadcast(df, is_small(df, max_rows))
