"""Named-table scans (SRC4) and the time-slice scan (SRC5, FLT2, PRJ2)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table of the data directory; any other name is a table of the
    session's catalog. Column pruning and filters written downstream reach this
    scan through Catalyst."""
    if name not in TABLES:
        if not spark.catalog.tableExists(name):
            raise ValueError(f"unknown table {name!r}")
        return spark.table(name)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ts_literal(value: datetime | str) -> F.Column:
    """A zone-free timestamp literal (``timestamp_ntz``)."""
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp_ntz")


def time_slice(df: DataFrame, ts_col: str, start: datetime | str, end: datetime | str) -> DataFrame:
    """All columns of the rows with ``start <= ts < end`` (half-open).

    Written as a plain filter so it reaches the parquet scan as pushed
    predicates (and prunes partitions when the table is stored by date).
    """
    ts = F.col(ts_col)
    return df.where((ts >= ts_literal(start)) & (ts < ts_literal(end)))
