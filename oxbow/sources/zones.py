"""Time slices that open only the files they need (SRC5).

``write_zoned`` writes a table range-partitioned and sorted by its time column, and
beside it a zone map: a small table of (file, rows, lowest, highest timestamp).
``read_slice`` compares the slice with the zone map and reads the files that
overlap it; the others are never opened, not even for their footers. Files that
the zone map does not know (another writer added them) are always read, and
entries of files that are gone are ignored, so the map only ever saves work.
``append_zoned`` adds files and their zones.

The driver handles one row per file. A timestamp shared by a large part of the
rows is split over files by a hash of the whole row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oxbow.session import hadoop_path
from oxbow.sources.tables import time_slice, ts_literal

#: Folder of the zone map, inside the table's; Spark's readers skip such names.
ZONES = "_zones"


def _name(file):
    """The file's own name; names given by Spark's writers are unique."""
    return F.element_at(F.split(file, "/"), -1)


def zones_of(table: DataFrame, ts_col: str) -> DataFrame:
    """file, rows, lowest, highest of a file-based table; reads one column."""
    return (table.groupBy(_name(F.col("_metadata.file_path")).alias("file"))
            .agg(F.count(F.lit(1)).alias("rows"), F.min(ts_col).alias("lowest"), F.max(ts_col).alias("highest")))


def _write(df: DataFrame, path: str, ts_col: str, files: int | None, mode: str) -> None:
    """The rows, then the zones of the files that have none yet."""
    spark = df.sparkSession
    keys = [F.col(ts_col), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(ts_col).write.mode(mode).parquet(path)
    known = read_zones(spark, path) if mode == "append" else None
    written = spark.read.parquet(path)
    if known is not None:
        names = {r["file"] for r in known.select("file").collect()}
        fresh = [f for f in written.inputFiles() if f.rsplit("/", 1)[-1] not in names]
        if not fresh:
            return
        written = spark.read.schema(written.schema).parquet(*fresh)
    zones_of(written, ts_col).coalesce(1).write.parquet(f"{path}/{ZONES}/{uuid.uuid4().hex}")  # a row per file


def write_zoned(df: DataFrame, path: str, ts_col: str, files: int | None = None) -> None:
    """Write ``df`` (replacing what is there) with a zone map on ``ts_col``.
    ``files`` is the number of files; by default the planner's partitions."""
    _write(df, path, ts_col, files, "overwrite")


def append_zoned(df: DataFrame, path: str, ts_col: str, files: int | None = None) -> None:
    """Add rows, in files of their own, and their zones."""
    _write(df, path, ts_col, files, "append")


def read_zones(spark: SparkSession, path: str) -> DataFrame | None:
    """The zone map, or None if the table has none."""
    fs, p = hadoop_path(spark, f"{path}/{ZONES}")
    if not fs.exists(p):
        return None
    return spark.read.option("recursiveFileLookup", True).parquet(f"{path}/{ZONES}")


def slice_files(spark: SparkSession, path: str, start, end) -> tuple[DataFrame, list[str]]:
    """(the whole table, the files that may hold rows with ``start <= ts < end``)."""
    whole = spark.read.parquet(path)
    files, zones = whole.inputFiles(), read_zones(spark, path)
    if zones is None:
        return whole, files
    overlaps = (F.col("lowest") < ts_literal(end)) & (F.col("highest") >= ts_literal(start))
    outside = {r["file"] for r in zones.where(~F.coalesce(overlaps, F.lit(False))).select("file").collect()}
    return whole, [f for f in files if f.rsplit("/", 1)[-1] not in outside]


def read_slice(spark: SparkSession, path: str, ts_col: str, start, end) -> DataFrame:
    """All columns of the rows with ``start <= ts < end``, from the files that
    may hold some; the exact filter is pushed to these."""
    whole, files = slice_files(spark, path, start, end)
    if not files:
        return spark.createDataFrame([], whole.schema)
    return time_slice(spark.read.schema(whole.schema).parquet(*files), ts_col, start, end)


def time_bounds(spark: SparkSession, path: str) -> tuple | None:
    """(lowest, highest) timestamp of the table by its zone map, without reading
    the rows; None if a file has no zone or there is no timestamp."""
    zones = read_zones(spark, path)
    if zones is None:
        return None
    names = {f.rsplit("/", 1)[-1] for f in spark.read.parquet(path).inputFiles()}
    known = {r["file"] for r in zones.select("file").collect()}
    if not names <= known:
        return None
    here = spark.createDataFrame([(n,) for n in sorted(names)], "file string")
    low, high = zones.join(F.broadcast(here), "file", "left_semi").agg(F.min("lowest"), F.max("highest")).first()
    return None if low is None else (low, high)
