"""Zone map: slices open only the files they need."""

import glob
import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from oxbow.sources import zones
from oxbow.sources.tables import table, time_slice
from tests.conftest import SF_SMALL

SLICE = ("2024-01-09 00:00:00", "2024-01-10 12:00:00")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_files_outside_are_never_opened(spark, workdir):
    ev, path = table(spark, SF_SMALL, "events"), f"{workdir}/events"
    zones.write_zoned(ev, path, "ts", files=12)
    whole, files = zones.slice_files(spark, path, *SLICE)
    assert len(whole.inputFiles()) == 12 and 1 <= len(files) <= 3
    got = zones.read_slice(spark, path, "ts", *SLICE)
    want = rows(time_slice(ev, "ts", *SLICE))
    assert rows(got) == want and want
    opened = {r[0] for r in got.select(F.input_file_name()).distinct().collect()}
    assert len(opened) <= len(files)
    keep = {os.path.basename(f) for f in files}
    for f in glob.glob(f"{path}/*.parquet"):  # what is not opened may be broken
        if os.path.basename(f) not in keep and f != sorted(glob.glob(f"{path}/*.parquet"))[0]:
            with open(f, "wb") as out:
                out.write(b"no parquet")
    assert rows(zones.read_slice(spark, path, "ts", *SLICE)) == want


def test_append_unknown_files_and_bounds(spark, workdir):
    ev, path = table(spark, SF_SMALL, "events"), f"{workdir}/events"
    early, late = ev.where("ts < '2024-01-15'"), ev.where("ts >= '2024-01-15'")
    zones.write_zoned(early, path, "ts", files=4)
    zones.append_zoned(late, path, "ts", files=4)
    assert rows(spark.read.parquet(path)) == rows(ev)
    assert rows(zones.read_slice(spark, path, "ts", *SLICE)) == rows(time_slice(ev, "ts", *SLICE))
    assert zones.time_bounds(spark, path) == tuple(ev.agg(F.min("ts"), F.max("ts")).first())
    more = ev.limit(5).withColumn("ts", F.lit("2024-01-09 01:00:00").cast("timestamp_ntz"))
    more.write.mode("append").parquet(path)  # by another writer: no zones
    assert zones.time_bounds(spark, path) is None
    assert len(rows(zones.read_slice(spark, path, "ts", *SLICE))) == len(rows(time_slice(ev, "ts", *SLICE))) + 5
    zones.write_zoned(early, path, "ts", files=2)  # replaces rows and zones
    assert rows(spark.read.parquet(path)) == rows(early)
    assert zones.read_zones(spark, path).count() == 2


def test_hot_and_missing_timestamps(spark, workdir):
    path, t = f"{workdir}/t", datetime(2024, 1, 1)
    data = [(i, t) for i in range(3000)] + [(i, None) for i in range(200)] + [(i, t + timedelta(days=i)) for i in range(100)]
    df = spark.createDataFrame(data, "id long, ts timestamp_ntz")
    zones.write_zoned(df, path, "ts", files=8)
    sizes = [r["rows"] for r in zones.read_zones(spark, path).collect()]
    assert sum(sizes) == 3300 and max(sizes) < 1500  # the hot timestamp is in several files
    for start, end in ((t, t + timedelta(microseconds=1)), (t + timedelta(days=50), t + timedelta(days=60)),
                       (t - timedelta(days=9), t), (t + timedelta(days=200), t + timedelta(days=300))):
        assert rows(zones.read_slice(spark, path, "ts", start, end)) == rows(time_slice(df, "ts", start, end))


def test_without_zones(spark, workdir):
    ev, path = table(spark, SF_SMALL, "events"), f"{workdir}/plain"
    ev.write.parquet(path)
    assert rows(zones.read_slice(spark, path, "ts", *SLICE)) == rows(time_slice(ev, "ts", *SLICE))
    assert zones.time_bounds(spark, path) is None


def test_empty_table(spark, workdir):
    ev, path = table(spark, SF_SMALL, "events").limit(0), f"{workdir}/none"
    zones.write_zoned(ev, path, "ts")
    assert zones.read_slice(spark, path, "ts", *SLICE).count() == 0
