"""Exported replay batches as a streaming source (ST1, ST7).

``spark.readStream.format("oxbow_batches")`` gives the lines of a JSON-lines export
that is partitioned by batch (``<path>/_batch_id=<n>/...``). Offsets are batch
numbers, so the query's own offset log says which batches are done: a restart goes
on behind the last one, and a batch that was not committed is read again. Each
micro-batch is one batch, and each of its files one input partition.

Options: ``path``; ``batches``, the number of batches; ``from``, the newest offset
of the query's log (``newest_offset``), since a source learns of committed offsets
only by the micro-batches it plans itself; ``first_us`` and ``step_us``, for a paced
source: the time (microseconds since the epoch) from which batch 0 is given out, and
how much later each further one is.

Files are read in Python workers by Arrow's file systems (local, HDFS, S3, GCS); the
lines are parsed by Spark. A file's lines are held at a time, so the export bounds
the rows of a file.
"""

from __future__ import annotations

import json
import time

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from oxbow.session import hadoop_path, ship_package

FORMAT = "oxbow_batches"


def _file_system(path: str):
    uri = path if "://" in path else path.replace("file:", "file://", 1) if path.startswith("file:/") else f"file://{path}"
    return pyarrow.fs.FileSystem.from_uri(uri)


class BatchFile(InputPartition):
    def __init__(self, batch: int, path: str, root: str):
        self.batch, self.path, self.root = batch, path, root


class BatchReader(DataSourceStreamReader):
    def __init__(self, options):
        self.root, self.batches = options["path"], int(options["batches"])
        self.planned = int(options.get("from", 0))
        self.first, self.step = (int(options.get(k, 0)) for k in ("first_us", "step_us"))

    def initialOffset(self) -> dict:
        return {"batch": 0}

    def latestOffset(self) -> dict:
        """One batch further than what has been planned, if its time has come."""
        now = time.time_ns() // 1000
        due = self.batches if not self.step else 0 if now < self.first else (now - self.first) // self.step + 1
        return {"batch": max(self.planned, min(self.planned + 1, self.batches, due))}

    def partitions(self, start: dict, end: dict) -> list[BatchFile]:
        self.planned = max(self.planned, end["batch"])
        fs, root = _file_system(self.root)
        found = []
        for batch in range(start["batch"], end["batch"]):
            folder = pyarrow.fs.FileSelector(f"{root}/_batch_id={batch}", allow_not_found=True)
            found += [BatchFile(batch, f.path, self.root) for f in sorted(fs.get_file_info(folder), key=lambda f: f.path)
                      if f.is_file and not f.base_name.startswith((".", "_"))]
        return found

    def read(self, partition: BatchFile):
        fs, _ = _file_system(partition.root)
        with fs.open_input_file(partition.path) as f:
            lines = f.read().decode().split("\n")
        if not lines[-1]:
            lines.pop()
        if lines:
            yield pa.RecordBatch.from_arrays([pa.array([partition.batch] * len(lines), pa.int64()), pa.array(lines, pa.string())],
                                             names=["batch", "line"])


class BatchSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "batch long, line string"

    def streamReader(self, schema) -> BatchReader:
        return BatchReader(self.options)


def newest_offset(spark: SparkSession, checkpoint: str) -> int:
    """The batch number that the query's offset log reached, 0 for a new query."""
    fs, folder = hadoop_path(spark, f"{checkpoint}/offsets")
    if not fs.exists(folder):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    newest = max((int(n) for n in names if n.isdigit()), default=None)
    if newest is None:
        return 0
    _, p = hadoop_path(spark, f"{checkpoint}/offsets/{newest}")
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return int(json.loads(text.strip().split("\n")[-1])["batch"])


def read_batches(spark: SparkSession, path: str, batches: int, checkpoint: str, first_us: int = 0,
                 step_us: int = 0) -> DataFrame:
    """A stream of ``batch`` and ``line``; with ``step_us`` paced by batches."""
    ship_package(spark)
    spark.dataSource.register(BatchSource)
    return (spark.readStream.format(FORMAT).option("path", path).option("batches", batches)
            .option("first_us", first_us).option("step_us", step_us)
            .option("from", newest_offset(spark, checkpoint)).load())


def parse_lines(lines: DataFrame, schema, options: dict) -> DataFrame:
    """The columns of ``schema`` from ``line``; a broken line fails."""
    return lines.select(F.from_json("line", schema, {**options, "mode": "FAILFAST"}).alias("row")).select("row.*")
