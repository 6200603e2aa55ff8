"""Grouped delivery with acknowledgements (SNK4, ST8).

``spark.write.format("oxbow_groups")`` and ``writeStream`` of the same name deliver
messages in groups, closed at ``max_messages``, before ``max_bytes`` would be passed
(a larger message is a group of its own), or ``max_seconds`` after their first
message. The target is a folder. A task writes each group as a file of its own and
counts it as acknowledged when the file system confirms its size, within
``ack_seconds``; it then reports the group in its commit message. Only when all
tasks have reported does the driver publish the groups, by one manifest file, so a
message of a failed or repeated task is never seen, and none is seen twice:

* a task that runs again leaves files that no manifest names;
* a write that fails drops the files it knows of and publishes nothing;
* a micro-batch that runs again after its manifest was written publishes nothing new.

The manifests hold one line per group. Readers read the files they name. ``path`` is
an address of Arrow's file systems (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter,
                                    WriterCommitMessage)

from oxbow.session import hadoop_path, ship_package
from oxbow.sinks.messages import LINE_SCHEMA

FORMAT = "oxbow_groups"
#: Limits of a group, and of the wait for its acknowledgement.
MAX_MESSAGES, MAX_BYTES, MAX_SECONDS, ACK_SECONDS = 1000, 5000, 1.0, 300.0
_MANIFEST = "file string, messages long, bytes long, batch long"


def open_target(path: str):
    """(file system, folder) of Arrow for a path."""
    if "://" not in path:
        path = "file://" + path.removeprefix("file:")
    return pyarrow.fs.FileSystem.from_uri(path)


@dataclass
class Delivered(WriterCommitMessage):
    """The groups of a task: (file, messages, bytes)."""

    groups: list = field(default_factory=list)


class _Grouper:
    """Closes groups by count, bytes and age; ``send`` gets each one's lines."""

    def __init__(self, limits: dict, send):
        self.limits, self.send = limits, send
        self.lines: list[str] = []
        self.bytes, self.opened = 0, 0.0

    def close(self) -> None:
        if self.lines:
            self.send(self.lines, self.bytes)
        self.lines, self.bytes = [], 0

    def add(self, lines: pa.Array) -> None:
        sizes = pc.binary_length(lines).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(lines):
            if self.lines and time.monotonic() - self.opened >= self.limits["max_seconds"]:
                self.close()
            done = int(ends[at - 1]) if at else 0
            by_bytes = int(np.searchsorted(ends, done + self.limits["max_bytes"] - self.bytes, "right"))
            stop = min(by_bytes, at + self.limits["max_messages"] - len(self.lines), len(lines))
            if stop == at:              # the next one does not fit
                if self.lines:
                    self.close()
                    continue
                stop = at + 1           # nor into a group of its own
            if not self.lines:
                self.opened = time.monotonic()
            self.lines += lines.slice(at, stop - at).to_pylist()
            self.bytes += int(ends[stop - 1]) - done
            at = stop
            if len(self.lines) >= self.limits["max_messages"] or self.bytes >= self.limits["max_bytes"]:
                self.close()


class _Delivery:
    """What batch and stream writers share."""

    def __init__(self, options):
        self.path = options["path"]
        self.ack_seconds = float(options.get("ack_seconds", ACK_SECONDS))
        self.limits = {"max_messages": int(options.get("max_messages", MAX_MESSAGES)),
                       "max_bytes": int(options.get("max_bytes", MAX_BYTES)),
                       "max_seconds": float(options.get("max_seconds", MAX_SECONDS))}

    def write(self, iterator) -> Delivered:
        fs, root = open_target(self.path)
        folder = f"groups/{uuid.uuid4().hex}"
        fs.create_dir(f"{root}/{folder}")
        done = Delivered()

        def send(lines: list[str], size: int) -> None:
            name, began = f"{folder}/{len(done.groups):08d}.json", time.monotonic()
            data = ("\n".join(lines) + "\n").encode()
            with fs.open_output_stream(f"{root}/{name}") as out:
                out.write(data)
            if fs.get_file_info(f"{root}/{name}").size != len(data):
                raise OSError(f"group {name} was not acknowledged")
            if time.monotonic() - began > self.ack_seconds:
                raise TimeoutError(f"group {name} was acknowledged after more than {self.ack_seconds} s")
            done.groups.append((name, len(lines), size))

        grouper = _Grouper(self.limits, send)
        for batch in iterator:
            grouper.add(batch.column("line"))
        grouper.close()
        return done

    def publish(self, messages, name: str, batch: int) -> None:
        fs, root = open_target(self.path)
        target = f"{root}/manifests/{name}.json"
        if fs.get_file_info(target).type == pyarrow.fs.FileType.File:
            return self.drop(messages)  # published before the writer was restarted
        lines = [json.dumps({"file": f, "messages": n, "bytes": b, "batch": batch})
                 for m in messages if m for f, n, b in m.groups]
        fs.create_dir(f"{root}/manifests")
        draft = f"{root}/manifests/.{name}-{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as out:
            out.write(("\n".join(lines) + "\n" if lines else "").encode())
        fs.move(draft, target)

    def drop(self, messages) -> None:
        fs, root = open_target(self.path)
        for m in messages:
            for name, _, _ in m.groups if m else ():
                if fs.get_file_info(f"{root}/{name}").type == pyarrow.fs.FileType.File:
                    fs.delete_file(f"{root}/{name}")


class GroupWriter(_Delivery, DataSourceArrowWriter):
    def __init__(self, options):
        super().__init__(options)
        self.name = uuid.uuid4().hex

    def commit(self, messages) -> None:
        self.publish(messages, self.name, -1)

    def abort(self, messages) -> None:
        self.drop(messages)


class GroupStreamWriter(_Delivery, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        self.publish(messages, f"batch-{batchId:012d}", batchId)

    def abort(self, messages, batchId: int) -> None:
        self.drop(messages)


class GroupTarget(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> GroupWriter:
        return GroupWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> GroupStreamWriter:
        return GroupStreamWriter(self.options)


def _lines(messages: DataFrame) -> DataFrame:
    line = F.to_json(F.struct(F.col("value").cast("string").alias("data"), "attributes"), {"ignoreNullFields": "false"})
    return messages.select(line.alias("line"))


def deliver(messages: DataFrame, path: str, **limits) -> None:
    """Deliver (value, attributes) rows in groups; all of them or none."""
    spark = messages.sparkSession
    ship_package(spark)
    spark.dataSource.register(GroupTarget)
    _lines(messages).write.format(FORMAT).mode("append").options(path=path, **limits).save()


def deliver_stream(messages: DataFrame, path: str, checkpoint: str, **limits):
    """A started query that delivers a stream of (value, attributes) rows; each
    micro-batch is published once, whole."""
    spark = messages.sparkSession
    ship_package(spark)
    spark.dataSource.register(GroupTarget)
    return (_lines(messages).writeStream.format(FORMAT).options(path=path, **limits)
            .option("checkpointLocation", checkpoint).start())


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """file, messages, bytes, batch: the published groups."""
    fs, p = hadoop_path(spark, f"{path}/manifests")
    if not fs.exists(p):
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).json(f"{path}/manifests")


def read_delivered(spark: SparkSession, path: str) -> DataFrame:
    """data, attributes, file: the published messages with their group."""
    fs, p = hadoop_path(spark, f"{path}/groups")
    if not fs.exists(p):
        return spark.createDataFrame([], f"{LINE_SCHEMA}, file string")
    rows = (spark.read.schema(LINE_SCHEMA).option("mode", "FAILFAST").option("recursiveFileLookup", True)
            .json(f"{path}/groups").withColumn("file", F.regexp_extract("_metadata.file_path", "groups/[^/]+/[^/]+$", 0)))
    # a row per group on the right; files that no manifest names drop out
    return rows.join(read_groups(spark, path).select("file"), "file", "left_semi").select("data", "attributes", "file")
