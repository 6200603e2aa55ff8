"""Versioned tables: a load that readers never see half done (SNK1).

Each load writes its tables into a folder of its own and then creates one small
manifest, numbered on from the newest. Readers take the newest complete manifest,
so they see the rows of before until the manifest is there, and all new ones from
then on; several tables of one load change together. A load that fails leaves files
that no manifest names. ``vacuum`` deletes old versions and such leftovers.

    <path>/_manifests/<number>.json     {"folder": ..., "tables": [...], "complete": true}
    <path>/v-<id>/<table>/...           the rows

A manifest is created exclusively: of two loads at a time that take the same number,
one goes on to the next. A manifest that is not complete yet is passed over.
"""

from __future__ import annotations

import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from oxbow.session import hadoop_path
from oxbow.sinks.tables import conform

_MANIFESTS = "_manifests"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, folder = hadoop_path(spark, f"{path}/{_MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted((int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit()), reverse=True)


def _manifest(spark: SparkSession, path: str, number: int) -> dict | None:
    fs, p = hadoop_path(spark, f"{path}/{_MANIFESTS}/{number:012d}.json")
    stream = fs.open(p)
    try:
        found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    except ValueError:
        return None  # its writer is not done, or was lost
    finally:
        stream.close()
    return found if found.get("complete") else None


def current(spark: SparkSession, path: str) -> tuple[int, dict] | None:
    """(number, manifest) of the newest complete version."""
    for number in _numbers(spark, path):
        if found := _manifest(spark, path, number):
            return number, found
    return None


def publish(spark: SparkSession, path: str, tables: dict[str, DataFrame]) -> int:
    """Write ``tables`` as the new version of ``path``; returns its number."""
    folder = f"v-{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{path}/{folder}/{name}")
    text = json.dumps({"folder": folder, "tables": sorted(tables), "complete": True})
    number = (_numbers(spark, path) or [0])[0] + 1
    while True:
        fs, p = hadoop_path(spark, f"{path}/{_MANIFESTS}/{number:012d}.json")
        try:
            stream = fs.create(p, False)
        except Py4JJavaError:
            if not fs.exists(p):
                raise
            number += 1  # another load was faster
            continue
        stream.write(bytearray(text.encode()))
        stream.close()
        return number


def read(spark: SparkSession, path: str, name: str = "data") -> DataFrame:
    """A table of the newest version. The frame keeps to that version."""
    found = current(spark, path)
    if found is None:
        raise FileNotFoundError(f"{path} has no version yet")
    return spark.read.parquet(f"{path}/{found[1]['folder']}/{name}")


def atomic_load(df: DataFrame, schema, path: str) -> DataFrame:
    """SNK1: cast to a declared schema (None: as it is) and replace the table's
    rows, created if needed; returns the loaded table."""
    spark = df.sparkSession
    publish(spark, path, {"data": conform(df, schema) if schema is not None else df})
    return read(spark, path)


def vacuum(spark: SparkSession, path: str, keep: int = 2, leftover_hours: float = 24.0) -> int:
    """Delete all but the newest ``keep`` versions, and folders without a manifest
    that are older than ``leftover_hours`` (a running load has none yet)."""
    numbers, kept, named, gone = _numbers(spark, path), set(), set(), 0
    for number in numbers:
        found = _manifest(spark, path, number)
        if found:
            named.add(found["folder"])
            if len(kept) < keep:
                kept.add(found["folder"])
                continue
        elif not kept:
            continue  # newer than the newest version: perhaps being written
        fs, p = hadoop_path(spark, f"{path}/{_MANIFESTS}/{number:012d}.json")
        fs.delete(p, False)  # before its rows, so that no reader finds a version without them
    fs, root = hadoop_path(spark, path)
    for s in fs.listStatus(root) if fs.exists(root) else ():
        name = s.getPath().getName()
        old = s.getModificationTime() < (time.time() - 3600 * leftover_hours) * 1000
        if name.startswith("v-") and name not in kept and (name in named or old):
            fs.delete(s.getPath(), True)
            gone += 1
    return gone
