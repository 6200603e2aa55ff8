"""Grouped, acknowledged delivery: sizes, one copy of each message, nothing by halves."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from oxbow.functions.messages import envelope
from oxbow.sinks import delivery


def messages(spark, n, parts=4, text="x"):
    df = spark.range(n, numPartitions=parts).select("id", F.repeat(F.lit(text), (F.col("id") % 40).cast("int")).alias("t"))
    return envelope(df, ["id"])


def ids(df):
    return sorted(int(r["attributes"]["id"]) for r in df.collect())


def test_groups_keep_their_limits(spark, workdir):
    target = f"{workdir}/t"
    delivery.deliver(messages(spark, 3000), target, max_messages=70, max_bytes=4000)
    assert ids(delivery.read_delivered(spark, target)) == list(range(3000))
    groups = delivery.read_groups(spark, target).collect()
    assert sum(g["messages"] for g in groups) == 3000
    assert all(g["messages"] <= 70 and g["bytes"] <= 4000 for g in groups)
    assert sum(g["messages"] == 70 or g["bytes"] > 3800 for g in groups) >= len(groups) - 4  # all but a task's last are full
    sizes = {r["file"]: r["n"] for r in delivery.read_delivered(spark, target).groupBy("file").agg(F.count("*").alias("n")).collect()}
    assert sizes == {g["file"]: g["messages"] for g in groups}


def test_large_and_slow_messages(monkeypatch):
    sent = []
    limits = {"max_messages": 3, "max_bytes": 10, "max_seconds": 1.0}
    g = delivery._Grouper(limits, lambda lines, size: sent.append((lines, size)))
    g.add(pa.array(["aaaa", "bbbb", "cccc", "d" * 50, "e", "f", "g", "h"]))
    assert [len(x) for x, _ in sent] == [2, 1, 1, 3] and [s for _, s in sent] == [8, 4, 50, 3]
    clock = [0.0]
    monkeypatch.setattr(delivery.time, "monotonic", lambda: clock[0])
    sent.clear()
    g = delivery._Grouper(limits, lambda lines, size: sent.append(lines))
    g.add(pa.array(["a"]))
    clock[0] = 0.9
    g.add(pa.array(["b"]))
    clock[0] = 1.0
    g.add(pa.array(["c"]))
    g.close()
    assert sent == [["a", "b"], ["c"]]


def test_a_failed_write_publishes_nothing(spark, workdir):
    target = f"{workdir}/t"
    broken = messages(spark, 500).withColumn(
        "value", F.when(F.col("attributes")["id"] == "499", F.raise_error(F.lit("task lost"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="task lost"):
        delivery.deliver(broken, target)
    assert delivery.read_delivered(spark, target).count() == 0
    delivery.deliver(messages(spark, 500), target)
    assert ids(delivery.read_delivered(spark, target)) == list(range(500))


def test_repeated_tasks_and_batches_publish_once(workdir, spark):
    w = delivery.GroupStreamWriter({"path": f"file:{workdir}/t"})
    line = lambda i: pa.RecordBatch.from_arrays([pa.array([f'{{"data":"{i}","attributes":{{"id":"{i}"}}}}'])], names=["line"])
    w.write(iter([line(0)]))                                # a task that was lost after it wrote
    w.commit([w.write(iter([line(0)])), w.write(iter([line(1)])), None], 0)
    again = [w.write(iter([line(0)])), w.write(iter([line(1)]))]
    w.commit(again, 0)                                      # the driver was lost before it logged the commit
    assert not any(os.path.exists(f"{workdir}/t/{f}") for m in again for f, *_ in m.groups)
    w.abort([w.write(iter([line(2)])), None], 1)
    w.commit([w.write(iter([line(2)]))], 1)
    assert ids(delivery.read_delivered(spark, f"file:{workdir}/t")) == [0, 1, 2]


def test_unacknowledged_group(workdir):
    w = delivery.GroupWriter({"path": workdir, "ack_seconds": "-1"})
    with pytest.raises(TimeoutError):
        w.write(iter([pa.RecordBatch.from_arrays([pa.array(["x"])], names=["line"])]))


def test_stream(spark, workdir):
    src, target = f"{workdir}/src", f"{workdir}/t"
    messages(spark, 100).write.parquet(f"{src}")
    stream = spark.readStream.schema(messages(spark, 1).schema).option("maxFilesPerTrigger", 1).parquet(src)
    for _ in range(2):  # the second run finds everything delivered
        q = delivery.deliver_stream(stream, target, f"{workdir}/ck")
        q.processAllAvailable()
        q.stop()
    assert ids(delivery.read_delivered(spark, target)) == list(range(100))
    assert delivery.read_groups(spark, target).select("batch").distinct().count() == 4
