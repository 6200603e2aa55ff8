"""Message sink (SNK4, SNK5, SNK6).

Messages are rows ``(value BINARY, attributes MAP<STRING,STRING>)``
(``functions.messages.envelope``), written by Spark's own writers:

* a folder: JSON lines ``{"data": ..., "attributes": {...}}``. A named batch has
  a folder of its own, which a re-run replaces, so each batch is there once;
* any format of the session, such as a message service's connector
  (``fmt="kafka"``), with its options; delivery is then what the connector gives;
* no target: the console, one JSON object per row and line, every row. The driver
  prints, one partition in memory at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_SCHEMA = "data string, attributes map<string,string>"


def publish(messages: DataFrame, target: str | None = None, *, batch: str | None = None,
            fmt: str | None = None, **options) -> None:
    """SNK6: a target given -> publish there; otherwise print to the console."""
    rows = messages.select("value", "attributes")
    if fmt:
        headers = F.transform(F.map_entries("attributes"),
                              lambda e: F.struct(e["key"].alias("key"), e["value"].cast("binary").alias("value")))
        rows = rows.select("value", headers.alias("headers")) if fmt == "kafka" else rows
        rows.write.format(fmt).mode("append").options(**options).save(*([target] if target else []))
    elif target:
        lines = rows.select(F.col("value").cast("string").alias("data"), "attributes")
        writer = lines.write.option("ignoreNullFields", "false")
        if batch:
            writer.mode("overwrite").json(f"{target}/batch={batch}")
        else:
            writer.mode("append").json(target)
    else:
        for row in console_lines(messages).toLocalIterator():
            print(row.line)


def console_lines(messages: DataFrame) -> DataFrame:
    """SNK5: the lines that the console shows, ``line`` for each message: its JSON
    object, whose line ends JSON escapes. A null value shows as null."""
    return messages.select(F.coalesce(F.col("value").cast("string"), F.lit("null")).alias("line"))


def read_messages(spark: SparkSession, target: str) -> DataFrame:
    """The messages in a folder: (data, attributes)."""
    return (spark.read.schema(LINE_SCHEMA).option("mode", "FAILFAST")
            .option("recursiveFileLookup", True).json(target))
