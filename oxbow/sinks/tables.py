"""Table sinks (SNK1, SNK2, SNK3, SRC6).

* ``truncate_load``: cast to a declared schema, then replace the table's
  contents (create if needed). The rows are first written in full beside the
  target, so a load that fails leaves the target as it was.
* ``create_or_replace_view``: publish a query as a view.
* ``export_jsonl`` / ``sql_export``: a query result as newline-delimited JSON,
  written by many tasks (no one-file limit).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oxbow.functions.messages import JSON_WRITE_OPTIONS
from oxbow.session import hadoop_path, scratch_path
from oxbow.sources.schema import schema_from_fields


def conform(df: DataFrame, schema) -> DataFrame:
    """Project and cast ``df`` to the declared schema, by name, in schema order.
    A declared column the frame lacks is added as NULL."""
    st = schema if isinstance(schema, T.StructType) else schema_from_fields(schema)
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in st.fields])


def truncate_load(df: DataFrame, schema=None, *, path: str | None = None,
                  table: str | None = None, fmt: str = "parquet") -> DataFrame:
    """SNK1: WRITE_TRUNCATE + CREATE_IF_NEEDED. Returns the loaded table."""
    out = conform(df, schema) if schema is not None else df
    spark = df.sparkSession
    if not (path or table):
        raise ValueError("truncate_load needs a path or a table name")
    if table:
        staged = scratch_path(spark, "staged-load")
        out.write.format(fmt).save(staged)
        w = spark.read.format(fmt).load(staged).write.mode("overwrite").format(fmt)
        (w.option("path", path) if path else w).saveAsTable(table)
        return spark.table(table)
    mark = uuid.uuid4().hex[:12]
    fresh, old = f"{path.rstrip('/')}._new-{mark}", f"{path.rstrip('/')}._old-{mark}"
    out.write.format(fmt).save(fresh)
    fs, target = hadoop_path(spark, path)
    (_, p_fresh), (_, p_old) = hadoop_path(spark, fresh), hadoop_path(spark, old)
    if fs.exists(target) and not fs.rename(target, p_old):
        raise OSError(f"cannot move {path}")
    if not fs.rename(p_fresh, target):
        fs.rename(p_old, target)
        raise OSError(f"cannot move the new data to {path}")
    fs.delete(p_old, True)
    spark.catalog.refreshByPath(path)
    return spark.read.format(fmt).load(path)


def create_or_replace_view(spark: SparkSession, name: str, query: DataFrame | str,
                           persistent: bool = False) -> DataFrame:
    """SNK2: a view over a query (SQL text or a DataFrame). A persistent view is
    kept in the catalog, beyond the session; it takes SQL over catalog tables."""
    if persistent:
        if not isinstance(query, str):
            raise ValueError("a persistent view needs SQL text")
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    elif isinstance(query, str):
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {query}")
    else:
        query.createOrReplaceTempView(name)
    return spark.table(name)


def export_jsonl(df: DataFrame, path: str, compression: str | None = None) -> str:
    """SNK3: newline-delimited JSON, one file per task; timestamps keep micros."""
    w = df.write.mode("overwrite").options(**JSON_WRITE_OPTIONS)
    if compression:
        w = w.option("compression", compression)
    w.json(path)
    return path


def sql_export(spark: SparkSession, sql: str, path: str) -> tuple[str, T.StructType]:
    """SRC6 + SNK3: run SQL text, export the result as JSON lines. Returns
    the path and the result schema (for reading the export back exactly)."""
    df = spark.sql(sql)
    export_jsonl(df, path)
    return path, df.schema
