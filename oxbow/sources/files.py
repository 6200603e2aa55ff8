"""File scans: CSV under a declared schema, line CSV, inferred CSV, JSON lines
(SRC1, SRC2, SRC3, SRC7, SC21).

CSV columns bind to the declared schema by position (the header row is
skipped, not matched by name: sample headers differ from the schema names).
Malformed rows fail the job by default (``mode="FAILFAST"``), or go to a
quarantine column with ``mode="PERMISSIVE"``. Either way every declared column is
parsed, also when a query reads only some of them or counts the rows: Spark's
text readers convert only the columns a plan asks for, so ``_parse_all`` asks for
all of them. One limit: a row that a pushed filter rejects is skipped before its
other columns are converted, so only the rows a query returns or counts are
sure to be well formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oxbow.functions.messages import JSON_READ_OPTIONS
from oxbow.sources.schema import schema_from_fields

CORRUPT = "_corrupt_record"


def _schema(schema) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else schema_from_fields(schema)


def _parse_all(df: DataFrame) -> DataFrame:
    """``df``, with a filter that holds for every row but needs every column."""
    return df.where(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(2)) < 2)


def _read(reader, st: T.StructType, mode: str):
    reader = reader.option("mode", mode)
    if mode.upper() == "PERMISSIVE":
        st = T.StructType(st.fields + [T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(st)


def read_csv(spark: SparkSession, path: str | list[str], schema, *, multiline: bool = True,
             mode: str = "FAILFAST") -> DataFrame:
    """SRC1: declared schema, one header row skipped, quoted newlines allowed.

    ``multiline=True`` lets quoted fields span lines (each file is then read
    by one task); use ``read_csv_lines`` for large files without embedded
    newlines, which splits files across tasks.
    ``mode="PERMISSIVE"`` adds ``_corrupt_record`` for malformed rows.
    """
    st = _schema(schema)
    reader = (spark.read.option("header", True).option("enforceSchema", True)
              .option("multiLine", multiline))
    return _parse_all(_read(reader, st, mode).csv(path))


def read_csv_lines(spark: SparkSession, path: str | list[str], schema,
                   mode: str = "FAILFAST") -> DataFrame:
    """SRC2: one record per line (quotes handled, no embedded newlines);
    splittable, so a large file is read by many tasks."""
    return read_csv(spark, path, schema, multiline=False, mode=mode)


def read_csv_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SRC3: header names and inferred types (an extra pass over the data;
    prefer a declared schema for large inputs)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_jsonl(spark: SparkSession, path: str | list[str], schema=None,
               recursive: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """SRC7/SC17: newline-delimited JSON. With a schema, decimals declared
    there stay exact; without one, JSON floats are inferred as decimals
    (``prefersDecimal``). Timestamps use the item text format. A broken line,
    a value of another type or a number too long for its column is malformed."""
    reader = spark.read.options(**JSON_READ_OPTIONS)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if schema is None:
        return _parse_all(reader.option("prefersDecimal", True).option("mode", mode).json(path))
    return _parse_all(_read(reader, _schema(schema), mode).json(path))
