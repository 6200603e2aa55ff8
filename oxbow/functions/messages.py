"""Message envelope columns (SC16, SC17, SC18, SNK4 projection).

A message is ``(value BINARY, attributes MAP<STRING,STRING>)``: the row as
UTF-8 JSON, plus chosen fields as string attributes, NULL fields left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oxbow.functions.timefmt import TS_PARSE_FORMAT, TS_TEXT_FORMAT

# JSON options: timestamps keep their microseconds, NULL fields are written.
JSON_WRITE_OPTIONS = {
    "timestampFormat": TS_TEXT_FORMAT,
    "timestampNTZFormat": TS_TEXT_FORMAT,
    "ignoreNullFields": "false",
}
JSON_READ_OPTIONS = {
    "timestampFormat": TS_PARSE_FORMAT,
    "timestampNTZFormat": TS_PARSE_FORMAT,
}


def row_json(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """SC16: the row (or the given columns) as one JSON object text."""
    cols = list(columns) if columns is not None else df.columns
    return F.to_json(F.struct(*[F.col(c) for c in cols]), JSON_WRITE_OPTIONS)


def attributes(names: Sequence[str]) -> Column:
    """SC18: map of the named fields that are not NULL, values as text."""
    if not names:
        return F.create_map().cast(T.MapType(T.StringType(), T.StringType()))
    pairs = []
    for n in names:
        pairs += [F.lit(n), F.col(n).cast("string")]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())


def envelope(df: DataFrame, attribute_names: Sequence[str] = (),
             keep: Sequence[str] = ()) -> DataFrame:
    """SNK4 projection: ``value`` (UTF-8 JSON bytes of the row) and
    ``attributes``; ``keep`` carries extra columns (e.g. an order key) along
    without putting them in the message."""
    payload = [c for c in df.columns if c not in keep]
    return df.select(row_json(df, payload).cast("binary").alias("value"),
                     attributes(list(attribute_names)).alias("attributes"),
                     *[F.col(c) for c in keep])


def decode(value: Column | str, schema: T.StructType) -> Column:
    """SC17: JSON text/bytes -> struct with ``schema`` (decimals stay decimal
    when the schema says so). Malformed text fails the job."""
    v = F.col(value) if isinstance(value, str) else value
    return F.from_json(v.cast("string"), schema, {**JSON_READ_OPTIONS, "mode": "FAILFAST"})
