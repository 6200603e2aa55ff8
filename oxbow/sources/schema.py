"""Schemas declared as JSON field lists (SRC8).

A field list is ``[{"name": ..., "type": ..., "mode": ...}, ...]``, bare or
wrapped as ``{"fields": [...]}``. Types map to Spark as below; NUMERIC has no
stated precision, so it loads as DECIMAL(28,9) (the product of a quantity
and a cost then keeps its nine fraction digits).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import types as T

# Declared type name -> Spark type.
TYPE_MAP = {
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "NUMERIC": T.DecimalType(28, 9),
    "BIGNUMERIC": T.DecimalType(38, 9),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "BOOL": T.BooleanType(),
    "BYTES": T.BinaryType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampNTZType(),
}


def _field(f: dict) -> T.StructField:
    kind = str(f.get("type", "STRING")).upper()
    mode = str(f.get("mode", "NULLABLE")).upper()
    if kind in ("RECORD", "STRUCT"):
        dt: T.DataType = schema_from_fields(f.get("fields", []))
    elif kind in TYPE_MAP:
        dt = TYPE_MAP[kind]
    else:
        raise ValueError(f"unsupported field type {kind!r} for {f.get('name')!r}")
    if mode == "REPEATED":
        dt = T.ArrayType(dt)
    return T.StructField(f["name"], dt, nullable=mode != "REQUIRED",
                         metadata={"description": f["description"]} if f.get("description") else {})


def schema_from_fields(fields: Sequence[dict] | dict | str) -> T.StructType:
    """StructType from a field list, a ``{"fields": [...]}`` object, or their JSON text."""
    if isinstance(fields, str):
        fields = json.loads(fields)
    if isinstance(fields, dict):
        fields = fields["fields"]
    return T.StructType([_field(f) for f in fields])


def fields_of(schema: T.StructType) -> list[dict]:
    """The inverse for the simple types: a field list for a StructType."""
    rev = {"bigint": "INTEGER", "int": "INTEGER", "string": "STRING", "double": "FLOAT",
           "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
           "timestamp": "TIMESTAMP", "binary": "BYTES"}
    out = []
    for f in schema.fields:
        s = f.dataType.simpleString()
        kind = "NUMERIC" if s.startswith("decimal") else rev.get(s, "STRING")
        out.append({"name": f.name, "type": kind, "mode": "NULLABLE" if f.nullable else "REQUIRED"})
    return out


# The declared schemas of the two sample CSVs (options sold,
# material costs) and of the profit output.
BASE_CSV_FIELDS = [
    {"name": "Vehicle_ID", "type": "INTEGER", "mode": "NULLABLE"},
    {"name": "Option_Quantities", "type": "INTEGER", "mode": "NULLABLE"},
    {"name": "Options_Code", "type": "STRING", "mode": "NULLABLE"},
    {"name": "Option_Desc", "type": "STRING", "mode": "NULLABLE"},
    {"name": "Model_Text", "type": "STRING", "mode": "NULLABLE"},
    {"name": "Sales_Price", "type": "NUMERIC", "mode": "NULLABLE"},
]
OPTIONS_CSV_FIELDS = [
    {"name": "Model", "type": "STRING", "mode": "NULLABLE"},
    {"name": "Option_Code", "type": "STRING", "mode": "NULLABLE"},
    {"name": "Option_Desc", "type": "STRING", "mode": "NULLABLE"},
    {"name": "Material_Cost", "type": "NUMERIC", "mode": "NULLABLE"},
]
PROFIT_FIELDS = BASE_CSV_FIELDS + [
    {"name": "Production_Cost", "type": "NUMERIC", "mode": "NULLABLE"},
    {"name": "Profit", "type": "NUMERIC", "mode": "NULLABLE"},
]
