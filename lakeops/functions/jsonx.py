"""JSON helpers: distributed schema inference over a text column."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ATOMS = {
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "FLOAT": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.StringType(),
    "STRING": T.StringType(),
    "VOID": T.NullType(),
}
BIG = T.DecimalType(38, 0)


def infer_schema(df: DataFrame, column: str, nulls: bool = True) -> T.StructType:
    """Schema of all JSON objects in `column`: ints widen to long or, above 18 digits, to decimal, mixed numbers to double, the rest to string.

    One aggregate on the executors with map-side merging; only the schema text reaches the driver. Fields that hold
    nothing but nulls are strings, or left out if `nulls` is false: a later batch then tells their type.
    """
    text = df.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("s")).head()["s"]
    parsed = _parse(text or "VOID")
    if not isinstance(parsed, T.StructType):
        return T.StructType([])
    kept = [f for f in parsed.fields if nulls or not isinstance(f.dataType, T.NullType)]
    return T.StructType([T.StructField(f.name, _known(f.dataType)) for f in kept])


def _known(kind: T.DataType) -> T.DataType:
    """Text in place of the type of a value never seen."""
    if isinstance(kind, T.NullType):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_known(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _known(f.dataType)) for f in kind.fields])
    return kind


def schema_of_text(spark, text: str) -> T.StructType:
    """Schema of one JSON object."""
    return infer_schema(spark.createDataFrame([(text,)], "v string"), "v")


def _parse(text: str) -> T.DataType:
    if text.startswith("ARRAY<"):
        return T.ArrayType(_parse(text[6:-1]))
    if text.startswith("OBJECT<"):
        fields = [
            T.StructField(name, _parse(kind)) for name, kind in (_field(part) for part in _split(text[7:-1]))
        ]
        return T.StructType(fields)
    if text.startswith("DECIMAL"):
        precision, scale = map(int, re.search(r"(\d+),\s*(\d+)", text).groups())
        return T.DoubleType() if scale else (T.LongType() if precision <= 18 else BIG)
    return _ATOMS.get(text, T.StringType())


def _field(part: str) -> tuple[str, str]:
    if part.startswith("`"):
        name, kind = re.fullmatch(r"`((?:[^`]|``)*)`: (.*)", part, re.S).groups()
        return name.replace("``", "`"), kind
    name, kind = part.split(": ", 1)
    return name, kind


def _split(text: str) -> list[str]:
    parts, depth, quoted, start = [], 0, False, 0
    for i, ch in enumerate(text):
        if ch == "`":
            quoted = not quoted
        elif not quoted and ch in "<(":
            depth += 1
        elif not quoted and ch in ">)":
            depth -= 1
        elif not quoted and depth == 0 and ch == ",":
            parts.append(text[start:i].strip())
            start = i + 1
    parts.append(text[start:].strip())
    return [p for p in parts if p]
