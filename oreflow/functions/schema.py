"""Schemas written as plain data, usable before a session exists."""

from __future__ import annotations

from typing import Any

from pyspark.sql import types as T

_NAMED = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
}


class MapOf:
    """Map from text to ``values``."""

    def __init__(self, values: Any = "string"):
        self.values = values


def data_type(shape: Any) -> T.DataType:
    """A type from its shape: a type name, a dict (struct), a one-element list (array) or a ``MapOf``."""
    if isinstance(shape, dict):
        return struct(shape)
    if isinstance(shape, list):
        return T.ArrayType(data_type(shape[0]))
    if isinstance(shape, MapOf):
        return T.MapType(T.StringType(), data_type(shape.values))
    return _NAMED[shape]


def struct(fields: dict[str, Any]) -> T.StructType:
    """A struct; a name that ends with ``!`` is not nullable."""
    return T.StructType([
        T.StructField(name.rstrip("!"), data_type(shape), not name.endswith("!")) for name, shape in fields.items()
    ])
