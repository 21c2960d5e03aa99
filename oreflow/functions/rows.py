"""Row-level hashing and comparison that also work for maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return True
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype.fields)
    return False


def comparable(field: T.StructField, prefix: str = "") -> Column:
    """The column in a form that can be hashed and compared: maps as sorted entries, variants as text."""
    column = F.col(f"{prefix}`{field.name}`")
    if isinstance(field.dataType, T.MapType) and not _holds_map(field.dataType.valueType):
        return F.array_sort(F.map_entries(column))
    if _holds_map(field.dataType):
        return F.to_json(F.struct(column))
    return column


def row_hash(df: DataFrame, exclude: tuple[str, ...] = ()) -> Column:
    """64-bit hash over all columns but ``exclude``: a tie-break that does not depend on row order."""
    skipped = {name.lower() for name in exclude}
    return F.xxhash64(*[comparable(f) for f in df.schema.fields if f.name.lower() not in skipped])
