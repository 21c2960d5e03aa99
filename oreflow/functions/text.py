"""Text forms used by alerts and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def thousands(column: Column, digits: int = 0) -> Column:
    """Number with thousands separators: 1234567 -> 1,234,567."""
    return F.format_number(column, digits)


def truncated(column: Column, length: int, default: str) -> Column:
    """The first ``length`` characters; ``default`` for null and empty text."""
    return F.when(F.length(column) > 0, F.substring(column, 1, length)).otherwise(F.lit(default))


def detail_lines(details: Column) -> Column:
    """Map entries as lines "• *key*: value"."""
    lines = F.transform(F.map_entries(details), lambda e: F.concat(F.lit("• *"), e.key, F.lit("*: "), e.value))
    return F.array_join(lines, "\n")


def escape_html(column: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        column = F.replace(column, F.lit(char), F.lit(entity))
    return column
