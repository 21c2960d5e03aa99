"""Template parameters of extraction queries.

The set of expressions is closed: configuration text is looked up, never evaluated.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping
from typing import Any

_SHIFT = re.compile(r"^trigger_time\s*([+-])\s*timedelta\((days|hours|minutes)\s*=\s*(\d+)\)$")
_PLACEHOLDER = re.compile(r"\$\{([^{}]*)\}")
_LITERAL_OR_REST = re.compile(r"'(?:[^']|'')*'|[^']+")


def sql_text(value: Any) -> str:
    """The text form databases accept: datetimes to the millisecond, dates in ISO form."""
    if isinstance(value, dt.datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S.%f")[:-3]
    if isinstance(value, dt.date):
        return value.isoformat()
    return str(value)


def resolve(expression: str, trigger_time: dt.datetime, context: Mapping[str, Any] | None = None) -> Any:
    """Value of one expression, given with or without its ``${}``. Unknown expressions raise ``KeyError``."""
    text = expression.strip()
    if text.startswith("${") and text.endswith("}"):
        text = text[2:-1].strip()
    known = {
        "trigger_time": trigger_time,
        "trigger_time.isoformat()": trigger_time.isoformat(),
        "current_date()": trigger_time.date(),
        **(context or {}),
    }
    if text in known:
        return known[text]
    shift = _SHIFT.match(text)
    if shift:
        sign, unit, amount = shift.groups()
        delta = dt.timedelta(**{unit: int(amount)})
        return trigger_time - delta if sign == "-" else trigger_time + delta
    raise KeyError(f"unknown parameter expression: {expression!r}")


def query_values(
    trigger_time: dt.datetime, parameters: Mapping[str, Mapping[str, str]] | None = None
) -> dict[str, str]:
    """Named parameters as SQL text: ``runtime_value`` when given, else ``default``."""
    values = {}
    for name, setting in (parameters or {}).items():
        runtime = setting.get("runtime_value")
        values[name] = sql_text(resolve(runtime, trigger_time)) if runtime else str(setting.get("default") or "")
    return values


def render(
    query: str,
    trigger_time: dt.datetime,
    parameters: Mapping[str, Mapping[str, str]] | None = None,
) -> str:
    """Query text for a foreign database, with every ``${...}`` replaced by its value."""
    values = query_values(trigger_time, parameters)

    def value_of(match: re.Match) -> str:
        inner = match.group(1).strip()
        if inner in values:
            return values[inner]
        if inner == "trigger_time.isoformat()":
            return sql_text(trigger_time)
        return sql_text(resolve(inner, trigger_time))

    return _PLACEHOLDER.sub(value_of, query)


def bind(
    query: str,
    trigger_time: dt.datetime,
    parameters: Mapping[str, Mapping[str, str]] | None = None,
) -> tuple[str, dict[str, str]]:
    """Query and arguments for ``spark.sql(query, args)``: each ``${...}``, quoted or not, becomes a marker.

    Values travel as typed arguments, so text in them can never become SQL. A literal that holds more than a
    placeholder becomes the concatenation of its parts. Quotes inside a literal are doubled.
    """
    values = query_values(trigger_time, parameters)
    args: dict[str, str] = {}

    def marker(inner: str) -> str:
        inner = inner.strip()
        if inner in values:
            name, value = inner, values[inner]
        else:
            name = "p_" + re.sub(r"\W+", "_", inner).strip("_")
            value = sql_text(trigger_time if inner == "trigger_time.isoformat()" else resolve(inner, trigger_time))
        args[name] = value
        return f":{name}"

    def piece(match: re.Match) -> str:
        text = match.group()
        if not text.startswith("'"):
            return _PLACEHOLDER.sub(lambda m: marker(m.group(1)), text)
        parts = _PLACEHOLDER.split(text[1:-1])  # text, inner, text, inner, ..., text
        if len(parts) == 1:
            return text
        values = [marker(x) if i % 2 else f"'{x}'" for i, x in enumerate(parts) if i % 2 or x]
        return values[0] if len(values) == 1 else f"concat({', '.join(values)})"

    return _LITERAL_OR_REST.sub(piece, query), args
