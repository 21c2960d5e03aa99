"""Stages of a dataflow as functions from DataFrame to DataFrame."""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from oreflow.functions.clock import AsOf
from oreflow.functions.params import render
from oreflow.functions.rows import row_hash
from oreflow.operators.cdc import (
    DELETED,
    SEQUENCE,
    ChangeRules,
    apply_changes,
    change_rows,
    split_changes,
    usable_row,
)
from oreflow.operators.dedup import best_by, latest_by
from oreflow.operators.filters import since
from oreflow.operators.joins import join_master
from oreflow.operators.project import add_metadata_columns, rtrim_strings, select_where
from oreflow.operators.quality import (
    Rule, count_columns, fail_gate, keep, keep_condition, metric_entries, metrics, quarantine, rules_from_json,
)


FILE_FORMATS = ("parquet", "orc", "json", "csv", "text")
TABLE_FORMATS = ("table", "delta", "iceberg", "hudi")


def file_format(name: str | None) -> str:
    """The file format that a spec names; tables of any table format are folders of parquet files here."""
    known = (name or "parquet").lower()
    if known in TABLE_FORMATS:
        return "parquet"
    if known not in FILE_FORMATS:
        raise ValueError(f"format {name!r} is not supported")
    return known


def writer_options(properties: Mapping[str, str] | None) -> tuple[dict[str, str], list[str]]:
    """Table properties as options of a parquet writer, and the names of those that mean nothing to it."""
    given = dict(properties or {})
    known = {k: v for k, v in given.items() if k == "compression" or k.startswith("parquet.")}
    return known, sorted(set(given) - set(known))


@dataclass(frozen=True)
class BronzeFlow:
    """Raw → bronze: filters and added columns, in the order they are declared."""

    source: Mapping[str, str]
    target: Mapping[str, str]
    dataflow_id: str = ""
    source_format: str = "parquet"
    reader_options: Mapping[str, str] = field(default_factory=dict)
    transformations: Sequence[Mapping[str, Any]] = ()
    cluster_by: Sequence[str] = ()
    append_flows: Sequence[Mapping[str, Any]] = ()
    append_schemas: Mapping[str, str] = field(default_factory=dict)

    def file_format(self) -> str:
        """How the source's files are read."""
        return file_format(self.source_format)


@dataclass(frozen=True)
class SilverFlow:
    """Bronze → silver: select, where, trim, deduplicate, expectations, change rules."""

    source: Mapping[str, str]
    target: Mapping[str, str]
    dataflow_id: str = ""
    select: Sequence[str] = ()
    where: Sequence[str] = ()
    rtrim: bool = False
    deduplication: Mapping[str, Any] | None = None
    rules: Sequence[Rule] = ()
    changes: ChangeRules | None = None
    cluster_by: Sequence[str] = ()
    sinks: Sequence[Mapping[str, Any]] = ()


def bronze_flow_of(row: Row) -> BronzeFlow:
    """The flow that a row of the bronze spec table describes."""
    extra = json.loads(row["flowOptions"] or "{}")
    return BronzeFlow(
        source=row["sourceDetails"], target=row["targetDetails"], dataflow_id=row["dataFlowId"],
        source_format=row["sourceFormat"], reader_options=row["readerConfigOptions"] or {},
        transformations=extra.get("transformations") or (), cluster_by=row["clusterBy"] or (),
        append_flows=json.loads(row["appendFlows"] or "[]"), append_schemas=row["appendFlowsSchemas"] or {},
    )


def change_rules_of(text: str | None) -> ChangeRules | None:
    """Change rules from the JSON of a spec row."""
    if not text:
        return None
    given = json.loads(text)
    return ChangeRules(
        keys=given["keys"], sequence_by=given["sequence_by"], delete_when=given.get("apply_as_deletes"),
        except_columns=given.get("except_column_list") or (), key_fallback=given.get("key_fallback") or {},
        soft_delete=bool(given.get("soft_delete")), delete_columns=given.get("delete_columns") or (), scd_type=given.get("scd_type") or "1",
    )


def silver_flow_of(row: Row) -> SilverFlow:
    """The flow that a row of the silver spec table describes."""
    extra = json.loads(row["flowOptions"] or "{}")
    return SilverFlow(
        source=row["sourceDetails"], target=row["targetDetails"], dataflow_id=row["dataFlowId"],
        select=row["selectExp"] or (), where=row["whereClause"] or (), rtrim=bool(extra.get("rtrim")),
        deduplication=extra.get("deduplication"), rules=rules_from_json(row["dataQualityExpectations"]),
        changes=change_rules_of(row["cdcApplyChanges"]), cluster_by=row["clusterBy"] or (), sinks=json.loads(row["sinks"] or "[]"),
    )


def ingest(
    log: DataFrame,
    master: DataFrame | None = None,
    log_key: str | None = None,
    master_key: str | None = None,
    cursor_column: str | None = None,
    cursor: AsOf = None,
    metadata_columns: Mapping[str, Any] | None = None,
    trigger_time: dt.datetime | None = None,
    context: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Raw rows: change log from the cursor on, left-joined to the master, with load columns."""
    if cursor_column and cursor is not None:
        log = since(log, cursor_column, cursor)
    if master is not None:
        log = join_master(log, master, log_key, master_key)
    return add_metadata_columns(log, metadata_columns or {}, trigger_time, context) if metadata_columns else log


_CLOCK = re.compile(r"\bcurrent_(date|timestamp)\s*\(\s*\)", re.IGNORECASE)


def at_moment(sql: str, as_of: AsOf = None) -> str:
    """SQL of a flow with its clock set: every ``current_date()`` and ``current_timestamp()`` becomes ``as_of``."""
    if as_of is None:
        return sql
    if not isinstance(as_of, (dt.datetime, str)):
        raise TypeError("a flow takes its moment as a datetime or as text")
    text = as_of if isinstance(as_of, str) else as_of.isoformat(sep=" ")
    return _CLOCK.sub(lambda m: f"CAST(TIMESTAMP '{text}' AS {m.group(1).upper()})", sql)


def bronze(raw: DataFrame, flow: BronzeFlow, as_of: AsOf = None) -> DataFrame:
    """Bronze rows. A filter may hold an IN subquery on a table; Spark turns it into a semi join."""
    for step in flow.transformations:
        if step["type"] == "filter":
            raw = raw.where(at_moment(step["condition"], as_of))
        elif step["type"] == "add_column":
            raw = raw.withColumns({name: F.expr(at_moment(sql, as_of)) for name, sql in step["columns"].items()})
        else:
            raise ValueError(f"unknown transformation type {step['type']!r}")
    return raw


def selected_rows(bronze_rows: DataFrame, flow: SilverFlow, as_of: dt.datetime | None = None) -> DataFrame:
    """Rows selected, filtered and trimmed, each on its own."""
    where = [render(clause, as_of, {}) for clause in flow.where] if as_of else flow.where
    rows = select_where(bronze_rows, flow.select, [at_moment(clause, as_of) for clause in where])
    return rtrim_strings(rows) if flow.rtrim else rows


@dataclass(frozen=True)
class Deduplication:
    """Which row of each key a flow keeps. Rows that tie in its order are ordered by their hash, so that the choice
    depends neither on partitions nor on batches."""

    partition_by: Sequence[str]
    order_by: Sequence[str]
    n: int = 1

    def order(self, rows: DataFrame) -> list[str | Column]:
        return [*self.order_by, row_hash(rows, ("_origin",)).desc()]  # which batch a row came in makes no difference

    def pick(self, rows: DataFrame) -> DataFrame:
        return latest_by(rows, self.partition_by, self.order(rows), self.n)

    def best(self, rows: DataFrame) -> DataFrame:
        return best_by(rows, self.partition_by, self.order(rows), self.n)


def deduplication_of(flow: SilverFlow) -> Deduplication | None:
    given = flow.deduplication
    if not given or not given.get("enabled"):
        return None
    return Deduplication(given["partition_by"], given["order_by"], int(given.get("row_number") or 1))


def silver_rows(bronze_rows: DataFrame, flow: SilverFlow, as_of: dt.datetime | None = None) -> DataFrame:
    """Rows that the expectations see: selected, filtered, trimmed, deduplicated."""
    rows, dedup = selected_rows(bronze_rows, flow, as_of), deduplication_of(flow)
    return dedup.pick(rows) if dedup else rows


def checked_rows(rows: DataFrame, flow: SilverFlow) -> tuple[DataFrame, Sequence[Rule]]:
    """Rows and rules as the expectations evaluate them.

    A delete has no key of its own, so a rule that names a key column judges inserts and updates only, by the key
    they came with. Deletes get their key afterwards, from the change log or not at all.
    """
    changes = flow.changes
    if not changes or not changes.delete_when:
        return rows, flow.rules
    names = "|".join(re.escape(k) for k in changes.keys)
    of_key = re.compile(rf"(?<![\w.])`?(?:{names})`?(?!\w)", re.IGNORECASE)
    upsert = f"NOT coalesce(({changes.delete_when}), false)"
    rules = [
        replace(r, constraint=f"CASE WHEN {upsert} THEN ({r.constraint}) ELSE true END") if of_key.search(r.constraint) else r
        for r in flow.rules
    ]
    return rows, rules


# Action of the metric that counts applicable rows; it is not an expectation.
REJECT = "reject"


@dataclass(frozen=True)
class SilverResult:
    changes: DataFrame
    quarantined: DataFrame
    metrics: DataFrame


def split_silver(rows: DataFrame, rules: Sequence[Rule], changes: ChangeRules | None) -> SilverResult:
    """Checked rows split by their rules, and all counts in one pass.

    Rows without key or sequence cannot be applied and join the quarantine. The last metric, with action
    ``REJECT``, tells how many of the kept rows can be applied.
    """
    kept, held = keep(rows, rules), quarantine(rows, rules)
    if changes:
        marked = change_rows(kept, changes)
        applied, rejected = split_changes(marked, changes)
        held = held.unionByName(rejected.select(*held.columns))
        kept = applied.drop(SEQUENCE, DELETED)
    counts = metrics(rows, [*rules], within=keep_condition(rules), extra=_usable(changes))
    return SilverResult(kept, held, counts)


def _usable(changes: ChangeRules | None) -> dict[str, Column]:
    return {REJECT: usable_row(changes) if changes else F.lit(True)}


def silver_counts(rules: Sequence[Rule], changes: ChangeRules | None) -> list[Column]:
    """The counts of ``split_silver`` as aggregates, for a ``Tally``."""
    return count_columns(rules, keep_condition(rules), _usable(changes))


def silver_entries(counts: Mapping[str, int], rules: Sequence[Rule]) -> list[dict]:
    """The metrics of ``split_silver`` from these counts."""
    return metric_entries(counts, rules, (REJECT,))


def silver_changes(
    bronze_rows: DataFrame, flow: SilverFlow, as_of: dt.datetime | None = None, gate: bool = True
) -> SilverResult:
    """Business rows that passed the expectations, the rows that did not, and the counts."""
    rows, rules = checked_rows(silver_rows(bronze_rows, flow, as_of), flow)
    if gate:
        fail_gate(rows, rules)
    result = split_silver(rows, rules, flow.changes)
    return SilverResult(result.changes, result.quarantined, result.metrics.where(F.col("action") != REJECT))


def silver(bronze_rows: DataFrame, flow: SilverFlow, as_of: dt.datetime | None = None, gate: bool = False) -> DataFrame:
    """The silver table built from all bronze rows at once."""
    kept = silver_changes(bronze_rows, flow, as_of, gate).changes
    return apply_changes(kept, flow.changes) if flow.changes else kept


def silver_of(rows: DataFrame, flow: SilverFlow) -> DataFrame:
    """The silver table of rows that are selected and deduplicated already."""
    kept = split_silver(*checked_rows(rows, flow), flow.changes).changes
    return apply_changes(kept, flow.changes) if flow.changes else kept


__all__ = [
    "BronzeFlow", "Deduplication", "SilverFlow", "SilverResult", "at_moment", "bronze", "deduplication_of", "bronze_flow_of", "change_rules_of",
    "REJECT", "checked_rows", "ingest", "silver", "silver_changes", "silver_flow_of", "selected_rows", "silver_of",
    "silver_counts", "silver_entries", "silver_rows", "split_silver",
]
