"""Expectations: rules that warn, drop, quarantine or fail."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spec key of each action.
ACTION_KEYS = {
    "warn": "expect",
    "fail": "expect_or_fail",
    "drop": "expect_or_drop",
    "quarantine": "expect_or_quarantine",
}
FAILED_RULES = "failed_rules"


class QualityError(Exception):
    """A fail rule was violated; ``offenders`` maps rule name to the number of rows."""

    def __init__(self, offenders: Mapping[str, int]):
        self.offenders = dict(offenders)
        super().__init__("expectations failed: " + ", ".join(f"{k} ({v} rows)" for k, v in self.offenders.items()))


@dataclass(frozen=True)
class Rule:
    name: str
    constraint: str
    action: str = "warn"

    @property
    def holds(self) -> Column:
        """True only where the constraint is true: a constraint that yields null is violated."""
        return F.coalesce(F.expr(self.constraint), F.lit(False))


def rules_from(expectations: Iterable[Mapping[str, str]] | None) -> list[Rule]:
    """Rules from a list of {name, constraint, action}. Unknown actions warn; the last of equal names wins."""
    rules: dict[tuple[str, str], Rule] = {}
    for item in expectations or ():
        action = (item.get("action") or "warn").lower()
        action = action if action in ACTION_KEYS else "warn"
        rule = Rule(item.get("name") or "unnamed", item.get("constraint") or "true", action)
        rules[(action, rule.name)] = rule
    return list(rules.values())


def rules_from_json(text: str | None) -> list[Rule]:
    """Rules from the JSON held in a spec row: {action key: {name: constraint}}."""
    parsed = json.loads(text) if text else {}
    return [
        Rule(name, constraint, action)
        for action, key in ACTION_KEYS.items()
        for name, constraint in parsed.get(key, {}).items()
    ]


def _with_action(rules: Sequence[Rule], *actions: str) -> list[Rule]:
    return [r for r in rules if r.action in actions]


def _all_hold(rules: Sequence[Rule]) -> Column:
    condition = F.lit(True)
    for rule in rules:
        condition = condition & rule.holds
    return condition


def failed_rules(rules: Sequence[Rule]) -> Column:
    """Names of the violated rules, in rule order."""
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(~r.holds, F.lit(r.name)) for r in rules]))


def count_columns(
    rules: Sequence[Rule], within: Column | None = None, extra: Mapping[str, Column] | None = None
) -> list[Column]:
    """The counts behind ``metrics`` as aggregates: total, violations per rule, and what ``extra`` conditions give."""
    among, extra = F.lit(True) if within is None else within, extra or {}
    failed = [F.count_if(~r.holds) for r in rules] + [F.count_if(among & ~holds) for holds in extra.values()]
    passed = [F.count_if(among & holds).alias(f"p{i}") for i, holds in enumerate(extra.values())]
    return [F.count(F.lit(1)).alias("total"), *[count.alias(f"f{i}") for i, count in enumerate(failed)], *passed]


def metrics(
    df: DataFrame, rules: Sequence[Rule], within: Column | None = None, extra: Mapping[str, Column] | None = None
) -> DataFrame:
    """Passed and failed rows per rule, all rules in one pass over the columns they use.

    ``extra`` conditions, named by their action, are counted in the same pass among the rows that meet ``within``.
    """
    extra = extra or {}
    counts = df.agg(*count_columns(rules, within, extra))

    def entry(name: str, action: str, passed: Column, number: int) -> Column:
        return F.struct(
            F.lit(name).alias("rule"), F.lit(action).alias("action"), passed.alias("passed"),
            F.col(f"f{number}").alias("failed"),
        )

    entries = [entry(r.name, r.action, F.col("total") - F.col(f"f{i}"), i) for i, r in enumerate(rules)]
    entries += [entry(name, name, F.col(f"p{i}"), len(rules) + i) for i, name in enumerate(extra)]
    listed = F.array(*entries).cast("array<struct<rule:string,action:string,passed:bigint,failed:bigint>>")
    return counts.select("total", F.inline(listed)).select("rule", "action", "passed", "failed", "total")


def metric_entries(counts: Mapping[str, int], rules: Sequence[Rule], extra: Sequence[str] = ()) -> list[dict]:
    """The rows of ``metrics`` from counts that were taken otherwise, as dicts."""
    total = counts["total"]
    rows = [
        {"rule": r.name, "action": r.action, "passed": total - counts[f"f{i}"], "failed": counts[f"f{i}"]}
        for i, r in enumerate(rules)
    ] + [
        {"rule": name, "action": name, "passed": counts[f"p{i}"], "failed": counts[f"f{len(rules) + i}"]}
        for i, name in enumerate(extra)
    ]
    return [{**row, "total": total} for row in rows]


def violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Offending fail rules with their row counts; empty when the gate is open."""
    gate = _with_action(rules, "fail")
    return metrics(df, gate).where(F.col("failed") > 0).select("rule", "failed")


def raise_offenders(metric_rows: Iterable[Mapping]) -> None:
    """Raise ``QualityError`` when collected metrics show a violated fail rule."""
    offenders = {row["rule"]: row["failed"] for row in metric_rows if row["action"] == "fail" and row["failed"]}
    if offenders:
        raise QualityError(offenders)


def fail_gate(df: DataFrame, rules: Sequence[Rule]) -> None:
    """Raise ``QualityError`` when a fail rule is violated. Runs before anything is written."""
    gate = _with_action(rules, "fail")
    if gate:
        raise_offenders(row.asDict() for row in metrics(df, gate).collect())


def keep_condition(rules: Sequence[Rule]) -> Column:
    return _all_hold(_with_action(rules, "drop", "quarantine"))


def keep(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that no drop rule and no quarantine rule rejects."""
    return df.where(keep_condition(rules))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that a quarantine rule rejects, with the names of those rules."""
    held = _with_action(rules, "quarantine")
    return df.withColumn(FAILED_RULES, failed_rules(held)).where(F.size(FAILED_RULES) > 0)


@dataclass(frozen=True)
class QualityResult:
    kept: DataFrame
    quarantined: DataFrame
    metrics: DataFrame


def check(df: DataFrame, rules: Sequence[Rule], gate: bool = True) -> QualityResult:
    """Carry out all rules. With ``gate`` the fail rules are counted at once, before the result is returned."""
    if gate:
        fail_gate(df, rules)
    return QualityResult(keep(df, rules), quarantine(df, rules), metrics(df, rules))


def reprocess(quarantined: DataFrame, corrections: Mapping[str, str], rules: Sequence[Rule]) -> QualityResult:
    """Correct quarantined rows with SQL expressions and send them through the same rules again."""
    corrected = quarantined.drop(FAILED_RULES)
    if corrections:
        corrected = corrected.withColumns({name: F.expr(sql) for name, sql in corrections.items()})
    return check(corrected, rules, gate=False)


def event_log(metric_rows: DataFrame, dataflow_id: str, as_of: Column) -> DataFrame:
    """Metrics as event-log rows whose ``details`` hold the expectation counts as JSON."""
    expectation = F.struct(
        F.col("rule").alias("name"), F.col("passed").alias("passed_records"), F.col("failed").alias("failed_records")
    )
    metric = F.struct(F.struct(F.array(expectation).alias("expectations")).alias("data_quality"))
    return metric_rows.select(
        as_of.alias("timestamp"),
        F.lit(dataflow_id).alias("dataflow_id"),
        F.lit("flow_progress").alias("event_type"),
        F.to_json(F.struct(metric.alias("flow_progress"))).alias("details"),
    )


def expectation_events(log: DataFrame) -> DataFrame:
    """Expectation counts read back from the JSON of an event log; other events are left out."""
    path = "$.flow_progress.data_quality.expectations"
    parsed = F.from_json(
        F.get_json_object("details", path),
        "array<struct<name:string,passed_records:bigint,failed_records:bigint>>",
    )
    return (
        log.where(F.get_json_object("details", path).isNotNull())
        .select("timestamp", "dataflow_id", F.inline(parsed))
        .withColumnsRenamed({"name": "rule", "passed_records": "passed", "failed_records": "failed"})
    )
