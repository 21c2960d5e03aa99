"""Type-1 change application.

A change row is the business row plus ``_sequence`` and ``_deleted``. The state of a target is a set of change
rows with one row per key, deleted keys included, so that a late, older update cannot revive them. Merging two
such sets keeps, per key, the row that is greatest in (sequence, deleted, row hash). That order is total, so
merging may be split, reordered and repeated without changing the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.functions.rows import comparable, row_hash
from oreflow.operators.dedup import latest_by

SEQUENCE = "_sequence"
DELETED = "_deleted"
CHANGE_TYPE = "_change_type"
CHANGES = "_changes"
LAST = "_last"


@dataclass(frozen=True)
class ChangeRules:
    """How changes are applied.

    ``key_fallback`` names, per key column, a column that supplies the key of a delete where it is null: a delete
    has lost its master row, and with it the key, but the change log still knows which key it was.

    With ``soft_delete`` a deleted row stays, flagged in ``soft_delete_column``, with the values of the last insert
    or update; of the delete it takes the columns in ``delete_columns`` (the time of the delete, say).
    """

    keys: Sequence[str]
    sequence_by: str
    delete_when: str | None = None
    except_columns: Sequence[str] = ()
    key_fallback: Mapping[str, str] = field(default_factory=dict)
    soft_delete: bool = False
    soft_delete_column: str = "is_del"
    delete_columns: Sequence[str] = ()
    scd_type: str = "1"

    def __post_init__(self) -> None:
        if str(self.scd_type) != "1":
            raise ValueError(f"scd_type {self.scd_type!r} is not supported; only '1' is")
        if not self.keys:
            raise ValueError("at least one key column is needed")


def is_delete(rules: ChangeRules) -> Column:
    """Whether a business row deletes its key."""
    return F.coalesce(F.expr(rules.delete_when), F.lit(False)) if rules.delete_when else F.lit(False)


def change_rows(df: DataFrame, rules: ChangeRules) -> DataFrame:
    """Business rows as change rows: sequence and delete flag evaluated, and the keys of deletes filled.

    An insert or update that has lost its key keeps none, so that it is rejected instead of applied.
    """
    df = df.withColumns({SEQUENCE: F.expr(rules.sequence_by), DELETED: is_delete(rules)})
    return df.withColumns({
        k: F.when(F.col(DELETED), F.coalesce(F.col(k), F.col(other))).otherwise(F.col(k))
        for k, other in rules.key_fallback.items()
    }) if rules.key_fallback else df


def usable_change(rules: ChangeRules) -> Column:
    """A change row has all its keys and a sequence."""
    usable = F.col(SEQUENCE).isNotNull()
    for key in rules.keys:
        usable = usable & F.col(key).isNotNull()
    return usable


def usable_row(rules: ChangeRules) -> Column:
    """The same of a business row, before its keys are filled."""
    usable = F.expr(rules.sequence_by).isNotNull()
    for key in rules.keys:
        other = rules.key_fallback.get(key)
        filled = F.col(key).isNotNull()
        usable = usable & (filled if other is None else filled | (is_delete(rules) & F.col(other).isNotNull()))
    return usable


def split_changes(changes: DataFrame, rules: ChangeRules) -> tuple[DataFrame, DataFrame]:
    """(usable, rejected): rows without key or sequence cannot be ordered and are set apart with a reason."""
    reasons = [F.when(F.col(k).isNull(), F.lit(f"null key: {k}")) for k in rules.keys]
    reasons.append(F.when(F.col(SEQUENCE).isNull(), F.lit("null sequence")))
    rejected = (
        changes.where(~usable_change(rules)).withColumn("failed_rules", F.array_compact(F.array(*reasons)))
    )
    return changes.where(usable_change(rules)), rejected


def stored_columns(changes: DataFrame, rules: ChangeRules) -> DataFrame:
    """Change rows without the excepted columns, which keys, sequence and delete flag have been made of by now.

    Keys stay until the target is read, even if excepted.
    """
    keys = {k.lower() for k in rules.keys}
    return changes.drop(*[c for c in rules.except_columns if c.lower() not in keys])


def latest_changes(changes: DataFrame, rules: ChangeRules) -> DataFrame:
    """One change row per key: the greatest sequence; on a tie a delete wins, then the greater row hash.

    Excepted columns go first, so that they are neither hashed nor shuffled nor, if nothing else needs them, read.
    """
    changes = stored_columns(changes, rules)
    if rules.soft_delete:
        return latest_two(changes, rules)
    return latest_by(changes, list(rules.keys), [F.col(SEQUENCE).desc(), F.col(DELETED).desc(), _hash(changes).desc()])


def _hash(changes: DataFrame) -> Column:
    return row_hash(changes, (SEQUENCE, DELETED, LAST))


def latest_two(changes: DataFrame, rules: ChangeRules) -> DataFrame:
    """One change row per key and, beside it in ``_last``, sequence and values of the key's last insert or update.

    They ride along with the state, because the delete itself may carry nothing but its key. Both are maxima of one
    aggregation that is partial before the only shuffle, so a busy key costs one row per task, and both merge like any
    maximum: what a stored delete was given when it was merged is one more candidate.
    """
    keys, columns = list(rules.keys), [c for c in changes.columns if c != LAST]
    values = [c for c in columns if c not in (*keys, SEQUENCE, DELETED)]
    own = F.struct(F.col(SEQUENCE).alias("at"), _hash(changes).alias("hash"), F.struct(*values).alias("row"))
    own = F.when(~F.col(DELETED), own)
    if LAST in changes.columns:
        own = F.coalesce(own, F.col(LAST))
    rows = changes.select(
        *keys, F.struct(*[c for c in columns if c not in keys]).alias("_row"),
        F.struct(SEQUENCE, DELETED, _hash(changes).alias("_hash")).alias("_order"), own.alias(LAST))
    # Without an insert or update there is no order either, and max_by passes over rows whose order is null.
    last = F.when(F.col(LAST).isNotNull(), F.struct(F.col(f"{LAST}.at"), F.col(f"{LAST}.hash")))
    newest = rows.groupBy(*keys).agg(F.max_by("_row", "_order").alias("_row"), F.max_by(LAST, last).alias(LAST))
    return newest.select(*keys, "_row.*", LAST).select(*columns, LAST)


def live_columns(state: DataFrame, rules: ChangeRules, prefix: str = "") -> dict[str, Column]:
    """Columns of the target as readers see them, by name; ``prefix`` leads to the state's columns."""
    dropped = {c.lower() for c in (SEQUENCE, DELETED, LAST, CHANGES, *rules.except_columns)}
    deleted, flag, last = F.col(f"{prefix}{DELETED}"), rules.soft_delete_column.lower(), set()
    if rules.soft_delete:
        dropped.add(flag)
        if LAST in state.columns:
            last = {f.name for f in state.schema[LAST].dataType["row"].dataType.fields}
    own = {c.lower() for c in (*rules.keys, *rules.delete_columns)}
    columns = {
        c: F.when(deleted, F.col(f"{prefix}{LAST}.row.{c}")).otherwise(F.col(f"{prefix}{c}"))
        if c in last and c.lower() not in own else F.col(f"{prefix}{c}")
        for c in state.columns if c.lower() not in dropped
    }
    return columns | ({rules.soft_delete_column: F.when(deleted, "Y").otherwise("N")} if rules.soft_delete else {})


def live_rows(state: DataFrame, rules: ChangeRules) -> DataFrame:
    """The target table seen by readers: no tombstones, no bookkeeping, no excepted columns."""
    rows = state if rules.soft_delete else state.where(~F.col(DELETED))
    return rows.select(*[c.alias(name) for name, c in live_columns(state, rules).items()])


def apply_changes(df: DataFrame, rules: ChangeRules) -> DataFrame:
    """Current rows after all changes in ``df``, whatever their order. One shuffle, on the keys."""
    usable, _ = split_changes(change_rows(df, rules), rules)
    return live_rows(latest_changes(usable, rules), rules)


def merge_changes(state: DataFrame, changes: DataFrame, rules: ChangeRules) -> DataFrame:
    """State after ``changes`` (both change rows): union and reduce, one shuffle of both sides."""
    changes = stored_columns(changes, rules)
    return latest_changes(stored_columns(state, rules).unionByName(changes, allowMissingColumns=True), rules)


def merge_with_changes(state: DataFrame, changes: DataFrame, rules: ChangeRules, reduced: bool = False) -> DataFrame:
    """State after ``changes`` (as ``merge_changes``), each row with what the merge changed of it for readers.

    One outer join of the state and the reduced batch: each is read once, and a state that is bucketed by its keys stays
    where it is for a batch of any size. ``_changes`` holds the entries of ``change_feed`` for the key, before and after
    being the readers' views; it is null for keys that the batch does not touch, or touches without effect. Stored with
    the state it is the feed of this merge (``change_entries``) and costs other readers nothing.
    """
    keys = list(rules.keys)
    state, changes = stored_columns(state, rules).drop(CHANGES), stored_columns(changes, rules)
    latest = changes if reduced else latest_changes(changes, rules)
    columns = [*state.columns, *[c for c in latest.columns if c not in state.columns]]
    state = state.unionByName(latest.limit(0), allowMissingColumns=True).select(*columns)
    latest = latest.unionByName(state.limit(0), allowMissingColumns=True).select(*columns)

    def side(frame: DataFrame, name: str) -> DataFrame:
        order = F.struct(F.col(SEQUENCE), F.col(DELETED), _hash(frame).alias("_hash"))
        return frame.select(*keys, F.struct(*columns).alias(f"_{name}"), order.alias(f"_{name}_order"))

    pairs = side(state, "held").join(side(latest, "given"), keys, "full_outer")
    newer = F.col("_held").isNull() | F.coalesce(F.col("_given_order") > F.col("_held_order"), F.lit(False))
    kept = F.when(newer, F.col("_given")).otherwise(F.col("_held"))
    if rules.soft_delete:
        held, given = F.col(f"_held.{LAST}"), F.col(f"_given.{LAST}")
        later = held.isNull() | (F.struct(given["at"], given["hash"]) > F.struct(held["at"], held["hash"]))
        kept = kept.withField(LAST, F.when(given.isNotNull() & later, given).otherwise(held))
    pairs = pairs.select("_held", kept.alias("_kept"), F.col("_given").isNotNull().alias("_touched"))
    seen = pairs.select("_kept", "_touched", _seen(pairs, "_held", rules).alias("_old"), _seen(pairs, "_kept", rules).alias("_new"))
    changed = F.col("_touched") & ~_compared(seen, "_old").eqNullSafe(_compared(seen, "_new"))
    return seen.select("_kept.*", F.when(changed, _entries("_old", "_new")).alias(CHANGES))


def _seen(pairs: DataFrame, name: str, rules: ChangeRules) -> Column:
    """Readers' view of the state row in column ``name``; null where they see none."""
    row = pairs.select(f"{name}.*")
    shown, deleted = live_columns(row, rules, f"{name}."), F.col(f"{name}.{DELETED}")
    visible = F.col(name).isNotNull() if rules.soft_delete else F.col(name).isNotNull() & ~deleted
    return F.when(visible, F.struct(*[c.alias(n) for n, c in shown.items()]))


def change_entries(merged: DataFrame) -> DataFrame:
    """The change feed that ``merge_with_changes`` left in a state."""
    entries = merged.where(F.col(CHANGES).isNotNull()).select(F.explode(CHANGES).alias("_entry"))
    return entries.select("_entry.row.*", F.col("_entry.kind").alias(CHANGE_TYPE))


def overlay_changes(state: DataFrame, changes: DataFrame, rules: ChangeRules, reduced: bool = False) -> DataFrame:
    """Same result as ``merge_changes`` for a batch that is small against a state that is not bucketed.

    The batch is reduced first, unless it is known to be, and joined to the state twice. Adaptive execution
    broadcasts it when its measured size allows, and then the state is scanned without being shuffled; the second
    scan reads the key columns only, which costs less than to shuffle all rows for the one outer join of
    ``merge_with_changes``. A batch too large for that falls back to shuffled joins, where ``merge_changes`` is cheaper.
    """
    if rules.soft_delete:  # a kept row is made of two, which only the merge of both sides sees
        return merge_changes(state, changes, rules)
    keys = list(rules.keys)
    state, changes = stored_columns(state, rules), stored_columns(changes, rules)
    columns = [*state.columns, *[c for c in changes.columns if c not in state.columns]]
    state = state.unionByName(changes.limit(0), allowMissingColumns=True).select(*columns)
    latest = changes if reduced else latest_changes(changes.dropna(subset=keys), rules)
    latest = latest.unionByName(state.limit(0), allowMissingColumns=True).select(*columns)

    def order(frame: DataFrame) -> Column:
        return F.struct(F.col(SEQUENCE), F.col(DELETED), _hash(frame).alias("_hash"))

    held = state.select(*keys, F.struct(*columns).alias("_held"), order(state).alias("_held_order"))
    given = latest.select(*keys, F.struct(*columns).alias("_given"), order(latest).alias("_given_order"))
    newer = F.col("_given_order") > F.col("_held_order")
    kept = held.join(given, keys, "left").select(
        F.when(F.coalesce(newer, F.lit(False)), F.col("_given")).otherwise(F.col("_held")).alias("_row")
    )
    # Only the right side of an anti join can be broadcast, so the state's keys are cut to those of the batch.
    known = state.select(*keys).join(latest.select(*keys), keys, "left_semi")
    added = latest.join(known, keys, "left_anti").select(*columns)
    return kept.select("_row.*").unionByName(added)


def apply_changes_incremental(
    state: DataFrame | None, batch: DataFrame, rules: ChangeRules, small_batch: bool = False
) -> DataFrame:
    """New state, tombstones included, after a batch of business rows. ``live_rows`` gives the readers' view."""
    usable, _ = split_changes(change_rows(batch, rules), rules)
    if state is None:
        return latest_changes(usable, rules)
    merge = overlay_changes if small_batch else merge_changes
    return merge(state, usable, rules)


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Differences of two snapshots that are unique on ``keys``.

    Rows carry ``_change_type``: insert, delete, update_preimage and update_postimage. Unchanged rows are left
    out before the update pairs are formed.
    """
    columns = list(before.columns)
    if {c.lower() for c in columns} != {c.lower() for c in after.columns}:
        raise ValueError("snapshots have different columns")
    after = after.select(*columns)

    def side(frame: DataFrame, name: str) -> DataFrame:
        return frame.select(*keys, F.struct(*columns).alias(name))

    pairs = side(before, "_old").join(side(after, "_new"), list(keys), "full_outer")
    changed = pairs.where(~_compared(pairs, "_old").eqNullSafe(_compared(pairs, "_new")))
    return (
        changed.select(F.explode(_entries("_old", "_new")).alias("_entry"))
        .select("_entry.row.*", F.col("_entry.kind").alias(CHANGE_TYPE))
    )


def _compared(pairs: DataFrame, name: str) -> Column:
    """The row of one side in comparable form; null when that side has no row."""
    fields = [comparable(f, f"{name}.").alias(f.name) for f in pairs.schema[name].dataType.fields]
    return F.when(F.col(name).isNotNull(), F.struct(*fields))


def _entries(old: str, new: str) -> Column:
    """The change entries of a key whose row was ``old`` and is ``new``; either may be missing."""
    def entry(kind: str, name: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(name).alias("row"))

    return (
        F.when(F.col(old).isNull(), F.array(entry("insert", new)))
        .when(F.col(new).isNull(), F.array(entry("delete", old)))
        .otherwise(F.array(entry("update_preimage", old), entry("update_postimage", new)))
    )


def snapshot_changes(before: DataFrame, after: DataFrame, keys: Sequence[str], version: int) -> DataFrame:
    """Change rows that turn snapshot ``before`` into ``after``, sequenced by the snapshot version."""
    feed = change_feed(before, after, keys).where(F.col(CHANGE_TYPE) != "update_preimage")
    return feed.withColumns(
        {SEQUENCE: F.lit(version).cast("long"), DELETED: F.col(CHANGE_TYPE) == "delete"}
    ).drop(CHANGE_TYPE)


def apply_changes_from_snapshot(
    state: DataFrame, snapshot: DataFrame, rules: ChangeRules, version: int
) -> DataFrame:
    """New state after a full snapshot: rows missing from it are deleted, the others inserted or updated."""
    held = state.where(~F.col(DELETED)).drop(SEQUENCE, DELETED, LAST)
    return merge_changes(state, snapshot_changes(held, snapshot, rules.keys, version), rules)
