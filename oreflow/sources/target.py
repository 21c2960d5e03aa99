"""A type-1 target as files: a base state plus the reduced change batches written since.

Plain parquet has no merge statement. Rewriting the whole target for every batch would cost its full size each
time, so a batch is only reduced to one row per key and appended, and readers merge. ``compact`` folds the
batches into a new base from time to time. Because merging change rows may be repeated and reordered freely
(see ``oreflow.operators.cdc``), a batch that is written twice, or a compaction that dies halfway, does no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from oreflow.functions.schema import struct
from oreflow.operators.cdc import (
    CHANGES,
    ChangeRules,
    change_entries,
    change_rows,
    latest_changes,
    live_rows,
    merge_changes,
    merge_with_changes,
    overlay_changes,
    split_changes,
)
from oreflow.sources.readers import open_table

SOURCE, BATCH = "_source", "_batch"


FOLD_SCHEMA = struct({"number": "bigint"})


class LatestRows:
    """The rows that a deduplication over a whole stream keeps, on plain files.

    Each batch is cut to the best n rows of each key, which is all that later batches can leave of it. Such sets merge to
    the best n rows of both, in any order, so after ``fold_every`` batches they are folded into one state; readers see the
    state and the batches since then, and open no more files than that however long the stream has run.

    Batches lie below ``epoch=K/_source=S/_batch=N``, the state of fold K, which begins epoch K, below ``state/number=K``.
    State rows remember their batch. So the same batch again replaces itself, even if it has been folded: readers leave
    out of the state what the epoch has anew. One writer at a time; files of earlier epochs stay.
    """

    def __init__(
        self, spark: SparkSession, path: str, best: Callable[[DataFrame], DataFrame], pick: Callable[[DataFrame], DataFrame],
        fold_every: int = 20,
    ):
        self.spark, self.path, self.best, self.pick, self.fold_every = spark, path.rstrip("/"), best, pick, fold_every
        #: Epoch and its batches, as this writer has left them; read once.
        self._now: tuple[int, set[str]] | None = None

    def epoch(self) -> int:
        folds = open_table(self.spark, f"{self.path}/folds", schema=FOLD_SCHEMA)
        return 0 if folds is None else folds.agg(F.max("number")).first()[0] or 0

    def append(self, rows: DataFrame, batch_id: int, source: str = "batch") -> None:
        if self._now is None:
            epoch = self.epoch()
            self._now = epoch, self._batches(epoch)
        if len(self._now[1]) >= self.fold_every:
            self._now = self.fold((source, batch_id)), set()
        place = f"{SOURCE}={source}/{BATCH}={batch_id}"
        self.best(rows).write.mode("overwrite").parquet(f"{self.path}/epoch={self._now[0]}/{place}")
        self._now[1].add(place)

    def fold(self, without: tuple[str, int] | None = None) -> int:
        """Begin the next epoch with one state of all that is written, but for a batch that is about to come again."""
        number = self.epoch() + 1
        held = self._held(without)
        if held is None:
            return number - 1
        self.best_of(held).write.mode("overwrite").parquet(f"{self.path}/state/number={number}")
        self.spark.range(0, 1, 1, 1).select(F.lit(number).cast("long").alias("number")).write.mode("append").parquet(f"{self.path}/folds")
        return number

    def best_of(self, held: DataFrame) -> DataFrame:
        """The best rows of each key with the batch they came in; the order must not see that."""
        origin = F.struct(SOURCE, BATCH).alias("_origin")
        rows = held.drop(SOURCE, BATCH)
        packed = held.select(*[F.col(f"`{c}`") for c in rows.columns], origin)
        return self.best(packed).select(*[F.col(f"`{c}`") for c in rows.columns], "_origin.*")

    def _batches(self, epoch: int) -> set[str]:
        """The batches of an epoch; there are not many more than ``fold_every``."""
        held = open_table(self.spark, f"{self.path}/epoch={epoch}", mergeSchema="true")
        return set() if held is None else {"/".join(file.split("/")[-3:-1]) for file in held.inputFiles()}

    def _held(self, without: tuple[str, int] | None = None) -> DataFrame | None:
        """All rows that count, with the batch they came in."""
        epoch = self.epoch()
        new = open_table(self.spark, f"{self.path}/epoch={epoch}", mergeSchema="true")
        if new is not None:
            new = new.withColumns({SOURCE: F.col(SOURCE).cast("string"), BATCH: F.col(BATCH).cast("long")})
        if epoch:
            state = self.spark.read.parquet(f"{self.path}/state/number={epoch}")
            if new is not None:
                state = state.join(new.select(SOURCE, BATCH).distinct(), [SOURCE, BATCH], "left_anti")
                new = state.unionByName(new, allowMissingColumns=True)
            else:
                new = state
        if new is not None and without:
            new = new.where(~(F.col(SOURCE).eqNullSafe(without[0]) & F.col(BATCH).eqNullSafe(without[1])))
        return new

    def candidates(self, without: tuple[str, int] | None = None) -> DataFrame | None:
        """The best rows of all batches, or of all but one (source, id)."""
        held = self._held(without)
        return None if held is None else held.drop(SOURCE, BATCH)

    def current(
        self, more: DataFrame | None = None, batch: tuple[str, int] | None = None, touched: tuple[DataFrame, Sequence[str]] | None = None
    ) -> DataFrame | None:
        """The kept rows of all batches, with ``more`` in the place of what is written of a (source, id). With ``touched``,
        a frame and key columns, those of its keys only."""
        held = self.candidates(batch)
        if held is not None and touched:
            keys = list(touched[1])
            given = touched[0].select(*[F.col(f"`{k}`").alias(f"_{i}") for i, k in enumerate(keys)]).distinct()
            held = held.join(given, [F.col(f"`{k}`").eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)], "left_semi")
        rows = more if held is None else held if more is None else held.unionByName(more, allowMissingColumns=True)
        return None if rows is None else self.pick(rows)


LOG_SCHEMA = struct({"number": "bigint", "kind": "string", "source": "string", "batch": "bigint"})


class ChangeTarget:
    """Layout below ``path``: ``changes/_source=S/_batch=N`` and ``base/upto=M`` hold change rows, ``log`` numbers the
    finished ones. A base holds everything up to its number.

    A batch is known by its source and id, so batches of another stream, or of the same stream after it lost its
    checkpoint, never replace each other. Readers see only what the log names, and an entry is logged after its
    files are complete. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, rules: ChangeRules, buckets: int | None = None, feed: bool = False):
        """With ``buckets`` the base is a bucketed external table of the session catalog: merging shuffles the
        batches only, to the buckets of the base, whatever their size. The number of buckets stays for good.

        With ``feed`` a compaction stores, beside each row, what it changed of it; see ``change_feed``."""
        self.spark = spark
        self.path = path.rstrip("/")
        self.rules = rules
        self.buckets = buckets
        self.feed = feed

    def append(self, changes: DataFrame, batch_id: int, source: str = "batch") -> None:
        """Apply a batch of business rows. The same batch of the same source again replaces the first.

        Rows without key or sequence cannot be applied; they are kept, with the reason, under ``rejected``.
        """
        usable, rejected = split_changes(change_rows(changes, self.rules), self.rules)
        rejected.write.mode("overwrite").parquet(f"{self.path}/rejected/{self._place(source, batch_id)}")
        self.append_reduced(latest_changes(usable, self.rules), batch_id, source)

    def append_reduced(
        self, latest: DataFrame, batch_id: int, source: str = "batch", gate: Callable[[], None] | None = None
    ) -> None:
        """Apply rows that are change rows already, one per key. ``gate`` is called when they are written and readers
        do not see them yet; what it raises keeps them unseen."""
        latest.write.mode("overwrite").parquet(f"{self.path}/changes/{self._place(source, batch_id)}")
        if gate:
            gate()
        log = self._read_log()
        last = log.agg(F.max("number")).first()[0] if log is not None else None
        self._log((last or 0) + 1, "changes", source, batch_id)

    def applied(self, batch_id: int, source: str = "batch") -> bool:
        """Whether readers see the batch already, as when it comes again after a failure."""
        log = self._read_log()
        same = (F.col("kind") == "changes") & (F.col("source") == source) & (F.col("batch") == batch_id)
        return log is not None and not log.where(same).isEmpty()

    def rejected(self) -> DataFrame | None:
        """Rows that ``append`` could not apply."""
        held = open_table(self.spark, f"{self.path}/rejected", mergeSchema="true")
        return None if held is None else held.drop(SOURCE, BATCH)

    @staticmethod
    def _place(source: str, batch_id: int) -> str:
        return f"{SOURCE}={source}/{BATCH}={batch_id}"

    def _log(self, number: int, kind: str, source: str | None = None, batch_id: int | None = None) -> None:
        values = {"number": number, "kind": kind, "source": source, "batch": batch_id}
        entry = self.spark.range(0, 1, 1, 1).select(
            *[F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in LOG_SCHEMA.fields]
        )
        entry.write.mode("append").parquet(f"{self.path}/log")

    def _read_log(self) -> DataFrame | None:
        return open_table(self.spark, f"{self.path}/log", schema=LOG_SCHEMA)

    def _pending(self) -> tuple[int | None, list[Row]]:
        """(number the base holds, batches logged since); as many rows as there are uncompacted batches."""
        log = self._read_log()
        if log is None:
            return None, []
        folded = log.where(F.col("kind") == "base").agg(F.max("number")).first()[0]
        entries = log.where((F.col("kind") == "changes") & (F.col("number") > (folded or 0)))
        return folded, entries.orderBy("number").collect()

    def pending_batches(self) -> int:
        """Batches that the next compaction would fold."""
        return len(self._pending()[1])

    def state(self, small_batches: bool = False) -> DataFrame | None:
        """Change rows, one per key, tombstones included; None when nothing was ever written.

        ``small_batches`` chooses the merge that leaves the base unshuffled while the batches can be broadcast.
        """
        return self._state(*self._pending(), small_batches)

    def _base_table(self, number: int) -> str:
        """Catalog name of a bucketed base; it depends on the location only."""
        return f"oreflow_{hashlib.sha256(self.path.encode()).hexdigest()[:16]}_{number}"

    def _base(self, number: int) -> DataFrame:
        location = f"{self.path}/base/upto={number}"
        base = self.spark.read.parquet(location)
        if self.buckets is None:
            return base
        name, keys = self._base_table(number), ", ".join(f"`{k}`" for k in self.rules.keys)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{location}'"
            )
        return self.spark.table(name)

    def _state(self, folded: int | None, entries: list[Row], small_batches: bool) -> DataFrame | None:
        base = None if folded is None else self._base(folded).drop(CHANGES)
        if not entries:
            return base
        pending, reduced = self._changes(entries)
        if base is None:
            return pending if reduced else latest_changes(pending, self.rules)
        if self.buckets:
            return merge_with_changes(base, pending, self.rules, reduced).drop(CHANGES)
        return overlay_changes(base, pending, self.rules, reduced) if small_batches else merge_changes(base, pending, self.rules)

    def _changes(self, entries: list[Row]) -> tuple[DataFrame, bool]:
        """The changes of the batches, and whether they have one row per key."""
        places = dict.fromkeys(f"{self.path}/changes/{self._place(e['source'], e['batch'])}" for e in entries)
        pending = self.spark.read.option("mergeSchema", "true").parquet(*places)
        return pending, len(places) == 1

    def _merged(self, folded: int | None, entries: list[Row]) -> DataFrame:
        """The next base with what becomes of each row; without a base before it, every live row is new."""
        pending, reduced = self._changes(entries)
        base = pending.limit(0) if folded is None else self._base(folded)
        return merge_with_changes(base, pending, self.rules, reduced)

    def change_feed(self, number: int | None = None) -> DataFrame | None:
        """What the compaction up to ``number``, the last one by default, changed for readers: insert, delete,
        update_preimage and update_postimage. None before the first compaction; others read no more than before."""
        number = self._pending()[0] if number is None else number
        if number is None:
            return None
        base = self._base(number)
        if CHANGES not in base.columns:
            raise ValueError(f"the compaction up to {number} was made without feed")
        return change_entries(base)

    def current(self, small_batches: bool = False) -> DataFrame | None:
        """The rows readers see. Directly after a compaction this is a plain scan."""
        state = self.state(small_batches)
        return None if state is None else live_rows(state, self.rules)

    def compact(self, small_batches: bool = False) -> int | None:
        """Fold all batches into a new base and return the number it holds.

        Rows are sorted by key within each file, which the merge has done already, so that row groups can be
        skipped on key lookups without another shuffle. Old files stay for readers that still use them.
        """
        folded, entries = self._pending()
        if not entries:
            return folded
        last = entries[-1]["number"]
        state, keys = self._merged(folded, entries) if self.feed else self._state(folded, entries, small_batches), list(self.rules.keys)
        location = f"{self.path}/base/upto={last}"
        if self.buckets is None:
            state.sortWithinPartitions(*keys).write.mode("overwrite").parquet(location)
        else:
            if folded is None:
                # Later bases inherit the buckets of the one before; the first is dealt out once, one task each.
                state = state.repartition(self.buckets, *keys)
            bucketed = state.write.format("parquet").bucketBy(self.buckets, *keys).sortBy(*keys)
            bucketed.mode("overwrite").option("path", location).saveAsTable(self._base_table(last))
        self._log(last, "base")
        return last
