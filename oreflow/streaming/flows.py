"""Incremental flows: triggered streams that process what is new and stop."""

from __future__ import annotations

import datetime as dt
import threading
from collections import defaultdict
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from oreflow.operators.cdc import change_rows, latest_changes
from oreflow.operators.quality import raise_offenders
from oreflow.functions.clock import AsOf
from oreflow.plans.flows import (
    REJECT, BronzeFlow, SilverFlow, bronze, checked_rows, deduplication_of, selected_rows, silver_counts, silver_entries,
    silver_rows, split_silver,
)
from oreflow.sources.sinks import ClusterRanges, Tally, clustered, read_merged, write_all, write_table
from oreflow.sources.target import BATCH, SOURCE, ChangeTarget, LatestRows


def append_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a file table. The file sink commits every micro-batch exactly once."""
    return (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def batch_stream(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Run ``each(batch, batch_id)`` on every micro-batch. A batch may come again after a failure, under the same
    id; ``each`` must write so that the second time replaces the first."""
    return (
        stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_id(batch: DataFrame) -> str:
    """The identity of the stream that a micro-batch belongs to; it lives as long as the checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def apply_changes_stream(
    stream: DataFrame, target: ChangeTarget, checkpoint: str, compact_every: int = 20
) -> StreamingQuery:
    """Type-1 changes from a stream of business rows into a target, which is compacted every so many batches, so that
    neither its readers nor its log entries since the last base grow without bound."""
    done = 0

    def each(batch: DataFrame, n: int) -> None:
        nonlocal done
        target.append(batch, n, stream_id(batch))
        done += 1
        if done % compact_every == 0:
            target.compact()

    return batch_stream(stream, each, checkpoint)


def append_flow_streams(
    sources: Mapping[str, DataFrame], path: str, checkpoint: str, ranges: ClusterRanges | None = None,
    written: dict[tuple[str, int], int] | None = None,
) -> list[StreamingQuery]:
    """Several streams into one table, each with a checkpoint of its own.

    A file sink takes one query only, so every flow writes below its own folder; ``read_flows`` reads them as one.
    With ``ranges`` every batch is clustered by them; ``written`` gets its rows by flow and batch then, as the write
    counts them: a stream that is observed would count the rows that are read ahead as well.
    """
    def writer(name: str) -> Callable[[DataFrame, int], None]:
        def each(batch: DataFrame, n: int) -> None:
            place = f"{path}/{FLOW}={name}/{BATCH}={n}"
            if ranges is None:
                batch.write.mode("overwrite").parquet(place)
                return
            rows = write_table(ranges.arranged(batch, n, name), place, "overwrite")
            if written is not None:
                written[name, n] = rows

        return each

    return [batch_stream(stream, writer(name), f"{checkpoint}/{name}") for name, stream in sources.items()]


def read_flows(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``append_flow_streams`` writes; columns that a flow lacks are null."""
    return read_merged(spark, path).drop(FLOW, BATCH)


FLOW = "_flow"
WRITTEN = "rows_written"


def bronze_stream(raw: DataFrame, flow: BronzeFlow, path: str, checkpoint: str, as_of: AsOf = None) -> StreamingQuery:
    """Raw → bronze as a stream; a ``WrittenRows`` that listens tells afterwards how many rows were written."""
    return append_stream(observed(bronze(raw, flow, as_of)), path, checkpoint)


def observed(rows: DataFrame) -> DataFrame:
    """A stream whose rows are counted as they are written."""
    return rows.observe(WRITTEN, F.count(F.lit(1)).alias("rows"))


class WrittenRows(StreamingQueryListener):
    """Counts what observed streams write: every report of every micro-batch, however many a query keeps.

    Reports reach a listener in order, the end of a query last. Counts are kept by micro-batch, so one that is
    reported again counts once.
    """

    PATIENCE = 60.0

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.batches: dict[str, dict[int, int]] = defaultdict(dict)
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def __enter__(self) -> WrittenRows:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(WRITTEN)
        if seen is not None:
            self.batches[str(event.progress.runId)][event.progress.batchId] = seen["rows"]

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()

    def of(self, query: StreamingQuery) -> int | None:
        """Rows of a finished query; None if its end was not reported, as the count may then be short."""
        run = str(query.runId)
        return sum(self.batches[run].values()) if self.ended[run].wait(self.PATIENCE) else None


class SilverBatches:
    """Micro-batches of a silver flow: expectations, quarantine, then the target or, without change rules, a plain
    table at ``path``.

    Rules are counted by the write of the batch itself (see ``Tally``), and the quarantine is written only if these
    counts say that it gets rows. Fail rules keep a batch from being seen: a change target logs a batch after its
    write, so they are judged in between. Where a write is seen at once, in a plain table or in the place of a batch
    that is logged already, a flow with fail rules counts in a narrow pass ahead of it. Every output of a batch goes to
    a folder named by its stream and id, so a repeated batch replaces itself; ``store`` gets its counts with that place.
    """

    def __init__(
        self, flow: SilverFlow, target: ChangeTarget | LatestRows | str, quarantine_path: str, as_of: dt.datetime | None = None,
        store: Callable[[list[dict], str], None] | None = None,
    ):
        if flow.sinks and isinstance(target, LatestRows):
            raise ValueError("a deduplicated table takes rows back, so it can feed no further sinks")
        self.flow, self.target, self.quarantine_path, self.as_of = flow, target, quarantine_path, as_of
        self.store = store
        self.rows = 0
        self.metrics: dict[str, dict] = {}
        #: Whether the quarantine of a deduplicated table is older than the table; it may be from an earlier run.
        self.stale = isinstance(target, LatestRows) and target.candidates() is not None
        self.counted = False

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if isinstance(self.target, LatestRows):
            return self._deduplicated(batch, batch_id)
        changes, source = self.flow.changes, stream_id(batch)
        place = f"{SOURCE}={source}/{BATCH}={batch_id}"
        rows, rules = checked_rows(silver_rows(batch, self.flow, self.as_of), self.flow)
        whole = split_silver(rows, rules, changes)
        tally = Tally(silver_counts(rules, changes))
        written = split_silver(tally.over(rows), rules, changes).changes
        counts: list[dict] = []

        def judge(counted: bool = True) -> None:
            found = tally.counts() if counted else None
            counts[:] = silver_entries(found, rules) if found else [row.asDict() for row in whole.metrics.collect()]
            raise_offenders(counts)

        hidden = isinstance(self.target, ChangeTarget) and not self.target.applied(batch_id, source)
        if not hidden and any(rule.action == "fail" for rule in rules):
            judge(counted=False)
        if isinstance(self.target, ChangeTarget):
            latest = latest_changes(change_rows(written, changes), changes)
            self.target.append_reduced(latest, batch_id, source, None if counts else judge)
            applied = batch.sparkSession.read.schema(latest.schema).parquet(f"{self.target.path}/changes/{place}")
            for sink in self.flow.sinks:
                self._sink(sink, place)(applied)
        else:
            rows = clustered(written, self.flow.cluster_by) if self.flow.cluster_by else written
            write_all(rows, f"{self.target}/{place}", [self._sink(s, place) for s in self.flow.sinks])
            if not counts:
                judge()
        if any(c["failed"] for c in counts if c["action"] in ("quarantine", REJECT)):
            whole.quarantined.write.mode("overwrite").parquet(f"{self.quarantine_path}/{place}")
        self._count(counts)
        if self.store:
            self.store([c for c in counts if c["action"] != REJECT], place)

    @staticmethod
    def _sink(sink: Mapping[str, Any], place: str) -> Callable[[DataFrame], None]:
        """A further sink of a batch, in a folder named by its stream and id like the first: again replaces itself."""
        def write(rows: DataFrame) -> None:
            writer = rows.write.format(sink.get("format") or "parquet").options(**(sink.get("options") or {}))
            writer.mode("overwrite").save(f"{sink['path'].rstrip('/')}/{place}")

        return write

    def _deduplicated(self, batch: DataFrame, batch_id: int) -> None:
        """With deduplication a batch may take back rows of earlier ones. So the rows that its keys had and have are
        judged, and the totals changed by the difference; rows of other keys stay as they were judged before."""
        place, keys = (stream_id(batch), batch_id), deduplication_of(self.flow).partition_by
        rows = selected_rows(batch, self.flow, self.as_of)
        after = self._judged(self.target.current(rows, place, (rows, keys)))
        raise_offenders(after)
        # What is written already counts, an earlier try of this batch included; its keys are the same.
        before = self._judged(self.target.current(touched=(rows, keys)))
        whole = [] if self.counted else self._judged(self.target.current())
        self.target.append(rows, *place[::-1])
        self.stale = self.counted = True
        self._count(whole)
        self._count(before, -1)
        self._count(after)

    def finish(self) -> None:
        """After the last batch: with deduplication, write anew which of the kept rows are held back."""
        if self.stale:
            held = split_silver(*checked_rows(self.target.current(), self.flow), self.flow.changes).quarantined
            held.write.mode("overwrite").parquet(f"{self.quarantine_path}/{SOURCE}=latest/{BATCH}=0")
            self.stale = False

    def _judged(self, rows: DataFrame | None) -> list[dict]:
        if rows is None:
            return []
        return [row.asDict() for row in split_silver(*checked_rows(rows, self.flow), self.flow.changes).metrics.collect()]

    def _count(self, counts: list[dict], sign: int = 1) -> None:
        for row in counts:
            if row["action"] == REJECT:
                self.rows += sign * row["passed"]
                continue
            known = self.metrics.setdefault(row["rule"], {**row, "passed": 0, "failed": 0, "total": 0})
            for name in ("passed", "failed", "total"):
                known[name] += sign * row[name]


def silver_stream(bronze_rows: DataFrame, batches: SilverBatches, checkpoint: str) -> StreamingQuery:
    return batch_stream(bronze_rows, batches, checkpoint)


__all__ = [
    "SilverBatches", "WrittenRows", "append_flow_streams", "append_stream", "apply_changes_stream", "batch_stream", "bronze_stream",
    "read_flows", "silver_stream",
]
