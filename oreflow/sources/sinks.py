"""Writes: append with schema growth, partitioned overwrite, clustering."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from itertools import groupby

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from oreflow.functions.rows import comparable
from oreflow.sources.readers import open_table


def balanced(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Even output files. The rebalance step merges small and splits large partitions at run time, so that a
    partition value with most of the rows is written by many tasks."""
    return df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")


def clustered(df: DataFrame, keys: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by key, so that readers filtering on the key skip row groups.

    A number that spreads rows stands behind the keys, so that a value with most of the rows is dealt out to several
    tasks too.
    """
    spread = F.xxhash64(*[comparable(f) for f in df.schema.fields])
    ranges = [*[F.col(k) for k in keys], spread]
    shuffled = df.repartitionByRange(files, *ranges) if files else df.repartitionByRange(*ranges)
    return shuffled.sortWithinPartitions(*keys)


class ClusterRanges:
    """Ranges of a table's first cluster key, kept beside the table, so that files of different batches line up.

    The bounds are quantiles of uniform samples of the batches. They are only ever added to: a range that holds more
    than twice its share of a batch is split by bounds of that batch, so keys that grow get ranges of their own. A
    batch uses the bounds that part its own rows, so however many there are, its plan has at most ``2 * SHARES`` values.
    A value that is several bounds at once holds that many shares, and its rows are dealt out to as many tasks. Null
    keys stand below all others. A small batch writes fewer files, each over ranges next to each other.

    The driver sees ``SAMPLE`` keys and the bounds, of which a batch adds ``2 * SHARES`` at most. They decide where rows
    lie, never which rows there are; writers side by side may miss each other's additions.
    """

    SAMPLE, SHARES = 4096, 64
    RANGE = "__range"

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], file_rows: int = 1_000_000):
        self.spark, self.path, self.keys, self.file_rows = spark, path.rstrip("/"), list(keys), file_rows

    def bounds(self) -> list:
        """The bounds so far, in order, None before all others."""
        held = open_table(self.spark, self.path)
        return [] if held is None else sorted((r["bound"] for r in held.collect()), key=_place)

    def arranged(self, batch: DataFrame, batch_id: int, source: str = "batch") -> DataFrame:
        """The batch dealt out by the ranges and sorted by the keys, in one shuffle. It reads the first key of the batch
        ahead, as a range partitioning does; bounds that it adds are stored under the source and id of the batch."""
        key, size = F.col(f"`{self.keys[0]}`"), Observation()
        sample = batch.select(key.alias("bound")).observe(size, F.count(F.lit(1)).alias("rows"))
        drawn = sample.select("bound", F.rand(batch_id).alias("drawn")).orderBy("drawn").limit(self.SAMPLE)
        found = sorted((r["bound"] for r in drawn.collect() if r["bound"] is None or r["bound"] == r["bound"]), key=_place)
        if not found:  # no rows, or nothing but NaN, which stands above all bounds
            return batch
        bounds = self.bounds()
        added = _bounds_to_add(bounds, found, self.SHARES)
        if added:
            rows = self.spark.createDataFrame([(b,) for b in added], sample.schema)
            rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_from={source}-{batch_id}")
        used = _bounds_of_use(sorted(bounds + added, key=_place), found, self.SHARES)
        pieces = min(len(used) + 1, -(-size.get["rows"] // self.file_rows))
        number = F.floor(self._number(key, used, batch) * F.lit(pieces) / F.lit(len(used) + 1)).cast("int")
        dealt = batch.withColumn(self.RANGE, number).repartitionById(pieces, self.RANGE)
        return dealt.sortWithinPartitions(*self.keys).drop(self.RANGE)

    @staticmethod
    def _number(key: Column, bounds: Sequence, batch: DataFrame) -> Column:
        """Number of a row's range: how many bounds are below its key, plus any number of those that equal it."""
        nulls, known = sum(b is None for b in bounds), [b for b in bounds if b is not None]

        def search(low: int, high: int, passes: Callable[[Column], Column]) -> Column:
            if low == high:
                return F.lit(nulls + low)
            middle = (low + high) // 2
            return F.when(passes(F.lit(known[middle])), search(middle + 1, high, passes)).otherwise(search(low, middle, passes))

        below = search(0, len(known), lambda bound: bound < key)
        equal = search(0, len(known), lambda bound: bound <= key) - below
        below, equal = F.when(key.isNull(), 0).otherwise(below), F.when(key.isNull(), nulls).otherwise(equal)
        spread = F.xxhash64(*[comparable(f) for f in batch.schema.fields])
        return below + F.pmod(spread, equal + F.lit(1))


def _place(value) -> tuple:
    """Sorts None before all others."""
    return value is not None, value


def _span(ordered: Sequence, value) -> tuple[int, int]:
    """How many values are below one, and how many are not above it."""
    return bisect_left(ordered, _place(value), key=_place), bisect_right(ordered, _place(value), key=_place)


def _bounds_to_add(bounds: Sequence, sample: Sequence, shares: int) -> list:
    """Quantiles of a sorted sample that split the ranges in which more than two shares of it lie."""
    share, parts, added = max(1, len(sample) // shares), defaultdict(list), []
    for value in sample:
        parts[_span(bounds, value)].append(value)
    for (low, high), values in parts.items():  # more than one range if the values are bounds already
        wanted = len(values) // share - (high - low)
        if len(values) > 2 * share * (high - low + 1):
            added += [values[len(values) * i // (wanted + 1)] for i in range(1, wanted + 1)]
    return added


def _bounds_of_use(bounds: Sequence, sample: Sequence, shares: int) -> list:
    """The bounds between which at least half a share of the sample lies, and of equal bounds as many as have a share."""
    share, used, last = max(1, len(sample) // shares), [], 0
    for value, copies in groupby(bounds):
        low, high = _span(sample, value)
        if 2 * (low - last) >= share or high - low > 2 * share:
            used += [value] * (1 + min(sum(1 for _ in copies) - 1, (high - low) // share))
            last = low
    return used


class Tally:
    """Counts of rows taken by the write that they go into, even ahead of its shuffles.

    A task before a shuffle that runs again, because an executor was lost or was slow, counts its rows again. So the
    tasks are counted too, as first rows and as different partitions. Where these differ, or the optimizer left the
    counts out of a plan without rows, ``counts`` is None, and the caller counts in a pass of its own.
    """

    PARTITION, FIRST = "__tally_partition", "__tally_first"
    #: Bits that ``monotonically_increasing_id`` leaves for the rows of a partition.
    ROW_BITS = (1 << 33) - 1

    def __init__(self, columns: Sequence[Column]):
        self.columns, self.seen = list(columns), Observation()

    def over(self, df: DataFrame) -> DataFrame:
        """The same rows, counted when something is written from them. Once per tally."""
        marked = df.withColumns({
            self.PARTITION: F.spark_partition_id(),
            self.FIRST: F.monotonically_increasing_id().bitwiseAND(F.lit(self.ROW_BITS)) == 0,
        })
        tasks = F.count_if(F.col(self.FIRST)).alias(self.FIRST)
        partitions = F.size(F.collect_set(self.PARTITION)).alias(self.PARTITION)
        return marked.observe(self.seen, *self.columns, tasks, partitions).drop(self.PARTITION, self.FIRST)

    def counts(self) -> dict[str, int] | None:
        """After the write: the counts by name, None if they may be wrong."""
        try:
            values = dict(self.seen.get)
        except Py4JError:  # the plan had no rows and lost its observation
            return None
        return values if values and values.pop(self.FIRST) == values.pop(self.PARTITION) else None


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    balance: bool = False,
) -> int:
    """Write and return the number of rows, counted during the write itself.

    A partitioned overwrite replaces only the partitions it writes to. Counting comes after the last shuffle: a
    stage before it may run again when an executor is lost, and would count twice.
    """
    if cluster_by:
        df = clustered(df, cluster_by)
    elif balance:
        df = balanced(df, partition_by)
    written = Observation()
    df = df.observe(written, F.count(F.lit(1)).alias("rows"))
    writer = df.write.format(fmt).mode(mode).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)
    return written.get["rows"]


def read_merged(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table whose appended files may have gained columns."""
    return spark.read.format(fmt).option("mergeSchema", "true").load(path)


def write_all(df: DataFrame, path: str, sinks: Sequence[Callable[[DataFrame], None]] = ()) -> None:
    """One result into several sinks: it is written to ``path``, replacing what is there, and the others are fed from
    what was written, so nothing is computed twice or held in memory."""
    df.write.mode("overwrite").parquet(path)
    for sink in sinks:
        sink(df.sparkSession.read.schema(df.schema).parquet(path))
