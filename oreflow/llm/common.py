"""What several operators share: reading tables, written intermediates, connected components."""

from __future__ import annotations

import gc
import shutil
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.session import fresh_dir

#: The white space of the word rules: blank, tab, line feed, vertical tab, form feed, carriage return.
WHITE = rb"[\x20\x09-\x0D]"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, in case it isn't installed there."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        place = tempfile.mkdtemp(prefix="package-")
        copy = shutil.copytree(root / "oreflow", f"{place}/from/oreflow", ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(f"{place}/oreflow", "zip", Path(copy).parent))
        _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write to the folder that all executors share and read back: later jobs need no recomputation if one is lost."""
    spark = frame.sparkSession
    path = fresh_dir(spark, name)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def cleared(spark: SparkSession, *paths: str) -> None:
    """Delete written intermediates that nothing reads any more: what was made of them is written itself."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def places(*frames: DataFrame) -> list[str]:
    """The folders that written tables lie in."""
    return sorted({file.rsplit("/", 1)[0] for frame in frames for file in frame.inputFiles()})


@contextmanager
def shuffles_end_with_writes(spark: SparkSession) -> Iterator[None]:
    """Within it, shuffle files go when the write that needed them is done, not when the driver next collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def tidied() -> None:
    """Gives back what this Python worker's earlier tasks have left: garbage, and the memory that Arrow holds for later batches."""
    gc.collect()
    pa.default_memory_pool().release_unused()


_kept: tuple[object, object] = (None, None)


def kept(key: object, make: Callable[[], object]):
    """What a Python worker keeps from task to task: one thing, not one for each operator that it has ever worked for."""
    global _kept
    if _kept[0] != key:
        _kept = None, None  # goes before the next one is made
        tidied()
        _kept = key, make()
    return _kept[1]


def lowest_hash(frame: DataFrame, columns: list[str], most: int) -> DataFrame:
    """At most `most` rows, those of lowest hash: a bounded sample that does not depend on partitions or on size.

    Rows far above the limit are dropped where they are read, so that what tasks send grows with `most` alone.
    """
    order, total = F.xxhash64(*columns), frame.count()
    share = 4 * max(most, 100) / max(1, total)
    if share < 1:
        frame = frame.filter(order < int(-(1 << 63) + share * (1 << 64)))
    return frame.orderBy(order, *columns).limit(most)


def keyed(documents: DataFrame, key: str, text: str) -> DataFrame:
    """Rows with (d, t): the id, or for a null id a number from the text; and the text's checksum, as ids may repeat."""
    raw = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    number = F.coalesce(F.col(key).cast("long"), F.lit(-1) - F.shiftrightunsigned(F.xxhash64(raw), 2))
    return documents.select(F.col(key).alias("key"), number.alias("d"), F.crc32(raw).alias("t"), raw.alias("text"))


def words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; ``bytes.lower`` and ``bytes.split`` do exactly that."""
    return text.lower().split()


def as_bytes(column: pa.Array) -> Iterator[bytes]:
    """The values of a binary column; null counts as empty."""
    for value in column:
        yield value.as_py() or b""


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads the bits of 64-bit integers (wraps around by design)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)


def list_column(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], least: int = 4096):
    """Of rows that come sorted by `keys`: batches of at least `least` rows with the bounds of their groups, none cut."""
    def bounds(rows: pa.RecordBatch) -> list[tuple[int, int]]:
        new = np.zeros(rows.num_rows, bool)
        for name in keys:
            c = rows.column(name)
            new[1:] |= pc.not_equal(c.slice(1), c.slice(0, rows.num_rows - 1)).to_numpy(zero_copy_only=False)
        starts = [0, *np.flatnonzero(new).tolist()]
        return list(zip(starts, [*starts[1:], rows.num_rows]))

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= least:
            rows = pa.concat_batches(held)
            found = bounds(rows)
            held = [rows.slice(found[-1][0])]
            if len(found) > 1:
                yield rows, found[:-1]
    if held:
        rows = pa.concat_batches(held)
        yield rows, bounds(rows)


def _lowest_neighbour(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        both.filter("v > u").join(_lowest_neighbour(both), "u").filter("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = _lowest_neighbour(down)
    return (
        down.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(lowest.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
    )


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of long ids: (node, root) for every node with a link, root being the smallest id.

    Alternates large-star and small-star steps, each an aggregation and a join on the node; a node with very many
    links is one row per map task in the aggregation and a skewed join that adaptive execution splits. Every round is
    written to the shared folder. It ends when a round changes nothing. Self-links and nulls are left out.
    """
    now = (
        edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
        .filter("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    now, before = stored(now, "links"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        now = stored(_small_star(_large_star(now)), "stars")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
