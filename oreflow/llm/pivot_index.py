"""Near-duplicate vectors by a pivot-permutation index.

A bounded sample of vectors are reference points (pivots). Every vector is described by its nearest pivots in order.
It stands in the inverted lists of the first of these; two vectors of one list are candidates if their descriptions
share enough pivots, and candidates are verified by their cosine. Lists are cut into blocks, and each pair of blocks
is one unit of work, so a list of any length is spread over many tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import components, lowest_hash, stored, whole_groups

#: Reference points (the sample the index is fitted on), length of a description, how many of its pivots have the
#: vector in their lists, shared pivots that make a candidate, and vectors of a block.
PIVOTS, DESCRIBED, LISTED, SHARED, BLOCK = 1024, 16, 12, 3, 256
#: Vectors drawn for each pivot that is sought, the cosine that two pivots must stay below, by how much it is raised
#: while too few are found, and how many times as far apart as linked vectors pivots must be all the same.
SAMPLE, APART, STEP, CROWD = 4, 0.8, 0.02, 4


def usable(label: Column, vector: Column) -> Column:
    """Labelled, with components that are all finite, one of them not zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(label.isNotNull() & ~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def choose_pivots(nodes: DataFrame, count: int, least: float) -> np.ndarray:
    """Unit rows from a bounded sample, the SAMPLE * count vectors of lowest hash, none close to another.

    Were a dense family to give many pivots, its members would be described by small differences among these. So the
    bound is raised in steps while pivots are too few, but not up to `least`, from which on vectors link. Vectors that
    stay too close for that have few pivots, up to a single one, and are then all compared.
    """
    rows = lowest_hash(nodes.select("vec"), ["vec"], SAMPLE * count).collect()
    width = max((len(r["vec"]) for r in rows), default=0)
    found = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        found[i, : len(r["vec"])] = r["vec"]
    found /= np.maximum(np.linalg.norm(found, axis=1, keepdims=True), np.finfo(float).tiny)
    kept = np.zeros((min(count, len(rows)), width))
    n, apart = 0, APART
    closest = np.full(len(rows), -np.inf)  # cosine to the nearest pivot so far
    while True:
        for i, v in enumerate(found):
            if n < len(kept) and closest[i] < apart:
                kept[n] = v
                n += 1
                closest = np.maximum(closest, found @ v)
        apart += STEP
        if n == len(kept) or apart > 1 - CROWD * (1 - least):
            return kept[:n]


def _vectors(column: pa.Array) -> list[np.ndarray]:
    flat, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a - offsets[0] : b - offsets[0]] for a, b in zip(offsets[:-1], offsets[1:])]


def _describe(pivots: np.ndarray, described: int, listed: int):
    """One row for each list a vector stands in: label, size, pivot, node, mult, its description, its components."""
    def run(batches):
        for batch in batches:
            vectors = _vectors(batch.column(2))
            if not vectors:
                continue
            square = np.zeros((len(vectors), pivots.shape[1]))
            for i, v in enumerate(vectors):
                width = min(len(v), pivots.shape[1])
                square[i, :width] = v[:width]
            near = np.argsort(-(square @ pivots.T), axis=1, kind="stable")[:, :described].astype(np.int16)
            lists = min(listed, near.shape[1])
            times = np.repeat(np.arange(len(vectors)), lists)
            take = pa.array(times)
            yield pa.RecordBatch.from_arrays([
                batch.column(1).take(take), pa.array(np.array([len(v) for v in vectors], np.int32)[times]),
                pa.array(near[:, :lists].ravel().astype(np.int32)), batch.column(0).take(take), batch.column(3).take(take),
                pa.array([x.tobytes() for x in near], pa.binary()).take(take),
                pa.array([v.tobytes() for v in vectors], pa.binary()).take(take),
            ], ["lab", "size", "pivot", "node", "mult", "near", "data"])
    return run


def _bits(near: np.ndarray, pivots: int) -> np.ndarray:
    flags = np.zeros((len(near), -(-pivots // 64) * 64), np.uint8)
    np.put_along_axis(flags, near.astype(np.int64), 1, axis=1)
    return np.packbits(flags, axis=1, bitorder="little").view(np.uint64)


def candidates(near_a: np.ndarray, near_b: np.ndarray, pivot: int, pivots: int, listed: int, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that share enough pivots and meet in this list first: no lower pivot lists both."""
    counts = np.bitwise_count(_bits(near_a, pivots)[:, None, :] & _bits(near_b, pivots)[None, :, :]).sum(axis=2, dtype=np.int32)
    i, j = np.nonzero(counts >= shared)
    both = _bits(near_a[:, :listed], pivots)[i] & _bits(near_b[:, :listed], pivots)[j]
    below = np.zeros(both.shape[1], np.uint64)
    below[: pivot // 64] = np.uint64(0xFFFFFFFFFFFFFFFF)
    below[pivot // 64] = np.uint64((1 << pivot % 64) - 1)
    first = ~(both & below).any(axis=1)
    return i[first], j[first]


def close(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
    """Which pairs have a cosine of at least `least`, in double precision."""
    found = np.zeros(len(i), bool)
    norm_a, norm_b = np.sqrt((a * a).sum(axis=1)), np.sqrt((b * b).sum(axis=1))
    for lo in range(0, len(i), 20_000):
        x, y = i[lo : lo + 20_000], j[lo : lo + 20_000]
        found[lo : lo + 20_000] = np.einsum("ij,ij->i", a[x], b[y]) / (norm_a[x] * norm_b[y]) >= least
    return found


def _local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(kind: str, pivots: int, listed: int, shared: int, least: float):
    """(node, links, peer) of the vectors of each pair of blocks that have links in it."""
    def group(rows: pa.RecordBatch):
        near = np.frombuffer(b"".join(rows.column("near").to_pylist()), np.int16).reshape(rows.num_rows, -1)
        data = np.frombuffer(b"".join(rows.column("data").to_pylist()), kind).reshape(rows.num_rows, -1).astype(np.float64)
        node, mult = rows.column("node").to_numpy(), rows.column("mult").to_numpy()
        block, pivot = rows.column("block").to_numpy(), rows.column("pivot")[0].as_py()
        one, two = rows.column("b1")[0].as_py(), rows.column("b2")[0].as_py()
        left, right = np.flatnonzero(block == one), np.flatnonzero(block == two)
        i, j = candidates(near[left], near[right], pivot, pivots, listed, shared)
        i, j = left[i], right[j]
        if one == two:
            i, j = i[i < j], j[i < j]
        good = close(data, data, i, j, least)
        i, j = i[good], j[good]
        if not len(i):
            return None
        links = np.bincount(i, mult[j], rows.num_rows) + np.bincount(j, mult[i], rows.num_rows)
        some, root = np.flatnonzero(links), _local_roots(rows.num_rows, i, j)
        return node[some], links[some].astype(np.int64), node[root[some]]

    def run(batches):
        for rows, bounds in whole_groups(batches, ["lab", "size", "pivot", "b1", "b2"]):
            found = [x for lo, hi in bounds if hi - lo > 1 and (x := group(rows.slice(lo, hi - lo)))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["node", "links", "peer"])
    return run


def near_duplicates(
    embeddings: DataFrame, least: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    pivots: int = PIVOTS, described: int = DESCRIBED, listed: int = LISTED, shared: int = SHARED, block: int = BLOCK,
) -> DataFrame:
    """Per row: key, n_links, component_id (smallest key reachable by links, its own included), kept (key = component_id).

    Vectors link when their labels are equal and their cosine is at least `least`, in double precision. Equal vectors
    of a label are compared as one and counted by their number. Without links are null, empty and zero vectors, those
    with null or non-finite components, and those without a label; vectors of different sizes do not link. A null key
    counts as larger than any; a component of such rows only has a null component_id. Repeated rows are vectors of
    their own. Links are found by an index, so some may be missed (tests measure the share); none is wrong.
    """
    source = embeddings.select(F.col(key).alias("key"), F.col(vector).alias("vec"), F.col(label).cast("string").alias("lab"))
    source = source.withColumn("ok", usable(F.col("lab"), F.col("vec")))
    kind = source.schema["vec"].dataType.elementType.simpleString()
    if kind not in ("float", "double"):
        source, kind = source.withColumn("vec", F.col("vec").cast("array<double>")), "double"
    groups = source.filter("ok").groupBy("lab", "vec").agg(F.min("key").alias("low"), F.count("*").alias("mult"))
    nodes = stored(groups.withColumn("node", F.monotonically_increasing_id()), "vectors")
    points = choose_pivots(nodes, pivots, least)
    shared = min(shared, max(1, len(points)))
    rows = nodes.select("node", "lab", "vec", "mult").mapInArrow(
        _describe(points, described, listed),
        "lab string, size int, pivot int, node long, mult long, near binary, data binary")
    lists = ["lab", "size", "pivot"]
    lengths = rows.groupBy(*lists).agg(F.count("*").alias("length")).filter("length > 1")
    blocks = F.ceil(F.col("length") / block).cast("int")
    placed = rows.join(lengths, lists).withColumn("blocks", blocks).withColumn("block", F.pmod(F.hash("node"), "blocks"))
    placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select(*lists, F.least("block", "with").alias("b1"), F.greatest("block", "with").alias("b2"), "block", "node", "mult", "near", "data")
    unit = [*lists, "b1", "b2"]
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = placed.repartition(parts, *unit).sortWithinPartitions(*unit).mapInArrow(
        _compare({"float": "<f4", "double": "<f8"}[kind], max(1, len(points)), listed, shared, least),
        "node long, links long, peer long")
    found = stored(found, "links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    placed = nodes.join(components(found, "node", "peer"), "node", "left").join(counts, "node", "left")
    placed = placed.select("lab", "vec", "low", "mult", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"))
    lowest = placed.groupBy("root").agg(F.min("low").alias("component"))
    placed = placed.join(lowest, "root").select(F.col("lab").alias("g_lab"), F.col("vec").alias("g_vec"), "mult", "links", "component")
    same = F.col("ok") & (F.col("lab") == F.col("g_lab")) & (F.col("vec") == F.col("g_vec"))
    component = F.when(F.col("mult").isNotNull(), F.col("component")).otherwise(F.col("key"))
    return source.join(placed, same, "left").select(
        F.col("key").alias(key), F.coalesce(F.col("mult") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("key").eqNullSafe(component).alias("kept"))
