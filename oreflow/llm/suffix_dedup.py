"""Repeated passages by suffix arrays, built by two-stage sorting over the places that can repeat at all.

Every window of `length` bytes belongs to its rarest-hashed short string, the anchor (the leftmost of equal ones).
Equal windows have equal anchors, so only anchors that occur more than once matter, and windows need to be compared
within one anchor only. Consecutive windows of one anchor form a fragment; equal fragments are one variant with a
count. An anchor with a single variant is settled by counting. For the others, one fragment per variant goes to the
task of its anchor. There a suffix array over the fragments is built in two stages: suffixes smaller than their
successor are sorted directly, all others are induced by scanning the buckets of their first byte in order. Adjacent
suffixes with a common prefix of `length` bytes are the repeated windows.
"""

from __future__ import annotations

from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import as_bytes, keyed, mix, signed, stored

#: Bytes of an anchor; windows hashed at a time; bytes of fragments that are sorted together.
ANCHOR, BLOCK, TOGETHER = 40, 1 << 17, 1 << 20
#: Low bits of a hash that hold its place while minima are sought: the same for every text, as equal windows must agree.
PLACE_BITS = 18
#: An anchor with more variants than this is split by window content instead of being sorted in one task.
MOST_VARIANTS = 4096

_BASE = 0x5851F42D4C957F2D
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n not in _POWERS:
        up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS[n] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS[n]


def anchor_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each string of ANCHOR bytes, by prefix sums of a polynomial that wraps around."""
    up, down = _powers(BLOCK + 4096)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    n = len(data) - ANCHOR + 1
    return mix((sums[ANCHOR:] - sums[:n]) * down[:n])


def _leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """For each stretch of `width` values the index of the smallest, the first of equal ones."""
    bits = np.uint64(PLACE_BITS)
    keyed = (values >> bits << bits) | np.arange(len(values), dtype=np.uint64)
    n = len(values) - width + 1
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = keyed
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    lowest = np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])
    return (lowest & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def fragments(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the runs of windows with one anchor: the anchor's hash, the first window's start, the number of windows."""
    hashes, starts, counts = [], [], []
    data, windows = np.frombuffer(text, np.uint8), len(text) - length + 1
    for begin in range(0, windows, BLOCK):
        here = min(BLOCK, windows - begin)
        rolled = anchor_hashes(data[begin : begin + here + length - 1])
        # The low bits of a hash give way to its place, so that the same hash can't win from two places.
        at = _leftmost_minimum(rolled, length - ANCHOR + 1)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        hashes.append(rolled[at[first]])
        starts.append(first + begin)
        counts.append(np.diff(np.append(first, here)))
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts), np.concatenate(counts)


def _entries(length: int):
    """Rows of fragments: anchor h, variant v, document (d, t), and place `at`: start << 12 | number of windows."""
    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            d_in, t_in, parts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), []
            for i, text in enumerate(as_bytes(batch.column(2))):
                if len(text) < length:
                    continue
                h, start, count = fragments(text, length)
                ends = (start + count + length - 1).tolist()
                v = np.fromiter((digest(text[a:b]) for a, b in zip(start.tolist(), ends)), np.uint64, len(ends))
                parts.append((signed(h), signed(v), np.full(len(h), d_in[i]), np.full(len(h), t_in[i]), start << 12 | count))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], ["h", "v", "d", "t", "at"])
    return run


def two_stage(codes: np.ndarray, places: np.ndarray, ends: np.ndarray, depth: int, text: str) -> np.ndarray:
    """Sort the suffixes at `places` by their first `depth` bytes (to the end of their fragment, if that is nearer).

    `codes` holds the bytes plus one, with 0 behind every fragment; `ends[i]` is the place of the 0 that ends the
    fragment of place i. Returns the places in order.
    """
    n = len(codes)
    step = np.sign(np.diff(codes.astype(np.int32), append=-1)).astype(np.int8)
    turn = np.where(step != 0, np.arange(n), n - 1)
    turn = np.minimum.accumulate(turn[::-1])[::-1]  # where the run of equal bytes at each place ends
    smaller = step[turn] > 0  # smaller than the successor
    stop = np.where(smaller | (codes == 0), np.arange(n), n - 1)
    stop = np.minimum.accumulate(stop[::-1])[::-1]  # the next place that needs no induction
    wanted = np.zeros(n, bool)
    wanted[places] = True
    # First stage: the suffixes that are smaller than their successors, and those that others are induced from.
    seeds = np.unique(stop[places])
    seeds = seeds[codes[seeds] > 0]
    limits = np.minimum(seeds + depth, ends[seeds])
    keys = [text[a:b] for a, b in zip(seeds.tolist(), limits.tolist())]
    order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
    del keys
    seeds = seeds[order]
    # Second stage: buckets by first byte, each: larger-than-successor suffixes by their successor's rank, then seeds.
    rank = np.full(n + 1, -1, np.int64)
    edge = np.zeros(n + 1, np.int32)  # marks the stretches from a wanted place to its stop
    np.add.at(edge, places, 1)
    np.add.at(edge, stop[places], -1)
    induced = np.flatnonzero((np.cumsum(edge[:-1]) > 0) & ~smaller & (codes > 0))
    wave = turn[induced] - induced  # equal bytes that follow: these are ranked one after the other
    induced_order = np.lexsort((wave, codes[induced]))
    induced, wave = induced[induced_order], wave[induced_order]
    group = np.flatnonzero(np.diff(codes[induced].astype(np.int64) << 32 | wave, prepend=-1))
    seed_codes = codes[seeds]
    filled, done = 0, 0
    for lo, hi in zip(group.tolist(), [*group[1:].tolist(), len(induced)]):
        here = induced[lo:hi]
        upto = int(np.searchsorted(seed_codes, codes[here[0]]))
        rank[seeds[done:upto]] = np.arange(filled, filled + upto - done)
        filled, done = filled + upto - done, upto
        here = here[np.argsort(rank[here + 1], kind="stable")]
        rank[here] = np.arange(filled, filled + len(here))
        filled += len(here)
    rank[seeds[done:]] = np.arange(filled, filled + len(seeds) - done)
    return places[np.argsort(rank[places], kind="stable")]


def repeated_windows(parts: list[tuple[bytes, int]], length: int) -> list[np.ndarray]:
    """For fragments (bytes, number of windows): which of each one's windows also start elsewhere among them."""
    joined = b"\0".join(x for x, _ in parts) + b"\0"
    sizes = np.array([len(x) + 1 for x, _ in parts])
    begins = np.cumsum(sizes) - sizes
    data = np.frombuffer(joined, np.uint8)
    codes = data.astype(np.uint16) + np.uint16(1)
    codes[begins + sizes - 1] = 0
    ends = np.repeat(begins + sizes - 1, sizes)
    counts = np.array([c for _, c in parts])
    places = np.concatenate([np.arange(b, b + c) for b, c in zip(begins, counts)])
    order = two_stage(codes, places, ends, length, joined.decode("latin-1"))
    view = np.lib.stride_tricks.sliding_window_view(data, length)
    marked = np.zeros(len(data), bool)
    for lo in range(0, len(order) - 1, 20_000):
        some = order[lo : lo + 20_001]
        rows = view[some]
        same = (rows[1:] == rows[:-1]).all(axis=1)  # a common prefix of `length` bytes with the next in order
        marked[some[1:][same]] = marked[some[:-1][same]] = True
    return [marked[b : b + c] for b, c in zip(begins, counts)]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return edges[::2], edges[1::2]


def _cut_out(length: int):
    """The fragments a document has to send: (h, v, windows, bytes)."""
    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for text, wanted in zip(as_bytes(batch.column(0)), batch.column(1)):
                for x in wanted.as_py():
                    start, count = x["at"] >> 12, x["at"] & 4095
                    out.append((x["h"], x["v"], count, text[start : start + count + length - 1]))
            if out:
                kinds = pa.int64(), pa.int64(), pa.int32(), pa.binary()
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], ["h", "v", "windows", "part"])
    return run


def _single_windows(length: int):
    """Windows of the fragments of one very common anchor, each by a digest of its bytes."""
    def run(batches):
        for batch in batches:
            h, v, windows = (batch.column(i).to_pylist() for i in range(3))
            out = [
                (h[i], v[i], w, blake2b(part[w : w + length], digest_size=16).digest())
                for i, part in enumerate(as_bytes(batch.column(3))) for w in range(windows[i])
            ]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.binary()))], ["h", "v", "w", "digest"]
                )
    return run


def _sorted_marks(length: int):
    """Suffix arrays over whole anchors, several together up to TOGETHER bytes; rows come sorted by anchor."""
    def marks(keys, parts):
        rows = [(h, v, lo, hi) for (h, v), flags in zip(keys, repeated_windows(parts, length))
                for lo, hi in zip(*(x.tolist() for x in _runs(flags)))]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["h", "v", "lo", "hi"]
            )

    def run(batches):
        keys, parts, held = [], [], 0
        for batch in batches:
            h, v, windows = (batch.column(i).to_pylist() for i in range(3))
            for i, part in enumerate(as_bytes(batch.column(3))):
                if keys and keys[-1] == (h[i], v[i]):
                    continue  # the same variant from a repeated row
                if held > TOGETHER and keys[-1][0] != h[i]:
                    yield from marks(keys, parts)
                    keys, parts, held = [], [], 0
                keys.append((h[i], v[i]))
                parts.append((part, windows[i]))
                held += len(part)
        if parts:
            yield from marks(keys, parts)
    return run


def _remove(length: int):
    def run(batches):
        for batch in batches:
            out = []
            for text, spans in zip(as_bytes(batch.column(2)), batch.column(3)):
                covered = np.zeros(len(text) + 1, np.int32)
                for x in spans.as_py():
                    covered[x["lo"]] += 1
                    covered[x["hi"] + length - 1] -= 1
                gone = np.cumsum(covered[:-1]) > 0
                lo, _ = _runs(gone)
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                out.append((int(gone.sum()), len(lo), sha256(kept).hexdigest(), kept))
            n, spans, digest, kept = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string()),
                 pa.array(kept, pa.binary())], ["d", "t", "n_removed", "n_spans", "kept_sha256", "kept"])
    return run


def remove_repeats(
    documents: DataFrame, length: int = 200, key: str = "doc_id", text: str = "text", most_variants: int = MOST_VARIANTS,
    with_kept: bool = False,
) -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans, kept_sha256 (and `kept`, the bytes left, if asked for).

    Removed is each byte covered by a string of `length` bytes that also starts anywhere else, in the same document
    too. Null counts as empty; empty and shorter texts keep everything. Rows that repeat, with or without their key,
    are documents of their own, so their texts are repeats of each other. Other columns are not read.
    """
    if length <= ANCHOR:
        raise ValueError(f"the length must exceed {ANCHOR} bytes")
    source = keyed(documents, key, text)
    schema = "h long, v long, d long, t long, at long"
    entries = source.select("d", "t", "text").mapInArrow(_entries(length), schema)
    anchors = entries.groupBy("h").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    # Written, so that both sides of the join are dealt by it alone and adaptive execution can split a hot anchor.
    anchors = stored(anchors.filter("n > 1").select("h", (F.col("low") != F.col("high")).alias("many")), "anchors")
    shared = stored(entries.join(anchors, "h"), "shared")

    variants = shared.filter("many").groupBy("h", "v").agg(
        F.count("*").alias("n"), F.min(F.struct("d", "t", "at")).alias("one"))
    variants = stored(variants.select("h", "v", "n", "one.*"), "variants")
    common = stored(variants.groupBy("h").count().filter(F.col("count") > most_variants).select("h"), "common")
    holders = shared.select("d", "t").distinct()
    texts = stored(source.join(holders, ["d", "t"], "left_semi").select("d", "t", "text"), "texts")
    to_send = variants.groupBy("d", "t").agg(F.collect_list(F.struct("h", "v", "at")).alias("wanted"))
    sent = texts.join(to_send, ["d", "t"]).select("text", "wanted").mapInArrow(
        _cut_out(length), "h long, v long, windows int, part binary")
    usual = sent.join(common, "h", "left_anti")
    parts = usual.sparkSession.conf.get("spark.sql.shuffle.partitions")
    marks = usual.repartition(int(parts), "h").sortWithinPartitions("h", "v").mapInArrow(
        _sorted_marks(length), "h long, v long, lo int, hi int")
    single = sent.join(common, "h", "left_semi").dropDuplicates(["h", "v"]).mapInArrow(
        _single_windows(length), "h long, v long, w int, digest binary")
    twice = single.groupBy("digest").count().filter("count > 1").select("digest")
    marks = marks.unionByName(single.join(twice, "digest").select("h", "v", F.col("w").alias("lo"), (F.col("w") + 1).alias("hi")))
    whole = variants.filter("n > 1").select("h", "v", F.lit(0).alias("lo"), F.expr("cast(at & 4095 as int)").alias("hi"))
    rest = marks.join(variants.filter("n = 1").select("h", "v"), ["h", "v"], "left_semi")
    found = stored(whole.unionByName(rest), "marks")

    first = F.expr("cast(shiftright(at, 12) as int)")
    spans = shared.filter("not many").select("d", "t", first.alias("lo"), (first + F.expr("cast(at & 4095 as int)")).alias("hi"))
    spans = spans.unionByName(
        shared.filter("many").join(found, ["h", "v"]).select("d", "t", (first + F.col("lo")).alias("lo"), (first + F.col("hi")).alias("hi")))
    lists = spans.groupBy("d", "t").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    cut = texts.join(lists, ["d", "t"]).select("d", "t", "text", "spans").mapInArrow(
        _remove(length), "d long, t long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    cut = (cut if with_kept else cut.drop("kept")).dropDuplicates(["d", "t"])
    raw = F.col("text")
    full = source.select("key", "d", "t", F.octet_length(raw).cast("long").alias("n_bytes"), F.sha2(raw, 256).alias("whole"),
                         *([raw.alias("all")] if with_kept else []))
    columns = [
        F.col("key").alias(key), "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    ]
    if with_kept:
        columns.append(F.coalesce("kept", "all").alias("kept"))
    return full.join(cut, ["d", "t"], "left").select(*columns)
