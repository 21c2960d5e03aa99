"""Exact Jaccard join of word n-gram sets: size-banded tiles, hashed bitmaps, then sorted arrays.

Sets are banded by size so that sets that can link stand in the same or neighbouring bands. A band bounds how many
n-grams two linked sets may differ in; the hash space is cut into two more parts than that, so linked sets agree in at
least two whole parts, and in one that isn't empty. A tile is all sets of a band and its lower neighbour that have
the same n-grams in one part. Within tiles, parity bitmaps bound the overlap from above; what passes is intersected
exactly. To find the groups, only links that can join two are sought: a pair whose members are already connected needs
no test. Every link lies within a group, so all links are then found by comparing all sets of each group exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import as_bytes, cleared, components, keyed, mix, places, shuffles_end_with_writes, signed, stored, tidied, whole_groups

#: Set numbers that a task remembers before it starts anew; bytes of texts hashed at once; sets of a block of a tile.
MEMORY, TOGETHER, BLOCK = 400_000, 1 << 18, 2048
#: N-grams of a block of a group, and different n-grams that are compared at once.
GRAMS, COLUMNS = 1 << 20, 1 << 15
#: Bits of a bitmap: the next power of two above twice the set's size, within these. With fewer, differing n-grams
#: often fall on one bit and cancel out, and sets just below the threshold pass; with more, rows grow.
LEAST_BITS, MOST_BITS = 64, 16384
#: Of so many tiles one is looked at first, for pairs that connect most of what can be connected.
FIRST = 4
#: Set numbers that two sets share; more than this would mean that the digest is broken.
MOST_CLASHES = 100_000


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9DDFEA08EB382D69
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, kept for the longest text so far."""
    if len(_powers[0]) < n:
        size = 1 << int(n).bit_length()
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _powers[i] = np.multiply.accumulate(row)
    return _powers


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of each word of the bytes, A-Z lower-cased: a polynomial by prefix sums, then mixed."""
    blank = np.concatenate(([True], _BLANK[data], [True]))
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _shingles(hashed: np.ndarray, width: int) -> np.ndarray:
    total = np.full(max(0, len(hashed) - width + 1), width, np.uint64)
    for i in range(width):
        total = mix(total + hashed[i : len(total) + i])
    return total


def _distinct(hashes: np.ndarray) -> np.ndarray:
    hashes = np.sort(hashes)
    return hashes[np.concatenate(([True], hashes[1:] != hashes[:-1]))] if len(hashes) else hashes


def ngram_sets(texts: list[bytes], n: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its n-word shingles, worked out for TOGETHER bytes of texts at once.

    With fewer words the whole sequence is the one shingle; without any the set is empty.
    """
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) < TOGETHER):
            size += len(texts[last]) + 1
            last += 1
        some = texts[first:last]
        starts, hashed = word_hashes(np.frombuffer(b"\n".join(some), np.uint8))
        begins = np.cumsum([0, *(len(t) + 1 for t in some)])
        bounds = np.searchsorted(starts, begins).tolist()
        whole = _shingles(hashed, n)
        for lo, hi in zip(bounds, bounds[1:]):
            yield _distinct(whole[lo : hi - n + 1] if hi - lo >= n else _shingles(hashed[lo:hi], hi - lo) if hi > lo else whole[:0])
        first = last


def ngram_set(text: bytes, n: int) -> np.ndarray:
    return next(ngram_sets([text], n))


@lru_cache(64)
def bands(percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest size of each band, and how many n-grams linked sets of up to that size can differ in."""
    tops, low = [], 1
    while low < 1 << 40:
        tops.append(low * 100 // percent)
        low = tops[-1] + 1
    upper = np.array(tops, np.int64)
    return upper, 2 * upper * (100 - percent) // (100 + percent)


def tiles(ngrams: np.ndarray, percent: int) -> np.ndarray:
    """The tiles of one set: for its own band and the next, one for each part of the hash space.

    One empty part is left out, as two parts agree; were more empty, they are tiles too. Bands whose linked sets are
    equal have none, because equal sets are one set here.
    """
    upper, differ = bands(percent)
    own, found = int(np.searchsorted(upper, len(ngrams))), []
    spread = mix(ngrams ^ np.uint64(0x7F4A7C159E3779B9))
    for band in (own, own + 1):
        if differ[band] == 0:
            continue
        parts = int(differ[band]) + 2
        place = ((ngrams >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        starts = np.flatnonzero(np.diff(place, prepend=np.uint64(1 << 63)))
        content = np.add.reduceat(spread, starts)
        numbers = place[starts]
        if parts - len(starts) > 1:
            empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), numbers)
            numbers, content = np.append(numbers, empty), np.append(content, np.zeros(len(empty), np.uint64))
        found.append(mix(content + mix(numbers * np.uint64(512) + np.uint64(band))))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def bitmap(ngrams: np.ndarray) -> bytes:
    """Bit i tells whether an odd number of n-grams falls on i."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << int(2 * len(ngrams) - 1).bit_length()))
    odd = np.bincount((ngrams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def may_link(n_a: int, bits_a: bytes, n_b: int, bits_b: bytes, percent: int) -> bool:
    """Whether sizes and bitmaps leave room for a link: each differing bit is a differing n-gram."""
    a, b, size_a, size_b = int.from_bytes(bits_a, "little"), int.from_bytes(bits_b, "little"), len(bits_a) * 8, len(bits_b) * 8
    while size_a > size_b:
        size_a //= 2
        a = (a ^ a >> size_a) & ((1 << size_a) - 1)
    while size_b > size_a:
        size_b //= 2
        b = (b ^ b >> size_b) & ((1 << size_b) - 1)
    both = n_a + n_b
    return min(n_a, n_b) * 100 >= percent * max(n_a, n_b) and (100 + percent) * (both - (a ^ b).bit_count()) >= 2 * percent * both


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact: intersection of two sorted arrays against their union."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _set_numbers(ngrams: np.ndarray) -> tuple[int, int]:
    digest = blake2b(ngrams.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _profiles(n: int):
    def run(batches):
        tidied()
        for batch in batches:
            rows = []
            for found in ngram_sets(list(as_bytes(batch.column(2))), n):
                rows.append((len(found), *_set_numbers(found), bitmap(found) if len(found) else b""))
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.binary()
            columns = [pa.array(x, k) for x, k in zip(zip(*rows) if rows else [()] * 4, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["d", "t", "n", "node", "other", "bits"])
    return run


def _entries(n: int, percent: int, clashes: frozenset[int]):
    """(tile, node) of each set; a set that a worker has just seen is not sent again."""
    def run(batches):
        tidied()
        seen: set[int] = set()
        for batch in batches:
            out, nodes, lengths = [], [], []
            for found in ngram_sets(list(as_bytes(batch.column(0))), n):
                node, other = _set_numbers(found)
                node = other if node in clashes else node
                if node in seen or not len(found):
                    continue
                seen.add(node)
                mine = tiles(found, percent)
                out.append(mine)
                nodes.append(node)
                lengths.append(len(mine))
            if len(seen) > MEMORY:
                seen.clear()
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(np.concatenate(out))), pa.array(np.repeat(np.array(nodes, np.int64), lengths))], ["tile", "node"])
    return run


def _bitmap_filter(percent: int):
    def run(batches):
        for batch in batches:
            n_a, n_b = batch.column(2).to_pylist(), batch.column(4).to_pylist()
            keep = [
                may_link(n_a[i], x, n_b[i], y, percent)
                for i, (x, y) in enumerate(zip(as_bytes(batch.column(3)), as_bytes(batch.column(5))))
            ]
            yield pa.RecordBatch.from_arrays(list(batch.columns[:2]), ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _folded(bits: list[bytes]) -> np.ndarray:
    """Bitmaps of one size, the smallest: halves of a parity bitmap folded onto each other are that of the half size."""
    least, rows = min(map(len, bits)), []
    for size in sorted(set(map(len, bits))):
        where = [i for i, x in enumerate(bits) if len(x) == size]
        found = np.frombuffer(b"".join(bits[i] for i in where), np.uint64).reshape(len(where), -1)
        while found.shape[1] * 8 > least:
            half = found.shape[1] // 2
            found = found[:, :half] ^ found[:, half:]
        rows.append((where, found))
    out = np.empty((len(bits), least // 8), np.uint64)
    for where, found in rows:
        out[where] = found
    return out


def _spanning(i: np.ndarray, j: np.ndarray, differ: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Of pairs (i, j) those that, taken from the most alike on, connect two parts that were apart."""
    _, part = np.unique(root, return_inverse=True)
    above, taken = list(range(int(part.max()) + 1)), []

    def top(x: int) -> int:
        while above[x] != x:
            above[x] = x = above[above[x]]
        return x

    for k in np.argsort(differ, kind="stable").tolist():
        x, y = top(part[i[k]]), top(part[j[k]])
        if x != y:
            above[x] = y
            taken.append(k)
    return np.array(taken, np.int64)


def _compare_blocks(percent: int, spanning: bool):
    def group(rows: pa.RecordBatch):
        node, root, n, block = (rows.column(c).to_numpy() for c in ("node", "root", "n", "block"))
        if (root == root[0]).all():
            return None
        bits = _folded(rows.column("bits").to_pylist())
        one, two = rows.column("b1")[0].as_py(), rows.column("b2")[0].as_py()
        left, right = np.flatnonzero(block == one), np.flatnonzero(block == two)
        if not len(left):  # a block that got no rows has no pairs
            return None
        found, step = [], max(1, (1 << 21) // max(1, len(right) * bits.shape[1]))
        for lo in range(0, len(left), step):
            x = left[lo : lo + step, None]
            differ = np.bitwise_count(bits[x[:, 0]][:, None, :] ^ bits[right][None, :, :]).sum(axis=2, dtype=np.int64)
            both = n[x] + n[right]
            fits = ((100 + percent) * (both - differ) >= 2 * percent * both) & (np.minimum(n[x], n[right]) * 100 >= percent * np.maximum(n[x], n[right]))
            i, j = np.nonzero(fits & (root[x] < root[right]) if one == two else fits & (root[x] != root[right]))
            found.append((x[i, 0], right[j], differ[i, j] * 1000 // both[i, j]))
        i, j, differ = (np.concatenate(x) for x in zip(*found))
        if spanning:
            taken = _spanning(i, j, differ, root)
            i, j = i[taken], j[taken]
        a, b = node[i], node[j]
        return (np.minimum(a, b), np.maximum(a, b)) if len(a) else None

    def run(batches):
        for rows, bounds in whole_groups(batches, ["tile", "b1", "b2"]):
            found = [x for lo, hi in bounds if hi - lo > 1 and (x := group(rows.slice(lo, hi - lo)))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["a", "b"])
    return run


def _verify(n: int, percent: int):
    def run(batches):
        held: tuple[int | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for batch in batches:
            a, b, keep = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for i, (text_a, text_b) in enumerate(zip(as_bytes(batch.column(2)), as_bytes(batch.column(3)))):
                if held[0] != b[i]:
                    held = b[i], ngram_set(text_b, n)
                keep.append(linked(ngram_set(text_a, n), held[1], percent))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many n-grams each set of `left` has in common with each of `right`."""
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    shared = times > 1  # what one set alone has is common to none
    some = shared[column]
    owner, column = owner[some], (np.cumsum(shared) - 1)[column[some]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    found, width = np.zeros((len(left), len(right)), np.int32), int(shared.sum())
    for begin in range(0, width, COLUMNS):
        lo, hi = np.searchsorted(column, [begin, begin + COLUMNS])
        place, words = column[lo:hi] - begin, -(-min(COLUMNS, width - begin) // 64)
        bits = np.zeros((len(sets), words), np.uint64)
        np.bitwise_or.at(bits, (owner[lo:hi], place >> 6), np.uint64(1) << (place & 63).astype(np.uint64))
        step = max(1, (1 << 21) // max(1, len(right) * words))
        for at in range(0, len(left), step):
            both = bits[left[at : at + step]][:, None, :] & bits[right][None, :, :]
            found[at : at + step] += np.bitwise_count(both).sum(axis=2, dtype=np.int32)
    return found


def _all_links(n: int, percent: int, pairs: bool):
    """Of each pair of blocks of a group all linked pairs (a, b), or how many rows each set links with (a, b)."""
    def group(rows: pa.RecordBatch):
        node, mult, block = (rows.column(c).to_numpy() for c in ("node", "mult", "block"))
        one, two = rows.column("b1")[0].as_py(), rows.column("b2")[0].as_py()
        left, right = np.flatnonzero(block == one), np.flatnonzero(block == two)
        if not len(left) or not len(right):
            return None
        sets = list(ngram_sets(list(as_bytes(rows.column("text"))), n))
        size = np.array([len(x) for x in sets], np.int64)
        common = _common(sets, left, right)
        fits = 100 * common.astype(np.int64) >= percent * (size[left][:, None] + size[right][None, :] - common)
        i, j = np.nonzero(fits)
        i, j = left[i], right[j]
        if one == two:
            i, j = i[i < j], j[i < j]
        if pairs:
            return np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
        links = (np.bincount(i, mult[j], rows.num_rows) + np.bincount(j, mult[i], rows.num_rows)).astype(np.int64)
        some = np.flatnonzero(links)
        return node[some], links[some]

    def run(batches):
        for rows, bounds in whole_groups(batches, ["root", "b1", "b2"], 256):
            found = [x for lo, hi in bounds if hi - lo > 1 and (x := group(rows.slice(lo, hi - lo)))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["a", "b"])
    return run


class _Join:
    """One run of the join over `source`: (d, t) tells rows apart, then text."""

    def __init__(self, source: DataFrame, n: int, percent: int):
        self.source, self.n, self.percent, self.read = source, n, percent, []
        columns = "d long, t long, n long, node long, other long, bits binary"
        profiles = stored(source.mapInArrow(_profiles(n), columns), "sets")
        clash = profiles.groupBy("node").agg(F.min("other").alias("low"), F.max("other").alias("high")).filter("low <> high")
        found = [r["node"] for r in clash.select("node").limit(MOST_CLASHES + 1).collect()]
        if len(found) > MOST_CLASHES:
            raise RuntimeError("too many different sets share a number")
        self.clashes = frozenset(found)
        node = F.when(F.col("node").isin(found), F.col("other")).otherwise(F.col("node")) if found else F.col("node")
        self.profiles = profiles.select("d", "t", "n", node.alias("node"), "bits")

    def survivors(self) -> DataFrame:
        """(tile, node, lo): the tiles with more than one set, and the lowest number in each."""
        entries = self.source.select("text").mapInArrow(_entries(self.n, self.percent, self.clashes), "tile long, node long")
        shared = entries.groupBy("tile").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi")
        # Written, so that both sides of the join are dealt by it alone and adaptive execution can split a hot tile.
        shared = stored(shared.select("tile", "lo"), "shared")
        tiled = stored(entries.join(shared, "tile").distinct(), "tiles")
        cleared(shared.sparkSession, *places(shared))
        return tiled

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Of distinct pairs (a, b) those that the bitmaps let through."""
        sizes = self.sets.select("node", "n", "bits")
        a = sizes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
        b = sizes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
        both = pairs.join(a, "a").join(b, "b").select("a", "b", "n_a", "bits_a", "n_b", "bits_b")
        return stored(both.mapInArrow(_bitmap_filter(self.percent), "a long, b long"), "likely")

    def within(self, members: DataFrame, spanning: bool) -> DataFrame:
        """Pairs of (tile, node, root, size) in one tile but apart that the bitmaps let through; all of them, or as
        many as would connect what they can connect in their tile.

        A tile is cut into blocks, and every pair of its blocks is compared in one go, in a task of its own if need
        be; only what passes leaves the task.
        """
        blocks = F.ceil(F.col("size") / BLOCK).cast("int")
        placed = members.join(self.sets.select("node", "n", "bits"), "node").withColumn("blocks", blocks)
        placed = placed.withColumn("block", F.pmod(F.hash("node"), "blocks"))
        whole = placed.filter("blocks = 1").select("tile", F.lit(0).alias("b1"), F.lit(0).alias("b2"), "block", "node", "root", "n", "bits")
        cut = placed.filter("blocks > 1").withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
            "tile", F.least("block", "with").alias("b1"), F.greatest("block", "with").alias("b2"), "block", "node", "root", "n", "bits")
        parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        unit = ["tile", "b1", "b2"]
        found = whole.unionByName(cut).repartition(parts, *unit).sortWithinPartitions(*unit).mapInArrow(
            _compare_blocks(self.percent, spanning), "a long, b long")
        return stored(found.distinct(), "within")

    def texts_of(self, pairs: DataFrame) -> DataFrame:
        """(node, text), one text for each set that stands in a pair."""
        nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = self.sets.join(nodes, "node", "left_semi").select("node", "d", "t")
        self.read.append(stored(self.source.join(wanted, ["d", "t"]).select("node", "text").dropDuplicates(["node"]), "texts"))
        return self.read[-1]

    def verified(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        both = pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
        return stored(both.mapInArrow(_verify(self.n, self.percent), "a long, b long"), "verified")

    def roots(self) -> DataFrame:
        """(node, root) of all connected sets."""
        one = self.profiles.filter("n > 0").groupBy("node").agg(F.min(F.struct("d", "t", "n", "bits")).alias("one"), F.count("*").alias("mult"))
        self.sets = stored(one.select("node", "one.*", "mult"), "one_per_set")
        tiled = self.survivors()
        # First each set against the lowest of each of its tiles.
        stars = tiled.filter("node <> lo").select(F.col("node").alias("a"), F.col("lo").alias("b")).distinct()
        likely = self.likely(stars)
        links = self.verified(likely, self.texts_of(likely))
        roots = components(links, "a", "b")
        # Then the pairs in a tile of which neither is its lowest, only across what is still apart: first those that
        # would connect some of the tiles, as most links of a family are spared once it is connected, then all.
        for first in (True, False):
            some = tiled.filter("node <> lo")
            some = some.filter(F.pmod(F.xxhash64("tile"), F.lit(FIRST)) == 0) if first else some
            some = some.join(roots, "node", "left").select("tile", "node", F.coalesce("root", "node").alias("root"))
            split = some.groupBy("tile").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"))
            split = stored(split.filter("low <> high").select("tile", "size"), "apart")
            if not split.isEmpty():
                more = self.within(some.join(split, "tile"), first)
                if not more.isEmpty():
                    links = links.unionByName(self.verified(more, self.texts_of(more)))
                    roots = components(links, "a", "b")
        # The groups are written by now.
        cleared(tiled.sparkSession, *places(tiled))
        return roots

    def links(self, roots: DataFrame, pairs: bool) -> DataFrame:
        """All links of different sets, as pairs (a, b), or for each pair of blocks (set a, rows it links with b).

        Each set with a link is in a group and its text was read to verify one. Groups are cut into blocks, and every
        pair of blocks of a group is compared in one go.
        """
        groups = roots.join(self.sets.select("node", "n", "mult"), "node")
        sizes = groups.groupBy("root").agg(F.count("*").alias("size"), F.sum("n").alias("grams"))
        blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("grams") / GRAMS)).cast("int")
        groups = groups.join(stored(sizes.select("root", blocks.alias("blocks")), "groups"), "root")
        texts = self.read[0]
        for more in self.read[1:]:
            texts = texts.unionByName(more)
        placed = texts.dropDuplicates(["node"]).join(groups, "node").withColumn("block", F.pmod(F.hash("node"), "blocks"))
        placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        unit = ["root", "b1", "b2"]
        placed = placed.select("root", F.least("block", "with").alias("b1"), F.greatest("block", "with").alias("b2"), "block", "node", "mult", "text")
        parts = int(roots.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        found = placed.repartition(parts, *unit).sortWithinPartitions(*unit).mapInArrow(_all_links(self.n, self.percent, pairs), "a long, b long")
        return stored(found, "links")


def ngram_components(
    documents: DataFrame, n: int = 3, percent: int = 90, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per row: key, n_shingles, component_id (smallest key reachable by links, the row's own included).

    Two rows link when 100 * intersection >= percent * union of their n-gram sets. Rows with null, empty or blank
    text have no n-grams and link with nothing. A null key counts as larger than any; a component of such rows only
    has a null component_id. Rows that repeat a key are documents of their own. Other columns are not read. Links are exact up to collisions of 64-bit n-gram hashes.
    """
    return _placed(documents, n, percent, key, text, False).select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.col("low").alias("component_id"))


def ngram_links(
    documents: DataFrame, n: int = 3, percent: int = 90, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """`ngram_components` with n_links after its columns: with how many other rows the row links, equal sets included."""
    return _placed(documents, n, percent, key, text, True).select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.col("low").alias("component_id"), "n_links")


def ngram_pairs(
    documents: DataFrame, n: int = 3, percent: int = 90, key: str = "doc_id", text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """All linked pairs (a, b), a < b, of different sets, and which rows have a set: (key, node). Rows without n-grams have none."""
    with shuffles_end_with_writes(documents.sparkSession):
        rows, join = _join(documents, n, percent, key, text)
        pairs = join.links(join.roots(), True)
    members = rows.select("key", "d", "t").join(join.profiles.filter("n > 0").select("d", "t", "node").distinct(), ["d", "t"])
    return pairs, members.select(F.col("key").alias(key), "node")


def _join(documents: DataFrame, n: int, percent: int, key: str, text: str) -> tuple[DataFrame, _Join]:
    if not 1 <= percent <= 100:
        raise ValueError("percent must be within 1 and 100")
    rows = keyed(documents, key, text)
    return rows, _Join(rows.select("d", "t", "text"), n, percent)


def _placed(documents: DataFrame, n: int, percent: int, key: str, text: str, count: bool) -> DataFrame:
    with shuffles_end_with_writes(documents.sparkSession):
        return _grouped(documents, n, percent, key, text, count)


def _grouped(documents: DataFrame, n: int, percent: int, key: str, text: str, count: bool) -> DataFrame:
    rows, join = _join(documents, n, percent, key, text)
    roots = join.roots()
    if count:
        links = join.links(roots, False).groupBy("a").agg(F.sum("b").alias("links")).withColumnRenamed("a", "node")
        number = F.col("mult") - 1 + F.coalesce("links", F.lit(0))
        roots = join.sets.select("node", "mult").join(roots, "node", "left").join(links, "node", "left").select("node", "root", number.alias("n_links"))
        roots = stored(roots, "numbers")
    placed = join.profiles.select("d", "t", "n", "node").distinct().join(roots, "node", "left")
    number = [F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")] if count else []
    placed = rows.select("key", "d", "t").join(placed, ["d", "t"]).select("key", "n", *number, F.coalesce("root", "node").alias("root"))
    lowest = stored(placed.filter("n > 0").groupBy("root").agg(F.min("key").alias("low")), "lowest")
    low = F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("key"))
    return placed.join(lowest, "root", "left").withColumn("low", low)
