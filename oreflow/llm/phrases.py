"""Frequent phrases from an FM-index per shard over word ids, with counts summed across shards.

A shard is a bounded run of words of one language. Its index keeps two Burrows-Wheeler transforms, of the words and of
the words backwards, over rows sorted by as many words as phrases may have. A phrase is an interval of rows in both:
the words before it are those that the first transform holds in its interval, the words behind it those of the second,
and either way the longer phrase's intervals follow from counts alone. All intervals of a shard are extended at once,
one word a level. A level's phrases meet across shards, where their counts are summed; only phrases that are frequent
in all shards together go back to the shards to be extended, and only to phrases both of whose parts are frequent, which
loses none. The longest group is one row per shard, never one per occurrence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import cleared, list_column, places, shuffles_end_with_writes, stored
from oreflow.session import fresh_dir

#: Words after which a task closes a language's shard, so many times as many close all; bytes of a text split at once.
SHARD, HELD, SLICE = 2_000_000, 2, 1_000_000
#: A phrase's number within its shard takes this many bits, the shard's number in its task that many.
PLACE, SHARDS = 28, 15

#: Every separator of pieces becomes a full stop, which no word holds; tabs are blanks.
_SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
_SPLIT = bytes.maketrans(_SEPARATORS, b"." * len(_SEPARATORS))
_BREAK = re.compile(rb"[\x20\x09-\x0D.,;:!?]")


class _Numbers(dict):
    """Words by number in the order they come; 0 is the separator."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def packed(numbers: np.ndarray) -> bytes:
    """Numbers of 32 bits compressed, their bytes of equal weight together."""
    planes = numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    planes = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()


class _Shard:
    def __init__(self, lang: str, words: list[bytes] = ()):
        self.lang, self.numbers, self.parts, self.size = lang, _Numbers({b".": 0}), [], 0
        self.add(words)

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def tail(self, most: int) -> list[bytes]:
        """The last words that no separator follows, `most` at most."""
        end, names = np.concatenate(self.parts)[-most:] if most else np.zeros(0, np.int32), list(self.numbers)
        cut = np.flatnonzero(end == 0)
        return [names[i] for i in end[cut[-1] + 1 if len(cut) else 0 :].tolist()]


def split_words(text: bytes) -> list[bytes]:
    """Words with A-Z lower-cased and a full stop for each separator."""
    return text.lower().translate(_SPLIT).replace(b".", b" . ").split()


def _slices(text: bytes, most: int) -> Iterator[bytes]:
    begin = 0
    while len(text) - begin > most and (cut := _BREAK.search(text, begin + most)):
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:] if begin else text


def shards(documents: DataFrame, lang: str, text: str, depth: int) -> DataFrame:
    """Documents as shards: (shard, lang, sign, words, counts, ids), written.

    A shard that closes within a text hands its last depth - 1 words to the next one, and a shard of these words alone
    with sign -1 takes back what both count.
    """
    base = documents.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text"))
    names = ["shard", "lang", "sign", "words", "counts", "ids"]

    def rows(found: list[tuple[int, _Shard, int]]) -> pa.RecordBatch:
        ids = [np.concatenate(s.parts) for _, s, _ in found]
        counts = [np.bincount(i, minlength=len(s.numbers))[1:] for i, (_, s, _) in zip(ids, found)]
        return pa.RecordBatch.from_arrays([
            pa.array([n for n, _, _ in found], pa.int64()), pa.array([s.lang for _, s, _ in found]), pa.array([x for _, _, x in found], pa.int32()),
            pa.array([list(s.numbers)[1:] for _, s, _ in found], pa.list_(pa.binary())),
            list_column(np.concatenate(counts), np.array([len(c) for c in counts]), pa.int64()),
            pa.array([packed(i) for i in ids], pa.binary())], names)

    def run(batches):
        task, made, now = TaskContext.get().partitionId(), 0, {}

        def number() -> int:
            nonlocal made
            made += 1
            if made >= 1 << SHARDS:
                raise ValueError("a task has too many shards; read the documents in more partitions")
            return task << SHARDS | made

        for batch in batches:
            for lang_, text_ in zip(batch.column(0).to_pylist(), batch.column(1)):
                for at, part in enumerate(_slices(text_.as_py() or b"", SLICE)):
                    full = list(now) if sum(s.size for s in now.values()) >= HELD * SHARD else [lang_] if lang_ in now and now[lang_].size >= SHARD else []
                    if full:
                        tail = now[lang_].tail(depth - 1) if at and lang_ in full else []
                        yield rows([(number(), now.pop(x), 1) for x in full] + [(number(), _Shard(lang_, tail), -1)] * bool(tail))
                        if tail:
                            now[lang_] = _Shard(lang_, tail)
                    if lang_ not in now:
                        now[lang_] = _Shard(lang_)
                    now[lang_].add(split_words(part))
                now[lang_].add([b"."])
        if now:
            yield rows([(number(), s, 1) for s in now.values()])

    return stored(base.mapInArrow(
        run, "shard long, lang string, sign int, words array<binary>, counts array<long>, ids binary"), "shards")


def sorted_order(keys: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of non-negative keys below `most`, and the keys in it.

    Plain numbers sort many times faster than their places do, so places are packed below the keys where both fit.
    """
    bits = (len(keys) - 1).bit_length()
    if (most - 1).bit_length() + bits > 63:
        order = np.argsort(keys, kind="stable")
        return order, keys[order]
    both = np.sort(keys << bits | np.arange(len(keys)))
    return both & ((1 << bits) - 1), both >> bits


def transforms(ids: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The words' transform and that of the words backwards, rows sorted by `depth` words. Words end with a separator."""
    out = []
    for words in (ids, ids[::-1]):
        rank, known, count = words.astype(np.int64), 1, int(words.max()) + 1
        order = None if depth > 1 else sorted_order(rank, count)[0]
        while known < depth:
            order, keys = sorted_order(rank * count + np.roll(rank, -known), count * count)
            known *= 2
            if known < depth:
                new = np.cumsum(np.r_[False, keys[1:] != keys[:-1]])
                count = int(new[-1]) + 1
                rank = np.empty(len(words), np.int64)
                rank[order] = new
        out.append(words[order - 1].astype("<i4"))
    return out[0], out[1]


class BiIndex:
    """An FM-index in both directions. A set of phrases is three arrays: first rows in the index of the words (0) and in
    that of the words backwards (1), and numbers of rows, which are the same in both."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray):
        self.bwt, self.size, self.symbols = (forward, backward), len(forward), int(forward.max(initial=0)) + 1
        counts = np.bincount(forward, minlength=self.symbols)
        self.first, self.counts = np.cumsum(counts) - counts, counts
        # All (symbol, row) in order: the place of one is the first row of the symbol plus its occurrences before the row.
        self.occurrences = tuple(np.sort(b.astype(np.int64) * self.size + np.arange(self.size)) for b in self.bwt)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The phrases of one word, separator left out."""
        return self.first[1:], self.first[1:], self.counts[1:]

    def backward(self, rows: np.ndarray, size: int) -> np.ndarray:
        """First rows in the backward index of phrases of `size` words, by their first rows in the forward one."""
        words, at = [], rows
        for _ in range(size):
            # The row at a place begins with the symbol, and its row there is that of the words behind it.
            words.append(self.occurrences[0][at] // self.size)
            at = self.occurrences[0][at] % self.size
        back = self.first[words[0]]
        for word in words[1:]:
            back = np.searchsorted(self.occurrences[1], word * self.size + back)
        return back

    def extend(self, side: int, rows: tuple[np.ndarray, np.ndarray], n: np.ndarray):
        """Every phrase longer by one word on the left (side 0) or right (1): which phrase, its rows and numbers."""
        source = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(source)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(rows[side], n)
        found, many = np.unique(source * self.symbols + self.bwt[side][at], return_counts=True)
        source, symbol = found // self.symbols, found % self.symbols
        same = np.searchsorted(self.occurrences[side], symbol * self.size + rows[side][source])
        before = np.cumsum(many) - many
        other = rows[1 - side][source] + before - before[np.searchsorted(source, source)]
        real = symbol > 0
        new = (same, other) if side == 0 else (other, same)
        return source[real], (new[0][real], new[1][real]), many[real]


def grow(index: BiIndex, side: int, ids: np.ndarray, rows: tuple[np.ndarray, np.ndarray], n: np.ndarray):
    """Frequent phrases extended to the `side`, if the part without the word at the other end is frequent as well.

    That part begins the longer phrase as seen from the other side, so its interval there holds the longer phrase's.
    Returns ids of the parts without the last and without the first word, rows and numbers.
    """
    source, new, many = index.extend(side, rows, n)
    order = np.argsort(rows[side])
    part = order[np.maximum(np.searchsorted(rows[side][order], new[side], "right") - 1, 0)] if len(n) else source
    good = (new[side] >= rows[side][part]) & (new[side] < rows[side][part] + n[part])
    source, part = source[good], part[good]
    left, right = (part, source) if side == 0 else (source, part)
    return ids[left], ids[right], (new[0][good], new[1][good]), many[good]


_ROWS = "code long, n int, left long, right long"


def _grown(shard: int, sign: int, index: BiIndex, side: int, ids, rows, n) -> pa.Table:
    left, right, new, many = grow(index, side, ids, rows, n)
    return pa.table({
        "code": pa.array((shard << PLACE) + new[0], pa.int64()), "n": pa.array(many * sign, pa.int32()),
        "left": pa.array(left, pa.int64()), "right": pa.array(right, pa.int64())})


def _together(rows: DataFrame, keys: list[str], least: int, name: str, *more) -> DataFrame:
    """Rows of shards whose phrase is frequent in all shards together, with its number (the lowest code) and its count."""
    same = Window.partitionBy(*keys)
    rows = rows.withColumn("id", F.min("code").over(same)).withColumn("f", F.sum(F.col("n").cast("long")).over(same))
    return stored(rows.filter(F.col("f") >= least).select("code", *more, "id", "f"), name)


_INDEX = "shard long, sign int, symbols array<long>, ids binary"


def _indexes(cut: DataFrame, words: DataFrame) -> tuple[DataFrame, str]:
    """Each shard's frequent words, over which its index is built; all others separate. Words alone between separators
    are left out.

    Written in buckets by shard, so that later levels move only phrases to them. The transforms are made anew where they
    are used, which takes a second for a million words; stored, both would be twice as large. The name is the table's.
    """
    def run(shard: pa.Table, found: pa.Table) -> pa.Table:
        if not shard.num_rows or not found.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary())], [c.split()[0] for c in _INDEX.split(", ")])
        ids = unpacked(shard.column("ids")[0].as_py())
        place = found.column("code").to_numpy() & ((1 << PLACE) - 1)
        number = np.zeros(shard.column("known")[0].as_py() + 1, np.int32)
        number[place] = np.arange(1, len(place) + 1)
        ids = number[ids]
        lone = (np.r_[0, ids[:-1]] == 0) & (np.r_[ids[1:], 0] == 0)
        ids = np.r_[np.where(lone, 0, ids), 0]
        ids = ids[(ids > 0) | (np.r_[1, ids[:-1]] > 0)]
        return pa.table({
            "shard": shard.column("shard"), "sign": shard.column("sign"), "symbols": pa.array([found.column("id").to_numpy()], pa.list_(pa.int64())),
            "ids": pa.array([packed(ids)], pa.binary())})

    spark = cut.sparkSession
    texts = cut.select("shard", "sign", F.size("words").alias("known"), "ids")
    mine = words.select(F.shiftright("code", PLACE).alias("shard"), "code", "id")
    whole = texts.groupBy("shard").cogroup(mine.groupBy("shard")).applyInArrow(run, _INDEX)
    path = fresh_dir(spark, "indexes")
    name, buckets = f"indexes_{path.rsplit('-', 1)[-1]}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole.write.format("parquet").bucketBy(buckets, "shard").option("path", path).option("compression", "zstd").saveAsTable(name)
    return spark.table(name), name


def _pairs(indexes: DataFrame, depth: int) -> DataFrame:
    """All phrases of two words of each shard."""
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                shard, sign, symbols, ids = (c[row].as_py() for c in batch.columns)
                index = BiIndex(*transforms(unpacked(ids), depth))
                a, b, n = index.words()
                yield from _grown(shard, sign, index, 1, np.array(symbols, np.int64)[: len(n)], (a, b), n).to_batches()

    return indexes.select("shard", "sign", "symbols", "ids").mapInArrow(run, _ROWS)


def _longer(indexes: DataFrame, level: DataFrame, size: int, depth: int) -> DataFrame:
    """All phrases of `size` words of each shard that extend the frequent ones in `level` by one word.

    Sides alternate: three words grow to the left, four to the right, and so on.
    """
    side = size % 2 == 0

    def run(shard: pa.Table, found: pa.Table) -> pa.Table:
        if not shard.num_rows or not found.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64())], [c.split()[0] for c in _ROWS.split(", ")])
        first = found.column("code").to_numpy() & ((1 << PLACE) - 1)
        index = BiIndex(*transforms(unpacked(shard.column("ids")[0].as_py()), depth))
        return _grown(
            shard.column("shard")[0].as_py(), shard.column("sign")[0].as_py(), index, int(side), found.column("id").to_numpy(),
            (first, index.backward(first, size - 1)), np.abs(found.column("n").to_numpy().astype(np.int64)))

    mine = level.select(F.shiftright("code", PLACE).alias("shard"), "code", "n", "id")
    texts = indexes.select("shard", "sign", "ids")
    return texts.groupBy("shard").cogroup(mine.groupBy("shard")).applyInArrow(run, _ROWS)


def ngrams(documents: DataFrame, depth: int = 4, least: int = 30, lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """All phrases of up to `depth` words that stand at least `least` times in a language, and each language's words.

    The first table has lang, phrase (words joined by blanks), words (how many), f, before and behind (the highest count of
    a frequent phrase with one more word on that side, or null), and counts of all its beginnings (`heads`, by length) and
    endings (`tails`). The second has lang and n, the occurrences of all words, frequent or not.

    Words are what blanks and tabs leave of pieces, pieces what ``. , ; : ! ?`` and line ends leave of texts; phrases stay
    within pieces, overlapping occurrences all count. A null lang is `und`; null and empty texts have no words; repeated
    rows count as often as they stand; other columns are not read, whatever their names. An empty table gives two empty
    ones. Very long texts are split into words slice by slice and may run over several shards.
    """
    if depth < 2:
        raise ValueError("phrases have two words at least")
    with shuffles_end_with_writes(documents.sparkSession):
        return _levels(documents, depth, least, lang, text)


def _levels(documents: DataFrame, depth: int, least: int, lang: str, text: str) -> tuple[DataFrame, DataFrame]:
    spark = documents.sparkSession
    cut = shards(documents, lang, text, depth)
    found = cut.select("shard", "lang", "sign", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "x")).select(
        (F.shiftleft("shard", PLACE) + F.col("at") + 1).alias("code"), "lang", F.col("x.words").alias("word"), (F.col("x.counts") * F.col("sign")).alias("n"))
    totals = stored(found.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    words = _together(found, ["lang", "word"], least, "words", "lang", "word")
    indexes, name = _indexes(cut, words)
    known = [stored(words.filter("code = id").select(
        "id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", F.array("f").alias("heads"), F.array("f").alias("tails")), "known")]
    cleared(spark, *places(cut, words))
    level, whole = None, []
    for size in range(2, depth + 1):
        rows, last = _pairs(indexes, depth) if size == 2 else _longer(indexes, level, size, depth), level
        level = _together(rows, ["left", "right"], least, "level", "n", "left", "right")
        mine = level.filter("code = id").select("id", "left", "right", "f")
        a = known[-1].select(F.col("id").alias("left"), "lang", F.col("phrase").alias("head"), "heads")
        b = known[-1].select(F.col("id").alias("right"), "last", "tails")
        mine = stored(mine.join(a, "left").join(b, "right").select(
            "id", "lang", F.concat("head", F.encode(F.lit(" "), "utf-8"), "last").alias("phrase"), "last", "f",
            F.concat("heads", F.array("f")).alias("heads"), F.concat("tails", F.array("f")).alias("tails"), "left", "right"), "known")
        cleared(spark, *(places(last) if last else []))
        whole.append(_with_extensions(known[-1], mine).withColumn("words", F.lit(size - 1)))
        known.append(mine)
    # Every level is written by now.
    cleared(spark, *places(level, indexes))
    spark.sql(f"DROP TABLE {name}")
    whole.append(known[-1].withColumns({"before": F.lit(None).cast("long"), "behind": F.lit(None).cast("long"), "words": F.lit(depth)}))
    columns = ["lang", F.col("phrase").cast("string").alias("phrase"), "words", "f", "before", "behind", "heads", "tails"]
    out = whole[0].select(*columns)
    for part in whole[1:]:
        out = out.unionByName(part.select(*columns))
    return out, totals


def _with_extensions(phrases: DataFrame, longer: DataFrame) -> DataFrame:
    behind = longer.groupBy(F.col("left").alias("id")).agg(F.max("f").alias("behind"))
    before = longer.groupBy(F.col("right").alias("id")).agg(F.max("f").alias("before"))
    return phrases.join(behind, "id", "left").join(before, "id", "left")


def collocations(
    documents: DataFrame, depth: int = 4, least: int = 30, inside: int = 80, most: int = 2000, lang: str = "lang", text: str = "text"
) -> DataFrame:
    """Each language's `most` best phrases of 2 to `depth` words: lang, rank, phrase, a, l, r, n, score.

    A phrase of count a, cut into parts of counts l and r, scores floor(2000000 * a / (l + r)); its lowest cut counts, of
    equal ones that after the fewest words. A phrase goes if one that holds it has at least `inside` percent of its count;
    one more word is enough to look at, because what holds a phrase within a longer one counts no less than that one.
    Ranks are by score, count and phrase (bytes), and the sorting drops all but the best before it moves rows.
    """
    found, totals = ngrams(documents, depth, least, lang, text)
    # Decimals of 38 digits hold the products of any two counts here.
    wide = "decimal(28,0)"
    cuts = F.expr(
        f"array_min(transform(sequence(1, words - 1), k -> struct(2000000 * cast(f as {wide}) div (heads[k - 1] + tails[words - k - 1]) as score, "
        "k as k, heads[k - 1] as l, tails[words - k - 1] as r)))")
    kept = found.filter("words > 1").filter(
        F.coalesce(F.expr(f"100 * cast(greatest(before, behind) as {wide}) < {int(inside)} * cast(f as {wide})"), F.lit(True)))
    scored = kept.select("lang", "phrase", F.col("f").alias("a"), cuts.alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
