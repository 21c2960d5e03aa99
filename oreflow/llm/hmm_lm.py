"""A hidden Markov language model: Baum-Welch over all training texts, exact likelihoods by the scaled forward recursion.

Word counts cover all training texts. The most frequent words (a documented number) are symbols of their own, known to
every task; every other word is emitted through one of a fixed number of classes, by its ending, and from its class
by its own count. Counts of these words come by a join, so the vocabulary may grow without bound. Every round of
Baum-Welch sums expected counts over all partitions, one row per symbol and task, and re-estimates.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import as_bytes, list_column, stored, words

#: Words that are symbols of their own (number 0 is the end), classes of the others, latent states, rounds.
HEAD, CLASSES, STATES, ROUNDS = 60_000, 256, 8, 4
#: Training runs over pieces of at most this many tokens; scoring always runs over whole texts.
PIECE = 512
#: Tokens worked on together; words a worker remembers; weight of the overall distribution in re-estimation.
TOGETHER, MEMORY, PRIOR = 2_000_000, 300_000, 50.0
END = b""


class _Words(dict):
    """Word to (hash, class), for as many words as MEMORY allows."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= MEMORY:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        self[word] = found = value - (1 << 64) if value >> 63 else value, zlib.crc32(word[-2:]) % CLASSES
        return found


_seen = _Words()


def _count():
    """(hash, class, count) of the words of each task, and of the end of each text."""
    def rows(counts: Counter):
        found = [_seen[w] for w in counts]
        return pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in found], pa.int64()), pa.array([c for _, c in found], pa.int32()), pa.array(list(counts.values()), pa.int64())],
            ["word", "class", "c"])

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in as_bytes(batch.column(0)):
                counts.update(words(text))
                counts[END] += 1
                if len(counts) > MEMORY:
                    yield rows(counts)
                    counts.clear()
        if counts:
            yield rows(counts)
    return run


class Vocabulary:
    """Symbols of the frequent words and their counts, and the totals that turn counts into probabilities."""

    def __init__(self, counts: DataFrame, head: int):
        total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
        self.tokens, self.distinct = total["n"] or 0, total["v"]
        end = _seen[END][0]
        top = self._frequent(counts.filter(F.col("word") != end), head)
        ended = counts.filter(F.col("word") == end).first()
        self.symbol = {end: 0} | {r["word"]: i for i, r in enumerate(top, 1)}
        self.head = np.array([ended["c"] if ended else 0, *(r["c"] for r in top)], np.float64)
        in_class = np.zeros((CLASSES, 2))
        for r in counts.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():
            in_class[r["class"]] += r["c"], r["v"]
        for r in [*top, *([ended] if ended else [])]:
            in_class[r["class"]] -= r["c"], 1
        self.class_size = in_class[:, 0] + 0.5 * (in_class[:, 1] + 1)
        self.whole = self.tokens + 0.5 * (self.distinct + 1)
        weight = np.concatenate([self.head + 0.5, self.class_size])
        self.overall = weight / weight.sum()


    @staticmethod
    def _frequent(counts: DataFrame, most: int) -> list:
        """The most frequent words, as many whole steps of frequency as fit into `most`; the driver sees no others."""
        step = F.floor(F.log2("c") * 16).cast("int")
        sizes = {r["step"]: r["n"] for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()}
        room, lowest = most, None
        for s in sorted(sizes, reverse=True):
            room -= sizes[s]
            if room < 0:
                break
            lowest = s
        return [] if lowest is None else sorted(counts.filter(step >= lowest).collect(), key=lambda r: (-r["c"], r["word"]))


def _code(vocabulary: Vocabulary):
    """Texts as symbols, with what the frequent words give to the sums, and the other words with their numbers."""
    symbol, first_class = vocabulary.symbol, len(vocabulary.head)
    log_head = np.log10((vocabulary.head + 0.5) / vocabulary.whole)
    log_class = np.log10(vocabulary.class_size)

    def run(batches):
        for batch in batches:
            out, tails, times, lengths = [], [], [], []
            for text in as_bytes(batch.column(2)):
                found = [_seen[w] for w in words(text)]
                codes = np.array([symbol.get(h, -1 - c) for h, c in found] + [0], np.int64)
                rare = codes < 0
                classes = -1 - codes[rare]
                codes[rare] = first_class + classes
                tail = Counter(found[i][0] for i in np.flatnonzero(rare).tolist())
                common = codes[~rare]
                out.append((
                    len(codes), int((vocabulary.head[common] > 0).sum()), float(log_head[common].sum()), int(rare.sum()),
                    float(log_class[classes].sum()), codes.astype(np.uint16).tobytes(),
                ))
                tails += tail.keys()
                times += tail.values()
                lengths.append(len(tail))
            kinds = pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.binary()
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), *(pa.array(x, k) for x, k in zip(zip(*out) if out else [()] * 6, kinds)),
                list_column(np.array(tails, np.int64), np.array(lengths, np.int64), pa.int64()),
                list_column(np.array(times, np.int32), np.array(lengths, np.int64), pa.int32()),
            ], ["key", "held_out", "n_tokens", "known", "base", "rare", "spread", "codes", "tail", "times"])
    return run


class Model:
    """Start, transition and emission probabilities; emissions are stored by symbol."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def initial(cls, overall: np.ndarray, states: int, seed: int = 1) -> Model:
        noise = np.random.default_rng(seed).normal(0, 1, (len(overall), states))
        emit = overall[:, None] * np.exp(noise)
        move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(axis=0))


class _Sequences:
    """Symbol sequences side by side, longest first, so that at each step the running ones are a prefix."""

    def __init__(self, sequences: list[np.ndarray]):
        self.order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
        rows = [sequences[i] for i in self.order]
        lengths = np.array([len(r) for r in rows])
        flat, starts = np.concatenate(rows), np.cumsum(lengths) - lengths
        steps = int(lengths[0])
        self.running = np.searchsorted(-lengths, -np.arange(steps), side="left")
        self.offsets = np.concatenate(([0], np.cumsum(self.running)))
        step = np.repeat(np.arange(steps), self.running)
        which = np.arange(len(step)) - self.offsets[step]
        self.symbols = flat[starts[which] + step]

    def forward(self, model: Model, keep: bool) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
        """Log likelihood of each sequence (natural), and the scaled values and scales if they are kept."""
        move, emit = model.move.astype(np.float64), model.emit
        total = np.zeros(self.running[0])
        values = np.empty((len(self.symbols), len(model.start)), np.float32) if keep else None
        scales = np.empty(len(self.symbols)) if keep else None
        now = np.empty(0)
        for t, n in enumerate(self.running.tolist()):
            lo = int(self.offsets[t])
            e = emit[self.symbols[lo : lo + n]]
            now = (model.start if t == 0 else now[:n] @ move) * e
            scale = now.sum(axis=1)
            now /= scale[:, None]
            total[:n] += np.log(scale)
            if keep:
                values[lo : lo + n], scales[lo : lo + n] = now, scale
        return total, values, scales

    def likelihoods(self, model: Model) -> np.ndarray:
        total, _, _ = self.forward(model, False)
        out = np.empty(len(total))
        out[self.order] = total
        return out

    def expected(self, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected counts of starts, moves and (state, symbol), and the log likelihood of all sequences."""
        total, values, scales = self.forward(model, True)
        states, steps = len(model.start), len(self.running)
        moves, back_move = np.zeros((states, states)), np.ascontiguousarray(model.move.T)
        later = np.ones((0, states))
        for t in range(steps - 1, -1, -1):
            lo, n = int(self.offsets[t]), int(self.running[t])
            here = np.ones((n, states))
            if len(later):
                m = len(later)
                moves += values[lo : lo + m].T.astype(np.float64) @ later
                here[:m] = later @ back_move
            # `later` is emission times backward value over scale, ready for the step before.
            later = model.emit[self.symbols[lo : lo + n]] * here / scales[lo : lo + n, None]
            values[lo : lo + n] *= here
        seen = np.stack([np.bincount(self.symbols, values[:, s], len(model.emit)) for s in range(states)], axis=1)
        return values[: self.running[0]].sum(axis=0), moves * model.move, seen, float(total.sum())


def _groups(sequences: list[np.ndarray], most: int):
    """Sequences of similar length, at most `most` tokens together (a longer one is alone)."""
    sequences = sorted(sequences, key=len)
    held, size = [], 0
    for s in sequences:
        if held and size + len(s) > most:
            yield _Sequences(held)
            held, size = [], 0
        held.append(s)
        size += len(s)
    if held:
        yield _Sequences(held)


def _expect(model: Model):
    """(symbol, expected count in each state); moves out of state s come as symbol -1 - s, starts as -1000."""
    states = len(model.start)

    def run(batches):
        starts, moves, seen = np.zeros(states), np.zeros((states, states)), np.zeros_like(model.emit)
        for batch in batches:
            pieces = []
            for codes in as_bytes(batch.column(0)):
                codes = np.frombuffer(codes, np.uint16)
                pieces += [codes[i : i + PIECE] for i in range(0, len(codes), PIECE)]
            for group in _groups(pieces, TOGETHER):
                a, b, c, _ = group.expected(model)
                starts, moves, seen = starts + a, moves + b, seen + c
        some = np.flatnonzero(seen.any(axis=1))
        symbols = np.concatenate([some, -1 - np.arange(states), [-1000]])
        values = np.vstack([seen[some], moves, starts[None]])
        values[values < 1e-7] = 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(symbols.astype(np.int32)), *(pa.array(values[:, s].astype(np.float32)) for s in range(states))],
            ["symbol", *(f"s{s}" for s in range(states))])
    return run


def baum_welch(codes: DataFrame, overall: np.ndarray, states: int, rounds: int) -> Model:
    """Re-estimates `rounds` times; `codes` has one binary column of symbols. All rows count in every round."""
    model = Model.initial(overall, states)
    names = [f"s{s}" for s in range(states)]
    schema = "symbol int, " + ", ".join(f"{x} float" for x in names)
    for _ in range(rounds):
        sums = codes.mapInArrow(_expect(model), schema).groupBy("symbol").agg(*(F.sum(x).alias(x) for x in names)).toArrow()
        symbol = sums.column("symbol").to_numpy()
        values = np.stack([sums.column(x).to_numpy() for x in names], axis=1)
        seen, moves, starts = np.zeros_like(model.emit), np.full((states, states), 0.1), np.full(states, 0.1)
        seen[symbol[symbol >= 0]] = values[symbol >= 0]
        moved = (symbol < 0) & (symbol > -1000)
        moves[-1 - symbol[moved]] += values[moved]
        starts += values[symbol == -1000].sum(axis=0)
        emit = seen + PRIOR * overall[:, None]
        model = Model(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    return model


def _score(model: Model):
    def run(batches):
        for batch in batches:
            texts = [np.frombuffer(c, np.uint16) for c in as_bytes(batch.column(1))]
            out, order, held, size = np.zeros(len(texts)), sorted(range(len(texts)), key=lambda i: len(texts[i])), [], 0
            for i in [*order, None]:
                if held and (i is None or size + len(texts[i]) > TOGETHER):
                    out[held] = _Sequences([texts[k] for k in held]).likelihoods(model)
                    held, size = [], 0
                if i is not None:
                    held.append(i)
                    size += len(texts[i])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out / np.log(10))], ["row", "forward"])
    return run


def hmm_scores(
    documents: DataFrame, key: str = "doc_id", text: str = "text", states: int = STATES, rounds: int = ROUNDS, head: int = HEAD,
) -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities of whole texts).

    Held out are rows whose crc32 of the key as text leaves 1 when divided by 5; a null key counts as an empty text.
    Null texts count as empty and consist of the end alone. Repeated rows count as often as they occur. Other columns
    are not read. Without training rows all words are unknown. Counts are exact up to collisions of 64-bit hashes.
    """
    number = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    source = documents.select(F.col(key).alias("key"), (F.pmod(number, F.lit(5)) == 1).alias("held_out"), F.col(text).cast("binary").alias("text"))
    counted = source.filter("not held_out").select("text").mapInArrow(_count(), "word long, class int, c long")
    counts = stored(counted.groupBy("word", "class").agg(F.sum("c").alias("c")), "counts")
    vocabulary = Vocabulary(counts, head)
    kind = documents.schema[key].dataType.simpleString()
    coded = source.mapInArrow(_code(vocabulary), (
        f"key {kind}, held_out boolean, n_tokens long, known long, base double, rare long, spread double, codes binary, "
        "tail array<bigint>, times array<int>"))
    coded = stored(coded.withColumn("row", F.monotonically_increasing_id()), "coded")
    model = baum_welch(coded.filter("not held_out").select("codes"), vocabulary.overall, states, rounds)
    postings = coded.select("row", F.explode(F.arrays_zip("tail", "times")).alias("x")).select("row", F.col("x.tail").alias("word"), F.col("x.times").alias("times"))
    rare = postings.join(counts.select("word", "c"), "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("logs"),
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    forward = coded.select("row", "codes").mapInArrow(_score(model), "row long, forward double")
    logs = F.coalesce("logs", F.lit(0.0))
    return coded.join(forward, "row").join(rare, "row", "left").select(
        F.col("key").alias(key), "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("rare") * float(np.log10(vocabulary.whole))).alias("base_score"),
        (F.col("forward") + logs - F.col("spread")).alias("score"))
