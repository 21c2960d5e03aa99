"""Which tokens of one tokenizer overlap which of another, by merging the ends of both along equal pieces of their path.

The byte offsets where tokens of A and of B end are two sorted lists. Merging them walks a path of as many steps as both
have ends, an end of A before an equal end of B. Every step but the second of an equal pair closes one stretch of bytes
that lies in one token of each side: these stretches are the links. A diagonal of the path, all points that are d steps
from its start, is crossed once, and a binary search over the diagonal finds where. So crossings at every STEPS-th
diagonal divide the work into pieces that need nothing of each other, whatever the lengths of the texts. A piece holds
the tokens whose ends it walks, the two tokens that are open where it ends, and how far apart both sides begin. Equal
ends cut the tokens into groups; the group that a piece begins or ends within is put together with its neighbours'.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.boundary_bpe import byte_letters
from oreflow.llm.common import list_column, stored

#: Steps of the merge in one piece.
STEPS = 16_384
#: Pairs whose counts travel with the tasks: each holds at least this part of all links, so they are at most as many.
#: All rarer ones meet their counts in a join, where none of them is a hot key.
HOT = 65_536
#: Links whose pairs are counted together before they leave a task, chunks remembered by a worker and their longest.
TOGETHER, MEMORY, REMEMBERED = 2_000_000, 300_000, 64

#: A blank between visible characters begins a token on both sides, whatever stands around it.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


class TokenPair:
    """Both tokenizers, from the bytes of their files, with the bytes of every token."""

    def __init__(self, a_file: bytes, b_file: bytes):
        model, byte = json.loads(a_file)["model"], {c: b for b, c in byte_letters().items()}
        ranks = {bytes(map(byte.__getitem__, token)): i for token, i in model["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in merges]
        if any(x >= y for x, y in zip(made, made[1:])):
            raise ValueError("ids have to be in the order of the merges")
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(_BYTE.match(p)[1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_lengths, self.b_lengths = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        # A blank after a visible character begins a token of B only if no piece has one inside.
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.size = max(len(self.a_bytes), len(self.b_bytes))
        self.kind = "<u2" if self.size <= 1 << 16 else "<i4"
        width = len(str(self.size - 1))
        numbers = np.arange(self.size)[:, None] // 10 ** np.arange(width - 1, -1, -1)
        self.digits = np.where((numbers > 0) | (np.arange(width) == width - 1), numbers % 10 + 48, 0).astype(np.uint8)
        self._known: dict[str, tuple[bytes, bytes] | None] = {}

    def chunk(self, chunk: str) -> tuple[bytes, bytes] | None:
        """Ids of both sides for a blank and a chunk of text; None if either side's bytes are not that."""
        a, b = self.a.encode_ordinary(" " + chunk), self.b.encode(chunk)
        raw = b" " + chunk.encode("utf-8", "replace")
        same = raw == b"".join([self.a_bytes[i] for i in a]) == b"".join([self.b_bytes[i] for i in b])
        found = (np.array(a, self.kind).tobytes(), np.array(b, self.kind).tobytes()) if same else None
        if len(chunk) <= REMEMBERED:
            if len(self._known) >= MEMORY:
                self._known.clear()
            self._known[chunk] = found
        return found

    def encode(self, data: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a blank and the text by A and by B; no ids if the text is empty or either side's bytes differ from it."""
        none = np.zeros(0, self.kind)
        try:
            text = (data or b"").decode()
        except UnicodeDecodeError:
            return none, none
        known, found = self._known, []
        for chunk in (_CUT.split(text) if self.cuts else [text]) if text else ():
            ids = known.get(chunk) or self.chunk(chunk)
            if ids is None:
                return none, none
            found.append(ids)
        return np.frombuffer(b"".join([f[0] for f in found]), self.kind), np.frombuffer(b"".join([f[1] for f in found]), self.kind)

    def spelled(self, a: np.ndarray, b: np.ndarray, a_to: np.ndarray, b_to: np.ndarray) -> bytes:
        """Groups as `a1,a2|b1;a3|b2`: group g ends before the tokens a_to[g] and b_to[g]; none is empty on either side."""
        group_a, group_b = (np.repeat(np.arange(len(to)), np.diff(to, prepend=0)) for to in (a_to, b_to))
        width = self.digits.shape[1]
        out = np.zeros((len(a) + len(b), width + 1), np.uint8)
        out[np.arange(len(a)) + np.r_[0, b_to][group_a], :width] = self.digits[a]
        out[np.arange(len(b)) + a_to[group_b], :width] = self.digits[b]
        out[:, width] = ord(",")
        out[np.r_[0, b_to[:-1]] + a_to - 1, width] = ord("|")
        out[a_to + b_to - 1, width] = ord(";")
        return out[out != 0].tobytes()[:-1]


def crossings(a_ends: np.ndarray, b_ends: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """For each diagonal d, how many of the first d merged ends are A's: one binary search a diagonal, all at a time."""
    low, high = np.maximum(0, diagonals - len(b_ends)), np.minimum(diagonals, len(a_ends))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        first = np.zeros(len(low), bool)
        first[open_] = a_ends[middle[open_]] <= b_ends[(diagonals - middle - 1)[open_]]
        low, high = np.where(open_ & first, middle + 1, low), np.where(open_ & ~first, middle, high)
    return low


@dataclass
class Piece:
    """Tokens of a piece, each side with the one that is open at its end; `n_a` and `n_b` of them end within it.

    `shift` tells how far behind the start of B's first token the start of A's first token lies.
    """

    a: np.ndarray
    b: np.ndarray
    n_a: int
    n_b: int
    shift: int


def divided(a: np.ndarray, b: np.ndarray, a_lengths: np.ndarray, b_lengths: np.ndarray, steps: int) -> list[Piece]:
    """The merge of both sides in pieces of `steps` steps; one empty piece without tokens."""
    if len(a) + len(b) <= steps:
        return [Piece(a, b, len(a), len(b), 0)]
    a_ends, b_ends = np.cumsum(a_lengths[a]), np.cumsum(b_lengths[b])
    diagonals = np.r_[np.arange(0, len(a) + len(b), steps), len(a) + len(b)]
    i = crossings(a_ends, b_ends, diagonals)
    j = diagonals - i
    starts = np.r_[0, a_ends][i] - np.r_[0, b_ends][j]
    return [
        Piece(a[i[k] : i[k + 1] + 1], b[j[k] : j[k + 1] + 1], int(i[k + 1] - i[k]), int(j[k + 1] - j[k]), int(starts[k]))
        for k in range(len(i) - 1)
    ]


class Merged:
    """A piece merged: its links as places of tokens within it, and its groups."""

    def __init__(self, p: Piece, pair: TokenPair):
        far = np.int64(1) << 62
        a_ends = np.r_[np.cumsum(pair.a_lengths[p.a]) + p.shift, far]
        b_ends = np.r_[np.cumsum(pair.b_lengths[p.b]), far]
        own_a, own_b = a_ends[: p.n_a], b_ends[: p.n_b]
        at_b, at_a = np.searchsorted(b_ends, own_a), np.searchsorted(a_ends, own_b)
        closing = b_ends[at_b] == own_a
        # An end of B that A has too was a link already, in this piece or as the last step of the one before.
        new = (a_ends[at_a] != own_b) & (own_b != p.shift)
        self.link_a = np.r_[np.arange(p.n_a), at_a[new]]
        self.link_b = np.r_[at_b, np.flatnonzero(new)]
        self.last_a = np.flatnonzero(closing)
        self.last_b = at_b[self.last_a]
        self.begun = int(p.n_b > 0 and own_b[0] == p.shift)

    def parts(self, p: Piece, pair: TokenPair) -> list[bytes]:
        """Head of A and of B, the groups that lie whole in the piece, tail of A and of B; with no closing, tails alone."""
        def ids(x: np.ndarray) -> bytes:
            return b",".join([b"%d" % i for i in x.tolist()])

        if not len(self.last_a):
            return [b"", b"", b"", ids(p.a[: p.n_a]), ids(p.b[self.begun : p.n_b])]
        a0, b0, a1, b1 = self.last_a[0] + 1, self.last_b[0] + 1, self.last_a[-1] + 1, self.last_b[-1] + 1
        middle = pair.spelled(p.a[a0:a1], p.b[b0:b1], self.last_a[1:] + 1 - a0, self.last_b[1:] + 1 - b0) if a1 > a0 else b""
        return [ids(p.a[:a0]), ids(p.b[self.begun : b0]), middle, ids(p.a[a1 : p.n_a]), ids(p.b[b1 : max(b1, p.n_b)])]

    def digest(self, p: Piece, pair: TokenPair) -> str:
        """The digest of the groups of a document that is one piece."""
        return sha256(pair.spelled(p.a, p.b, self.last_a + 1, self.last_b + 1)).hexdigest() if p.n_a else ""


_loaded: dict[int, TokenPair] = {}


def _worker(files: tuple[bytes, bytes]) -> TokenPair:
    """The tokenizers, read once per Python worker."""
    key = hash(files)
    if key not in _loaded:
        _loaded[key] = TokenPair(*files)
    return _loaded[key]


def _files(a_path: str, b_path: str) -> tuple[bytes, bytes]:
    with open(a_path, "rb") as a, open(b_path, "rb") as b:
        return a.read(), b.read()


def pieces(frame: DataFrame, files: tuple[bytes, bytes], key: str = "doc_id", text: str = "text", steps: int = STEPS) -> DataFrame:
    """The documents encoded by both tokenizers and divided: (row, key, piece, pieces, a, b, n_a, n_b, shift), written.

    `row` numbers the rows of the frame, so that null and repeated keys do no harm.
    """
    base = frame.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    names = ["row", "key", "piece", "pieces", "a", "b", "n_a", "n_b", "shift"]
    kind = base.schema["key"].dataType.simpleString()

    def run(batches):
        pair = _worker(files)
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part, source, out = batch.slice(begin, 500), [], []
                for at, value in enumerate(part.column(2)):
                    found = divided(*pair.encode(value.as_py()), pair.a_lengths, pair.b_lengths, steps)
                    source += [at] * len(found)
                    out += [(k, len(found), p.a.tobytes(), p.b.tobytes(), p.n_a, p.n_b, p.shift) for k, p in enumerate(found)]
                kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64()]
                columns = [pa.array(list(x), t) for x, t in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(pa.array(source)) for c in (0, 1)), *columns], names)

    schema = f"row long, key {kind}, piece int, pieces int, a binary, b binary, n_a int, n_b int, shift long"
    return stored(base.mapInArrow(run, schema), "pieces")


def _read(batch: pa.RecordBatch, pair: TokenPair):
    columns = [batch.column(batch.schema.get_field_index(c)) for c in ("a", "b", "n_a", "n_b", "shift")]
    for a, b, n_a, n_b, shift in zip(*columns):
        yield Piece(np.frombuffer(a.as_py(), pair.kind), np.frombuffer(b.as_py(), pair.kind), n_a.as_py(), n_b.as_py(), shift.as_py())


def links(frame: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", steps: int = STEPS) -> DataFrame:
    """One row per link: row (a number of the document's row), key, piece, a, b (ids), in no order.

    Null, empty and differing texts have no links; see `alignment`.
    """
    files, cut = _files(a_path, b_path), pieces(frame, _files(a_path, b_path), key, text, steps)

    def run(batches):
        pair = _worker(files)
        for batch in batches:
            for at, p in enumerate(_read(batch, pair)):
                m = Merged(p, pair)
                same = pa.array(np.full(len(m.link_a), at))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(same) for c in (0, 1, 2)), pa.array(p.a[m.link_a], pa.int32()), pa.array(p.b[m.link_b], pa.int32())],
                    ["row", "key", "piece", "a", "b"])

    return cut.mapInArrow(run, f"row long, key {cut.schema['key'].dataType.simpleString()}, piece int, a int, b int")


def pair_counts(cut: DataFrame, files: tuple[bytes, bytes]) -> DataFrame:
    """How many links of the whole corpus hold each pair of ids: (pair, n, best), written; pair = a * size + b.

    Counted within tasks first, so a frequent pair is a few rows per task. `best` tells whether no other A id has more
    links with the pair's B id; the highest counts are one row per B id, as many as the vocabulary at most.
    """
    def run(batches):
        pair, held, many = _worker(files), [], 0
        for batch in batches:
            for p in _read(batch, pair):
                m = Merged(p, pair)
                held.append(p.a[m.link_a].astype(np.int64) * pair.size + p.b[m.link_b])
                many += len(held[-1])
                if many >= TOGETHER:
                    yield _counted(np.concatenate(held))
                    held, many = [], 0
        if held:
            yield _counted(np.concatenate(held))

    size = TokenPair(*files).size
    counts = stored(cut.select("a", "b", "n_a", "n_b", "shift").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    most = counts.groupBy(F.expr(f"pair % {size}").alias("b")).agg(F.max("n").alias("most"))
    counts = counts.join(F.broadcast(most), F.expr(f"pair % {size}") == F.col("b"))
    return stored(counts.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counts")


def _counted(pairs: np.ndarray) -> pa.RecordBatch:
    found, n = np.unique(pairs, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["pair", "n"])


#: What a piece tells of itself; `rare` and `times` are its pairs whose counts are not among the frequent ones.
_TOLD = ["row", "key", "piece", "pieces", "n_a", "n_b", "n_groups", "n_links", "best", "total", "digest", "parts", "rare", "times"]


def _told(cut: DataFrame, counts: DataFrame, files: tuple[bytes, bytes], hot: int) -> DataFrame:
    """Each piece merged again and scored by the frequent pairs; written."""
    least = (counts.agg(F.sum("n")).first()[0] or 0) / hot
    frequent = counts.filter(F.col("n") >= F.lit(least)).orderBy("pair").toArrow()
    keys, ns, bests = (frequent.column(c).to_numpy() for c in ("pair", "n", "best"))

    def run(batches):
        pair = _worker(files)
        for batch in batches:
            rows, rare, times = [], [], []
            whole = batch.column(batch.schema.get_field_index("pieces"))
            for one, p in zip(whole, _read(batch, pair)):
                m = Merged(p, pair)
                pairs = p.a[m.link_a].astype(np.int64) * pair.size + p.b[m.link_b]
                at = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
                known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
                found, n = np.unique(pairs[~known], return_counts=True)
                alone = one.as_py() == 1
                rows.append((
                    len(m.last_a), len(pairs), int(bests[at[known]].sum()), int(ns[at[known]].sum()),
                    m.digest(p, pair) if alone else None, None if alone else [*m.parts(p, pair), b"%d" % len(m.last_a)]))
                rare.append(found)
                times.append(n)
            kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.binary())]
            lengths = np.array([len(x) for x in rare])
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in _TOLD[:6]] + [pa.array(list(x), t) for x, t in zip(zip(*rows), kinds)]
                + [list_column(np.concatenate(x), lengths, pa.int64()) for x in (rare, times)], _TOLD)

    kind = cut.schema["key"].dataType.simpleString()
    return stored(cut.mapInArrow(
        run, f"row long, key {kind}, piece int, pieces int, n_a int, n_b int, n_groups long, n_links long, best long, total long, "
             "digest string, parts array<binary>, rare array<long>, times array<long>"), "told")


def stitched(told: DataFrame) -> DataFrame:
    """(row, digest) of documents in several pieces: groups that pieces begin or end within are put together in turn.

    A document's pieces come in order and are hashed as they come; only the open group is held.
    """
    def run(batches):
        now, digest, a, b, first = None, sha256(), [], [], True
        for batch in batches:
            done = []
            for row, parts in zip(batch.column(0).to_pylist(), batch.column(1)):
                if row != now:
                    done += [(now, digest.hexdigest())] * (now is not None)
                    now, digest, a, b, first = row, sha256(), [], [], True
                head_a, head_b, middle, tail_a, tail_b, closings = parts.as_py()
                if int(closings):
                    group = b",".join(x for x in [*a, head_a] if x) + b"|" + b",".join(x for x in [*b, head_b] if x)
                    digest.update(b";" * (not first) + group + (b";" + middle if middle else b""))
                    a, b, first = [], [], False
                a.append(tail_a)
                b.append(tail_b)
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in done], pa.int64()), pa.array([d for _, d in done], pa.string())], ["row", "digest"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([digest.hexdigest()])], ["row", "digest"])

    ordered = told.filter("pieces > 1").select("row", "parts", "piece").repartition("row").sortWithinPartitions("row", "piece")
    return ordered.select("row", "parts").mapInArrow(run, "row long, digest string")


def alignment(frame: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", steps: int = STEPS, hot: int = HOT) -> DataFrame:
    """Per row: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A encodes a blank and the text, B the text, to which it adds that blank. `n_best` are the links whose pair has the
    highest count of its B id in the corpus, ties included; `count_sum` adds the counts of all links. Texts that are
    null, empty, not UTF-8, or that one side doesn't give back byte for byte (such as those with U+2581) have zeros and
    an empty digest. Repeated rows count as often as they stand; other columns are not read, whatever their names; an
    empty table gives an empty one. A very long text is many pieces, and only its digest is one task's work.
    """
    files = _files(a_path, b_path)
    cut = pieces(frame, files, key, text, steps)
    counts = pair_counts(cut, files)
    told = _told(cut, counts, files, hot)
    rare = told.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("pair"), "x.times")
    rare = rare.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("rare_best"), F.sum(F.col("times") * F.col("n")).alias("rare_total"))
    sums = [F.sum(c).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "best", "total")]
    several = told.filter("pieces > 1").groupBy("row", "key").agg(*sums).join(stitched(told), "row")
    columns = ["row", "key", *(F.col(c).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "best", "total")), "digest"]
    both = told.filter("pieces = 1").select(*columns).unionByName(several.select(*columns))
    return both.join(rare, "row", "left").select(
        F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links",
        (F.col("best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
        (F.col("total") + F.coalesce("rare_total", F.lit(0))).alias("count_sum"),
        F.col("digest").alias("groups_sha256"))
