"""Byte-level BPE by prefix dynamic programming: for every byte prefix of a piece, its unique valid last token.

A sequence of tokens is the encoding of its bytes exactly when every two neighbours are *compatible*, that is, when
merging the bytes of both by rank gives those two tokens again. So each prefix has one last token that is compatible
with the last token of the prefix before it, and the encoding is read backwards along these. Appending bytes adds
entries and changes none; after an edit, entries before it stay.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.common import kept

#: Words held per Python worker before its memory of pieces is emptied, and the longest piece that is remembered.
MEMORY, REMEMBERED = 500_000, 48
#: Pieces of up to this many bytes work out prefixes only as the search needs them.
NESTED = 200
#: Texts above this many characters are split at certain piece boundaries before the pattern runs over them.
SLICE = 1_000_000


class Ranks:
    """A vocabulary of byte strings by rank, with the merge tree of each token found when it is first needed."""

    def __init__(self, lines: bytes):
        self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a}
        self.token = {r: t for t, r in self.rank.items()}
        self.longest = max(map(len, self.rank))
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._fits: dict[int, bool] = {}
        self._pieces: dict[str, tuple[int, ...]] = {}
        # Every beginning of a token that merging can give, with its rank, or -1 where it is not itself such a token.
        usable = {t: r for t, r in self.rank.items() if self.halves(r) != (-1, -1)}
        self._begins = {t[:i]: -1 for t in usable for i in range(1, len(t))} | usable

    def merged(self, data: bytes, below: int | None = None) -> list[bytes]:
        """Merge neighbours of lowest rank, leftmost first, while a rank (under `below`) is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            found = [(r, i) for i in range(len(parts) - 1) if (r := self.rank.get(parts[i] + parts[i + 1])) is not None]
            if not found or below is not None and min(found)[0] >= below:
                break
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that merge into this one; None for a single byte; (-1, -1) if merging never gives it."""
        if token not in self._halves:
            data = self.token[token]
            if len(data) == 1:
                self._halves[token] = None
            else:
                parts = self.merged(data, token)
                whole = len(parts) == 2 and all(p in self.rank for p in parts)
                self._halves[token] = (self.rank[parts[0]], self.rank[parts[1]]) if whole else (-1, -1)
        return self._halves[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging both tokens' bytes together leaves the border between them.

        Goes back in time from the finished tokens: the one made later is undone first, so the two that touch the
        border at each moment are met in turn. The border falls if those two form a token that merges before either
        of them is used up; at equal rank the left merge comes first.
        """
        key = left << 32 | right
        known = self._fits.get(key)
        if known is not None:
            return known
        token, rank, x, y = self.token, self.rank, left, right
        x_ends = y_ends = 1 << 60
        fits = True
        while True:
            across = rank.get(token[x] + token[y])
            if across is not None and across < x_ends and across <= y_ends:
                fits = False
                break
            x_halves, y_halves = self.halves(x), self.halves(y)
            if x_halves is None and y_halves is None:
                break
            if y_halves is None or x_halves is not None and x > y:
                x_ends, x = x, x_halves[1]
            else:
                y_ends, y = y, y_halves[0]
        if len(self._fits) > 4 * MEMORY:
            self._fits.clear()
        self._fits[key] = fits
        return fits

    def last_token(self, data: bytes, end: int, last: list[int]) -> int:
        """The last token of data[:end]; `last` holds those of the shorter prefixes, at their lengths."""
        for start in range(max(0, end - self.longest), end):
            token = self._begins.get(data[start:end], -1)
            if token >= 0 and (start == 0 or self.compatible(last[start], token)):
                return token
        raise ValueError(f"byte {data[end - 1]} is not in the vocabulary")

    def prefix_token(self, data: bytes, end: int, last: list[int]) -> int:
        """As `last_token`, but works out only those shorter prefixes that the search comes to (and fills `last`)."""
        begins, fits = self._begins.get, self._fits.get
        for start in range(max(0, end - self.longest), end):
            token = begins(data[start:end], -1)
            if token >= 0:
                if start == 0:
                    break
                before = last[start]
                if before < 0:
                    before = self.prefix_token(data, start, last)
                fit = fits(before << 32 | token)
                if fit or fit is None and self.compatible(before, token):
                    break
        else:
            raise ValueError(f"byte {data[end - 1]} is not in the vocabulary")
        last[end] = token
        return token

    def read_back(self, last: list[int], end: int) -> list[int]:
        ids = []
        while end:
            ids.append(last[end])
            end -= len(self.token[last[end]])
        return ids[::-1]

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one match of the pattern; a piece that is itself a token is that token."""
        known = self._pieces.get(piece)
        if known is not None:
            return known
        data = piece.encode("utf-8", "surrogatepass")
        whole = self.rank.get(data)
        if whole is not None:
            ids = (whole,)
        else:
            last = [-1] * (len(data) + 1)
            # Long pieces fill every prefix in turn, which keeps the search from nesting.
            for end in range(1, len(data)) if len(data) > NESTED else ():
                self.prefix_token(data, end, last)
            self.prefix_token(data, len(data), last)
            ids = tuple(self.read_back(last, len(data)))
        if len(piece) <= REMEMBERED:
            if len(self._pieces) >= MEMORY:
                self._pieces.clear()
            self._pieces[piece] = ids
        return ids

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class PrefixTable:
    """Last tokens of all prefixes of one byte string; exact under appends and edits."""

    def __init__(self, ranks: Ranks, data: bytes = b""):
        self.ranks, self.data, self.last = ranks, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        for end in range(len(self.last), len(self.data) + 1):
            self.last.append(self.ranks.last_token(self.data, end, self.last))

    def edit(self, start: int, end: int, new: bytes) -> None:
        """Replace data[start:end]. Prefixes up to `start` stay; behind the edit, work ends when entries repeat.

        A prefix entry depends on the bytes of the longest token and the entries before it. So once as many entries
        in a row as the longest token has bytes are the same as before, all later ones are.
        """
        old_data, old_last = self.data, self.last
        if not 0 <= start <= end <= len(old_data):
            raise ValueError("edit outside the data")
        self.data = old_data[:start] + new + old_data[end:]
        self.last = old_last[: start + 1]
        shift, same = len(new) - (end - start), 0
        for at in range(start + 1, len(self.data) + 1):
            self.last.append(self.ranks.last_token(self.data, at, self.last))
            behind = at >= start + len(new) + self.ranks.longest
            same = same + 1 if behind and self.last[at] == old_last[at - shift] else 0
            if same >= self.ranks.longest:
                self.last += old_last[at - shift + 1 :]
                break

    def ids(self) -> list[int]:
        whole = self.ranks.rank.get(self.data)
        return [whole] if whole is not None else self.ranks.read_back(self.last, len(self.data))


class EncodedText:
    """A text split by a pattern, each piece encoded; an edit splits and encodes anew only near itself."""

    #: Characters after its end that a match may look at: contractions, and one after white space.
    LOOKS = 3

    def __init__(self, ranks: Ranks, pattern: str, text: str = ""):
        self.ranks, self.pattern, self.text = ranks, regex.compile(pattern), text
        self.pieces = [(m.start(), m.end(), ranks.encode_piece(m.group())) for m in self.pattern.finditer(text)]

    def edit(self, start: int, end: int, new: str) -> int:
        """Replace text[start:end] and return how many pieces were encoded anew."""
        shift, begin = len(new) - (end - start), start + len(new)
        self.text = self.text[:start] + new + self.text[end:]
        head = 0
        while head < len(self.pieces) and self.pieces[head][1] <= start - self.LOOKS:
            head += 1
        later = {s + shift: i for i, (s, _, _) in enumerate(self.pieces) if s + shift >= begin and s >= end}
        fresh, tail = [], len(self.pieces)
        for m in self.pattern.finditer(self.text, self.pieces[head - 1][1] if head else 0):
            if m.start() in later:
                tail = later[m.start()]
                break
            fresh.append((m.start(), m.end(), self.ranks.encode_piece(m.group())))
        moved = [(s + shift, e + shift, ids) for s, e, ids in self.pieces[tail:]]
        self.pieces = self.pieces[:head] + fresh + moved
        return len(fresh)

    def append(self, more: str) -> int:
        return self.edit(len(self.text), len(self.text), more)

    def ids(self) -> list[int]:
        return [i for _, _, ids in self.pieces for i in ids]


def _worker(lines: bytes, pattern: str) -> tuple[Ranks, regex.Pattern]:
    """The vocabulary, read once per Python worker as long as that does nothing else (`regex` itself keeps patterns)."""
    return kept(("ranks", hash(lines)), lambda: Ranks(lines)), regex.compile(pattern)


#: A blank between a visible character and a letter begins a piece, whatever stands around it.
_CUT = regex.compile(r"(?<=\S) (?=\p{L})")


def _slices(text: str) -> Iterator[str]:
    begin = 0
    while len(text) - begin > SLICE:
        cut = _CUT.search(text, begin + SLICE)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:] if begin else text


def _text(value: bytes | None) -> str:
    return (value or b"").decode("utf-8", "replace")


def _vocabulary(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(frame: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds `ids`, the tokens of the whole text, as array<int>; null and empty texts give an empty array.

    The vocabulary file is read by the driver and travels with the task; other columns pass through, but a column
    that is already called `ids` is replaced.
    """
    lines, name = _vocabulary(ranks_path), ids
    base = frame.drop(ids)
    schema = T.StructType([*base.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches):
        ranks, split = _worker(lines, pattern)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("__text"))
            out = [[i for s in _slices(_text(t.as_py())) for p in split.findall(s) for i in ranks.encode_piece(p)] for t in texts]
            others = [batch.column(i) for i, f in enumerate(batch.schema) if f.name != "__text"]
            names = [f.name for f in batch.schema if f.name != "__text"]
            yield pa.RecordBatch.from_arrays([*others, pa.array(out, pa.list_(pa.int32()))], [*names, name])

    return base.withColumn("__text", F.col(text).cast("binary")).mapInArrow(run, schema)


def decode(frame: DataFrame, ranks_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds `out`, the bytes of the tokens in `ids`, as binary; a null array gives null."""
    lines, base = _vocabulary(ranks_path), frame.drop(out)
    schema = T.StructType([*base.schema.fields, T.StructField(out, T.BinaryType())])

    def run(batches):
        ranks, _ = _worker(lines, "")
        for batch in batches:
            values = [None if x.as_py() is None else ranks.decode(x.as_py()) for x in batch.column(batch.schema.get_field_index(ids))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.binary())], [*batch.schema.names, out])

    return base.mapInArrow(run, schema)


def digests(frame: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 (bytes decoded from the ids).

    One pass without a shuffle, and the ids never leave the task. Null and empty texts have no tokens and the hash of
    nothing; repeated rows give repeated rows; a very long text is worked through slice by slice, cut only where a
    piece certainly begins, and its hashes are fed as it goes.
    """
    lines = _vocabulary(ranks_path)
    schema = T.StructType([
        T.StructField(key, frame.schema[key].dataType), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ])

    def run(batches):
        ranks, split = _worker(lines, pattern)
        known, encode_piece, spelled = ranks._pieces, ranks.encode_piece, [str(i) for i in range(max(ranks.token) + 1)]
        for batch in batches:
            counts, encoded, decoded = [], [], []
            for value in batch.column(1):
                n, in_ids, in_bytes = 0, sha256(), sha256()
                for part in _slices(_text(value.as_py())):
                    ids: list[int] = []
                    for piece in split.findall(part):
                        ids += known.get(piece) or encode_piece(piece)
                    if ids:
                        in_ids.update(("," * (n > 0) + ",".join([spelled[i] for i in ids])).encode())
                        in_bytes.update(ranks.decode(ids))
                        n += len(ids)
                counts.append(n)
                encoded.append(in_ids.hexdigest())
                decoded.append(in_bytes.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(encoded), pa.array(decoded)], schema.names
            )

    return frame.select(F.col(key), F.col(text).cast("binary").alias("__text")).mapInArrow(run, schema)
