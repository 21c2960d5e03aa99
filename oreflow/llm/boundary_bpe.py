"""BPE by forced boundaries: a pair of bytes that stands inside no token of the vocabulary is a certain cut.

Merging only ever makes tokens of the vocabulary. So if no token holds two neighbouring bytes side by side, no merge
crosses the border between them, whatever the order of merges: the fragments on both sides are encoded on their own and
their ids concatenated. White space stands in no token at all, so the same rule cuts a text into runs of visible bytes
before anything else is looked at; within a word the table of pairs cuts further. The last byte of a word carries the
word-end mark and has a table of its own. Fragments repeat far more often than words, and each is merged once a worker.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

#: Runs and fragments that a Python worker remembers before it starts anew, and the longest that it remembers.
MEMORY, REMEMBERED = 400_000, 64
#: Bytes of a text that are worked on at once; slices end at white space.
SLICE = 1_000_000
_WHITE = regex.compile(rb"[\x20\x09-\x0D]")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if visible, else the next free one."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in visible}
    return letters | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in letters)}


class BoundaryBpe:
    """A vocabulary of the kind: canonical composition, lower case, words by a pattern, byte-level BPE with word ends.

    Takes the bytes of a tokenizer file. Other kinds of normalisers, of splitting or of added tokens are refused.
    """

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model, split = spec["model"], (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        kinds = [s["type"] for s in split]
        if model["type"] != "BPE" or normal != ["NFC", "Replace", "Lowercase"] or kinds != ["Split", "ByteLevel"]:
            raise ValueError("not a byte-level BPE over composed, lower-cased words")
        if not split[0]["invert"] or split[0]["behavior"] != "Removed" or split[1]["use_regex"] or spec.get("decoder"):
            raise ValueError("the pattern has to give the words, and ids have to decode to tokens set apart by blanks")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens have to stand for their exact strings")
        letters, suffix, ids = byte_letters(), model["end_of_word_suffix"] or "", model["vocab"]
        self.inside = [ids[letters[b]] for b in range(256)]
        self.ending = [ids[letters[b] + suffix] for b in range(256)]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in ids.items()} | {i: t for t, i in self.added.items()}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merge.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
        self.pairs, self.last_pairs = self._pairs({c: b for b, c in letters.items()}, suffix, ids)
        self.words = regex.compile(split[0]["pattern"]["Regex"])
        self._byte, self._library = {c: b for b, c in letters.items()}, Tokenizer.from_buffer(data)
        self._added = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        self._fragments: dict[tuple[bytes, bool], tuple[int, ...]] = {}
        self._runs: dict[bytes, tuple[int, bytes, bytes]] = {}

    @staticmethod
    def _pairs(byte: dict[str, int], suffix: str, tokens) -> tuple[set[bytes], set[bytes]]:
        """Pairs of bytes inside tokens, and pairs whose second byte ends a word."""
        pairs, last = set(), set()
        for token in tokens:
            ends = bool(suffix) and token.endswith(suffix) and len(token) > len(suffix)
            data = bytes(byte[c] for c in (token[: -len(suffix)] if ends else token))
            found = [data[i : i + 2] for i in range(len(data) - 1)]
            if ends and found:
                last.add(found.pop())
            pairs.update(found)
        return pairs, last if suffix else pairs

    def fragments(self, word: bytes) -> list[tuple[bytes, bool]]:
        """The word cut at every forced boundary; the flag tells the fragment that ends it."""
        begin, out, top = 0, [], len(word) - 1
        pairs = self.pairs
        for i in range(1, top):
            if word[i - 1 : i + 1] not in pairs:
                out.append((word[begin:i], False))
                begin = i
        if top > 0 and word[top - 1 :] not in self.last_pairs:
            out.append((word[begin:top], False))
            begin = top
        out.append((word[begin:], True))
        return out

    def merged(self, data: bytes, ends: bool) -> tuple[int, ...]:
        """One fragment by merging: lowest rank first, of equal ranks the leftmost."""
        ids = [self.inside[b] for b in data]
        if ends:
            ids[-1] = self.ending[data[-1]]
        # A chain of symbols and a heap of their pairs: a long fragment costs no more than its length times a logarithm.
        after, before, merge = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)], self.merge
        heap = [(*merge[p], i) for i in range(len(ids) - 1) if (p := (ids[i], ids[i + 1])) in merge]
        heapq.heapify(heap)
        while heap:
            _, made, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or merge.get((ids[i], ids[j]), (0, -1))[1] != made:
                continue
            ids[i], ids[j], after[i] = made, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (p := (ids[x], ids[y])) in merge:
                    heapq.heappush(heap, (*merge[p], x))
        return tuple(i for i in ids if i >= 0)

    def word(self, word: bytes) -> list[int]:
        known, ids = self._fragments, []
        for fragment in self.fragments(word):
            found = known.get(fragment)
            if found is None:
                found = self.merged(*fragment)
                if len(fragment[0]) <= REMEMBERED:
                    if len(known) >= MEMORY:
                        known.clear()
                    known[fragment] = found
            ids += found
        return ids

    def plain(self, text: str) -> list[int]:
        """Ids of text without added tokens. Capital sigma is lowered without looking at its place in the word.

        Characters that this Python's Unicode tables lack are left to the library's tables of letters and cases.
        """
        if not text.isascii():
            if any(unicodedata.category(c) == "Cn" for c in text):
                found = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))
                return [i for w, _ in found for i in self.word(bytes(map(self._byte.__getitem__, w)))]
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return [i for w in self.words.findall(text.lower()) for i in self.word(w.encode("utf-8", "surrogatepass"))]

    def run(self, run: bytes) -> list[int]:
        """Ids of a run of visible bytes. Added tokens are found in it before anything is changed."""
        text, ids, at = run.decode("utf-8", "replace"), [], 0
        for m in self._added.finditer(text):
            ids += [*self.plain(text[at : m.start()]), self.added[m.group()]]
            at = m.end()
        return ids + self.plain(text[at:])

    def spelled(self, run: bytes) -> tuple[int, bytes, bytes]:
        """How many ids a run has, the ids in decimal, and their tokens; the last two joined by blanks."""
        found = self._runs.get(run)
        if found is None:
            ids = self.run(run)
            found = len(ids), b" ".join([b"%d" % i for i in ids]), self.decode(ids).encode()
            if len(run) <= REMEMBERED:
                if len(self._runs) >= MEMORY:
                    self._runs.clear()
                self._runs[run] = found
        return found

    def encode(self, text: bytes) -> list[int]:
        return [i for part in slices(text) for run in part.split() for i in self.run(run)]

    def decode(self, ids) -> str:
        return " ".join([self.token[i] for i in ids])


def slices(text: bytes) -> Iterator[bytes]:
    """The text in slices of about SLICE bytes that end at white space."""
    begin = 0
    while len(text) - begin > SLICE and (cut := _WHITE.search(text, begin + SLICE)):
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:] if begin else text


_loaded: dict[int, BoundaryBpe] = {}


def _worker(data: bytes) -> BoundaryBpe:
    """The vocabulary, read once per Python worker."""
    key = hash(data)
    if key not in _loaded:
        _loaded[key] = BoundaryBpe(data)
    return _loaded[key]


def _file(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _with(frame: DataFrame, source, name: str, kind: T.DataType, work) -> DataFrame:
    """The frame with a column `name` that `work` makes of each value of `source`; a column of that name is replaced."""
    kept = [c for c in frame.columns if c != name]
    schema = T.StructType([*(frame.schema[c] for c in kept), T.StructField(name, kind)])

    def run(batches):
        for batch in batches:
            values = [work(v.as_py()) for v in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(values, pa.list_(pa.int32()) if isinstance(kind, T.ArrayType) else pa.string())],
                [*kept, name])

    # The source stands last and is found by its place, so no name of the caller's is lost.
    return frame.select(*(F.col(f"`{c}`") for c in kept), source.alias(name)).mapInArrow(run, schema)


def encode(frame: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds `ids`, the tokens of the whole text, as array<int>; null and empty texts give an empty array.

    Other columns pass through whatever their names; one that is already called `ids` is replaced. An empty table gives
    an empty table. The vocabulary file is read by the driver and travels with the tasks.
    """
    data = _file(path)
    return _with(frame, F.col(text).cast("binary"), ids, T.ArrayType(T.IntegerType()), lambda v: _worker(data).encode(v or b""))


def decode(frame: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds `out`, the tokens of the array `ids` joined by blanks; a null array gives null."""
    data = _file(path)
    return _with(frame, F.col(ids), out, T.StringType(), lambda v: None if v is None else _worker(data).decode(v))


def digests(frame: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_tokens, ids_sha256 (decimal ids joined by one blank), decoded_sha256 (text decoded from the ids).

    One pass without a shuffle; ids never leave the task. Null and empty texts, and texts of white space only, have no
    tokens and the hash of nothing. Repeated rows and ids give repeated rows, other columns are not read, an empty table
    gives an empty one. A very long text is worked through in slices that end at white space; a run without white space
    is held whole.
    """
    data = _file(path)
    schema = T.StructType([
        T.StructField(key, frame.schema[key].dataType), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ])

    def run(batches):
        bpe = _worker(data)
        known, spelled = bpe._runs, bpe.spelled
        for batch in batches:
            counts, encoded, decoded = [], [], []
            for value in batch.column(1):
                n, in_ids, in_text = 0, sha256(), sha256()
                for part in slices(value.as_py() or b""):
                    found = [f for r in part.split() if (f := known.get(r) or spelled(r))[0]]
                    if found:
                        in_ids.update(b" " * (n > 0) + b" ".join([f[1] for f in found]))
                        in_text.update(b" " * (n > 0) + b" ".join([f[2] for f in found]))
                        n += sum([f[0] for f in found])
                counts.append(n)
                encoded.append(in_ids.hexdigest())
                decoded.append(in_text.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(encoded), pa.array(decoded)], schema.names)

    return frame.select(F.col(key), F.col(text).cast("binary").alias("__text")).mapInArrow(run, schema)
