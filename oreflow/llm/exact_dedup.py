"""Exact duplicates by content-defined chunk recipes.

A normalised text is cut where a rolling hash of its last bytes says so; its recipe is the ordered list of its chunks'
identifiers. Recipes, a few numbers per document, are grouped and compared; texts are not. Only texts whose recipe
occurs more than once send their chunks, each distinct chunk once per map task, so that an identifier is verified to
stand for one byte string. Should two chunks share a hash, they get numbers of their own, and recipes carry these.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import as_bytes, mix, stored, tidied

#: Bytes the rolling hash looks back over, mean and bounds of a chunk, and bytes hashed at a time.
LOOK_BACK, MEAN, LEAST, MOST, BLOCK = 32, 2048, 256, 16384, 1 << 20
_GEAR = mix(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32)


def normalise(text: bytes) -> bytes:
    """Each run of white space becomes one blank, also at the ends."""
    if not text:
        return text
    inner = b" ".join(text.split())
    if not inner:
        return b" "
    return b" " * text[:1].isspace() + inner + b" " * text[-1:].isspace()


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks: where the hash of the last LOOK_BACK bytes has its low bits clear, within the bounds."""
    ends, last, n = [], 0, len(data)
    for begin in range(0, n, BLOCK):
        low = max(0, begin - LOOK_BACK + 1)
        rolled = _GEAR[np.frombuffer(data[low : begin + BLOCK], np.uint8)]
        step = 1
        while step < LOOK_BACK:
            further = rolled.copy()
            further[step:] += rolled[:-step] << np.uint32(step)
            rolled, step = further, 2 * step
        # A value with too few bytes before it belongs to the block before, or to the first chunk's least length.
        marks = np.flatnonzero((rolled >> np.uint32(5)) % MEAN == 0) + low + 1
        for mark in marks[marks > begin].tolist():
            while mark - last > MOST:
                last += MOST
                ends.append(last)
            if mark - last >= LEAST:
                last = mark
                ends.append(last)
    while n - last > MOST:
        last += MOST
        ends.append(last)
    if n > last:
        ends.append(n)
    return ends


def chunks(data: bytes) -> Iterator[bytes]:
    last = 0
    for end in cut_points(data):
        yield data[last:end]
        last = end


def _hash(chunk: bytes, bits: int) -> int:
    value = xxhash.xxh3_64_intdigest(chunk) & ((1 << bits) - 1)
    return value - (1 << 64) if value >> 63 else value


def _recipes(bits: int):
    def run(batches):
        tidied()
        for batch in batches:
            shas, keys, lists = [], [], []
            for text in as_bytes(batch.column(1)):
                text = normalise(text)
                recipe = np.array([_hash(c, bits) for c in chunks(text)], np.int64)
                shas.append(sha256(text).digest())
                keys.append(blake2b(recipe.tobytes(), digest_size=16).digest())
                lists.append(recipe)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(shas, pa.binary()), pa.array(keys, pa.binary()), pa.array(lists, pa.list_(pa.int64()))],
                ["id", "sha", "recipe_key", "recipe"],
            )
    return run


def _chunk_rows(bits: int, with_place: bool):
    """(hash, chunk), and the text's digest and the chunk's number if asked for."""
    def run(batches):
        for batch in batches:
            for text in as_bytes(batch.column(0)):
                text = normalise(text)
                found = list(chunks(text))
                columns = [pa.array([_hash(c, bits) for c in found], pa.int64()), pa.array(found, pa.binary())]
                names = ["hash", "chunk"]
                if with_place:
                    columns += [pa.array([sha256(text).digest()] * len(found), pa.binary()), pa.array(range(len(found)), pa.int32())]
                    names += ["sha", "seq"]
                yield pa.RecordBatch.from_arrays(columns, names)
    return run


def _collision_numbers(texts: DataFrame, bits: int) -> DataFrame | None:
    """(sha, numbers) for texts with a chunk whose hash stands for several byte strings; None if there is no such hash."""
    verified = texts.mapInArrow(_chunk_rows(bits, False), "hash long, chunk binary").distinct()
    shared = stored(verified.groupBy("hash").count().filter("count > 1").select("hash"), "collisions")
    if shared.isEmpty():
        return None
    rank = F.row_number().over(Window.partitionBy("hash").orderBy("chunk"))
    numbered = verified.join(shared, "hash").withColumn("rank", rank)
    places = texts.mapInArrow(_chunk_rows(bits, True), "hash long, chunk binary, sha binary, seq int")
    return places.join(numbered, ["hash", "chunk"]).groupBy("sha").agg(
        F.sort_array(F.collect_set(F.struct("seq", "rank"))).alias("numbers")
    )


def exact_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text", hash_bits: int = 64) -> DataFrame:
    """Per row: key, keep_id, group_size, kept, text_sha256, n_chunks. All rows come back, dropped ones too.

    Texts are equal when identical after each run of ``[\\x20\\x09-\\x0D]`` became one blank; null counts as empty, and
    all empty texts are one group. Of equal texts the row with the smallest key stays; a null key comes after all
    others, and among rows that repeat a key exactly one stays. Other columns are not read, so their names cannot
    clash. `hash_bits` below 64 makes chunk hashes collide, which costs time but changes no result.
    """
    source = documents.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text"))
    kind = documents.schema[key].dataType.simpleString()
    recipes = source.mapInArrow(_recipes(hash_bits), f"id {kind}, sha binary, recipe_key binary, recipe array<bigint>")
    recipes = stored(recipes.withColumn("row", F.monotonically_increasing_id()), "recipes")
    # Written, like the groups below: then a join is dealt by its key alone and a hot group can be split.
    repeated = stored(recipes.groupBy("recipe_key").count().filter("count > 1").select("recipe_key"), "repeated")
    wanted = recipes.join(repeated, "recipe_key").select(F.col("id").alias("wanted")).distinct()
    # The ids of repeated recipes grow with the corpus, so texts meet them by a merge at every size.
    texts = source.join(wanted.hint("merge"), source["id"].eqNullSafe(wanted["wanted"]), "left_semi").select("text")
    numbers = _collision_numbers(texts, hash_bits)
    if numbers is None:
        recipes = recipes.withColumn("numbers", F.array().cast("array<struct<seq:int,rank:int>>"))
    else:
        recipes = recipes.join(numbers, "sha", "left").withColumn(
            "numbers", F.coalesce("numbers", F.array().cast("array<struct<seq:int,rank:int>>")))
    same = ["recipe_key", "recipe", "numbers"]
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    groups = stored(recipes.groupBy(*same).agg(first.alias("first"), F.count("*").alias("group_size")), "groups")
    return recipes.join(groups, same).select(
        F.col("id").alias(key), F.col("first.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
        F.size("recipe").alias("n_chunks"),
    )
