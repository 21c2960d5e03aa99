"""Small documents with all that may go wrong in them."""

import random

from pyspark.sql import types as T

#: Extra columns with names that operators use inside.
EXTRA = ["key", "node", "root", "h", "v", "d", "t", "row", "lang2", "lab", "__id"]
DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    *(T.StructField(c, T.StringType()) for c in EXTRA),
])


def documents(spark, rows, parts=3):
    """Rows are (doc_id, text) or (doc_id, text, lang)."""
    full = [(*r, *(["en"] if len(r) == 2 else []), *["x"] * len(EXTRA)) for r in rows]
    return spark.createDataFrame(full, DOCUMENTS).repartition(parts) if full else spark.createDataFrame([], DOCUMENTS)


def prose(seed, n, vocabulary=60):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(text, seed, n):
    rng, found = random.Random(seed), text.split()
    for _ in range(n):
        found[rng.randrange(len(found))] = f"z{rng.randrange(10**6)}"
    return " ".join(found)
