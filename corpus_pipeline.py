"""Documents through quality, duplicates, mixing and tokens: each stage works on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from oreflow.llm import bpe, exact_dedup, mixing, ngram_join, quality_lm
from oreflow.llm.common import stored, table

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Words of a shingle and percent of similarity from which on documents are near duplicates.
SHINGLE, SIMILAR = 5, 80
#: What the mix aims at, as factors of the domains' expected tokens; a document is taken once at most.
MIX = {"good": 1.0, "low": 0.2, "toxic": 0.05}


def staying(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose doc_id is among `ids`; of rows that repeat a doc_id and a text, one."""
    ids = ids.select(F.col("doc_id").alias("__id")).distinct()
    kept = docs.join(ids, docs["doc_id"].eqNullSafe(ids["__id"]), "left_semi")
    again = Window.partitionBy("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256)).orderBy(F.lit(0))
    return kept.withColumn("__again", F.row_number().over(again)).filter("__again = 1").drop("__again")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents whose perplexity exceeds their language's threshold go."""
    return quality_lm.good_documents(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the one with the smallest id stays."""
    return staying(docs, exact_dedup.exact_duplicates(docs).filter("kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of near duplicates the one with the smallest id stays."""
    return staying(docs, ngram_join.ngram_components(docs, SHINGLE, SIMILAR).filter("component_id <=> doc_id"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents stay by their rates, which leave good ones whole and thin out low and toxic ones."""
    labels = mixing.label_domains(table(spark, sf_dir, "labels"))
    rated = mixing.soft_mix(docs, labels, MIX, most_rate=1.0, relative=True)
    return staying(docs, rated.filter(mixing.drawn(F.col("doc_id"), F.col("rate"))))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: token counts and digests of what is left."""
    return bpe.digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("tokens", tokens)]

#: Perplexities, rates and token ids are beyond SQL; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
