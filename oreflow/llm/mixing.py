"""Mixing to target weights with soft membership.

A classifier fitted on all labelled documents gives every document a posterior over the domains. Its vocabulary is one
count over them, each step of its fit one aggregation, so the driver holds weights only, whose number is fixed. Then
projected gradient steps fit a nonnegative rate for each document, so that the expected token totals of the domains,
summed over documents as rate times tokens times posterior, come as near to the targets as the bounds allow. A step
needs only the totals of the step before: these are one aggregation over all documents, and a document's rate follows
from its posterior and the totals so far, so nothing per document is kept between steps.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.common import as_bytes, list_column, shuffles_end_with_writes, stored, tidied, words

#: Words that are features, and in how many labelled documents they must stand.
FEATURES, LEAST = 4_096, 8
#: Steps of the classifier's fit at most, its ridge (on features of unit variance), the pull of rates towards 1, and the bounds of the fit of rates.
FIT, RIDGE, PULL, STEPS, NEAR = 120, 3e-4, 0.002, 60, 1e-5
#: Rows that a step's tasks have, as every step starts them anew: about that many in a file, one or a few files in a task.
ROWS = 1 << 17
#: Features that are not words: shares of the 256 bytes, the share of distinct words and of immediate repeats, the size.
DENSE = 256 + 3


class Features:
    """Turns a text into sparse features: (numbers, values), and the number of its words."""

    def __init__(self, vocabulary: list[bytes]):
        self.number = {w: DENSE + i for i, w in enumerate(vocabulary)}
        self.size = DENSE + len(vocabulary)

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray, int]:
        tokens = words(text)
        distinct = set(tokens)
        present = sorted(map(self.number.__getitem__, distinct & self.number.keys()))
        dense = np.empty(DENSE)
        dense[:256] = np.bincount(np.frombuffer(text, np.uint8), minlength=256) * (10 / max(1, len(text)))
        n = max(1, len(tokens))
        dense[256:] = len(distinct) / n, sum(map(operator.eq, tokens[1:], tokens)) / n, np.log10(n)
        some = np.flatnonzero(dense)
        return np.concatenate([some, np.array(present, np.int64)]), np.concatenate([dense[some], np.ones(len(present))]), len(tokens)


@dataclass
class Classifier:
    """Softmax regression; `weights` has a row for each feature and, last, the intercepts."""

    features: Features
    weights: np.ndarray

    def posteriors(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        scores, counts = np.empty((len(texts), self.weights.shape[1])), np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            numbers, values, counts[i] = self.features.of(text)
            scores[i] = values @ self.weights[numbers] + self.weights[-1]
        return softmax(scores), counts


def softmax(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def _word_counts(batches):
    tidied()
    for batch in batches:
        found = pa.array([w for text in as_bytes(batch.column(0)) for w in set(words(text))], pa.binary()).value_counts()
        yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "n"])


def _featured(features: Features):
    """Labels and sparse vectors, as Spark's own classifiers read them."""
    def run(batches):
        tidied()
        for batch in batches:
            rows = [features.of(text)[:2] for text in as_bytes(batch.column(1))]
            if not rows:
                continue
            numbers, values = (np.concatenate([r[i] for r in rows]) for i in (0, 1))
            lengths = [len(r[0]) for r in rows]
            vectors = pa.StructArray.from_arrays([
                pa.array(np.zeros(len(rows), np.int8)), pa.array(np.full(len(rows), features.size, np.int32)),
                list_column(numbers.astype(np.int32), lengths, pa.int32()), list_column(values, lengths, pa.float64())],
                ["type", "size", "indices", "values"])
            yield pa.RecordBatch.from_arrays([batch.column(0), vectors], ["label", "features"])
    return run


def fit(labelled: DataFrame, features: Features, seen: list[int], domains: int) -> np.ndarray:
    """Softmax regression on all rows of `labelled`, (domain, text), whose domains are `seen`."""
    # Imported here, as workers that import this module would hold pandas and all of Spark's learners.
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import VectorUDT

    weights = np.zeros((features.size + 1, domains))
    if len(seen) > 1:  # the labels are places in `seen`
        place = F.array_position(F.lit(seen), F.col("domain")) - 1
        schema = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())])
        rows = stored(labelled.select(place.cast("double"), "text").mapInArrow(_featured(features), schema), "features")
        model = LogisticRegression(family="multinomial", maxIter=FIT, regParam=RIDGE).fit(rows)
        weights[:-1, seen] = model.coefficientMatrix.toArray().T
        weights[-1, seen] = model.interceptVector.toArray()
    if seen:
        weights[-1, [d for d in range(domains) if d not in seen]] = -30 + weights[-1, seen].min()  # no document here
    return weights


def train(documents: DataFrame, labels: DataFrame, domains: list[str]) -> Classifier:
    """From all documents with a label. `labels` is (doc_id, domain); of an id's domains the first in `domains` counts."""
    number = F.array_position(F.lit(domains), F.col("domain")) - 1
    labels = labels.filter(F.col("doc_id").isNotNull() & F.col("domain").isin(domains))
    labels = labels.groupBy(F.col("doc_id").alias("t_id")).agg(F.min(number).cast("int").alias("domain"))
    picked = stored(labels, "labels")  # written, so that Spark knows whether it can be broadcast
    with shuffles_end_with_writes(documents.sparkSession):
        labelled = stored(documents.join(picked, F.col("key") == F.col("t_id")).select("domain", "text"), "labelled")
    seen = sorted(r["domain"] for r in labelled.select("domain").distinct().collect())
    common = labelled.select("text").mapInArrow(_word_counts, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    common = common.filter(F.col("n") >= LEAST).orderBy(F.desc("n"), "word").limit(FEATURES).collect()
    features = Features([bytes(r["word"]) for r in common])
    return Classifier(features, fit(labelled, features, seen, len(domains)))


def with_posteriors(frame: DataFrame, classifier: Classifier, text: str) -> DataFrame:
    """Adds `tokens` (words of the text) and `posterior` (array<double>, by domain) in place of the text."""
    base = frame.drop(text)
    schema = T.StructType([*base.schema.fields, T.StructField("tokens", T.LongType()), T.StructField("posterior", T.ArrayType(T.DoubleType()))])

    def run(batches):
        tidied()
        for batch in batches:
            posterior, tokens = classifier.posteriors(list(as_bytes(batch.column(batch.num_columns - 1))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(tokens), pa.array(list(posterior), pa.list_(pa.float64()))],
                [*batch.schema.names[:-1], "tokens", "posterior"])

    return frame.select(*base.columns, F.col(text).cast("binary").alias(text)).mapInArrow(run, schema)


def rates(posterior: np.ndarray, errors: list[np.ndarray], most: float) -> tuple[np.ndarray, np.ndarray]:
    """Rates after one accelerated projected gradient step for each of `errors`, and the point that the next starts from.

    An error is the relative miss of the domain totals at the point its step starts from.
    """
    found = ahead = np.ones(len(posterior))
    for step, error in enumerate(errors):
        new = np.clip(ahead - (posterior @ error + PULL * (ahead - 1)) / (1 + PULL), 0, most)
        ahead, found = new + step / (step + 3) * (new - found), new
    return found, ahead


def _posterior_matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _packed(batches):
    """Of each batch one row with the bytes of its numbers, so that a step does nothing row by row."""
    for batch in batches:
        if batch.num_rows:
            columns = batch.column(0).to_numpy(), _posterior_matrix(batch.column(1))
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in columns], ["tokens", "posterior"])


def packed(judged: DataFrame) -> DataFrame:
    """Tokens and posteriors of all rows of `judged`, written in files of about ROWS rows."""
    files = judged.select("tokens", "posterior").coalesce(max(1, -(-judged.count() // ROWS)))
    return stored(files.mapInArrow(_packed, "tokens binary, posterior binary"), "packed")


def fit_rates(judged: DataFrame, targets: np.ndarray, most: float) -> list[np.ndarray]:
    """Misses of all steps; `judged` has tokens and posterior. Targets are token totals by domain.

    A miss is relative to the domain's own present or wanted total, the larger one, so rare domains weigh no less.
    """
    domains, errors, scale, names = len(targets), [], np.ones(len(targets)), [f"t{i}" for i in range(len(targets))]
    blocks = packed(judged)

    def totals(batches):
        sums = np.zeros(domains)
        for batch in batches:
            for tokens, posterior in zip(as_bytes(batch.column(0)), as_bytes(batch.column(1))):
                posterior = np.frombuffer(posterior).reshape(-1, domains)
                sums += (rates(posterior, errors, most)[1] * np.frombuffer(tokens, np.int64)) @ posterior
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in sums], names)

    for _ in range(STEPS):
        sums = blocks.mapInArrow(totals, ", ".join(f"{n} double" for n in names)).agg(*(F.sum(n) for n in names)).first()
        now = np.array([x or 0.0 for x in sums])
        if not errors:  # all rates are 1
            scale = np.maximum(np.maximum(now, targets), 1.0)
        error = (now - targets) / scale
        if errors and np.abs(error - errors[-1]).max() < NEAR:
            break
        errors.append(error)
    return errors


def soft_mix(
    documents: DataFrame, labels: DataFrame, weights: dict[str, float], key: str = "doc_id", text: str = "text",
    most_rate: float = 4.0, relative: bool = False,
) -> DataFrame:
    """Per row: key, tokens, rate, and p_<domain> for each domain of `weights`.

    `labels` is (doc_id, domain). The targets are `weights` as shares of all tokens, or, with `relative`, as factors
    of the domains' present expected totals. Null, empty and blank texts have no tokens, so they weigh nothing and
    get the rate that their posterior gives. Repeated rows count as often as they occur. Without labels all domains
    are equally likely; without documents the result is empty. Ids that labels repeat or lack do no harm (of
    several domains the first in `weights` counts), and other columns are not read.
    """
    domains = list(weights)
    source = documents.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))
    judged = stored(with_posteriors(source, train(source, labels, domains), "text"), "posteriors")
    present = judged.agg(*(F.sum(F.col("tokens") * F.col("posterior")[i]).alias(f"t{i}") for i in range(len(domains)))).first()
    present = np.array([x or 0.0 for x in present])
    factors = np.array([weights[d] for d in domains])
    targets = present * factors if relative else present.sum() * factors / factors.sum()
    errors = fit_rates(judged, targets, most_rate)
    kind = documents.schema[key].dataType.simpleString()

    def rated(batches):
        for batch in batches:
            found = rates(_posterior_matrix(batch.column(2)), errors, most_rate)[0] if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], ["key", "tokens", "posterior", "rate"])

    found = judged.select("key", "tokens", "posterior").mapInArrow(rated, f"key {kind}, tokens long, posterior array<double>, rate double")
    return found.select(
        F.col("key").alias(key), "tokens", "rate", *(F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(domains)))


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled table: toxic, else good or low."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "low")
    return labels.select("doc_id", domain.alias("domain"))


def drawn(key: Column, rate: Column) -> Column:
    """Whether a document with a rate of up to 1 is drawn: by a fixed number between 0 and 1 that its key gives."""
    return F.pmod(F.xxhash64(key), F.lit(1 << 30)) / float(1 << 30) < rate
