import random

import numpy as np
from pyspark.sql import functions as F

from oreflow.llm import mixing
from tests.llm.helpers import documents


def corpus(n):
    rng, rows, domains = random.Random(1), [], {}
    own = {"good": "river stone", "low": "click buy", "toxic": "scum idiot"}
    for i in range(n):
        domain = rng.choices(list(own), [6, 3, 1])[0]
        rows.append((i, " ".join(rng.choice([f"w{rng.randrange(40)}", *own[domain].split()] if rng.random() < 0.2 else [f"w{rng.randrange(40)}"]) for _ in range(rng.randint(20, 90)))))
        domains[i] = domain
    return rows, domains


def labels(spark, domains, ids):
    return spark.createDataFrame([(i, domains[i]) for i in ids] + [(None, "good"), (0, domains[0]), (10**6, "low"), (3, None)], "doc_id long, domain string")


def test_totals_match_the_targets_and_the_classifier_holds_out(spark):
    rows, domains = corpus(700)
    more = [(900, None), (901, ""), (901, ""), (None, "w1 w2"), (902, "river " * 60_000)]
    weights = {"good": 0.8, "low": 0.15, "toxic": 0.05}
    found = mixing.soft_mix(documents(spark, rows + more), labels(spark, domains, range(0, 400)), weights).toPandas()
    assert len(found) == 705 and (found.rate >= 0).all() and (found.rate <= 4).all()
    test = found[(found.doc_id >= 400) & (found.doc_id < 700)]
    guess = test[["p_good", "p_low", "p_toxic"]].to_numpy().argmax(axis=1)
    assert np.mean([list(weights)[g] == domains[int(d)] for g, d in zip(guess, test.doc_id)]) > 0.85
    total = found.tokens.sum()
    for name, weight in weights.items():
        assert abs((found.rate * found.tokens * found[f"p_{name}"]).sum() / total - weight) < 0.02


def test_rates_are_those_of_a_plain_projected_gradient():
    rng = np.random.default_rng(2)
    posterior, tokens = rng.dirichlet([1, 1, 1], 200), rng.integers(1, 100, 200)
    targets = np.array([0.7, 0.25, 0.05]) * tokens.sum()
    errors = []
    for _ in range(400):
        _, ahead = mixing.rates(posterior, errors, 1.5)
        errors.append(((ahead * tokens) @ posterior - targets) / tokens.sum())
    found, _ = mixing.rates(posterior, errors, 1.5)
    plain = np.ones(200)
    for _ in range(20_000):
        error = ((plain * tokens) @ posterior - targets) / tokens.sum()
        plain = np.clip(plain - (posterior @ error + mixing.PULL * (plain - 1)) / (1 + mixing.PULL), 0, 1.5)
    assert np.abs(found - plain).max() < 0.02


def test_no_labels_no_documents_and_relative_targets(spark):
    rows, domains = corpus(60)
    none = labels(spark, domains, []).filter(F.lit(False))
    same = mixing.soft_mix(documents(spark, rows), none, {"good": 1.0, "low": 1.0}, relative=True).toPandas()
    assert np.allclose(same.p_good, 0.5) and np.allclose(same.rate, 1)
    assert mixing.soft_mix(documents(spark, []), none, {"good": 1.0, "low": 1.0}).count() == 0


def test_drawing_follows_the_rate(spark):
    frame = spark.range(4000).select(F.col("id").alias("doc_id"))
    assert frame.filter(mixing.drawn(F.col("doc_id"), F.lit(1.0))).count() == 4000
    assert abs(frame.filter(mixing.drawn(F.col("doc_id"), F.lit(0.3))).count() - 1200) < 150


def test_rare_domains_reach_their_targets(spark):
    rare = [(50, [0.01, 0.99]) if i % 500 == 0 else (50, [0.9999, 0.0001]) for i in range(4000)]
    judged = spark.createDataFrame(rare, "tokens long, posterior array<double>")
    tokens, posterior = np.array([t for t, _ in rare]), np.array([p for _, p in rare])
    present = tokens @ posterior
    targets = present * [1.0, 0.1]
    found, _ = mixing.rates(posterior, mixing.fit_rates(judged, targets, 1.0), 1.0)
    assert np.abs((found * tokens) @ posterior / present - [1.0, 0.1]).max() < 0.02


def test_the_classifier_learns_from_all_labelled_documents(spark):
    """More than the 4,000 of a domain that were drawn before: its mean posteriors are those of all labels, and a word in eight of them counts."""
    rng, rows = random.Random(4), []
    for i in range(12_000):
        low = rng.random() < 0.4
        own = " seldom" if i % 1500 == 7 else ""
        rows.append((i, " ".join(f"w{min(rng.randrange(20), rng.randrange(20)) + 3 * low}" for _ in range(4)) + own, "low" if low or own else "good"))
    named = spark.createDataFrame([(i, d) for i, _, d in rows], "doc_id long, domain string")
    more = [(20_000, "w5 w5"), (20_001, "w5 seldom")]
    found = mixing.soft_mix(documents(spark, [r[:2] for r in rows] + more), named, {"good": 0.5, "low": 0.5}).toPandas().set_index("doc_id")
    assert abs(found.p_low[found.index < 20_000].sum() - sum(d == "low" for _, _, d in rows)) < 5
    assert found.p_low[20_001] > found.p_low[20_000] + 0.1


def test_of_several_domains_of_an_id_the_first_counts(spark):
    rows = [(i, "river stone" if i % 2 else "click buy") for i in range(40)]
    named = [(i, "good" if i % 2 else "low") for i in range(40)] + [(i, "low") for i in range(1, 40, 2)]
    found = mixing.soft_mix(documents(spark, rows), spark.createDataFrame(named, "doc_id long, domain string"), {"good": 0.5, "none": 0.1, "low": 0.4}).toPandas()
    assert (found.p_good[found.doc_id % 2 == 1] > 0.8).all() and (found.p_low[found.doc_id % 2 == 0] > 0.8).all() and (found.p_none < 1e-9).all()


def test_a_step_reads_few_packed_rows(spark, monkeypatch):
    """Before, each step of the fit of rates started a task for every file or so and read every row in it."""
    rng = np.random.default_rng(3)
    rows = [(int(n), p.tolist()) for n, p in zip(rng.integers(0, 90, 3000), rng.dirichlet([1, 1, 1], 3000))]
    judged = spark.createDataFrame(rows, "tokens long, posterior array<double>").repartition(24)
    for most, files in ((1 << 17, 1), (1000, 3)):
        monkeypatch.setattr(mixing, "ROWS", most)
        blocks = mixing.packed(judged)
        assert len(blocks.inputFiles()) == files
        found = [(t, tuple(p)) for r in blocks.collect() for t, p in zip(np.frombuffer(r.tokens, np.int64), np.frombuffer(r.posterior).reshape(-1, 3))]
        assert sorted(found) == sorted((n, tuple(p)) for n, p in rows)
    tokens, posterior = np.array([n for n, _ in rows]), np.array([p for _, p in rows])
    errors, targets, present = [], tokens @ posterior * [1.0, 0.4, 0.1], tokens @ posterior
    for error in mixing.fit_rates(judged, targets, 1.0):
        _, ahead = mixing.rates(posterior, errors, 1.0)
        assert np.allclose(error, ((ahead * tokens) @ posterior - targets) / present)
        errors.append(error)
    none = mixing.fit_rates(judged.filter("tokens < 0"), np.zeros(3), 1.0)
    assert not np.any(none)
