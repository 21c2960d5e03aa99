import collections
import itertools
import math
import zlib

import numpy as np
import pytest

from oreflow.llm import hmm_lm
from tests.llm.helpers import documents, prose


def small_model(seed, states=3, symbols=5):
    rng = np.random.default_rng(seed)
    return hmm_lm.Model(rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), states), rng.dirichlet(np.ones(symbols), states).T)


def test_likelihoods_are_sums_over_all_paths():
    model = small_model(1)
    texts = [np.array(t, np.uint16) for t in ([0], [3, 1, 4, 2], [2, 2], [1, 0, 0, 4, 3])]
    found = hmm_lm._Sequences(texts).likelihoods(model)
    for text, value in zip(texts, found):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(text)):
            p = model.start[path[0]] * model.emit[text[0], path[0]]
            for i in range(1, len(text)):
                p *= model.move[path[i - 1], path[i]] * model.emit[text[i], path[i]]
            total += p
        assert value == pytest.approx(math.log(total), rel=1e-9)


def test_expected_counts_are_those_of_all_paths():
    model = small_model(2)
    texts = [np.array(t, np.uint16) for t in ([3, 1, 4], [2, 2], [0])]
    starts, moves, seen, _ = hmm_lm._Sequences(texts).expected(model)
    w_starts, w_moves, w_seen = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for text in texts:
        weights = {}
        for path in itertools.product(range(3), repeat=len(text)):
            p = model.start[path[0]] * model.emit[text[0], path[0]]
            for i in range(1, len(text)):
                p *= model.move[path[i - 1], path[i]] * model.emit[text[i], path[i]]
            weights[path] = p
        for path, p in weights.items():
            p /= sum(weights.values())
            w_starts[path[0]] += p
            for i, s in enumerate(path):
                w_seen[text[i], s] += p
                if i:
                    w_moves[path[i - 1], s] += p
    assert np.allclose(starts, w_starts, atol=1e-5) and np.allclose(moves, w_moves, atol=1e-5) and np.allclose(seen, w_seen, atol=1e-5)


def test_training_raises_the_likelihood(spark):
    rng = np.random.default_rng(3)
    texts = [np.concatenate([rng.integers(0, 10, 30) + 10 * (k % 2), [20]]).astype(np.uint16) for k in range(60)]
    codes = spark.createDataFrame([(t.tobytes(),) for t in texts], "codes binary").repartition(4)
    overall = np.bincount(np.concatenate(texts), minlength=21) / sum(map(len, texts))
    before = hmm_lm._Sequences(texts).likelihoods(hmm_lm.Model.initial(overall, 4)).sum()
    once = hmm_lm._Sequences(texts).likelihoods(hmm_lm.baum_welch(codes, overall, 4, 1)).sum()
    often = hmm_lm._Sequences(texts).likelihoods(hmm_lm.baum_welch(codes, overall, 4, 6)).sum()
    assert before < once < often


def test_scores_against_counts(spark):
    rows = [(i, prose(i, 40, 200) + " Äpfel") for i in range(60)] + [(100, None), (101, ""), (101, ""), (102, " \t"), (None, "w1 UNSEENWORD"), (103, "w1 " * 20_000)]
    found = hmm_lm.hmm_scores(documents(spark, rows), states=3, rounds=2, head=50).collect()
    tokens = [((k, t), (t or "").encode().lower().split() + [b""]) for k, t in rows]
    held = {k: zlib.crc32(str(k).encode() if k is not None else b"") % 5 == 1 for k, _ in rows}
    counts = collections.Counter(w for (k, _), ws in tokens if not held[k] for w in ws)
    whole, kinds = sum(counts.values()), len(counts)
    want = [(k, held[k], len(ws), sum(counts[w] > 0 for w in ws), whole, round(sum(math.log10((counts[w] + 0.5) / (whole + 0.5 * (kinds + 1))) for w in ws), 5)) for (k, _), ws in tokens]
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert all(r.score < 0 for r in found)


def test_one_state_and_no_frequent_words(spark):
    """Then a score is the end's share times that of the word's class times that of the word within it."""
    rows = [(i, f"w{i % 7}") for i in range(70)]
    found = {r.doc_id: r.score for r in hmm_lm.hmm_scores(documents(spark, rows), states=1, rounds=1, head=0).collect()}
    counts = collections.Counter(t for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1)
    ends, classes = sum(counts.values()), collections.defaultdict(list)
    for w, c in counts.items():
        classes[zlib.crc32(w.encode()) % hmm_lm.CLASSES].append(c)
    sizes = {k: sum(v) + 0.5 * (len(v) + 1) for k, v in classes.items()}
    weight = ends + 0.5 + sum(sizes.values()) + 0.5 * (hmm_lm.CLASSES - len(sizes))
    share = lambda seen, size: (seen + hmm_lm.PRIOR * size / weight) / (2 * ends + hmm_lm.PRIOR)
    for i, w in rows:
        k = zlib.crc32(w.encode()) % hmm_lm.CLASSES
        want = share(ends, ends + 0.5) * share(sum(classes[k]), sizes[k]) * (counts[w] + 0.5) / sizes[k]
        assert found[i] == pytest.approx(math.log10(want), rel=1e-5)


def test_an_empty_table_and_no_training_rows(spark):
    assert hmm_lm.hmm_scores(documents(spark, []), states=2, rounds=1).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = hmm_lm.hmm_scores(documents(spark, [(held, "a b")]), states=2, rounds=1).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0) and row.base_score == pytest.approx(0)
