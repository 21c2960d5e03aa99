import collections
import random
import re

import numpy as np
import pytest

from oreflow.llm import phrases
from tests.llm.helpers import documents


def pieces_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\x0a-\x0d]", lowered)]


def brute(rows, depth, least, inside, most):
    """Counts of all phrases, cuts and containment straight from the rules."""
    counts, n = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in rows:
        for words in pieces_of(text):
            n[lang or "und"] += len(words)
            for k in range(1, depth + 1):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = [g for g in f if len(g) > 1 and f[g] >= least]
        inner = collections.defaultdict(int)
        for g in candidates:
            for i in range(len(g)):
                for j in range(i + 1, len(g) + 1):
                    if j - i < len(g):
                        inner[g[i:j]] = max(inner[g[i:j]], f[g])
        scored = []
        for g in candidates:
            if not inner[g] or 100 * inner[g] < inside * f[g]:
                score, k = min((2000000 * f[g] // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
                scored.append((-score, -f[g], " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def texts(seed, count):
    rng, out = random.Random(seed), []
    stock = ["New York City", "as well as the", "in the", "of the", "La Seine", "x x x x", "é ß"]
    for i in range(count):
        parts = [rng.choice(stock) if rng.random() < 0.5 else f"w{rng.randrange(12)}" for _ in range(rng.randint(0, 60))]
        out.append((i, "".join(p + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " ; ", " "]) for p in parts), rng.choice(["en", "fr", None])))
    return out + [(None, None, "en"), (0, "", "de"), (1, "one word", "xx"), *[(7, "same row again", "en")] * 8, (9, "a a a a a a a a a a", "rep")]


def test_both_indexes_find_every_phrase_and_its_neighbours():
    rng = random.Random(1)
    for _ in range(30):
        words = [rng.randrange(5) for _ in range(rng.randint(0, 80))] + [0]
        index = phrases.BiIndex(*phrases.transforms(np.array(words, np.int32), 4))
        spelled, (a, b, n) = [(s,) for s in range(1, index.symbols)], index.words()
        rows = (a, b)
        for size, side in ((2, 1), (3, 0), (4, 1)):
            source, rows, n = index.extend(side, rows, n)
            expected = collections.Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1) if 0 not in words[i : i + size])
            # The word that was added is told by the rows themselves: all of the interval begin (or end) with it.
            symbol = np.searchsorted(index.first, rows[side], "right") - 1
            spelled = [(s, *spelled[w]) if side == 0 else (*spelled[w], s) for w, s in zip(source, symbol)]
            assert dict(zip(spelled, n.tolist())) == dict(expected)


@pytest.mark.parametrize("depth, least, shard, cut", [(4, 5, 2_000_000, 1_000_000), (4, 3, 50, 40), (2, 4, 7, 9), (5, 3, 100, 1), (3, 1, 40, 30)])
def test_collocations_equal_brute_force(spark, monkeypatch, depth, least, shard, cut):
    monkeypatch.setattr(phrases, "SHARD", shard)
    monkeypatch.setattr(phrases, "SLICE", cut)
    rows = texts(depth, 60)
    got = phrases.collocations(documents(spark, rows), depth, least, 80, 25)
    assert got.columns[:8] == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, depth, least, 80, 25)


def test_extensions(spark):
    rows = [(i, "the new york times. old new york", "en") for i in range(6)]
    found, totals = phrases.ngrams(documents(spark, rows), 3, 5)
    by = {r.phrase: r for r in found.collect()}
    assert totals.first().asDict() == {"lang": "en", "n": 42}
    assert (by["new york"].f, by["new york"].before, by["new york"].behind) == (12, 6, 6) and by["york"].behind == 6 and by["the"].before is None
    assert list(by["new york times"].heads) == [12, 12, 6] and list(by["new york times"].tails) == [6, 6, 6]


def test_empty_tables_and_nothing_frequent(spark):
    assert phrases.collocations(documents(spark, [])).count() == 0
    assert phrases.collocations(documents(spark, [(1, "a b c", "en"), (2, None, None)])).count() == 0
    with pytest.raises(ValueError):
        phrases.ngrams(documents(spark, []), 1)


def test_a_text_without_separators_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD", 20)
    monkeypatch.setattr(phrases, "SLICE", 64)
    rows = [(1, "one two three four " * 200, "en")]
    assert sorted(map(tuple, phrases.collocations(documents(spark, rows), 4, 30, 100, 9).collect())) == brute(rows, 4, 30, 100, 9)


def test_products_beyond_64_bits(spark):
    """The score's arithmetic at counts whose product with the factor passes 64 bits."""
    row = spark.sql("select 2000000 * cast(9000000000000000000 as decimal(28,0)) div (9000000000000000000 + 1L) as s").first()
    assert row.s == 1999999


def test_a_language_has_a_shard_of_its_own_size(spark, monkeypatch):
    """Shards that close because other languages have many words are small, and their phrases more rows."""
    monkeypatch.setattr(phrases, "SHARD", 1000)
    rows = [(i, "a b c d e f g h i", ["en", "fr"][i % 2]) for i in range(180)]  # ten numbers a text, the separator's included
    cut = phrases.shards(documents(spark, rows).coalesce(1), "lang", "text", 4)
    assert sorted(r["lang"] for r in cut.select("lang").collect()) == ["en", "fr"]


def test_the_order_of_packed_keys_is_stable():
    rng = np.random.default_rng(5)
    for most in (7, 1 << 20, 1 << 58):  # the last does not leave room for places
        keys = rng.integers(0, most, 300)
        keys[100:200] = keys[:100]
        order, found = phrases.sorted_order(keys, most)
        assert (order == np.argsort(keys, kind="stable")).all() and (found == keys[order]).all()
