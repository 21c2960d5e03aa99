import random

import numpy as np
import pytest

from oreflow.llm import ngram_join
from tests.llm.helpers import documents, edited, prose


def brute(rows, n, percent):
    sets, root = [], list(range(len(rows)))
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset([tuple(w)] if 0 < len(w) < n else [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    found = []
    for i, (key, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if sets[i] and top(j) == top(i) and rows[j][0] is not None]
        found.append((key, len(sets[i]), min(ids) if ids else (None if sets[i] else key)))
    return sorted(found, key=repr)


def families(n_families, size, words, changes):
    rows = [(10_000, None), (10_001, ""), (10_002, " \n"), (10_003, "two words"), (10_004, "Two  WORDS"), (10_005, "one"), (None, "one"),
            (10_006, prose(1, 40)), (10_006, prose(1, 40)), (None, prose(2, 30))]
    for f in range(n_families):
        base, rng = prose(100 + f, words, 10**6), random.Random(f)
        rows += [(f * 100 + k, edited(base, f * 100 + k, rng.randint(0, changes))) for k in range(size)]
    return rows


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_components_match_brute_force(spark, n, percent):
    rows = families(5, 12, 150, 5)
    found = ngram_join.ngram_components(documents(spark, rows), n, percent)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows, n, percent)


def test_tiles_cut_into_blocks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rows = families(2, 40, 120, 4)
    found = ngram_join.ngram_components(documents(spark, rows), 3, 90)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows, 3, 90)


def test_linked_sets_always_share_a_tile():
    rng = np.random.default_rng(1)
    for size in (10, 19, 40, 75, 300):
        for _ in range(60):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            gone = int(rng.integers(0, max(1, size // 18) + 1))
            b = np.unique(np.concatenate([a[gone:], rng.integers(0, 1 << 63, int(rng.integers(0, size // 18 + 1)), dtype=np.uint64)]))
            if len(b) and ngram_join.linked(a, b, 90) and len(np.setxor1d(a, b)):
                assert np.intersect1d(ngram_join.tiles(a, 90), ngram_join.tiles(b, 90)).size


def test_bitmaps_never_reject_a_link():
    rng = np.random.default_rng(2)
    for size in (5, 60, 70, 500, 6000):
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            b = np.unique(np.concatenate([a[size // 30 :], rng.integers(0, 1 << 63, size // 40, dtype=np.uint64)]))
            if ngram_join.linked(a, b, 90):
                assert ngram_join.may_link(len(a), ngram_join.bitmap(a), len(b), ngram_join.bitmap(b), 90)
    low, high = np.arange(100, dtype=np.uint64), np.arange(1000, 1100, dtype=np.uint64) * np.uint64(77)
    assert not ngram_join.may_link(100, ngram_join.bitmap(low), 100, ngram_join.bitmap(high), 90)


def test_an_empty_table(spark):
    assert ngram_join.ngram_components(documents(spark, [])).count() == 0


@pytest.mark.parametrize("n,percent,block", [(3, 90, 2048), (5, 80, 4)])
def test_all_links_are_found_and_counted(spark, monkeypatch, n, percent, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "COLUMNS", 64 * block)
    rows = families(4, 15, 150, 2)
    sets = [set(map(int, ngram_join.ngram_set((text or "").encode(), n))) for _, text in rows]
    close = [[i != j and bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    found = ngram_join.ngram_links(documents(spark, rows), n, percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == brute(rows, n, percent)
    assert ngram_join.ngram_links(documents(spark, rows)).columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    assert sorted(((r.doc_id, r.n_links) for r in found), key=repr) == sorted(((key, sum(x)) for (key, _), x in zip(rows, close)), key=repr)
    pairs, members = ngram_join.ngram_pairs(documents(spark, rows), n, percent)
    keys = {}
    for r in members.collect():
        keys.setdefault(r.node, []).append(r.doc_id)
    got = sorted(tuple(sorted((min(keys[r.a], key=str), min(keys[r.b], key=str)), key=str)) for r in pairs.collect())
    first = {}
    for (key, _), x in zip(rows, sets):
        if x and str(key) < str(first.get(frozenset(x), "~")):
            first[frozenset(x)] = key
    names = list(first.items())
    want = [tuple(sorted((names[i][1], names[j][1]), key=str)) for i in range(len(names)) for j in range(i)
            if 100 * len(names[i][0] & names[j][0]) >= percent * len(names[i][0] | names[j][0])]
    assert got == sorted(want) and len(want) > len(rows)


def test_tiles_go_when_the_groups_are_written(spark, monkeypatch):
    """They and the shuffle files of earlier steps otherwise lie on disk until the job ends."""
    from pathlib import Path
    cleanup, real, written = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", ngram_join.stored, {}

    def stored(frame, name):
        written[name] = spark.conf.get(cleanup, None), (out := real(frame, name)).inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        return out

    monkeypatch.setattr(ngram_join, "stored", stored)
    words = [f"w{i}" for i in range(40)]
    found = ngram_join.ngram_components(documents(spark, [(1, " ".join(words)), (2, " ".join(words + ["x"])), (3, "other text altogether")]), 3, 80)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {1: 1, 2: 1, 3: 3}
    assert all(on == "true" for on, _ in written.values())
    assert [Path(written[x][1]).exists() for x in ("shared", "tiles", "lowest")] == [False, False, True]
