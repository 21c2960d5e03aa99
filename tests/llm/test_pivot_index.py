import numpy as np
import pytest
from pyspark.sql import types as T

from oreflow.llm import pivot_index

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
    T.StructField("node", T.StringType()), T.StructField("vec", T.StringType()), T.StructField("lab", T.StringType()),
])


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def brute(rows, least):
    good = []
    for _, v, label in rows:
        ok = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        good.append(np.array(v, np.float32).astype(float) if ok else None)
    links, root = [0] * len(rows), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = good[i], good[j]
            if a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2]:
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                    links[i] += 1
                    links[j] += 1
                    x, y = sorted((root[i], root[j]))
                    root = [x if r == y else r for r in root]
    return [(k, n, min(rows[j][0] for j in range(len(rows)) if root[j] == root[i])) for i, ((k, _, _), n) in enumerate(zip(rows, links))]


def family_rows():
    rng = np.random.default_rng(4)
    rows, key = [], 0
    for label in (1, 2):
        for _ in range(120):
            rows.append((key, rng.normal(size=32).astype(np.float32).tolist(), label))
            key += 1
        for size in (2, 5, 40):
            base = rng.normal(size=32)
            for _ in range(size):
                rows.append((key, (base + rng.normal(size=32) * rng.choice([0.05, 0.1])).astype(np.float32).tolist(), label))
                key += 1
    copy = rows[3][1]
    rows += [(1000, copy, 1), (1001, copy, 1), (1002, copy, 2), (1003, None, 1), (1004, [], 1), (1005, [0.0] * 32, 1), (1006, copy, None),
             (1007, [float("nan")] + copy[1:], 1), (1008, [None] + copy[1:], 1), (1009, copy[:16], 1), (1010, copy[:16], 1), (1011, [float("inf")] * 32, 1)]
    return rows


@pytest.mark.parametrize("block", [256, 8])
def test_links_and_components_match_brute_force(spark, block):
    rows = family_rows()
    found = pivot_index.near_duplicates(vectors(spark, rows), 0.98, block=block).collect()
    want = brute(rows, 0.98)
    got = {r.vec_id: (r.n_links, r.component_id) for r in found}
    assert len(found) == len(rows) and all(got[k][0] <= n for k, n, _ in want)
    assert sum(n for n, _ in got.values()) >= 0.95 * sum(n for _, n, _ in want)
    assert np.mean([got[k][1] == c for k, _, c in want]) > 0.99
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_double_vectors_null_ids_and_an_empty_table(spark):
    rows = spark.createDataFrame([(None, [1.0, 2.0], "a"), (4, [1.0, 2.0], "a"), (None, [3.0, 1.0], "b")], "vec_id long, embedding array<double>, label string")
    assert sorted(map(tuple, pivot_index.near_duplicates(rows).collect()), key=repr) == [(4, 1, 4, True), (None, 0, None, True), (None, 1, 4, False)]
    assert pivot_index.near_duplicates(vectors(spark, [])).count() == 0


def test_pairs_meet_in_their_first_shared_list_only():
    near = np.array([[1, 5, 9], [5, 9, 2], [9, 5, 70]], np.int16)
    assert [tuple(map(list, pivot_index.candidates(near, near, p, 128, 3, 2))) for p in (5, 9)][1] == ([], [])
    i, j = pivot_index.candidates(near, near, 5, 128, 3, 2)
    assert {(a, b) for a, b in zip(i, j) if a < b} == {(0, 1), (0, 2), (1, 2)}


def test_few_pivots_lose_no_link(spark):
    rng = np.random.default_rng(7)
    close = [(1, [1.0, 0.0], 1), (2, [0.99, 0.141], 1)]
    middle = rng.normal(size=32)
    cones = {}
    for noise in (0.1, 0.2, 0.35):  # mutual cosines of about 0.99, 0.96 and 0.89
        alone = [middle + noise * rng.normal(size=32) for _ in range(300)]
        copies = [v + 0.03 * rng.normal(size=32) for v in alone[:60] for _ in range(2)]
        cones[noise] = [(i, v.astype(np.float32).tolist(), 1) for i, v in enumerate(alone + copies)]
    for rows in (close, *cones.values()):
        got = sorted((r.vec_id, r.n_links, r.component_id) for r in pivot_index.near_duplicates(vectors(spark, rows), 0.98).collect())
        want = brute(rows, 0.98)
        assert sum(n for _, n, _ in want) > 0 and got == sorted(want)
