import collections
import hashlib
import random

import numpy as np
import pytest

from oreflow.llm import suffix_dedup
from tests.llm.helpers import documents, edited, prose


def brute(texts, length):
    counts = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    found = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        found.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return found


def rows():
    passage, rng = prose(5, 90, 10**5), random.Random(1)
    found = [(0, None), (1, ""), (2, "é" * 150), (3, "é" * 150), (4, "short"), (5, "ab" * 400), (6, "-" * 1000), (7, prose(7, 300, 10**5)),
             (8, prose(7, 300, 10**5)), (None, prose(8, 100, 10**5)), (None, prose(8, 100, 10**5)), (9, prose(9, 80, 10**5)), (9, prose(10, 80, 10**5))]
    found += [(20 + k, prose(50 + k, rng.randint(5, 60), 10**5) + " " + passage + " " + prose(90 + k, rng.randint(5, 60), 10**5)) for k in range(12)]
    return found + [(60 + k, edited(prose(200, 250, 10**5), k, 3)) for k in range(12)]


@pytest.mark.parametrize("most_variants", [4096, 2])
def test_removed_bytes_match_brute_force(spark, most_variants):
    data = rows()
    found = suffix_dedup.remove_repeats(documents(spark, data), 200, most_variants=most_variants).collect()
    want = [(key, *x) for (key, _), x in zip(data, brute([(t or "").encode() for _, t in data], 200))]
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)


def test_kept_bytes_and_an_empty_table(spark):
    text = prose(1, 100, 10**5)
    found = suffix_dedup.remove_repeats(documents(spark, [(1, text), (2, text), (3, "own words")]), with_kept=True)
    assert {r.doc_id: bytes(r.kept) for r in found.collect()} == {1: b"", 2: b"", 3: b"own words"}
    assert suffix_dedup.remove_repeats(documents(spark, [])).count() == 0


def test_two_stage_sorting_orders_suffixes():
    rng = random.Random(2)
    for alphabet in (b"ab", b"a", b"abcd ", bytes(range(256))):
        for _ in range(10):
            parts = [bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 150))) for _ in range(5)]
            joined = b"\0".join(parts) + b"\0"
            ends, at = np.zeros(len(joined), np.int64), 0
            codes = np.frombuffer(joined, np.uint8).astype(np.uint16) + 1
            for p in parts:
                ends[at : at + len(p) + 1] = at + len(p)
                codes[at + len(p)] = 0
                at += len(p) + 1
            places = np.flatnonzero(codes)
            order = suffix_dedup.two_stage(codes, places, ends, 200, joined.decode("latin-1"))
            suffixes = [joined[i : ends[i]] for i in order]
            assert sorted(order) == sorted(places) and suffixes == sorted(suffixes)


def test_windows_of_all_blocks_are_covered(monkeypatch):
    text = prose(3, 3000, 50).encode()
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1000)
    _, start, count = suffix_dedup.fragments(text, 200)
    assert count.sum() == len(text) - 199 and (start == np.cumsum(count) - count).all()
