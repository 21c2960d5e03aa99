import hashlib
import re

import pytest

from oreflow.llm import exact_dedup
from tests.llm.helpers import documents, prose

ROWS = [
    (5, "a  b\tc"), (3, "a b c"), (9, " a b c"), (8, "\n a b c"), (1, None), (2, ""), (None, ""), (4, "  "), (6, "\x0b"), (7, "a\xa0b"),
    (20, prose(1, 9000)), (21, prose(1, 9000).replace(" ", "\n", 50)), (22, prose(1, 9000) + "."), (23, "x" * 100_000), (24, "x" * 100_000),
    (25, "x" * 100_001), (3, "a b c"), (None, "only here"), (None, "only here"),
]


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    found = []
    for (key, _), t in zip(rows, norm):
        ids = [k for (k, _), u in zip(rows, norm) if u == t]
        found.append((key, min((k for k in ids if k is not None), default=None), len(ids), hashlib.sha256(t.encode()).hexdigest()))
    return found


@pytest.mark.parametrize("bits", [64, 2])
def test_groups_match_brute_force_even_if_chunk_hashes_collide(spark, bits):
    found = exact_dedup.exact_duplicates(documents(spark, ROWS), hash_bits=bits).collect()
    want = brute(ROWS)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=repr) == sorted(want, key=repr)
    assert sum(r.kept for r in found) == len({x[3] for x in want})
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_chunks_join_to_the_text_and_follow_its_content():
    text = prose(3, 30_000).encode()
    parts = list(exact_dedup.chunks(text))
    assert b"".join(parts) == text and max(map(len, parts)) <= exact_dedup.MOST
    moved = list(exact_dedup.chunks(b"some words before " + text))
    assert len(set(parts) & set(moved)) > len(parts) * 0.8


def test_blocks_do_not_move_cuts(monkeypatch):
    text = prose(4, 20_000).encode()
    whole = exact_dedup.cut_points(text)
    monkeypatch.setattr(exact_dedup, "BLOCK", 5000)
    assert exact_dedup.cut_points(text) == whole


def test_an_empty_table(spark):
    assert exact_dedup.exact_duplicates(documents(spark, [])).count() == 0
