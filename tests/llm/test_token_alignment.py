import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from oreflow.llm import token_alignment as ta
from tests.llm.helpers import documents, prose

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pair():
    return ta._worker(ta._files(A, B))


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def encoded(library, pair, text):
    """By the libraries over the whole text, and without tokens where bytes differ."""
    a = library[0].encode(" " + text, add_special_tokens=False).ids if text else []
    b = library[1].encode(text) if text else []
    raw = (" " + text).encode()
    same = b"".join(pair.a_bytes[i] for i in a) == raw and b"".join(pair.b_bytes[i] for i in b) == raw
    return (a, b) if same else ([], [])


def brute(pair, a, b):
    """Links by comparing byte ranges of all tokens, and groups by common ends."""
    def ranges(ids, sizes):
        ends = np.cumsum([sizes[i] for i in ids]).tolist() if ids else []
        return list(zip([0, *ends], ends))

    ra, rb = ranges(a, pair.a_lengths), ranges(b, pair.b_lengths)
    links = [(a[i], b[j]) for i, (s, e) in enumerate(ra) for j, (u, v) in enumerate(rb) if s < v and u < e]
    common = sorted({e for _, e in ra} & {e for _, e in rb})
    groups = []
    for s, e in zip([0, *common], common):
        groups.append(",".join(str(i) for i, r in zip(a, ra) if s < r[1] <= e) + "|" + ",".join(str(i) for i, r in zip(b, rb) if s < r[1] <= e))
    return links, groups


TEXTS = [
    "Hello there, it's 2024!", None, "", " ", "  two  blanks\n\n\tand <s> <0x41> <|endoftext|> ", "été Straße 日本語😀 ｆｕｌｌ", "x▁y",
    "a" * 300, "\x00\x1c \x85 　x", "it's  'll \n of the of the", prose(1, 400), prose(2, 150) + " \n" + prose(3, 90), "Hello there, it's 2024!",
]


def test_encodings_are_those_of_the_libraries(pair, library):
    rng = random.Random(4)
    letters = [*"Aa'sdl1 \t\n!,Σς😀日éß  \u0085\u001c　ﬁ�▁", "<s>", "<|endoftext|>", "'re", " the", " of ", "  "]
    for text in [t for t in TEXTS if t] + ["".join(rng.choices(letters, k=rng.randint(1, 40))) for _ in range(2000)]:
        a, b = pair.encode(text.encode())
        assert (a.tolist(), b.tolist()) == encoded(library, pair, text), text


def test_diagonals_cross_the_path_where_merging_does():
    rng = random.Random(5)
    for _ in range(200):
        a, b = (np.array(sorted(rng.sample(range(60), rng.randint(0, 20))), np.int64) for _ in "ab")
        merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        diagonals = np.arange(len(merged) + 1)
        assert ta.crossings(a, b, diagonals).tolist() == [sum(k == 0 for _, k in merged[:d]) for d in diagonals]


def test_pieces_of_any_size_give_the_same_links_and_groups(pair, library):
    rng = random.Random(6)
    for text in [t for t in TEXTS if t][:9] + ["".join(rng.choices("ab cé日 ", k=80)) for _ in range(30)]:
        a, b = encoded(library, pair, text)
        links, groups = brute(pair, a, b)
        for steps in (1, 2, 3, 7, 1000):
            cut = ta.divided(np.array(a, pair.kind), np.array(b, pair.kind), pair.a_lengths, pair.b_lengths, steps)
            assert all(p.n_a + p.n_b == steps for p in cut[:-1]) and (len(cut) == 1 or len(cut) == -(-(len(a) + len(b)) // steps))
            merged = [ta.Merged(p, pair) for p in cut]
            found = [(int(p.a[i]), int(p.b[j])) for p, m in zip(cut, merged) for i, j in zip(m.link_a, m.link_b)]
            assert sorted(found) == sorted(links) and sum(len(m.last_a) for m in merged) == len(groups)


@pytest.mark.parametrize("steps, hot", [(ta.STEPS, ta.HOT), (50, 3), (7, 1), (1, 20)])
def test_alignment_equals_brute_force(spark, pair, library, steps, hot):
    rows = [*enumerate(TEXTS), (None, "null key"), (3, "same key, other text")]
    sides = [encoded(library, pair, t or "") for _, t in rows]
    found = [brute(pair, *s) for s in sides]
    counts = collections.Counter(x for links, _ in found for x in links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    expected = [
        (key, len(a), len(b), len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for (key, _), (a, b), (links, groups) in zip(rows, sides, found)
    ]
    got = ta.alignment(documents(spark, rows), A, B, steps=steps, hot=hot)
    assert got.columns[:8] == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)


def test_links_and_an_empty_table(spark, pair, library):
    rows = [(1, TEXTS[0]), (2, TEXTS[5]), (2, None)]
    got = collections.Counter((r.key, r.a, r.b) for r in ta.links(documents(spark, rows), A, B, steps=5).collect())
    assert got == collections.Counter((k, *x) for k, t in rows for x in brute(pair, *encoded(library, pair, t or ""))[0])
    assert ta.alignment(documents(spark, []), A, B).count() == 0


def test_a_very_long_text_is_many_pieces(spark, pair, library):
    text = "A long wörd,  and " * 20_000
    a, b = pair.encode(text.encode())
    assert len(ta.divided(a, b, pair.a_lengths, pair.b_lengths, ta.STEPS)) > 8
    row = ta.alignment(documents(spark, [(1, text)]), A, B).first()
    assert (row.n_a, row.n_b) == (len(a), len(b)) and row.n_links == len(a) + len(b) - row.n_groups
    whole = ta.alignment(documents(spark, [(1, text)]), A, B, steps=1 << 30).first()
    assert row == whole
