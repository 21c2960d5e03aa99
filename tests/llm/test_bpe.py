import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from oreflow.llm import bpe
from tests.llm.helpers import documents

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as file:
        return bpe.Ranks(file.read())


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.rank, special_tokens={})


def test_pieces_are_encoded_as_by_merging(ranks, reference):
    rng, tokens = random.Random(1), list(ranks.rank)
    for k in range(800):
        text = b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 6))).decode("utf8", "replace")
        if k % 3 == 0:
            text = "".join(rng.choice(" aab\n\t1'sé日!") for _ in range(rng.randint(1, 60)))
        assert bpe.EncodedText(ranks, public_tokenizers.PATTERN, text).ids() == reference.encode_ordinary(text)


def test_a_very_long_piece(ranks, reference):
    for text in ("ab" * 3000, " " * 4000, "é" * 2000):
        assert bpe.EncodedText(ranks, public_tokenizers.PATTERN, text).ids() == reference.encode_ordinary(text)


def test_appends_and_edits_are_exact(ranks):
    rng = random.Random(2)
    for _ in range(60):
        data = bytes(rng.choice(b"abcde the") for _ in range(rng.randint(0, 120)))
        table, fed = bpe.PrefixTable(ranks, data), bpe.PrefixTable(ranks)
        for i in range(0, len(data), 7):
            fed.append(data[i : i + 7])
        assert fed.last == table.last
        start = rng.randint(0, len(data))
        end, new = rng.randint(start, len(data)), bytes(rng.choice(b"ing he") for _ in range(rng.randint(0, 9)))
        table.edit(start, end, new)
        again = bpe.PrefixTable(ranks, data[:start] + new + data[end:])
        assert table.data == again.data and table.last == again.last and ranks.decode(table.ids()) == again.data


def test_a_text_is_encoded_anew_only_near_an_edit(ranks, reference):
    rng, text = random.Random(3), " ".join(f"word{i} it's  " for i in range(200))
    for _ in range(60):
        encoded = bpe.EncodedText(ranks, public_tokenizers.PATTERN, text)
        start = rng.randint(0, len(text))
        end, new = min(len(text), start + rng.randint(0, 5)), rng.choice(["", " ", "x", "'s a\n", "  "])
        fresh = encoded.edit(start, end, new)
        assert encoded.ids() == reference.encode_ordinary(text[:start] + new + text[end:]) and fresh < 20
    encoded.append(" the end")
    assert encoded.ids() == reference.encode_ordinary(encoded.text)


def test_slices_do_not_change_the_pieces(ranks, reference, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 40)
    text = "It's a day,  with 12 words\n\n and more 'll. " * 20
    assert list(bpe._slices(text)) != [text] and "".join(bpe._slices(text)) == text
    assert [i for s in bpe._slices(text) for i in reference.encode_ordinary(s)] == reference.encode_ordinary(text)


def test_digests_and_round_trip(spark, reference):
    rows = [(1, "Hello there, it's 2024!"), (2, None), (3, ""), (None, "été <|endoftext|>"), (3, ""), (5, "long wörd " * 30_000)]
    docs = documents(spark, rows)
    found = bpe.digests(docs, PATH, public_tokenizers.PATTERN).collect()
    expected = []
    for key, text in rows:
        ids = reference.encode_ordinary(text or "")
        expected.append((key, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    back = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH)
    assert {(r.doc_id, (r.text or "").encode()) for r in back.collect()} == {(r.doc_id, bytes(r.decoded)) for r in back.collect()}
    assert bpe.digests(documents(spark, []), PATH, public_tokenizers.PATTERN).count() == 0
