import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from oreflow.llm import boundary_bpe
from tests.llm.helpers import documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def bpe():
    return boundary_bpe._worker(boundary_bpe._file(PATH))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def reference(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_cuts_stand_where_no_token_has_the_pair(bpe):
    word = "straßenbahn😀xqzj12".encode()
    fragments = bpe.fragments(word)
    assert b"".join(f for f, _ in fragments) == word and len(fragments) > 2 and [e for _, e in fragments[:-1]] == [False] * (len(fragments) - 1)
    for (left, _), (right, ends) in zip(fragments, fragments[1:]):
        pair = left[-1:] + right[:1]
        assert pair not in (bpe.last_pairs if ends and len(right) == 1 else bpe.pairs)


def test_every_cut_is_certain(bpe):
    """Encoding the whole word in one piece gives the same as encoding its fragments."""
    rng, pieces = random.Random(1), [t.encode() for t in ("ing", "sch", "qx", "zj", "é", "日", "😀", "th", "e", "1", "!!", "ß")]
    for _ in range(500):
        word = b"".join(rng.choice(pieces) for _ in range(rng.randint(1, 8)))
        assert tuple(bpe.word(word)) == bpe.merged(word, True)


def test_texts_are_encoded_and_decoded_as_by_the_library(bpe, library):
    rng = random.Random(2)
    letters = [*"Aa'sdl1 \t\n!,Σσς😀日éßỊ̇́  \u0085\u001c\u001f각ﬁÅ�\U000105d2\U00010d50", "<|endoftext|>", "<|STARTOFTEXT|>", "'re", "the "]
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 30)))
        ids = reference(library, text)
        assert bpe.encode(text.encode()) == ids, text
        assert bpe.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_a_very_long_run_and_slices(bpe, library, monkeypatch):
    assert bpe.encode(b"ab" * 20_000) == reference(library, "ab" * 20_000)
    monkeypatch.setattr(boundary_bpe, "SLICE", 40)
    text = ("It's a day,  with 12 ẃörds\n\n and more 'll " + "x" * 90 + " ") * 20
    parts = list(boundary_bpe.slices(text.encode()))
    assert len(parts) > 10 and b"".join(parts) == text.encode() and bpe.encode(text.encode()) == reference(library, text)


def test_memory_is_emptied_when_full(library, monkeypatch):
    monkeypatch.setattr(boundary_bpe, "MEMORY", 3)
    small = boundary_bpe.BoundaryBpe(boundary_bpe._file(PATH))
    text = "one two three four five six seven eight one two"
    assert [i for r in text.encode().split() for i in map(int, small.spelled(r)[1].split())] == reference(library, text)
    assert len(small._runs) <= 3


def test_digests_and_round_trip(spark, library):
    rows = [(1, "Hello there, it's 2024! <|startoftext|>"), (2, None), (3, ""), (None, "Été   ÉTÉ"), (3, ""), (4, " \n\t"), (5, "long Wörd " * 30_000)]
    docs = documents(spark, rows)
    expected = []
    for key, text in rows:
        ids = reference(library, text or "")
        spelled, decoded = " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)
        expected.append((key, len(ids), hashlib.sha256(spelled.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, boundary_bpe.digests(docs, PATH).collect()), key=repr) == sorted(expected, key=repr)
    back = boundary_bpe.decode(boundary_bpe.encode(docs, PATH), PATH)
    assert set(docs.columns) < set(back.columns)
    for r in back.collect():
        assert r.ids == reference(library, r.text or "") and r.decoded == library.decode(r.ids, skip_special_tokens=False)
    assert boundary_bpe.decode(docs.selectExpr("cast(null as array<int>) as ids", "key"), PATH).filter("decoded is null").count() == len(rows)
    assert boundary_bpe.digests(documents(spark, []), PATH).count() == 0


def test_other_kinds_of_vocabularies_are_refused():
    with pytest.raises(ValueError):
        boundary_bpe.BoundaryBpe(boundary_bpe._file(public_tokenizers.path("byte_bpe_50k.json")))
