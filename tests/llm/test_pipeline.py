
import corpus_pipeline
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from oreflow.llm.common import stored
from tests.llm.helpers import prose
from tests.llm.test_bpe import PATH
from tests.llm.test_ngram_join import brute as brute_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def sf_dir(tmp_path_factory):
    place = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, prose(i, 80, 500), "en") for i in range(240)]
    rows += [(300 + i, prose(i, 80, 500), "en") for i in range(10)]  # copies
    rows += [(400 + i, prose(20 + i, 80, 500).replace(" w", " w1", 1), "en") for i in range(10)]  # near copies
    rows += [(500 + i, "".join(chr(33 + (i * 7 + j * j) % 90) for j in range(300)), "en") for i in range(10)]  # junk
    rows += [(600 + i, prose(600 + i, 70, 500) + " w300 w311 w322 w333 w344", "en") for i in range(40)]
    rows += [(700, None, "en"), (701, "", None), (1, prose(1, 80, 500), "en")]
    pq.write_table(pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "lang": [r[2] for r in rows], "source": ["s"] * len(rows),
                             "n_chars": pa.array([len(r[1] or "") for r in rows], pa.int64())}), f"{place}/documents.parquet")
    quality = {i: (1, 0) for i in range(0, 240, 2)} | {500 + i: (0, 0) for i in range(5)} | {600 + i: (1, 1) for i in range(20)}
    pq.write_table(pa.table({"doc_id": list(quality), "quality": pa.array([q for q, _ in quality.values()], pa.int32()),
                             "toxic": pa.array([t for _, t in quality.values()], pa.int32())}), f"{place}/labels.parquet")
    return place


def test_every_stage_does_its_part(spark, sf_dir):
    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stored(stage(spark, docs, sf_dir), name)
        seen[name] = before, docs.collect()
        if name != "tokens":
            assert docs.columns == COLUMNS and {tuple(r) for r in seen[name][1]} <= {tuple(r) for r in before}
    ids = {name: [r.doc_id for r in after] for name, (_, after) in seen.items()}
    assert not any(500 <= i < 510 for i in ids["quality"]) and sum(i < 240 for i in ids["quality"]) >= 236
    before, after = seen["exact"]
    first = {}
    for r in before:
        text = " ".join((r.text or "").split())
        first[text] = min(first.get(text, 10**9), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(first.values())
    before, after = seen["near"]
    components = brute_components([(r.doc_id, r.text) for r in before], corpus_pipeline.SHINGLE, corpus_pipeline.SIMILAR)
    assert sorted(r.doc_id for r in after) == sorted(k for k, _, c in components if k == c) and len(after) < len(before)
    before, after = seen["mix"]
    good = [r.doc_id for r in before if r.doc_id < 600]
    bad = [r.doc_id for r in before if r.doc_id >= 600]
    assert len(set(good) & set(ids["mix"])) >= 0.97 * len(good) and len(set(bad) & set(ids["mix"])) < 0.7 * len(bad)
    import tiktoken
    from oreflow.llm import bpe
    with open(PATH, "rb") as file:
        ranks = bpe.Ranks(file.read())
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.rank, special_tokens={})
    assert {r.doc_id: r.n_tokens for r in seen["tokens"][1]} == {r.doc_id: len(encoding.encode_ordinary(r.text or "")) for r in after}
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()) == sorted(ids["tokens"])


def test_the_quality_stage_learns_from_all_trusted_documents(spark, tmp_path, monkeypatch):
    """More than the 20,000 that were drawn before."""
    from oreflow.llm import quality_lm
    docs = spark.range(21_000).selectExpr("id as doc_id", "concat('t', id) as text", "'en' as lang")
    docs.selectExpr("doc_id", "1 as quality", "0 as toxic").write.parquet(f"{tmp_path}/labels.parquet")
    trained, real = [], quality_lm.train
    monkeypatch.setattr(quality_lm, "train", lambda texts: (trained.append(texts.count()), real(texts))[1])
    assert corpus_pipeline.quality(spark, docs, str(tmp_path)).columns == docs.columns
    assert trained == [docs.where(f"pmod(hash(doc_id), {quality_lm.HELD}) <> 0").count()]


def test_the_mix_stage_learns_from_all_labelled_documents(spark, tmp_path, monkeypatch):
    """More than the 4,000 of a domain that were drawn before."""
    from oreflow.llm import mixing
    docs = spark.range(9_000).selectExpr("id as doc_id", "concat('t', id % 50, if(id % 9 = 0, ' buy', ' stone')) as text")
    docs.selectExpr("doc_id", "if(doc_id % 9 = 0, 0, 1) as quality", "0 as toxic").where("doc_id % 3 < 2").write.parquet(f"{tmp_path}/labels.parquet")
    learnt, real = [], mixing.fit
    monkeypatch.setattr(mixing, "fit", lambda rows, *rest: (learnt.append(len(rows) if isinstance(rows, list) else rows.count()), real(rows, *rest))[1])
    assert corpus_pipeline.mix(spark, docs, str(tmp_path)).columns == docs.columns
    assert learnt == [6_000]
