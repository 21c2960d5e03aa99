"""The operators over the test tables, one query each, and the same as DuckDB SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm import (
    boundary_bpe, bpe, exact_dedup, fixity, hmm_lm, mixing, ngram_join, phrases, pivot_index, quality_lm, suffix_dedup,
    token_alignment, url_rules,
)
from oreflow.llm.common import table

RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_BPE, BYTE_BPE, PIECE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"

#: Rules of the URL query, fixed by its contract.
HOST_RULES = [
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"),
]
#: Host words that block a page no rule of the contract covers.
HOST_WORDS = ("adult", "ads", "bets", "casino", "pills", "porn", "spam", "xxx")


def url_rule_list() -> list[url_rules.Rule]:
    return [url_rules.host_path_rule(*r) for r in HOST_RULES] + [url_rules.host_word_rule(w) for w in HOST_WORDS]


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of all documents, encoded and decoded again."""
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of each document's set of 3-word shingles, its links of Jaccard 0.9 or more, and its component by them."""
    return ngram_join.ngram_links(table(spark, sf_dir, "documents"), 3, 90)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents have equal texts, and which of them stay."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop("n_chunks")


EXACT_SQL = """
WITH d AS (
  SELECT doc_id, row_number() OVER () AS i, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t ORDER BY doc_id NULLS LAST, i)
"""


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under the model of trusted text, and whether its language's threshold keeps it."""
    return quality_lm.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and staying row of every vector, at a cosine of 0.98 or more within its label."""
    return pivot_index.near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


def op6_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of the archived pages against a replica with damage.

    The replica is derived: by the first byte of the url's digest, records have a byte changed (00), are lost (01), are
    longer (02), or are as they were.
    """
    pages = fixity.archived(table(spark, sf_dir, "pages"))
    kind = F.substring(F.md5(F.coalesce("url", F.lit(""))), 1, 2)
    html = F.coalesce("payload", F.lit(""))
    spoilt = F.when(kind == "00", F.concat(F.lit("#"), F.substring(html, 2, 1 << 30))).when(kind == "02", F.concat(html, F.lit("!"))).otherwise(html)
    damaged = fixity.warc_record(F.col("record_id"), F.col("url"), spoilt)
    rows = pages.select(
        "key", "record_id", (kind == "01").alias("lost"), F.struct(*fixity.fingerprint(F.col("record"))).alias("a"),
        F.struct(*fixity.fingerprint(damaged)).alias("b"))
    rows = fixity.numbered(rows, ["key", "record_id"]).withColumn("segment", F.expr(f"at div {fixity.SEGMENT}"))
    a = rows.select("segment", "at", "record_id", "a.*")
    b = rows.filter("not lost").select("segment", "at", "record_id", "b.*")
    return fixity.audit(a, b)


FIXITY_SQL = f"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, substr(md5(coalesce(url, '')), 1, 2) AS kind,
         md5(coalesce(page_id::varchar, 'null') || ' ' || coalesce(url, 'null')) AS record_id
  FROM pages
), q AS (
  SELECT *, CASE kind WHEN '00' THEN '#' || substr(html, 2) WHEN '02' THEN html || '!' ELSE html END AS spoilt,
         row_number() OVER (ORDER BY page_id NULLS FIRST, record_id) - 1 AS place
  FROM p
), r AS (
  SELECT *, place // {fixity.SEGMENT} AS segment, chr(13) || chr(10) AS nl,
         'WARC/1.1' || nl || 'WARC-Type: resource' || nl || 'WARC-Record-ID: <urn:md5:' || record_id || '>' || nl
         || 'WARC-Target-URI: ' || url || nl || 'Content-Type: text/html' || nl || 'Content-Length: ' AS head
  FROM q
), s AS (
  SELECT *, head || strlen(html) || nl || nl || html || nl || nl AS a, head || strlen(spoilt) || nl || nl || spoilt || nl || nl AS b
  FROM r
), t AS (
  SELECT segment, record_id, kind, strlen(a) AS length, sha256(a) AS digest, sha256(b) AS other,
         sum(strlen(a)) OVER w - strlen(a) AS start,
         sum(CASE WHEN kind = '01' THEN 0 ELSE strlen(b) END) OVER w - CASE WHEN kind = '01' THEN 0 ELSE strlen(b) END AS there,
         row_number() OVER (PARTITION BY segment, record_id ORDER BY place) AS copy
  FROM s WINDOW w AS (PARTITION BY segment ORDER BY place)
)
SELECT segment, record_id, copy, start::bigint AS start, length, digest,
       CASE WHEN kind = '01' THEN 'missing' WHEN digest <> other THEN 'altered' WHEN start <> there THEN 'moved' ELSE 'intact' END AS status
FROM t
"""


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the strings of 200 bytes that stand anywhere else too."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), 200)


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page."""
    judged = url_rules.judge(table(spark, sf_dir, "pages"), url_rule_list())
    return judged.select("page_id", "host", "path", "rule", "verdict", "matched")


#: Shares of all tokens that the mix aims at.
MIX = {"good": 0.94, "low": 0.05, "toxic": 0.01}


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors of every document and the rate at which the mix takes it."""
    return mixing.soft_mix(table(spark, sf_dir, "documents"), mixing.label_domains(table(spark, sf_dir, "labels")), MIX)


def op10_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Likelihood of every document under a hidden Markov model of the training part, and under single words."""
    return hmm_lm.hmm_scores(table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of two to four words of each language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


PHRASES_SQL = f"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{url_rules.UPPER}', '{url_rules.LOWER}') AS t FROM documents
), p AS (
  SELECT lang, unnest(string_split_regex(t, '[.,;:!?
-]')) AS piece FROM d
), w AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ 	]+'), lambda x: x <> '') AS w FROM p
), g AS (
  SELECT lang, w[s : s + k - 1] AS g, k, count(*) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS s FROM w), (SELECT unnest([1, 2, 3, 4]) AS k)
  WHERE s + k - 1 <= len(w) GROUP BY ALL
), total AS (
  SELECT lang, sum(f) AS n FROM g WHERE k = 1 GROUP BY lang
), c AS (
  SELECT * FROM g WHERE k > 1 AND f >= 30
), held AS (
  SELECT lang, q[s : s + m - 1] AS g, max(f) AS f
  FROM (SELECT lang, g AS q, k, f, unnest(range(1, k + 1)) AS s FROM c), (SELECT unnest([2, 3]) AS m)
  WHERE m < k AND s + m - 1 <= k GROUP BY ALL
), kept AS (
  SELECT c.* FROM c LEFT JOIN held USING (lang, g) WHERE held.f IS NULL OR 100 * held.f::hugeint < 80 * c.f::hugeint
), cuts AS (
  SELECT x.lang, x.g, x.f AS a, m, a.f AS l, b.f AS r, (2000000 * x.f::hugeint) // (a.f + b.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS m FROM kept) AS x
  JOIN g AS a ON a.lang = x.lang AND a.g = x.g[1 : m] JOIN g AS b ON b.lang = x.lang AND b.g = x.g[m + 1 : x.k]
), scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, m) = 1
)
SELECT lang, row_number() OVER w AS rank, array_to_string(g, ' ') AS phrase, a, l, r, n::bigint AS n, score::bigint AS score
FROM scored JOIN total USING (lang)
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) QUALIFY rank <= 2000
"""


def op12_boundary_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of all documents under a vocabulary of lower-cased words, encoded and decoded again."""
    return boundary_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two vocabularies overlap in every document, and how often their pairs are linked in all."""
    return token_alignment.alignment(
        table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))


def _url_sql() -> str:
    rules = " UNION ALL ".join(f"SELECT '{r}' AS r, '{v}' AS v" for r, v in HOST_RULES)
    words = " UNION ALL ".join(f"SELECT '{w}' AS w" for w in HOST_WORDS)
    return f"""
WITH p AS (
  SELECT page_id, row_number() OVER () AS i, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), q AS (
  SELECT page_id, i, translate(regexp_extract(rest, '^[^/?#]*'), '{url_rules.UPPER}', '{url_rules.LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p
), rules AS ({rules}), words AS ({words}), fit AS (
  SELECT i, arg_max(r, length(r)) AS r, arg_max(v, length(r)) AS v
  FROM q JOIN rules ON (host = split_part(r, '/', 1) OR ends_with(host, '.' || split_part(r, '/', 1)))
   AND starts_with(path, substr(r, instr(r, '/')))
  GROUP BY i
), bad AS (
  SELECT i, arg_max(w, (length(w), w)) AS w FROM q JOIN words ON list_contains(string_split(replace(host, '-', '.'), '.'), w) GROUP BY i
)
SELECT page_id, host, path, r AS rule, coalesce(v, CASE WHEN w IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       coalesce(r, '*' || w || '*') AS matched
FROM q LEFT JOIN fit USING (i) LEFT JOIN bad USING (i)
"""


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_ngram_join": op2_ngram_join,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_quality": op4_quality,
    "op5_pivot_index": op5_pivot_index,
    "op6_fixity": op6_fixity,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_url_filters": op8_url_filters,
    "op9_mixing": op9_mixing,
    "op10_hmm": op10_hmm,
    "op11_phrases": op11_phrases,
    "op12_boundary_bpe": op12_boundary_bpe,
    "op13_token_alignment": op13_token_alignment,
}
ORACLE = {"op3_exact_dedup": EXACT_SQL, "op6_fixity": FIXITY_SQL, "op8_url_filters": _url_sql(), "op11_phrases": PHRASES_SQL}
