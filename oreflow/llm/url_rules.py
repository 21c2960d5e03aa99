"""URL filters: pattern rules indexed by their rarest literal token; only fetched rules run their expressions.

A rule has a regular expression over the host, one over the path, and the literal tokens that any matching URL must
contain. The index keeps each rule under the one of its tokens that the fewest URLs contain. A URL's own tokens fetch
candidates from it, the candidates' expressions run, and the longest rule that matches decides. Everything is one
narrow pass of built-in functions; the only aggregation counts the rules' own tokens.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The rule index is part of the plan; larger rule sets are refused instead of growing it without bound.
MOST_RULES = 20_000


@dataclass(frozen=True)
class Rule:
    """One pattern rule. `weight` decides between matches (the longer text wins), `final` outranks all that are not."""

    name: str
    verdict: str
    host: str
    path: str
    tokens: tuple[str, ...]
    weight: int
    final: bool = True


def host_path_rule(text: str, verdict: str) -> Rule:
    """`host/path` as a pattern: the host itself or any subdomain, and paths that start with the rule's path."""
    host, slash, rest = text.partition("/")
    path = slash + rest
    labels = tuple(x for x in host.split(".") if x)
    # The last part of a prefix may go on in the URL, so only parts closed by a slash are certain tokens.
    parts = tuple(x for x in path.split("/")[1:-1] if x)
    return Rule(
        text, verdict, r"(?s)\A(?:.*\.)?" + re.escape(host) + r"\z", r"(?s)\A" + re.escape(path),
        tuple(f"h:{x}" for x in labels) + tuple(f"p:{x}" for x in parts), len(text),
    )


def host_word_rule(word: str, verdict: str = "block") -> Rule:
    """Hosts that have `word` as one of the parts between dots and dashes."""
    return Rule(f"*{word}*", verdict, r"(?s)\A(?:.*[.-])?" + re.escape(word) + r"(?:[.-].*)?\z", r"(?s)\A", (f"w:{word}",), len(word), False)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for URLs without ``://``."""
    rest = F.regexp_extract(url, r"(?s)\A.*?://(.*)\z", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def url_tokens(host: Column, path: Column) -> Column:
    """Labels of the host, words of the host between dots and dashes, and parts of the path, each with its kind."""
    def tagged(kind: str, values: Column) -> Column:
        return F.transform(values, lambda x: F.concat(F.lit(kind), x))
    return F.array_distinct(F.concat(
        tagged("h:", F.split(host, r"\.")), tagged("w:", F.split(host, "[.-]")), tagged("p:", F.split(path, "/")),
    ))


def token_counts(pages: DataFrame, rules: list[Rule], url: str = "url") -> dict[str, int]:
    """In how many URLs each token of a rule stands. Counts every row; the result has one number per rule token."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    host, path = split_url(F.col(url))
    seen = pages.select(url_tokens(host, path).alias("t")).select(
        F.explode(F.array_intersect("t", F.array(*map(F.lit, wanted)))).alias("t")
    )
    counts = {t: 0 for t in wanted}
    counts.update({r["t"]: r["n"] for r in seen.groupBy("t").agg(F.count("*").alias("n")).collect()})
    return counts


def index_rules(rules: list[Rule], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Each rule under its rarest token; rules without a token under "" (they are candidates for every URL)."""
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        token = min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default="")
        index.setdefault(token, []).append(rule)
    return index


def _rule_column(rule: Rule) -> Column:
    return F.struct(
        F.lit(rule.final).alias("final"), F.lit(rule.weight).alias("weight"), F.lit(rule.name).alias("name"),
        F.lit(rule.verdict).alias("verdict"), F.lit(rule.host).alias("host"), F.lit(rule.path).alias("path"),
    )


def judge(pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """Per row: key, host, path, rule, verdict, matched (the pattern that decided, if any) and n_candidates.

    `rule` is the final rule that decides, else null; then the longest other pattern that matches gives the verdict,
    else `default`. Null URLs and those without ``://`` have empty host and path. Repeated rows give repeated rows,
    an empty table an empty one; other columns of `pages` are not read, so their names cannot clash. Rules are a
    driver-side list of at most MOST_RULES.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MOST_RULES} fit into a plan")
    index = index_rules(rules, token_counts(pages, rules, url))
    host, path = split_url(F.col(url))
    parts = pages.select(F.col(key).alias("k"), host.alias("host"), path.alias("path"))
    kind = "array<struct<final:boolean,weight:int,name:string,verdict:string,host:string,path:string>>"
    none = F.array().cast(kind)
    always = F.array(*map(_rule_column, index.pop("", []))).cast(kind)
    fetched = none
    if index:
        lookup = F.create_map(*(x for t, rs in sorted(index.items()) for x in (F.lit(t), F.array(*map(_rule_column, rs)).cast(kind))))
        keys = F.array(*map(F.lit, sorted(index)))
        known = F.array_intersect(url_tokens(F.col("host"), F.col("path")), keys)
        fetched = F.flatten(F.transform(known, lambda t: F.coalesce(F.element_at(lookup, t), none)))
    found = parts.withColumn("candidates", F.concat(always, fetched))
    matches = F.filter("candidates", lambda r: F.regexp_like(F.col("host"), r["host"]) & F.regexp_like(F.col("path"), r["path"]))
    best = found.withColumn("best", F.array_max(matches))
    return best.select(
        F.col("k").alias(key), "host", "path", F.when(F.col("best.final"), F.col("best.name")).alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"), F.col("best.name").alias("matched"),
        F.size("candidates").alias("n_candidates"),
    )
