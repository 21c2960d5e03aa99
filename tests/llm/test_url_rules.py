import re

from oreflow.llm import url_rules
from oreflow.llm.queries import HOST_RULES, HOST_WORDS, url_rule_list


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [r for r in HOST_RULES if (host == r[0].split("/")[0] or host.endswith("." + r[0].split("/")[0])) and path.startswith(r[0][r[0].index("/") :])]
    if fits:
        rule, verdict = max(fits, key=lambda r: len(r[0]))
        return host, path, rule, verdict
    return host, path, None, "block" if set(re.split("[.-]", host)) & set(HOST_WORDS) else "allow"


URLS = [
    None, "", "no scheme/com/", "http://", "https://com", "https://com/", "http://EXAMPLE.com/en/1", "http://www.example.com/en/x?y", "http://wwwexample.com/en/",
    "http://a.www.example.com/en/#f", "http://example.com/en", "http://x.net/es/", "http://x.net/es", "http://net/fr/a", "http://x.net/de/://com/", "http://É.example.net/fr/",
    "ftp://casino-win.example.org/x", "http://mycasino.org/", "http://free.bets.org?com/", "http://a.com#/en/", "http://a.com:80/", "//a.com/", "://example.com/en/",
    "http://a.org/\n/com/", "x\nhttp://b.com/é", "http://a.org/" + "p/" * 5000,
]


def test_verdicts_match_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "h", "k") for i, u in enumerate(URLS)] + [(0, None, "h", "k"), (None, URLS[6], "h", "k")], "page_id long, url string, host string, candidates string")
    found = url_rules.judge(pages, url_rule_list()).collect()
    assert len(found) == len(URLS) + 2
    for r in found:
        url = URLS[6] if r.page_id is None else URLS[r.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == brute(url), url


def test_rules_stand_under_their_rarest_token_and_only_candidates_run(spark):
    pages = spark.createDataFrame([(i, f"http://a{i}.example.com/en/x") for i in range(20)] + [(99, "http://rare.com/en/x")], "page_id long, url string")
    rules = [url_rules.host_path_rule("example.com/en/", "block"), url_rules.host_path_rule("rare.com/en/", "block")]
    counts = url_rules.token_counts(pages, rules)
    assert counts == {"h:example": 20, "h:com": 21, "p:en": 21, "h:rare": 1}
    assert set(url_rules.index_rules(rules, counts)) == {"h:example", "h:rare"}
    assert {r.n_candidates for r in url_rules.judge(pages, rules).collect()} == {1}


def test_rules_without_tokens_no_rules_and_an_empty_table(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    anywhere = url_rules.Rule("any", "block", r"(?s)\A", r"x", (), 3)
    assert [r.rule for r in url_rules.judge(pages, [anywhere]).collect()] == ["any"]
    assert [r.verdict for r in url_rules.judge(pages, []).collect()] == ["allow"]
    assert url_rules.judge(pages.limit(0), url_rule_list()).count() == 0


def test_no_python_runs(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    plan = url_rules.judge(pages, url_rule_list())._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan) and "Exchange" not in plan
