import re

from driftwell.llm import queries
from driftwell.llm.url_rules import UrlRule, host_rule, judge_urls, wildcard_rule

URLS = [
    None, "", "no scheme", "http://", "https://example.org", "https://EXAMPLE.org/es/x?y#z", "http://a.b.example.org/en/12",
    "http://example.org/en/2", "http://notexample.org/es/", "http://x.com/fr/1", "http://x.com/de/1#/casino/",
    "ftp://x.net/casino/y", "http://x.net/a/casino/", "http://x.net/casinos/", "http://x.net/setup.exe", "http://x.net/setup.exe?x",
    "http://com/fr/", "http://x.net//a", "mailto:a://org/es/", "http://x.org/é\n/ü", "http://x.org", "http://x.COM/fr/?/de/",
    "http://x.net/TAG/1/page/2/", "http://x.net/tag/1/page/2/", "http://x.org/es/" + "tag/" * 50_000 + "page/",
    "http://" + "a." * 20_000 + "example.org/en/1",
]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    best = None
    for name, action in queries.HOST_RULES:
        h, p = name.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (not best or len(name) > len(best[0])):
            best = name, action
    if best:
        return host, path, *best
    for name, action in queries.PATTERN_RULES:
        if re.fullmatch(".*".join(map(re.escape, name.split("*"))), host + path, re.S):
            return host, path, None, action
    return host, path, None, "allow"


def test_judges_like_brute_force(spark):
    rows = [(i, u, "x", "y", i, "b", "w", "t") for i, u in enumerate(URLS)]
    rows += [(None, URLS[5], *[None] * 6), rows[3], rows[3]]
    kinds = "page_id long, url string, rule string, Host string, best long, _spot string, _won string, token string"
    pages = spark.createDataFrame(rows, kinds).repartition(3)
    got = judge_urls(pages, queries.url_rule_list()).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(r["url"]), r["url"]
    assert judge_urls(pages.limit(0), queries.url_rule_list()).collect() == []
    assert {r["verdict"] for r in judge_urls(pages, []).collect()} == {"allow"}


def test_tokens_that_a_rule_implies():
    assert host_rule("example.org/en/1", "block").tokens == ("example", "org", "en")
    assert wildcard_rule("*/tag/*/page/*", "block").tokens == ("tag", "page")
    assert wildcard_rule("*free-download.*", "block").tokens == ("download",)
    assert wildcard_rule("*abc*", "block").tokens == ()


def test_rule_without_tokens_runs_on_every_url(spark):
    pages = spark.createDataFrame([(1, "http://x.y/zabcq"), (2, "http://x.y/q")], "page_id long, url string")
    rules = [wildcard_rule("*abc*", "block"), UrlRule("digits", "block", r"\d{3}", ())]
    got = {r["page_id"]: (r["verdict"], r["pattern"]) for r in judge_urls(pages, rules).collect()}
    assert got == {1: ("block", "*abc*"), 2: ("allow", None)}


