"""URL filters: pattern rules indexed by their rarest literal token.

Every rule has tokens that any URL it fits must contain whole. The rule is filed under
the one of them that the corpus has least often. A URL's tokens fetch the rules filed
under them, and only those run their regular expression. Rules without such a token are
filed under the empty token, which every URL has.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.llm.text import ascii_lower, literal_rows, unused

#: The index is broadcast up to this number of rules (a rule is one short row); beyond, it is shuffled.
BROADCAST_RULES = 20_000


@dataclass(frozen=True)
class UrlRule:
    """``regex`` is searched in host + path; ``tokens`` are the whole tokens it implies.

    Of the rules that fit, a higher ``tier`` wins, then the longer ``name``.
    """

    name: str
    action: str
    regex: str
    tokens: tuple[str, ...]
    tier: int = 0


def _whole_tokens(text: str, left_open: bool, right_open: bool) -> tuple[str, ...]:
    """Tokens of literal text; one that touches an open end may go on in the URL."""
    out = []
    for m in re.finditer("[A-Za-z0-9]+", text):
        if not (left_open and m.start() == 0) and not (right_open and m.end() == len(text)):
            out.append(m.group())
    return tuple(dict.fromkeys(out))


def host_rule(name: str, action: str) -> UrlRule:
    """``host/path``: fits that host and its subdomains where the path starts so."""
    host, slash, path = name.partition("/")
    regex = r"\A(?:[^/]*\.)?" + re.escape(host) + (re.escape(slash + path) if slash else r"(?:/|\z)")
    tokens = _whole_tokens(host, False, False) + _whole_tokens(slash + path, False, True)
    return UrlRule(name, action, regex, tuple(dict.fromkeys(tokens)), 1)


def wildcard_rule(name: str, action: str) -> UrlRule:
    """``*`` is any run of characters; the rest is literal and covers host + path."""
    parts = name.split("*")
    regex = r"\A" + r"[\s\S]*".join(re.escape(p) for p in parts) + r"\z"
    tokens: list[str] = []
    for i, p in enumerate(parts):
        tokens += _whole_tokens(p, i > 0, i < len(parts) - 1)
    return UrlRule(name, action, regex, tuple(dict.fromkeys(tokens)))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty where the URL is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def judge_urls(
    pages: DataFrame,
    rules: Sequence[UrlRule],
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """Adds host, path, rule (the host rule that won, or null), pattern (the pattern that
    decided where no host rule fits, or null) and verdict to every row.

    Null URLs and those without ``://`` have an empty host and path; no host rule fits
    them. Repeated URLs are judged once. A column of ``pages`` with one of these names is
    replaced. An empty rule list gives the default verdict everywhere.
    """
    spark = pages.sparkSession
    names = ("host", "path", "rule", "pattern", "verdict")
    pages = pages.drop(*[c for c in pages.columns if c.lower() in names])
    host, path = host_and_path(F.col(url))
    pages = pages.withColumns({"host": host, "path": path})
    spot, won = unused(pages, "_spot"), unused(pages, "_won")
    # Host and path decide everything; a page's query string or fragment adds no work.
    # A host never contains a slash, so the two are told apart in one text.
    pages = pages.withColumn(spot, F.concat("host", "path"))
    seen = pages.groupBy(spot).count()
    tokens = F.array_union(F.array(F.lit("")), F.regexp_extract_all(spot, F.lit("[A-Za-z0-9]+"), 0))
    hits = seen.select(spot, "count", F.explode(tokens).alias("token"))

    implied = [(i, t) for i, r in enumerate(rules) for t in r.tokens or ("",)]
    literals = literal_rows(spark, ("rule_no", "token"), implied, "rule_no int, token string")
    filed = literal_rows(
        spark,
        ("rule_no", "name", "action", "regex", "tier"),
        [(i, r.name, r.action, r.regex, r.tier) for i, r in enumerate(rules)],
        "rule_no int, name string, action string, regex string, tier int",
    )
    small = F.broadcast if len(rules) <= BROADCAST_RULES else (lambda df: df)
    # How often the corpus has each token that some rule implies; rarest first, then by text.
    often = hits.join(small(literals.select("token").distinct()), "token").groupBy("token").agg(
        F.sum("count").alias("often")
    )
    index = (
        literals.join(often, "token", "left")
        .groupBy("rule_no")
        .agg(F.min_by("token", F.struct(F.coalesce("often", F.lit(0)), "token")).alias("token"))
        .join(filed, "rule_no")
    )
    best = (
        hits.join(small(index), "token")
        .where(F.expr(f"{spot} RLIKE regex"))
        .groupBy(spot)
        .agg(F.max(F.struct("tier", F.length("name").alias("len"), "name", "action")).alias(won))
    )
    return pages.join(best, spot, "left").select(
        *[c for c in pages.columns if c != spot],
        F.when(F.col(f"{won}.tier") > 0, F.col(f"{won}.name")).alias("rule"),
        F.when(F.col(f"{won}.tier") == 0, F.col(f"{won}.name")).alias("pattern"),
        F.coalesce(f"{won}.action", F.lit(default)).alias("verdict"),
    )
