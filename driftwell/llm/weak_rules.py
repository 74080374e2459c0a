"""Quality rules under weak supervision.

Rules vote good (1), bad (-1) or abstain (0) on each document. Nobody knows how good the
rules are: expectation-maximisation over the counts of vote patterns estimates each
rule's vote rates among good and bad documents, and a document is kept by the posterior
probability that it is good, instead of having to pass every rule.

All of it is DataFrame expressions. A document's text is read once, in its own row; what
is shuffled is one small row per vote pattern (at most 3 ** number of rules).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.llm.text import WORD, let, stored, words

ROUNDS = 25
#: Weight of the rates at the start against those counted.
PULL = 0.02

#: Words that running text of the corpus's languages has many of.
COMMON = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "with", "was", "on", "by", "this",
    "de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "est", "pour", "dans",
    "der", "die", "und", "das", "von", "zu", "den", "mit", "ist", "ein", "eine", "nicht", "auf",
    "el", "y", "los", "las", "del", "se", "por", "con", "una", "para", "no", "es", "al",
)


def repeated_words(tokens: Column, width: int = 5) -> Column:
    """Number of words in ``width``-word windows that the text has twice or more.

    Windows are compared by 64-bit hash. Texts without such a window, most of them, only
    pay for a hash set; the others sort their windows.
    """
    hashes = F.transform(tokens, lambda w: F.xxhash64(w))
    n = F.size(tokens) - (width - 1)

    def windows(h: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)])
        )

    def covered(win: Column) -> Column:
        order = F.array_sort(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(order, lambda o: let(
            F.array_sort(
                F.transform(
                    F.filter(
                        F.transform(
                            o,
                            lambda x, k: F.struct(
                                x["i"].alias("i"),
                                (
                                    F.coalesce(F.get(o, k - 1)["h"] == x["h"], F.lit(False))
                                    | F.coalesce(F.get(o, k + 1)["h"] == x["h"], F.lit(False))
                                ).alias("twice"),
                            ),
                        ),
                        lambda x: x["twice"],
                    ),
                    lambda x: x["i"],
                )
            ),
            lambda p: F.aggregate(
                F.transform(p, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - x, F.lit(width)))),
                F.lit(0),
                lambda acc, x: acc + x,
            ),
        ))

    counted = let(hashes, lambda h: let(
        windows(h),
        lambda win: F.when(F.size(F.array_distinct(win)) == F.size(win), F.lit(0)).otherwise(covered(win)),
    ))
    return F.when(n >= 2, counted).otherwise(F.lit(0)).cast("long")


def measures(docs: DataFrame, doc_id: str, text: str, carry: bool = False) -> DataFrame:
    """Counts of each whole text, from which rules vote; ``carry``: and the row itself."""
    t = F.coalesce(F.col(text), F.lit(""))
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    base = docs.select(F.col(doc_id).alias("doc_id"), t.alias("text"), *row)
    base = base.withColumn("w", words(F.col("text")))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD))
    lower = F.lower("text")
    return base.select(
        "doc_id",
        *(["row"] if carry else []),
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter(F.split(lower, r"[\x20\x09-\x0D]+"), lambda x: x.isin(*COMMON)))
        .cast("long").alias("n_common"),
        F.size(F.filter("w", lambda x: x.rlike(r"[!?]{2,}\z"))).cast("long").alias("n_shouts"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.size(F.filter("w", lambda x: x.rlike(r"[.!?]\z"))).cast("long").alias("n_stops"),
    )


def votes() -> dict[str, Column]:
    """Each rule's vote from the measures: 1 good, -1 bad, 0 abstains."""
    c = F.col
    share = lambda a, b: F.when(c(b) > 0, c(a) / c(b)).otherwise(0.0)

    def defect(bad: Column) -> Column:
        return F.when(bad, F.lit(-1)).otherwise(F.lit(0))

    def rule(good: Column, bad: Column) -> Column:
        return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))

    length = share("word_chars", "n_words")
    common, stops = share("n_common", "n_words"), share("n_stops", "n_words")
    return {
        "v_word_chars": defect((length < 2) | (length > 14)),
        "v_symbols": defect(share("n_symbols", "n_words") > 0.1),
        "v_dup_lines": defect(share("n_dup_lines", "n_lines") > 0.3),
        "v_repeats": defect(100 * c("n_repeat_words") > 15 * c("n_words")),
        "v_shouts": defect(share("n_shouts", "n_words") > 0.2),
        "v_upper": defect(share("n_upper", "word_chars") > 0.4),
        "v_common": rule(common >= 0.05, (common < 0.01) & (c("n_words") >= 40)),
        "v_stops": rule(stops >= 0.02, (stops < 0.002) & (c("n_words") >= 100)),
    }


def _posterior(names: list[str], model: dict) -> Column:
    """P(good | votes) of independent rules."""
    odds = F.lit(math.log(model["prior"] / (1 - model["prior"])))
    for v in names:
        against, none, for_it = (F.lit(_evidence(model, v, value)) for value in (-1, 0, 1))
        odds = odds + F.when(F.col(v) == -1, against).when(F.col(v) == 1, for_it).otherwise(none)
    return 1 / (1 + F.exp(-odds))


def _evidence(model: dict, rule: str, value: int) -> float:
    """Log of how much likelier good documents get this vote, or none, than bad ones."""
    rate = {c: model[rule, value, c] if value else 1 - model[rule, -1, c] - model[rule, 1, c] for c in ("good", "bad")}
    return math.log(rate["good"] / rate["bad"])


def fit_votes(patterns: DataFrame, names: list[str], rounds: int = ROUNDS) -> dict:
    """EM over pattern counts (columns ``names`` and n): the prior and each rule's rates.

    There are at most 3 ** rules patterns, so the driver holds them. To abstain is an
    outcome like a vote: most rules only ever blame, and a document that none blames is
    the likelier to be good. Rates start from rules that seldom blame a good document, and
    stay mixed with the start by PULL, so that none becomes 0 or 1. A rule's vote is never
    taken against its word: its rates are then made equal. Without documents the model is
    the start.
    """
    start: dict = {"prior": 0.85}
    for v in names:
        start |= {(v, 1, "good"): 0.6, (v, -1, "good"): 0.01, (v, 1, "bad"): 0.3, (v, -1, "bad"): 0.4}
    rows = patterns.select(*names, "n").collect()
    votes = np.array([[r[v] for v in names] for r in rows]).reshape(len(rows), len(names))
    n = np.array([float(r["n"]) for r in rows])
    model = dict(start)
    for _ in range(rounds if len(rows) else 0):
        odds = np.full(len(rows), math.log(model["prior"] / (1 - model["prior"])))
        for k, v in enumerate(names):
            for value in (-1, 0, 1):
                odds[votes[:, k] == value] += _evidence(model, v, value)
        p = 1 / (1 + np.exp(-odds))
        weight = {"good": n * p, "bad": n * (1 - p)}
        model["prior"] = (weight["good"].sum() + start["prior"]) / (n.sum() + 1)
        for k, v in enumerate(names):
            for value in (-1, 1):
                hit = votes[:, k] == value
                g, b = (
                    (1 - PULL) * (weight[c][hit].sum() + start[v, value, c]) / (weight[c].sum() + 1) + PULL * start[v, value, c]
                    for c in ("good", "bad")
                )
                if (g < b) == (value == 1):  # against its word: no evidence
                    g = b = (g + b) / 2
                model[v, value, "good"], model[v, value, "bad"] = g, b
    return model


def apply_rules(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: float = 0.5, carry: bool = False
) -> DataFrame:
    """Rows doc_id, the measures, the votes, base_failed, quality and kept, one per document.

    base_failed: fewer than 10 words, or over a fifth of the words in repeated 5-word
    windows; such documents are never kept. Of the others those with a posterior of
    ``keep`` or more are; the model is fitted on all documents. A null text counts as empty and fails. Repeated rows and ids are
    judged each by itself; an empty table gives an empty table. Other columns of ``docs``
    are not read, unless ``carry`` asks for the whole row, as the column row.
    """
    named = votes()
    counted = measures(docs, doc_id, text, carry).withColumns(named)
    counted = stored(counted, "rule-votes")
    names = list(named)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    model = fit_votes(counted.groupBy(*names).agg(F.count("*").alias("n")), names)
    quality = _posterior(names, model)
    return counted.withColumns(
        {"base_failed": failed, "quality": quality, "kept": ~failed & (quality >= F.lit(keep))}
    )
