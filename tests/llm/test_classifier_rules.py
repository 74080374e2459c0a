import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwell.llm import nbsvm, weak_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    t = text or ""
    words = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= set(range(i, i + 5))
    symbols = len(re.findall(r"[#*$%&|<>]", t))
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def test_measures_equal_brute_force(awkward, rows, nothing):
    got = weak_rules.apply_rules(awkward).collect()
    counts = Counter(
        (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        for r in got
    )
    want = Counter()
    for r in rows:
        b = base(r[1])
        want[(r[0], *b, b[0] < 10 or 100 * b[4] > 20 * b[0])] += 1
    assert counts == want
    assert all(not (r["kept"] and r["base_failed"]) for r in got)
    assert weak_rules.apply_rules(nothing).collect() == []


def test_rows_are_carried_whole(awkward, rows):
    got = weak_rules.apply_rules(awkward, carry=True).select("row.*")
    assert Counter(map(tuple, got.collect())) == Counter(rows)


def test_rules_part_junk_from_prose(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    judged = weak_rules.apply_rules(docs).select("doc_id", "kept", "base_failed").join(labels, "doc_id").collect()
    rest = [r for r in judged if not r["base_failed"]]
    assert np.mean([r["kept"] == (r["quality"] == 1) for r in rest]) > 0.97


def test_votes_are_fitted_like_by_hand(spark):
    """One EM round over three patterns, by hand."""
    patterns = [(1, -1, 10), (0, -1, 5), (1, 0, 85)]
    df = spark.createDataFrame(patterns, "x int, y int, n long")
    model = weak_rules.fit_votes(df, ["x", "y"], rounds=1)
    good_at, bad_at = {1: 0.6, -1: 0.01, 0: 0.39}, {1: 0.3, -1: 0.4, 0: 0.3}

    def p(x, y):
        good, bad = 0.85 * good_at[x] * good_at[y], 0.15 * bad_at[x] * bad_at[y]
        return good / (good + bad)

    good = sum(n * p(x, y) for x, y, n in patterns)
    assert np.isclose(model["prior"], (good + 0.85) / 101)
    x_good = sum(n * p(x, y) for x, y, n in patterns if x == 1)
    assert np.isclose(model["x", 1, "good"], 0.98 * (x_good + 0.6) / (good + 1) + 0.02 * 0.6)
    empty = weak_rules.fit_votes(df.limit(0), ["x", "y"])
    assert empty["prior"] == 0.85 and empty["y", -1, "bad"] == 0.4


@pytest.mark.parametrize("corpus,least", [("all", 0.99), ("junk", 0.9)])
def test_rules_on_clean_and_on_bad_corpora(spark, corpus, least):
    """The share of junk is estimated, also where half of the corpus is junk."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    if corpus == "junk":
        docs = docs.join(labels.where("quality = 0 or doc_id % 10 = 0"), "doc_id", "left_semi")
    judged = weak_rules.apply_rules(docs).drop("quality").join(labels, "doc_id").where(~F.col("base_failed"))
    right = judged.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert right > least


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    labels = labels.select("doc_id", F.col("quality").alias("label"))
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    model = nbsvm.fit(docs, labels.where(learn))
    held = nbsvm.with_score(docs.select("doc_id", "text"), model).join(labels.where(~learn), "doc_id").collect()
    right = [(r["score"] >= 0.7) == (r["label"] == 1) for r in held]
    assert np.mean(right) > 0.93


def test_scores_of_awkward_rows(spark, awkward, rows, nothing):
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 60, 3)] + [(None, 1), (3, None)], "doc_id long, label int")
    model = nbsvm.fit(awkward, labels)
    scored = nbsvm.with_score(awkward, model, out="p").collect()
    assert Counter(tuple(r)[:-1] for r in scored) == Counter(rows)
    assert all(0 <= r["p"] <= 1 for r in scored)
    assert nbsvm.with_score(nothing, model, out="p").collect() == []
    one_class = nbsvm.fit(awkward, labels.where("label = 1"))
    assert all(r["p"] > 0.9 for r in nbsvm.with_score(awkward, one_class, out="p").collect())
    empty = nbsvm.fit(nothing, labels.limit(0))
    assert {r["p"] for r in nbsvm.with_score(awkward, empty, out="p").collect()} == {0.5}


def test_features_are_distinct_ngrams():
    found = nbsvm.Features()("abcabc")
    grams = {b"abcabc"[i : i + n] for n in nbsvm.ORDERS for i in range(7 - n)}
    assert len(found) == len(set(found.tolist())) == len(grams) + 3


def test_descent_reaches_the_optimum_of_a_small_problem():
    rows = [np.array([0, 1]), np.array([0]), np.array([2]), np.array([2, 1])]
    y, ratio = np.array([1.0, 1, -1, -1]), np.array([1.0, 0.5, 1.0])
    cost = np.ones(4)
    w = nbsvm.descend(rows, y, ratio, cost, 0)

    def loss(w):
        total = 0.5 * w @ w
        for idx, v, c in zip(rows, y, cost, strict=True):
            x = ratio[idx] / np.linalg.norm(ratio[idx])
            total += c * max(0.0, 1 - v * (w[idx] @ x))
        return total

    rng = np.random.default_rng(0)
    best = min(loss(w + rng.normal(0, 0.05, 3)) for _ in range(2000))
    assert loss(w) <= best + 1e-3
