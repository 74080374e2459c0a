import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwell.llm import suffix_tree as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


@pytest.mark.parametrize("frequent", [1 << 18, 20, 0])
def test_base_score_equals_brute_force(awkward, rows, frequent):
    train = F.coalesce(F.col("doc_id"), F.lit(0)) % 2 == 0
    got = S.score_texts(awkward, train, frequent=frequent).collect()
    counts, ends = Counter(), 0
    for r in rows:
        if (r[0] or 0) % 2 == 0:
            counts.update(WORD.findall(lower(r[1])))
            ends += 1
    total, kinds = sum(counts.values()) + ends, len(counts) + 1
    want = Counter()
    for r in rows:
        words = WORD.findall(lower(r[1]))
        score = sum(math.log10((c + 1) / (total + kinds + 1)) for c in [*(counts[w] for w in words), ends])
        want[(r[0], len(words) + 1, sum(counts[w] > 0 for w in words) + 1, total, round(score, 6))] += 1
    assert want == Counter(
        (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got
    )
    assert all(r["score"] < 0 for r in got)


def counted(texts, depth):
    """Next-byte counts of every context, by the bytes themselves."""
    held = {}
    for t in texts:
        history = bytes([S.END]) * depth
        for b in [*t, S.END]:
            for d in range(depth + 1):
                held.setdefault(history[len(history) - d :], Counter())[b] += 1
            history += bytes([b])
    return held


def by_hand(held, least, depth, texts):
    """Longest retained suffix of the history, byte by byte, from the counts."""
    root = held.get(b"", Counter())
    size = sum(root.values())
    dist = {b"": {b: (root[b] + 1) / (size + 256) for b in range(256)}}
    kept = {b""}
    for key in sorted(held, key=len):
        c, n = held[key], sum(held[key].values())
        if not key or n < least:
            continue
        below = dist[key[1:]]
        pull = S.SMOOTH * len(c)
        if sum(v * math.log(v / n / below[b]) for b, v in c.items()) >= S.DIVERGENCE:
            kept.add(key)
            dist[key] = {b: (c[b] + pull * below[b]) / (n + pull) for b in range(256)}
        else:
            dist[key] = below
    out = []
    for t in texts:
        history, score = bytes([S.END]) * depth, 0.0
        for b in [*t, S.END]:
            key = next(k for d in range(depth, -1, -1) if (k := history[len(history) - d :]) in kept)
            assert math.isclose(sum(dist[key].values()), 1.0)
            score += math.log10(dist[key][b])
            history += bytes([b])
        out.append(score)
    return out


def grown_from(texts, least):
    code, n = S._grams(texts, S.DEPTH)
    code, root = code.astype(np.int64), np.ones(256)
    np.add.at(root, code & 255, n)
    tree = S.Tree(S.DEPTH, root / root.sum())
    for d in range(1, S.DEPTH + 1):
        grams, at = np.unique(S._part(code, d, S.DEPTH), return_inverse=True)
        times = np.bincount(at, n).astype(np.int64)
        _, row = np.unique(grams >> 8, return_inverse=True)
        keep = np.bincount(row, times)[row] >= least
        tree.add(d, grams[keep], times[keep])
    return tree


def test_tree_follows_the_longest_suffix(rows, monkeypatch):
    texts = [S.normal(r[1])[:4000] for r in rows]
    tree = grown_from(texts, 40)
    assert sum(len(x[0]) for x in tree.contexts.values()) > 10
    some = [*(t[:300] for t in texts), b"\x00\xff unseen", b""]
    want = by_hand(counted(texts, S.DEPTH), 40, S.DEPTH, some)
    assert np.allclose(S.Scorer(tree)(some), want, atol=1e-9)
    monkeypatch.setattr(S, "BLOCK_BYTES", 500)
    for remembered in (0, 100, 10**6):
        monkeypatch.setattr(S, "REMEMBERED", remembered)
        assert np.allclose(S.Scorer(tree)(some), want, atol=1e-9)


@pytest.mark.parametrize("most", [10**6, 300, 10])
def test_scores_equal_brute_force(awkward, rows, most):
    """Whichever part of the tree goes to the tasks and which is joined."""
    short = F.length(F.coalesce(F.col("text"), F.lit(""))) < 3000
    got = S.score_texts(awkward.where(short), F.lit(True), most=most).collect()
    texts = [S.normal(r[1]) for r in rows if len(r[1] or "") < 3000]
    want = by_hand(counted(texts, S.DEPTH), S.LEAST_COUNT, S.DEPTH, texts)
    assert np.allclose(sorted(r["score"] for r in got), sorted(want), atol=1e-6)


def test_tables_without_rows(awkward, nothing):
    assert S.score_texts(nothing, F.lit(True)).collect() == []
    blind = S.score_texts(awkward, F.lit(False)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"]) for r in blind} == {(0, 0, 0.0)}
    assert all(r["score"] < 0 for r in blind)


def test_held_out_text_is_likely(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    got = S.score_texts(docs, ~held).where(held).agg(F.sum("score").alias("s"), F.sum("n_tokens").alias("n")).first()
    assert got["s"] / got["n"] > -4.4  # log10 for each word; six bytes all alike are -14


def test_a_larger_corpus_loses_no_context(spark):
    """A pattern that occurs 40 times stays in the tree when 9 MB of other text are added."""
    few = [(0, "qzxvkj " * 40)]
    many = [(i, "the old man and the sea went on and on " * 2000) for i in range(1, 120)]
    probe = [(10**6, "qzxvkj qzxvkj")]
    kind = "doc_id long, text string"
    small = S.score_texts(spark.createDataFrame(few + many[:1] + probe, kind), F.col("doc_id") < 10**6)
    large = S.score_texts(spark.createDataFrame(few + many + probe, kind), F.col("doc_id") < 10**6)
    got = [t.where("doc_id = 1000000").first()["score"] for t in (small, large)]
    # Only the first bytes, from the root, know how large the corpus is.
    assert got[1] > got[0] - 4
