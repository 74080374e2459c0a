import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from driftwell.llm import sketches


def units(t):
    out = set()
    for line in (t or "").split("\n"):
        out |= {line} if len(line) <= sketches.LINE else set(re.split(r"(?<=[.!?])[ \t]+", line))
    return out - {""}


def near(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows, by):
    order = sorted(rows, key=by)
    out = Counter()
    for n, r in enumerate(order):
        t, x = r[1] or "", order[(n + 1) % len(order)][1] or ""
        half = len(t) // 2
        e = t[: len(t) - half] + x[:half]
        sha = hashlib.sha256(e.encode()).hexdigest()
        out[r[0], len(t), sha, round(near(units(t), units(e)), 9), round(near(units(t), units(x)), 9)] += 1
    return out


def result(df):
    return Counter(
        (r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9))
        for r in df.collect()
    )


def test_fingerprints_equal_brute_force(spark, awkward, rows, nothing):
    hashes = {
        r["text"]: r["h"]
        for r in spark.createDataFrame([(x[1],) for x in rows], "text string")
        .select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    }
    by = lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]])
    got = sketches.fingerprints(awkward).cache()
    assert result(got) == expected(rows, by)
    text = {r[0]: r[1] or "" for r in rows if r[0] is not None}
    seen = {}
    for r in got.where("doc_id is not null").collect():
        seen.setdefault(text[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in seen.values())
    assert sketches.fingerprints(nothing).collect() == []
    one = sketches.fingerprints(awkward.where("doc_id = 24")).first()
    assert one["near_next"] == 1.0


def test_ranges_keep_the_order(spark, monkeypatch):
    monkeypatch.setattr(sketches, "RANGE_ROWS", 7)
    ids = [i * i % 1009 for i in range(1, 200)]
    rows = [(i, f"text {i}\n" * 3) for i in sorted(set(ids))] + [(None, "no id"), (None, "nor here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["text"]: r["next_text"] for r in sketches.with_next(docs).collect()}
    known = sorted(r for r in rows if r[0] is not None)
    for (_, t), (_, n) in zip(known, known[1:], strict=False):
        assert got[t] == n
    assert got[known[-1][1]] in ("no id", "nor here") and len(got) == len(rows)


def test_small_tables_are_made_again_larger(spark, monkeypatch):
    """Cells for two digests, groups of forty: only larger retries can peel."""
    monkeypatch.setattr(sketches, "PART", 2)
    monkeypatch.setattr(sketches, "GROUP", 40)
    a, b = list(range(60)), list(range(30, 75))
    df = spark.createDataFrame([(a, b)], "a array<long>, b array<long>")
    mixed = lambda c: F.transform(c, lambda x: F.xxhash64(x))
    d = df.select(sketches.difference(mixed("a"), mixed("b"), sketches.level_of(F.col("a"))).alias("d"), mixed("a").alias("a"), mixed("b").alias("b")).first()
    assert {x["k"] for x in d["d"] if x["n"] == 1} == set(d["a"]) - set(d["b"])
    assert {x["k"] for x in d["d"] if x["n"] == -1} == set(d["b"]) - set(d["a"])
    short = df.select(sketches.peel(sketches.subtract(sketches.cells(mixed("a"), 2), sketches.cells(mixed("b"), 2)), 2, 0).alias("d")).first()
    assert short["d"] is None


def test_lines_without_sentence_ends_are_cut_by_content(spark):
    """One line of words, one of characters without blanks, and one that repeats a word:
    many units each, and a beginning that is put before moves few of them."""
    import random

    rng = random.Random(3)
    line = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(4000))
    solid = "".join(rng.choice("漢字仮名交文章例示abcd") for _ in range(20000))
    same = "same " * 2000
    before = "some words put before "
    rows = [(i, t, before + t) for i, t in enumerate((line, solid, same))]
    df = spark.createDataFrame(rows, "i int, a string, b string").select(
        "i", sketches.digests(F.col("a")).alias("a"), sketches.digests(F.col("b")).alias("b")
    )
    got = {r["i"]: (set(r["a"]), set(r["b"])) for r in df.collect()}
    for i in (0, 1):
        a, b = got[i]
        assert len(a) > 50
        assert near(a, b) > 0.9
    assert got[2][0] & got[2][1]


def test_sentences_over_two_hundred_characters_are_units(spark):
    """A line of 300 characters is one unit for each of its sentences."""
    text = " ".join(f"Sentence number {i} is here." for i in range(11))
    assert 200 < len(text) < 400
    row = spark.createDataFrame([(text,)], "t string").select(sketches.digests(F.col("t")).alias("d")).first()
    assert len(row["d"]) == 11
