import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from driftwell.llm import merkle


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def grown(leaves):
    """All levels of a tree, leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[k : k + 16])) for k in range(0, len(last), 16)])
    return levels


def path_of(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 16 * 16
        out += [level[j] for j in range(run, min(run + 16, len(level))) if j != i]
        i //= 16
    return out


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 1000])
def test_log_positions(n):
    """Segments side by side are the log; every node stands where `position` says."""
    leaves = [h(str(k)) for k in range(n)]
    levels = grown(leaves)
    log = []
    for first in range(0, n, merkle.LEAVES):
        assert merkle.position(0, first, n) == len(log)
        log += merkle.segment(leaves[first : first + merkle.LEAVES], first, n)
    for level in range(merkle.climb(n) + 1):
        for j, node in enumerate(levels[level]):
            assert log[merkle.position(level, j, n)] == node
    assert len(log) == sum(len(x) for x in levels[: merkle.climb(n) + 1])


@pytest.mark.parametrize("n", [1, 2, 16, 17, 100, 256])
def test_siblings_and_fold(n):
    leaves = [h(str(k)) for k in range(n)]
    levels, nodes = grown(leaves), "".join(merkle.segment(leaves, 0, n))
    for i in range(n):
        path = merkle.siblings(nodes, 0, i, n)
        assert path == "".join(path_of(levels, i))
        assert merkle.fold(leaves[i], path, (i, n)) == levels[-1][0]
        if n > 1:
            assert merkle.fold(h("other"), path, (i, n)) != levels[-1][0]


def expected(rows):
    """Rows (key, source, leaf, claim) by brute force."""
    trees = defaultdict(list)
    for key, source, leaf, claim in rows:
        trees[source].append((key is not None, key or 0, leaf, claim or leaf))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    grown_by = {s: grown([r[2] for r in sorted(trees[s], key=lambda r: r[:3])]) for s in order}
    top = grown([grown_by[s][-1][0] for s in order])
    out = Counter()
    for place, s in enumerate(order):
        for i, (known, key, leaf, claim) in enumerate(sorted(trees[s], key=lambda r: r[:3])):
            path = path_of(grown_by[s], i) + path_of(top, place)
            subroot, root = grown_by[s][-1][0], top[-1][0]
            out[key if known else None, leaf, subroot, root, h("".join(path)), root if claim == leaf else "other"] += 1
    return out


def got(df):
    out = Counter()
    for r in df.collect():
        folded = r["folded_root"] if r["folded_root"] == r["root"] else "other"
        out[r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], folded] += 1
    return out


KINDS = "doc_id long, source string, leaf string, claim string, block long, tree string, path string, nodes string"


@pytest.mark.parametrize("ranges", [merkle.RANGE_ROWS, 97])
def test_proofs_of_trees_of_all_sizes(spark, monkeypatch, ranges):
    monkeypatch.setattr(merkle, "RANGE_ROWS", ranges)
    rng = random.Random(3)
    sizes = {None: 300, "": 1, "a": 16, "b": 257, "é": 17, "z": 2} | {f"t{k}": 1 for k in range(14)}
    rows = [(k if k % 50 else None, s, h(f"{s}{k}"), None) for s, n in sizes.items() for k in range(n)]
    rows += rows[5:8]  # repeated rows are leaves of their own
    rows = [(*r[:3], h("changed") if rng.random() < 0.2 else r[2]) for r in rows]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "x", "y", "z") for r in rows], KINDS).repartition(5)
    found = merkle.prove(df, "source", "doc_id", "leaf", "claim", with_siblings=True)
    assert got(found) == expected(rows)
    assert all(h("".join(r["siblings"])) == r["proof_sha256"] for r in found.collect())


def test_three_tiers(spark):
    """A tree of more than LEAVES blocks: digests made by Spark, expected ones by hand."""
    n = merkle.LEAVES**2 + 300
    df = spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.lit("s").alias("source"),
        F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("leaf"),
        F.lit(None).cast("string").alias("claim"),
    )
    found = merkle.prove(df, "source", "doc_id", "leaf", "claim").where("doc_id % 97 = 0 or doc_id > 65500").collect()
    levels = grown([h(str(k)) for k in range(n)])
    assert len(found) > 300
    for r in found:
        assert r["root"] == r["folded_root"] == levels[-1][0]
        assert r["proof_sha256"] == h("".join(path_of(levels, r["doc_id"])))


def test_awkward_documents(spark, awkward, rows, nothing):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    docs = awkward.withColumn("leaf_", merkle.document_leaves(awkward, F.col("text"))).withColumn("claim_", F.lit(None).cast("string"))
    want = [(r[0], r[3], h("".join(map(field, (r[0], r[3], r[2], r[4], r[1])))), None) for r in rows]
    assert got(merkle.prove(docs, "source", "doc_id", "leaf_", "claim_")) == expected(want)
    none = nothing.withColumn("leaf_", F.lit("")).withColumn("claim_", F.lit(""))
    assert merkle.prove(none, "source", "doc_id", "leaf_", "claim_").collect() == []
