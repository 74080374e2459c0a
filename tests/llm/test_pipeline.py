import itertools
from collections import Counter

import corpus_pipeline

from driftwell.llm import mixing, near_dups, queries, weak_rules
from driftwell.llm.text import stored
from tests.llm.test_near_dups import shingle_set
from tests.llm.test_packing import check_places

FOLDER = "/root/testdata/sf0.001"


def test_stages_on_the_test_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, None
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, FOLDER), f"test-{name}")
        had = Counter(map(tuple, before.collect()))
        if name == "pack":
            pieces = docs.collect()
            check_places(pieces, 4096)
            assert Counter(r["doc_id"] for r in pieces if r["piece"] == 0) == Counter(r[0] for r in had.elements())
            continue
        got = Counter(map(tuple, docs.collect()))
        assert docs.columns == columns and got and set(got) <= set(had)
        if name in ("quality_classifier", "quality_rules", "near_dedup"):
            assert all(got[r] <= had[r] for r in got)
        if name == "quality_classifier":
            right = [(doc[0] in {r[0] for r in got}) == (labels[doc[0]] == 1) for doc in had if doc[0] in labels]
            assert sum(right) > 0.9 * len(right)
        if name == "quality_rules":
            kept = {r["doc_id"] for r in weak_rules.apply_rules(before).where("kept").collect()}
            assert {r[0] for r in got} == kept
        if name == "near_dedup":
            sets = [shingle_set(r[1]) for r in got]
            for a, b in itertools.combinations(sets, 2):
                assert not a & b or 100 * len(a & b) < 80 * len(a | b)
        if name == "mix":
            assert max(got.values()) <= 3


def test_stages_take_awkward_and_empty_tables(spark, awkward, rows, nothing):
    for df in (awkward, nothing):
        docs = df
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            if name != "pack":
                assert out.columns == docs.columns
                docs = stored(out, f"test-{name}")
            else:
                assert out.count() >= docs.count()
    assert set(map(tuple, corpus_pipeline.near_dedup(spark, awkward, FOLDER).collect())) <= set(rows)


def test_registered(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n in entry.queries() if n.startswith("op")] == list(queries.queries())
    assert len(queries.queries()) == 13 and mixing and near_dups
