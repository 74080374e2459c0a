from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from driftwell.functions import clip, to_number
from driftwell.operators import clean, validate
from driftwell.operators.clean import CleanOptions
from driftwell.plans import jobs
from driftwell.spec import CREDIT, Field, TableSpec

SPEC = TableSpec(
    (
        Field("amount", "numeric", source="hoehe"),
        Field("savings", "category", 1, 5, source="sparkont"),
        Field("number_credits", "integer", source="bishkred"),
        Field("credit_risk", "label", source="kredit"),
    ),
    junk=("mixed_type_col",),
)


def raw(spark, rows):
    return spark.createDataFrame(
        rows, "hoehe string, sparkont string, bishkred string, kredit string, mixed_type_col string"
    )


@pytest.mark.parametrize(
    "text,value",
    [
        ("1.0 ", 1.0),
        (" 2", 2.0),
        ("abc", None),
        ("", None),
        ("nan", None),
        ("1d", None),
        ("1e3", 1000.0),
        (".5", 0.5),
        ("5.", 5.0),
        ("+7", 7.0),
        ("1_000", None),
        ("inf", float("inf")),
        (None, None),
    ],
)
def test_text_to_number(spark, text, value):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(to_number(F.col("x"))).first()[0] == value


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(None,), (0,), (9,), (3,)], "x int")
    assert [r[0] for r in df.select(clip(F.col("x"), 1, 5)).collect()] == [None, 1, 5, 3]


def test_whole_cleaner_by_hand(spark):
    rows = [
        ("100", "1", "1", "1", "x"),
        ("200", "1 ", "2", "2", "x"),
        ("abc", "9", "409", "1.0", "x"),
        ("301", "", "1", "0", "x"),
        ("400", "2", "", "2", "x"),
        ("999", "1", "1", "3", "x"),  # invalid label
        ("999", "1", "1", None, "x"),  # missing label
    ]
    out, fitted = clean.clean(raw(spark, rows), SPEC)
    assert (fitted.rows_in, fitted.rows_kept) == (7, 5)
    # Median of 100, 200, 301, 400; kept exact, then cut by the integer cast.
    assert fitted.fills == {"amount": 250.5, "savings": 1.0}
    assert out.columns == ["amount", "savings", "number_credits", "credit_risk"]
    assert dict(out.dtypes)["savings"] == "int" and dict(out.dtypes)["amount"] == "bigint"
    got = sorted(tuple(r) for r in out.collect())
    assert got == [
        (100, 1, 1, 1),
        (200, 1, 2, 0),
        (250, 5, 409, 1),
        (301, 1, 1, 0),
        (400, 2, 0, 0),
    ]


def test_options_of_the_exploratory_cleaner(spark):
    rows = [
        ("100", "1", "1", "2", "x"),
        ("201", "7", None, "3", "x"),
        ("", "2", "3", "3", "x"),
        ("100", "1", "1", "2", "x"),
    ]
    options = CleanOptions(
        label_codes=clean.LABEL_CODES_EXPLORATORY,
        median_rounding="half_even",
        domain="list",
        drop_duplicates=True,
    )
    out, fitted = clean.clean(raw(spark, rows), SPEC, options)
    assert fitted.fills["amount"] == 100.0 and fitted.fills["number_credits"] == 1.0
    got = sorted(tuple(r) for r in out.collect())
    assert got == sorted([(100, 1, 1, 1), (201, None, 1, 0), (100, 2, 3, 0)], key=str)


@pytest.mark.parametrize("holes", [0, 30, 400])
def test_bounds_equal_ranking_after_imputing(spark, holes):
    """The shortcut for bounds of the imputed column against doing it in order."""
    import random

    rng = random.Random(holes)
    xs = [round(rng.lognormvariate(7, 1), 1) for _ in range(700)]
    rows = [(str(x), "1", "1", "1", "") for x in xs] + [("?", "1", "1", "1", "")] * holes
    _, fitted = clean.clean(raw(spark, rows).repartition(3), SPEC)
    ordered = sorted(xs)
    median = (ordered[349] + ordered[350]) / 2
    full = sorted(xs + [median] * holes)
    k = int(0.01 * len(full))
    assert fitted.bounds["amount"] == (full[k], full[len(full) - k - 1])


def test_winsorize_moves_exactly_k_values(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("x"))
    row = clean.winsorize(df, ["x"]).agg(F.min("x"), F.max("x"), F.count("x"), F.countDistinct("x")).first()
    assert tuple(row) == (11.0, 990.0, 1000, 980)


def test_all_missing_numeric_becomes_zero(spark):
    rows = [("", "1", "1", "1", "x"), ("?", "1", "1", "2", "x")]
    out, _ = clean.clean(raw(spark, rows), SPEC)
    assert {r["amount"] for r in out.collect()} == {0}


def test_modes_take_the_smallest_on_ties(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (2, "a"), (1, "b"), (None, None)], "n int, s string")
    assert clean.modes(df, ["n", "s"]) == {"n": 1.0, "s": "a"}


def test_checks_raise(spark):
    df = spark.createDataFrame([(1, None), (2, 1)], "credit_risk int, x int")
    with pytest.raises(ValueError, match="missing"):
        clean.require_clean(df, "credit_risk")
    with pytest.raises(ValueError, match="label"):
        clean.require_clean(df.fillna(0), "credit_risk")


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a")] * 5 + [(2, "b")], "x int, s string")
    assert tuple(clean.duplicate_count(df).first()) == (6, 2, 4)
    assert clean.drop_duplicate_rows(df).count() == 2


def test_clean_job_reads_and_writes_csv(spark, tmp_path, credit):
    names = {f.name: f.source for f in CREDIT.fields}
    dirty = credit.drop("row_key").withColumnsRenamed(names).withColumn("mixed_type_col", F.lit("?"))
    dirty.write.option("header", True).csv(str(tmp_path / "raw.csv"))
    fitted = jobs.clean_table(
        spark, str(tmp_path / "raw.csv"), str(tmp_path / "out" / "clean.csv"), CREDIT
    )
    back = spark.read.option("header", True).schema(CREDIT.clean_schema()).csv(
        str(tmp_path / "out" / "clean.csv")
    )
    assert back.count() == fitted.rows_kept == 100
    assert back.columns == CREDIT.names()


def application(**changes):
    base = {f.name: f.check_range[0] for f in CREDIT.fields if f.kind != "label"}
    return {**base, **changes}


def test_request_rules(spark):
    rules = validate.rules_of(CREDIT)
    assert len(rules) == 20
    rows = [
        application(),
        application(duration=73, purpose=11),
        application(people_liable=3),
        application(age=None),
    ]
    df = spark.createDataFrame(
        [tuple(None if v is None else float(v) for v in r.values()) for r in rows],
        ", ".join(f"{c} double" for c in rows[0]),
    ).withColumn("amount", F.when(F.col("age").isNotNull(), F.col("amount") + 0.5).otherwise(F.col("amount")))
    valid, rejected = validate.split_valid(df.withColumn("amount", F.floor("amount").cast("double")), rules)
    assert valid.count() == 1
    failures = sorted(sorted(f["column"] for f in r["failures"]) for r in rejected.collect())
    assert failures == [["age"], ["duration", "purpose"], ["people_liable"]]
    # A fraction breaks a whole-number rule.
    assert validate.split_valid(df, rules)[0].count() == 0
    counts = {r["column"]: r["rejected"] for r in validate.reject_counts(df, rules).collect()}
    assert counts["duration"] == 1 and counts["status"] == 0 and counts["age"] == 1
    assert counts["amount"] == 3


def test_request_lists(spark):
    df = spark.createDataFrame(
        [("a", [(1,), (2,)]), ("b", []), ("c", [(i,) for i in range(4)])],
        "request string, applications array<struct<x:int>>",
    )
    rows = validate.explode_requests(df, "applications", cap=3).collect()
    ok = {r["request"]: r["batch_ok"] for r in rows}
    assert ok == {"a": True, "b": False, "c": False} and len(rows) == 7
