from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from driftwell.operators import attribution, models, prep
from driftwell.plans import jobs
from driftwell.sources import runlog, tables
from driftwell.spec import CREDIT

FEATURES = CREDIT.features
QUICK = {"maxIter": 5, "maxDepth": 3}


def vectors(df):
    return [list(r[0]) for r in df.select(vector_to_array("features")).collect()]


def test_column_kinds_and_one_hot(spark):
    df = spark.createDataFrame([(1.0, 10.0, "a"), (2.0, 20.0, "b"), (3.0, 30.0, "a")], "num1 double, num2 double, cat1 string")
    kinds = {r["column"]: r["kind"] for r in jobs.describe_columns(df).collect()}
    assert kinds == {"num1": "numeric", "num2": "numeric", "cat1": "categorical"}
    fitted = prep.fit_preprocessor(df, ["num1", "num2"], ["cat1"], scale=True)
    got = vectors(fitted.transform(df))
    assert len(got) == 3 and len(got[0]) == 4
    assert math.isclose(got[0][0], (1 - 2) / math.sqrt(2 / 3))
    assert [v[2:] for v in got] == [[1, 0], [0, 1], [1, 0]]
    assert prep.feature_names(fitted) == ["num__num1", "num__num2", "cat__cat1_a", "cat__cat1_b"]


def test_missing_and_unseen_values(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "x"), (2.0, None), (float("nan"), "z")], "num1 double, cat1 string")
    fitted = prep.fit_preprocessor(df, ["num1"], ["cat1"])
    # Missing number takes the median 1.5, missing text the smallest mode x.
    assert vectors(fitted.transform(df)) == [[1.0, 1, 0], [2.0, 1, 0], [1.5, 0, 1]]
    tables.save_model(fitted, str(tmp_path / "prep"))
    again = tables.load_model(str(tmp_path / "prep"))
    new = spark.createDataFrame([(5.0, "never seen"), (None, "it's")], "num1 double, cat1 string")
    assert vectors(again.transform(new)) == [[5.0, 0, 0], [1.5, 0, 0]]


def test_quotes_in_fills(spark):
    df = spark.createDataFrame([("it's \\ odd",), (None,)], "c string")
    fitted = prep.fit_preprocessor(df, [], ["c"])
    assert vectors(fitted.transform(df)) == [[1.0], [1.0]]


def test_scaling_a_constant(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [r[0] for r in prep.standard_scale(df, ["x"]).collect()] == [0.0, 0.0]


def test_too_many_levels_are_refused(spark):
    df = spark.range(1500).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="levels"):
        prep.dummy_columns(df, "c")


def test_balanced_weights_sum_to_rows(spark, credit):
    weighted = models.balanced_weights(credit, "credit_risk")
    by_class = weighted.groupBy("credit_risk").agg(F.sum(models.WEIGHT).alias("w")).collect()
    assert all(math.isclose(r["w"], 50.0) for r in by_class)


@pytest.fixture(scope="module")
def trained(spark, credit, tmp_path_factory):
    """One training job on the synthetic credit table, reused by the tests below."""
    root = tmp_path_factory.mktemp("train")
    # A label that the features decide, so that the model has something to learn.
    df = credit.withColumn("credit_risk", (F.col("status") + F.col("savings") > 5).cast("long"))
    log = runlog.RunLog(spark, str(root / "log"))
    options = jobs.TrainOptions("credit_risk", ["row_key"], numeric=FEATURES, booster=QUICK)
    result = jobs.train(df, options, log, str(root / "model"), str(root / "metrics"))
    return df, log, root, result


def test_training_job(trained):
    df, log, root, result = trained
    assert set(result.metrics) == {
        "f1_score_test", "accuracy_test", "precision_test", "recall_test", "auc_test", "bad_rate_test",
    }
    assert result.metrics["auc_test"] > 0.8
    assert result.drift.count() == len(FEATURES)
    assert result.scored_test.count() == 20
    top = [r["feature"] for r in result.importance.collect()]
    assert len(top) == 10 and set(top[:2]) == {"num__status", "num__savings"}
    assert log.table("runs").first()["status"] == "FINISHED"
    assert log.table("run_metrics").count() == 6
    params = {r["key"]: r["value"] for r in log.table("run_params").collect()}
    assert params["maxIter"] == "5" and params["stepSize"] == "0.1"


def test_saved_model_is_evaluated(spark, trained, tmp_path):
    df, _, root, result = trained
    got = jobs.evaluate(spark, str(root / "model"), df, "credit_risk", str(tmp_path / "eval"))
    assert 0.0 <= got.metrics["accuracy_test"] <= 1.0
    row = spark.read.parquet(str(tmp_path / "eval" / "confusion")).first()
    assert sum(row) == 100
    for name in ("class_report", "roc", "pr", "importance"):
        assert spark.read.parquet(str(tmp_path / "eval" / name)).count() > 0


# Two applications in feature order.
BATCH = [
    (2, 24, 3, 2, 3500, 4, 3, 3, 2, 1, 2, 3, 45, 3, 1, 1, 2, 1, 1, 1),
    (1, 12, 2, 1, 1500, 2, 2, 2, 3, 1, 1, 2, 30, 3, 2, 2, 3, 1, 2, 1),
]


def test_batch_scoring_job(spark, trained, tmp_path):
    _, _, root, _ = trained
    schema = ", ".join(f"{c} long" for c in FEATURES)
    batch = spark.createDataFrame(BATCH, schema)
    tables.write_table(batch, str(tmp_path / "in.csv"))
    out = jobs.score_table(spark, str(tmp_path / "in.csv"), str(root / "model"), str(tmp_path / "out.csv"), batch.schema)
    assert out.count() == 2
    assert out.columns == [*FEATURES, "prediction"]
    assert {r["prediction"] for r in out.collect()} <= {0, 1}


def test_form_scoring_fills_defaults(spark, trained):
    _, _, _, result = trained
    forms = spark.createDataFrame([("f1", 2.0, 24.0, 3.0, 3500.0, 45.0, 2.0, 4.0)],
        "form string, status double, duration double, credit_history double, amount double, age double, purpose double, savings double")
    defaults = {f.name: f.default for f in CREDIT.fields if f.default is not None}
    row = models.score_forms(forms, result.model, defaults, FEATURES).first()
    assert row["verdict"] in ("approve", "reject") and row["form"] == "f1"
    assert row["housing"] == 2.0 and row["foreign_worker"] == 2.0


def test_scored_records(spark, trained):
    df, _, _, result = trained
    out = models.score_records(df, result.model)
    off = out.where(F.abs(F.col("probability_good") + F.col("probability_bad") - 1) > 1e-9)
    assert off.count() == 0
    assert {r[0] for r in out.select("risk_level").distinct().collect()} <= {"BAJO", "MEDIO", "ALTO"}
    assert not [c for c in out.columns if c.startswith("num__")]


def test_attributions_add_up_to_the_log_odds(spark, trained):
    df, _, _, result = trained
    stages = result.model.stages
    prepared = stages[1].transform(stages[0].transform(df))
    names = prep.feature_names(type(result.model)(stages[:-1]))
    values, base = attribution.tree_attributions(prepared, stages[-1], names, ["row_key"])
    odds = result.model.transform(df).select(
        "row_key", F.ln(vector_to_array("probability")[1] / vector_to_array("probability")[0]).alias("odds")
    )
    joined = values.join(odds, "row_key").collect()
    assert len(joined) == 100
    for r in joined:
        assert math.isclose(base + sum(r[n] for n in names), r["odds"], abs_tol=1e-6)


def _by_subsets(leaves, row, features):
    """Shapley values of one row from their definition, subset by subset."""
    from itertools import combinations
    from math import factorial

    def value(subset):
        total = 0.0
        for leaf in leaves:
            part = leaf.value
            for j, f in enumerate(map(int, leaf.features)):
                inside = row[f] in leaf.codes[j] if j in leaf.codes else leaf.low[j] < row[f] <= leaf.high[j]
                part *= inside if f in subset else leaf.shares[j]
            total += part
        return total

    out = {}
    for f in features:
        others = [g for g in features if g != f]
        out[f] = sum(
            factorial(size) * factorial(len(others) - size) / factorial(len(features))
            * (value({*chosen, f}) - value(set(chosen)))
            for size in range(len(others) + 1)
            for chosen in combinations(others, size)
        )
    return out


def test_attribution_against_all_subsets(spark, trained):
    df, _, _, result = trained
    stages = result.model.stages
    leaves = attribution.leaves_of(attribution.node_table(spark, stages[-1]), stages[-1].treeWeights)
    used = sorted({int(f) for leaf in leaves for f in leaf.features})[:6]
    keep = [leaf for leaf in leaves if set(map(int, leaf.features)) <= set(used)]
    matrix = np.array(vectors(stages[1].transform(stages[0].transform(df.limit(3)))))
    got = attribution.attribute(matrix, keep)
    for row, values in zip(matrix, got, strict=True):
        for f, want in _by_subsets(keep, row, used).items():
            assert math.isclose(values[f], want, abs_tol=1e-9)


@pytest.mark.parametrize("m", [1, 2, 5, 9, 12])
def test_path_values_of_long_paths(m):
    rng = np.random.default_rng(m)
    shares = rng.uniform(1e-6, 1, m)
    inf = np.full(m, np.inf)
    leaf = attribution.Leaf(np.arange(m), np.zeros(m), inf, {}, shares, 1.7)
    hits = rng.random((3, m)) < 0.6
    got = attribution.path_values(hits, shares, 1.7)
    for row, values in zip(hits, got, strict=True):
        want = _by_subsets([leaf], np.where(row, 1.0, -1.0), list(range(m)))
        assert np.allclose(values, [want[f] for f in range(m)], atol=1e-12)
    # A path of 40 features: together the values are the leaf's, less what is expected.
    shares, hits = rng.uniform(0.2, 1, 40), np.ones((1, 40), bool)
    total = attribution.path_values(hits, shares, 2.0).sum()
    assert math.isclose(total, 2.0 - 2.0 * math.prod(shares), abs_tol=1e-9)


def test_deep_forest_attributions_add_up(spark, deep):
    ready, model = deep
    names = [f"f{k}" for k in range(12)]
    assert max(t.depth for t in model.trees) > 12
    values, base = attribution.tree_attributions(ready, model, names, ["id"])
    share = model.transform(ready).select("id", vector_to_array("probability")[1].alias("p"))
    for r in values.join(share, "id").collect():
        assert math.isclose(base + sum(r[n] for n in names), r["p"], abs_tol=1e-9)


@pytest.fixture(scope="module")
def deep(spark):
    """A forest of depth 30 on rows that need deep trees, with a coded feature."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler, VectorIndexer

    cells = [F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(3 if k == 0 else 1000)).cast("double").alias(f"f{k}") for k in range(12)]
    df = spark.range(600).select("id", *cells)
    noisy = F.pmod(F.xxhash64(F.lit("y"), "id"), F.lit(4)) == 0
    df = df.withColumn("y", (((F.col("f1") > 500) != noisy) != (F.col("f0") == 1)).cast("int"))
    df = VectorAssembler(inputCols=[f"f{k}" for k in range(12)], outputCol="raw").transform(df)
    ready = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=4).fit(df).transform(df).cache()
    model = RandomForestClassifier(labelCol="y", numTrees=20, maxDepth=30, seed=1).fit(ready)
    return ready, model


def test_nested_forests(spark, deep):
    from driftwell.operators import forests

    ready, model = deep
    whole = forests.forest_arrays(forests.node_table(spark, model))
    points = [{"numTrees": t, "maxDepth": d} for t in (1, 7, 20) for d in (0, 3, 30)]
    scored = forests.nested_scores(ready, "features", whole, points, ["id"]).collect()
    share = {r["id"]: r["p"] for r in model.transform(ready).select("id", vector_to_array("probability")[1].alias("p")).collect()}
    x = dict(ready.select("id", vector_to_array("features")).collect())
    for r in scored:
        # All trees uncut are the forest itself.
        assert math.isclose(r["shares"][8], share[r["id"]], abs_tol=1e-12)
    for r in scored[:20]:  # cut trees, walked one by one
        for p, got in zip(points, r["shares"], strict=True):
            total = 0.0
            for root in whole.roots[: p["numTrees"]]:
                at = root
                for _ in range(p["maxDepth"]):
                    v = x[r["id"]][whole.feature[at]]
                    left = whole.answers[whole.coded[at] + int(v)] if whole.coded[at] >= 0 else v <= whole.threshold[at]
                    at = whole.left[at] if left else whole.right[at]
                total += whole.share[at]
            assert math.isclose(got, total / p["numTrees"], abs_tol=1e-12)


def test_permutation_importance_finds_the_used_feature(spark):
    df = spark.range(2000).select(
        "id", (F.col("id") % 7).cast("double").alias("used"), (F.col("id") % 11).cast("double").alias("unused"),
        (F.col("id") % 7 > 3).cast("int").alias("y"),
    )
    rows = attribution.permutation_importance(
        df, ["used", "unused"], lambda d: models.scorecard(d, -3.5, {"used": 1.0}), "y", "score", ["id"]
    ).collect()
    got = {r["feature"]: r["importance"] for r in rows}
    assert got["used"] > 0.4 and got["unused"] == 0.0


def test_permutation_importance_numbers_rows_once(spark, monkeypatch):
    from driftwell.operators import perturb
    from driftwell.operators.quality import auc

    checked, check = [], perturb.require_row_key
    monkeypatch.setattr(perturb, "require_row_key", lambda *a: checked.append(1) or check(*a))
    df = spark.range(500).select(
        "id", F.when(F.col("id") % 9 > 0, F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 11).cast("double").alias("b"),
        (F.col("id") % 7 > 3).cast("int").alias("y"),
    )
    scorer = lambda d: models.scorecard(d, -3.5, {"a": 1.0, "b": 0.1})
    rows = attribution.permutation_importance(df, ["a", "b"], scorer, "y", "score", ["id"]).collect()
    assert len(checked) == 1
    base = auc(scorer(df), "y", "score").first()["auc"]
    for r in rows:
        after = auc(scorer(perturb.permute_columns(df, [r["feature"]], ["id"], "importance")), "y", "score")
        assert r["importance"] == base - after.first()["auc"]
    with pytest.raises(ValueError):
        attribution.permutation_importance(df.union(df), ["a"], scorer, "y", "score", ["id"])


def test_grid_search(spark, credit):
    df = credit.withColumn("credit_risk", (F.col("status") > 2).cast("int"))
    prepared = prep.fit_preprocessor(df, FEATURES)
    grid = {"numTrees": (3, 6), "maxDepth": (2, 4), "minInstancesPerNode": (1, 5)}
    found = models.grid_search(df, prepared, "credit_risk", ["row_key"], grid, folds=3)
    rows = {r["params"]: r["f1"] for r in found.results.collect()}
    assert len(rows) == 8 and max(rows.values()) > 0.8
    assert models.add_predictions(df, found.model).count() == 100
    # Each row is predicted once at each point, and the scores follow from that.
    predicted = found.predictions.toPandas()
    assert len(predicted) == 800 and not predicted.duplicated(["row_key", "params"]).any()
    for name, part in predicted.groupby("params"):
        scores = []
        for _, p in part.groupby("fold"):
            hit = ((p["credit_risk"] == 1) & (p["prediction"] == 1)).sum()
            scores.append(2 * hit / ((p["credit_risk"] == 1).sum() + (p["prediction"] == 1).sum()))
        assert math.isclose(rows[name], np.mean(scores))
    best = max(rows.values())
    forest = found.model.stages[-1]
    chosen = f"maxDepth={forest.getOrDefault('maxDepth')}, minInstancesPerNode={forest.getOrDefault('minInstancesPerNode')}, numTrees={forest.getNumTrees}"
    assert rows[chosen] == best


def test_grid_search_on_a_bounded_sample(spark, credit):
    df = credit.withColumn("credit_risk", (F.col("status") > 2).cast("int"))
    prepared = prep.fit_preprocessor(df, FEATURES)
    found = models.grid_search(df, prepared, "credit_risk", ["row_key"], {"numTrees": (3,)}, folds=2, fit_rows=60)
    assert found.predictions.count() == 100


def test_monitor_job(spark, credit, trained):
    from driftwell.operators import perturb

    _, _, _, result = trained
    calm = jobs.monitor(credit, credit, ["row_key", "credit_risk"], result.model)
    assert calm.rollup.first()["status"] == "ESTABLE"
    assert not calm.predictions.first()["drift"]
    crisis = perturb.perturb(credit, perturb.CRISIS, ["row_key"])
    loud = jobs.monitor(credit, crisis, ["row_key", "credit_risk"], result.model)
    assert loud.rollup.first()["status"] == "CRÍTICO"
    drifted = {r["column"] for r in loud.report.where("drift").collect()}
    assert {"amount", "age", "savings", "property"} <= drifted
    assert loud.scores.count() == 200
