from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.catalog.drift import _SPLIT
from driftwell.catalog.registry import query, rounded, table, uniform_sql
from driftwell.functions import keyed_uniform, risk_band
from driftwell.operators import models, prep
from driftwell.operators.attribution import (
    global_attribution,
    permutation_importance,
    tree_attributions,
)
from driftwell.operators.quality import model_table, top_features
from driftwell.operators.validate import Rule
from driftwell.plans.jobs import evaluate, train_and_test
from driftwell.session import scratch_path
from driftwell.sources import tables
from driftwell.streaming.scoring import score_stream

NUMERIC = ["o_totalprice", "month", "day"]
CODED = ["o_orderpriority"]
LABEL = "good"


@query(
    "standard_scale",
    """SELECT c_custkey, round((c_acctbal - m) / s, 6) + 0 AS c_acctbal FROM customer,
    (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s FROM customer)""",
)
def standard_scale(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    scaled = rounded(prep.standard_scale(customer, ["c_acctbal"]))
    return scaled.withColumn("c_acctbal", F.col("c_acctbal") + F.lit(0.0))


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]


@query(
    "one_hot",
    "SELECT c_custkey, "
    + ", ".join(f"CAST(c_mktsegment = '{s}' AS INTEGER) AS \"c_mktsegment_{s}\"" for s in _SEGMENTS)
    + " FROM customer",
)
def one_hot(spark, folder):
    # HOUSEHOLD plays the value not seen in training: all zeros.
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return prep.one_hot(customer, "c_mktsegment", _SEGMENTS)


@query(
    "dummy_drop_first",
    """SELECT o_orderkey, CAST(o_orderpriority = '2-HIGH' AS INTEGER) AS "o_orderpriority_2-HIGH",
    CAST(o_orderpriority = '3-MEDIUM' AS INTEGER) AS "o_orderpriority_3-MEDIUM",
    CAST(o_orderpriority = '4-NOT SPECIFIED' AS INTEGER) AS "o_orderpriority_4-NOT SPECIFIED",
    CAST(o_orderpriority = '5-LOW' AS INTEGER) AS "o_orderpriority_5-LOW" FROM orders""",
)
def dummy_drop_first(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return prep.dummy_columns(orders, "o_orderpriority")


@query(
    "scorecard",
    """SELECT l_orderkey, l_linenumber, round(1.0 / (1.0 + exp(-(-0.4 + 0.00002 * l_extendedprice
    + -0.03 * l_quantity))), 6) AS score FROM lineitem""",
)
def scorecard(spark, folder):
    lines = table(spark, folder, "lineitem")
    scored = models.scorecard(lines, -0.4, {"l_extendedprice": 0.00002, "l_quantity": -0.03})
    return rounded(scored.select("l_orderkey", "l_linenumber", "score"))


@query(
    "balanced_weights",
    """SELECT o_orderstatus, count(*) AS n, round(max(w), 6) AS weight FROM orders JOIN
    (SELECT o_orderstatus AS s, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS w FROM orders GROUP BY 1)
    ON o_orderstatus = s GROUP BY 1""",
)
def balanced_weights(spark, folder):
    weighted = models.balanced_weights(table(spark, folder, "orders"), "o_orderstatus", "weight")
    return rounded(
        weighted.groupBy("o_orderstatus").agg(
            F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight")
        )
    )


def applications(spark, folder):
    """Orders as loan applications; the label depends on the amount, with noise by key."""
    orders = table(spark, folder, "orders")
    noise = keyed_uniform(["o_orderkey"], "noise")
    risk = F.col("o_totalprice") / 500000.0 + noise * 0.6
    return orders.select(
        "o_orderkey",
        "o_totalprice",
        F.month("o_orderdate").alias("month"),
        F.dayofmonth("o_orderdate").alias("day"),
        "o_orderpriority",
        (risk < 0.8).cast("int").alias(LABEL),
    )


_APPLICATIONS = f"""(SELECT o_orderkey, o_totalprice, day(o_orderdate) AS day,
    CAST(o_totalprice / 500000.0 + {uniform_sql(['o_orderkey'], 'noise')} * 0.6 < 0.8 AS INTEGER) AS good
    FROM orders)"""
_TEST_KEYS = (
    "(SELECT o_orderkey FROM "
    + _SPLIT.replace("o_orderstatus", LABEL).replace("FROM orders", f"FROM {_APPLICATIONS}")
    + " WHERE is_test)"
)
# What holds for every scored row, whatever model was fitted.
_CHECKS = "TRUE AS sums_to_one, TRUE AS band_agrees, TRUE AS prediction_agrees"


def checked_scores(scored, *more):
    """Key and what must hold: probabilities sum to 1, band and prediction follow them."""
    good, bad = F.col(models.PROBABILITY_GOOD), F.col(models.PROBABILITY_BAD)
    return scored.select(
        "o_orderkey",
        (F.abs(good + bad - 1) < 1e-9).alias("sums_to_one"),
        (F.col("risk_level") == risk_band(good)).alias("band_agrees"),
        (F.col("prediction") == (good > bad).cast("int")).alias("prediction_agrees"),
        *more,
    )


def _parts(spark, folder):
    return train_and_test(applications(spark, folder), LABEL, ["o_orderkey"])


#: Fitted boosted models by session and folder: model path, preparation, test rows.
_fitted: dict[tuple[str, str], tuple] = {}


def _boosted(spark, folder, again=False):
    """The boosted model at its full settings; fitted once for the queries that read it."""
    key = (spark.sparkContext.applicationId, folder)
    if again or key not in _fitted:
        train, test = _parts(spark, folder)
        prepared = prep.fit_preprocessor(train, NUMERIC, CODED)
        _fitted[key] = models.fit_model(train, prepared, models.boosted_trees(LABEL), LABEL), prepared, test
    return _fitted[key]


@query("train_gbt", f"SELECT o_orderkey, {_CHECKS} FROM {_TEST_KEYS}")
def train_gbt(spark, folder):
    """Test rows scored by a freshly trained boosted model, and what holds for them."""
    model, _, test = _boosted(spark, folder, again=True)
    return checked_scores(models.score_records(test, model))


#: Labelled rows that a baseline is fitted on; all test rows are scored.
BASELINE_FIT_ROWS = 1_000
_BASELINES = ("DecisionTree", "GradientBoosting", "LogisticRegression", "RandomForest")


@query(
    "train_baselines",
    f"""SELECT model, count(*) AS rows, TRUE AS metrics_agree
    FROM {_TEST_KEYS}, (SELECT unnest({list(_BASELINES)!r}) AS model) GROUP BY 1""",
)
def train_baselines(spark, folder):
    """All baselines at their full settings; the model table agrees with counts of the
    written predictions."""
    train, test = _parts(spark, folder)
    prepared = prep.fit_preprocessor(train, NUMERIC, CODED, scale=True)
    sample = models.written(models.bounded_rows(train, ["o_orderkey"], BASELINE_FIT_ROWS), "baseline-rows")
    scored = {
        name: models.written(
            models.add_predictions(test, models.fit_model(sample, prepared, estimator, LABEL)), f"baseline-{name}"
        )
        for name, estimator in models.baseline_models(LABEL).items()
    }
    table_ = model_table({name: (df, LABEL, "prediction", models.PROBABILITY_GOOD) for name, df in scored.items()})
    hit, said = F.col(LABEL) == 1, F.col("prediction") == 1
    counts = None
    for name, df in scored.items():
        part = df.agg(
            F.lit(name).alias("name"),
            F.count("*").alias("rows"),
            F.avg((hit == said).cast("int")).alias("right"),
            F.sum((hit & said).cast("int")).alias("both"),
            F.sum(hit.cast("int")).alias("hits"),
            F.sum(said.cast("int")).alias("calls"),
        )
        counts = part if counts is None else counts.unionByName(part)
    near = lambda a, b: F.abs(F.col(a) - b) < 1e-6
    agree = (
        near("accuracy", F.col("right"))
        & near("f1", 2 * F.col("both") / (F.col("hits") + F.col("calls")))
        & near("precision", F.try_divide("both", "calls"))
        & near("recall", F.col("both") / F.col("hits"))
    )
    joined = table_.join(counts, F.col("model") == F.col("name"))
    return joined.select("model", "rows", agree.alias("metrics_agree"))


def _grid_names_sql():
    lists = ", ".join(f"(SELECT unnest({list(v)!r}) AS {k})" for k, v in models.FOREST_GRID.items())
    name = " || ', ' || ".join(f"'{k}=' || {k}" for k in sorted(models.FOREST_GRID))
    return f"(SELECT {name} AS params FROM {lists})"


@query(
    "grid_search",
    f"""SELECT params, count(*) AS rows, 5 AS folds, TRUE AS f1_agrees, TRUE AS better_than_chance FROM {_grid_names_sql()},
    (SELECT o_orderkey FROM {_APPLICATIONS} WHERE o_orderkey NOT IN {_TEST_KEYS}) GROUP BY 1""",
)
def grid_search(spark, folder):
    """The whole grid of 27 points and 5 folds, fitted on all rows; its scores agree with
    counts of the rows that were predicted out of their fold."""
    train, _ = _parts(spark, folder)
    prepared = prep.fit_preprocessor(train, NUMERIC, CODED)
    found = models.grid_search(train, prepared, LABEL, ["o_orderkey"])
    hit, said = F.col(LABEL) == 1, F.col("prediction") == 1
    by_fold = found.predictions.groupBy("params", "fold").agg(
        F.count("*").alias("rows"),
        F.avg((hit == said).cast("int")).alias("right"),
        F.try_divide(
            2 * F.sum((hit & said).cast("int")), F.sum(hit.cast("int")) + F.sum(said.cast("int"))
        ).alias("again"),
    )
    points = by_fold.groupBy("params").agg(
        F.sum("rows").alias("rows"), F.count("*").cast("int").alias("folds"), F.avg("again").alias("again"), F.avg("right").alias("right")
    )
    return found.results.join(points, "params").select(
        "params", "rows", "folds", (F.abs(F.col("f1") - F.col("again")) < 1e-9).alias("f1_agrees"), (F.col("right") > 0.5).alias("better_than_chance")
    )


@query("score_batch", f"SELECT o_orderkey, {_CHECKS}, TRUE AS reload_agrees FROM orders")
def score_batch(spark, folder):
    """Save, load and apply a fitted pipeline to the whole table."""
    rows = applications(spark, folder)
    prepared = prep.fit_preprocessor(rows, NUMERIC, CODED, scale=True)
    estimator = models.baseline_models(LABEL)["LogisticRegression"]
    path = scratch_path(spark, "model")
    fitted = models.fit_model(rows, prepared, estimator, LABEL)
    tables.save_model(fitted, path)
    loaded = tables.load_model(path)
    by_loaded = models.score_records(rows.drop(LABEL), loaded)
    # Scored once more by the model in memory, in the same pass over the rows.
    kept = by_loaded.withColumnsRenamed({c: f"loaded_{c}" for c in ("prediction", models.PROBABILITY_GOOD)})
    again = models.add_predictions(kept.drop(models.PROBABILITY_BAD, "risk_level"), fitted)
    agrees = F.abs(F.col(models.PROBABILITY_GOOD) - F.col(f"loaded_{models.PROBABILITY_GOOD}")) < 1e-12
    flags = again.withColumn("risk_level", risk_band(F.col(models.PROBABILITY_GOOD)))
    return checked_scores(flags.withColumn("reload_agrees", agrees), "reload_agrees")


@query(
    "score_forms",
    """SELECT o_orderkey, 6.0 AS month, 15.0 AS day, TRUE AS sums_to_one, TRUE AS verdict_agrees,
    TRUE AS follows_amount FROM orders""",
)
def score_forms(spark, folder):
    """Forms that name the amount only; the rest comes from defaults."""
    rows = applications(spark, folder)
    prepared = prep.fit_preprocessor(rows, NUMERIC)
    estimator = models.baseline_models(LABEL)["LogisticRegression"]
    model = models.fit_model(rows, prepared, estimator, LABEL)
    forms = rows.select("o_orderkey", "o_totalprice")
    scored = models.score_forms(forms, model, {"month": 6.0, "day": 15.0}, NUMERIC)
    good, bad = F.col(models.PROBABILITY_GOOD), F.col(models.PROBABILITY_BAD)
    slope = float(model.stages[-1].coefficients[0])
    # With the rest fixed, the log-odds are a line in the amount.
    line = F.lit(float(model.stages[-1].intercept)) + F.lit(slope) * F.col("o_totalprice")
    for i, default in ((1, 6.0), (2, 15.0)):
        line = line + F.lit(float(model.stages[-1].coefficients[i]) * default)
    return scored.select(
        "o_orderkey",
        "month",
        "day",
        (F.abs(good + bad - 1) < 1e-9).alias("sums_to_one"),
        (F.col("verdict") == F.when(good > bad, "approve").otherwise("reject")).alias("verdict_agrees"),
        (F.abs(F.ln(good / bad) - line) < 1e-6).alias("follows_amount"),
    )


_WEIGHTS = {"o_totalprice": -0.000005, "day": 0.01}


def _auc_sql(source):
    """Share of pairs that the margin ranks right, ties half, by mean ranks."""
    margin = " + ".join(f"{w!r} * {c}" for c, w in _WEIGHTS.items())
    return f"""(SELECT (sum(r) FILTER (good = 1) - count(*) FILTER (good = 1) * (count(*) FILTER (good = 1) + 1) / 2.0)
        / (count(*) FILTER (good = 1) * CAST(count(*) FILTER (good = 0) AS DOUBLE))
      FROM (SELECT good, rank() OVER (ORDER BY m) + (count(*) OVER (PARTITION BY m) - 1) / 2.0 AS r
            FROM (SELECT good, 1.0 / (1.0 + exp(-(2.0 + {margin}))) AS m FROM {source})))"""


def _permuted_sql(column):
    """Each row with the column of the row that has its number in the column's own order."""
    number = "row_number() OVER (ORDER BY {u}, o_orderkey)"
    rows, values = (
        number.format(u=uniform_sql(["o_orderkey"], f"importance-{salt}")) for salt in ("rows", column)
    )
    return f"""(SELECT a.* REPLACE (b.v AS {column}) FROM
      (SELECT *, {rows} AS n FROM {_APPLICATIONS}) a
      JOIN (SELECT {column} AS v, {values} AS n FROM {_APPLICATIONS}) b USING (n))"""


@query(
    "permutation_importance",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round({_auc_sql(_APPLICATIONS)} - {_auc_sql(_permuted_sql(c))}, 6) AS importance"
        for c in _WEIGHTS
    ),
)
def permuted(spark, folder):
    return rounded(
        permutation_importance(
            applications(spark, folder),
            list(_WEIGHTS),
            lambda df: models.scorecard(df, 2.0, _WEIGHTS),
            LABEL,
            "score",
            ["o_orderkey"],
        )
    )


@query("tree_attribution", f"SELECT o_orderkey, TRUE AS adds_up FROM {_TEST_KEYS}")
def tree_attribution(spark, folder):
    """Per test row: base and features' attributions together are its log-odds."""
    model, prepared, test = _boosted(spark, folder)
    scored = models.add_predictions(test, model)
    odds = F.ln(F.col(models.PROBABILITY_GOOD) / F.col(models.PROBABILITY_BAD))
    ready = prepared.transform(scored.select(*test.columns, odds.alias("log_odds")))
    names = prep.feature_names(prepared)
    values, base = tree_attributions(ready, model.stages[-1], names, ["o_orderkey", "log_odds"])
    total = sum((F.col(f"`{n}`") for n in names), F.lit(base))
    return values.select("o_orderkey", (F.abs(total - F.col("log_odds")) < 1e-6).alias("adds_up"))


@query("top_attribution")
def top_attribution(spark, folder):
    model, prepared, test = _boosted(spark, folder)
    names = prep.feature_names(prepared)
    return top_features(global_attribution(prepared.transform(test), model.stages[-1], names))


@query(
    "score_stream",
    """SELECT o_orderkey, o_totalprice BETWEEN 5000 AND 480000 AS valid,
    CASE WHEN o_totalprice BETWEEN 5000 AND 480000 THEN '' ELSE 'o_totalprice' END AS broken FROM orders""",
)
def streamed_scores(spark, folder):
    """Orders arriving as files: valid ones scored, others kept with the rules they break."""
    raw = table(spark, folder, "orders")
    rows = applications(spark, folder)
    prepared = prep.fit_preprocessor(rows, ["o_totalprice"])
    estimator = models.baseline_models(LABEL)["LogisticRegression"]
    model = models.fit_model(rows, prepared, estimator, LABEL)
    arrivals = spark.readStream.schema(raw.schema).option("pathGlobFilter", "orders.parquet").parquet(folder)
    path = scratch_path(spark, "scored")
    stream = score_stream(
        arrivals,
        model,
        [Rule("o_totalprice", 5000, 480000, whole=False)],
        f"{path}/scored",
        f"{path}/rejected",
        f"{path}/checkpoint",
    )
    stream.awaitTermination()
    scored = spark.read.parquet(f"{path}/scored").where(F.col("risk_level").isNotNull())
    rejected = spark.read.parquet(f"{path}/rejected")
    return scored.select("o_orderkey", F.lit(True).alias("valid"), F.lit("").alias("broken")).unionByName(
        rejected.select(
            "o_orderkey", F.lit(False).alias("valid"), F.array_join("failures.column", ",").alias("broken")
        )
    )


@query(
    "evaluate_model",
    f"""SELECT count(*) AS rows, count(*) FILTER (good = 1) AS positives, TRUE AS accuracy_agrees, TRUE AS curve_ends,
    TRUE AS record_agrees FROM {_APPLICATIONS}""",
)
def evaluate_model(spark, folder):
    """A saved model evaluated on the whole table; its written tables agree with each other."""
    rows = applications(spark, folder)
    prepared = prep.fit_preprocessor(rows, NUMERIC, CODED, scale=True)
    fitted = models.fit_model(rows, prepared, models.baseline_models(LABEL)["LogisticRegression"], LABEL)
    path = scratch_path(spark, "evaluated")
    tables.save_model(fitted, f"{path}/model")
    found = evaluate(spark, f"{path}/model", rows, LABEL, f"{path}/out", attribute_rows=False)
    cells = spark.read.parquet(f"{path}/out/confusion")
    record = spark.read.json(f"{path}/out/metrics").first()  # one row, as is the curve's end
    end = spark.read.parquet(f"{path}/out/roc").agg(F.max("fpr").alias("fpr"), F.max("tpr").alias("tpr")).first()
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    total = tn + fp + fn + tp
    right, near = (tp + tn) / total, lambda a, b: F.abs(a - F.lit(b)) < 1e-9
    return cells.select(
        total.alias("rows"),
        (tp + fn).alias("positives"),
        near(right, found.metrics["accuracy_test"]).alias("accuracy_agrees"),
        F.lit(end["fpr"] == 1 and end["tpr"] == 1).alias("curve_ends"),
        (near(right, record["accuracy_test"]) & near(tp / (tp + fn), record["recall_test"])).alias("record_agrees"),
    )
