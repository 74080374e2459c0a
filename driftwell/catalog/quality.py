from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.catalog.registry import query, rounded, table
from driftwell.functions import risk_band, verdict
from driftwell.operators import quality
from driftwell.operators.models import scorecard

# Fixed scorecard over order lines; the truth is whether the line was returned late.
WEIGHTS = {"l_extendedprice": 0.00002, "l_quantity": -0.03, "l_discount": 4.0}
_SCORES = """(SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred FROM
  (SELECT CASE WHEN l_returnflag = 'R' OR l_extendedprice > 70000 THEN 1 ELSE 0 END AS y,
     round(1.0 / (1.0 + exp(-(-0.4 + 0.00002 * l_extendedprice + -0.03 * l_quantity + 4.0 * l_discount))), 4) AS score
   FROM lineitem))"""
_COUNTS = f"""(SELECT count(*) FILTER (y = 0 AND pred = 0) AS tn, count(*) FILTER (y = 0 AND pred = 1) AS fp,
  count(*) FILTER (y = 1 AND pred = 0) AS fn, count(*) FILTER (y = 1 AND pred = 1) AS tp FROM {_SCORES})"""
_METRICS = """coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0.0) AS accuracy,
  coalesce(tp / nullif(tp + fp, 0), 0.0) AS "precision", coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1,
  coalesce((tn + fn) / nullif(tp + tn + fp + fn, 0), 0.0) AS bad_rate"""


def four_places(share):
    """A share cut to four places, half up, in double arithmetic: rounding by decimals is
    most of a scan's time."""
    return F.when(F.isnan(share), share).otherwise(F.floor(share * 10000.0 + 0.5) / 10000.0)


def scored_lines(spark, folder):
    lines = table(spark, folder, "lineitem")
    truth = (F.col("l_returnflag") == "R") | (F.col("l_extendedprice") > 70000)
    scored = scorecard(lines, -0.4, WEIGHTS).select(
        truth.cast("int").alias("y"), four_places(F.col("score")).alias("score")
    )
    return scored.withColumn("pred", (F.col("score") >= 0.5).cast("int"))


@query("confusion", f"SELECT tn, fp, fn, tp FROM {_COUNTS}")
def confusion(spark, folder):
    return quality.confusion(scored_lines(spark, folder), "y", "pred")


@query(
    "class_metrics",
    f"""SELECT round(accuracy, 6) AS accuracy, round("precision", 6) AS "precision", round(recall, 6) AS recall,
    round(f1, 6) AS f1, round(bad_rate, 6) AS bad_rate FROM (SELECT {_METRICS} FROM {_COUNTS})""",
)
def class_metrics(spark, folder):
    return rounded(
        quality.class_metrics(quality.confusion(scored_lines(spark, folder), "y", "pred"))
    )


_PER_CLASS = f"""(SELECT CAST(c AS VARCHAR) AS "class",
   coalesce(hit / nullif(given, 0), 0.0) AS p, coalesce(hit / nullif(support, 0), 0.0) AS r,
   coalesce(2 * hit / nullif(given + support, 0), 0.0) AS f, support, hit
   FROM (SELECT c, count(*) FILTER (y = c AND pred = c) AS hit, count(*) FILTER (pred = c) AS given,
                count(*) FILTER (y = c) AS support FROM {_SCORES}, (SELECT unnest([0, 1]) AS c) GROUP BY c))"""


@query(
    "class_report",
    f"""SELECT "class", round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1, support FROM {_PER_CLASS}
    UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM {_PER_CLASS}
    UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
      round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM {_PER_CLASS}
    UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(hit) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM {_PER_CLASS}""",
)
def class_report(spark, folder):
    return rounded(quality.class_report(scored_lines(spark, folder), "y", "pred"))


_VALUES = f"""(SELECT score AS v, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS q FROM {_SCORES} GROUP BY 1)"""
_AUC = f"""(SELECT CAST(max(n1) AS BIGINT) AS n_1, CAST(max(n0) AS BIGINT) AS n_0,
   coalesce(sum(p * (before + q / 2.0)) / nullif(max(n1) * max(n0), 0), 0.5) AS auc
   FROM (SELECT *, sum(q) OVER (ORDER BY v) - q AS before, sum(p) OVER () AS n1, sum(q) OVER () AS n0 FROM {_VALUES}))"""


@query("auc", f"SELECT n_1, n_0, round(auc, 6) AS auc FROM {_AUC}")
def auc(spark, folder):
    return rounded(quality.auc(scored_lines(spark, folder), "y", "score"))


_RUN = f"""(SELECT *, sum(p) OVER (ORDER BY v DESC) AS tp, sum(q) OVER (ORDER BY v DESC) AS fp,
   lead(p) OVER (ORDER BY v DESC) AS np, lead(q) OVER (ORDER BY v DESC) AS nq,
   row_number() OVER (ORDER BY v DESC) AS k, sum(p) OVER () AS n1, sum(q) OVER () AS n0 FROM {_VALUES})"""


@query(
    "roc_points",
    f"""SELECT v AS threshold, CAST(fp AS BIGINT) AS fp, CAST(tp AS BIGINT) AS tp, round(fp / n0, 6) AS fpr, round(tp / n1, 6) AS tpr
    FROM {_RUN} WHERE k = 1 OR np IS NULL OR np <> p OR nq <> q
    UNION ALL SELECT CAST('inf' AS DOUBLE), 0, 0, 0.0, 0.0""",
)
def roc_points(spark, folder):
    return rounded(quality.roc_points(scored_lines(spark, folder), "y", "score"))


@query(
    "roc_points_all",
    f"""SELECT v AS threshold, CAST(fp AS BIGINT) AS fp, CAST(tp AS BIGINT) AS tp, round(fp / n0, 6) AS fpr, round(tp / n1, 6) AS tpr
    FROM {_RUN} UNION ALL SELECT CAST('inf' AS DOUBLE), 0, 0, 0.0, 0.0""",
)
def roc_points_all(spark, folder):
    return rounded(
        quality.roc_points(scored_lines(spark, folder), "y", "score", drop_collinear=False)
    )


@query(
    "pr_points",
    f"""SELECT v AS threshold, round(tp / (tp + fp), 6) AS "precision", round(tp / n1, 6) AS recall FROM {_RUN}
    UNION ALL SELECT CAST('inf' AS DOUBLE), 1.0, 0.0""",
)
def pr_points(spark, folder):
    return rounded(quality.pr_points(scored_lines(spark, folder), "y", "score"))


_SWEEP = f"""(SELECT t AS threshold, count(*) FILTER (y = 0 AND score >= t) AS fp, count(*) FILTER (y = 1 AND score < t) AS fn,
   5.0::DOUBLE * count(*) FILTER (y = 1 AND score < t) + count(*) FILTER (y = 0 AND score >= t) AS cost
   FROM {_SCORES}, (SELECT unnest([CASE WHEN i = 32 THEN 0.9 ELSE CAST(0.1 AS DOUBLE) + i * ((CAST(0.9 AS DOUBLE) - CAST(0.1 AS DOUBLE)) / 32) END
     FOR i IN range(0, 33)]) AS t) GROUP BY t)"""


@query("cost_sweep", f"SELECT round(threshold, 6) AS threshold, fp, fn, cost FROM {_SWEEP}")
def cost_sweep(spark, folder):
    return rounded(quality.cost_sweep(scored_lines(spark, folder), "y", "score"))


@query(
    "best_threshold",
    f"SELECT round(threshold, 6) AS threshold, cost FROM {_SWEEP} ORDER BY cost, threshold LIMIT 1",
)
def best_threshold(spark, folder):
    sweep = quality.cost_sweep(scored_lines(spark, folder), "y", "score")
    return rounded(quality.best_threshold(sweep))


_RECORD = f"""(SELECT f1 AS f1_score_test, accuracy AS accuracy_test, "precision" AS precision_test, recall AS recall_test,
   auc AS auc_test, bad_rate AS bad_rate_test FROM (SELECT {_METRICS} FROM {_COUNTS}), {_AUC})"""


@query(
    "metric_record",
    f"SELECT {', '.join(f'round({m}, 6) AS {m}' for m in quality.METRICS)} FROM {_RECORD}",
)
def metric_record(spark, folder):
    return rounded(quality.metric_record(scored_lines(spark, folder), "y", "pred", "score"))


_DOCS = """(SELECT doc_id, quality AS y, round(1.0 / (1.0 + exp(-({intercept} + {slope} * n_chars))), 4) AS score
   FROM documents JOIN labels USING (doc_id))"""
CARDS = {"flat": (0.2, 0.0002), "steep": (-0.5, 0.002), "inverse": (1.0, -0.0005)}


def _doc_record(name, intercept, slope):
    scores = f"""(SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred FROM
       {_DOCS.format(intercept=intercept, slope=slope)})"""
    counts = f"""(SELECT count(*) FILTER (y = 0 AND pred = 0) AS tn, count(*) FILTER (y = 0 AND pred = 1) AS fp,
       count(*) FILTER (y = 1 AND pred = 0) AS fn, count(*) FILTER (y = 1 AND pred = 1) AS tp FROM {scores})"""
    rank = f"""(SELECT sum(p * (before + q / 2.0)) / max(n1 * n0) AS auc FROM
       (SELECT *, sum(q) OVER (ORDER BY v) - q AS before, sum(p) OVER () AS n1, sum(q) OVER () AS n0 FROM
        (SELECT score AS v, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS q FROM {scores} GROUP BY 1)))"""
    return f"""SELECT '{name}' AS model, round(auc, 6) AS roc_auc, round(accuracy, 6) AS accuracy,
       round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1
       FROM (SELECT {_METRICS} FROM {counts}), {rank}"""


def scored_documents(spark, folder, intercept, slope):
    docs = table(spark, folder, "documents").select("doc_id", "n_chars")
    joined = docs.join(table(spark, folder, "labels"), "doc_id")
    scored = scorecard(joined, intercept, {"n_chars": slope}).select(
        "doc_id", F.col("quality").alias("y"), F.round("score", 4).alias("score")
    )
    return scored.withColumn("pred", (F.col("score") >= 0.5).cast("int"))


@query("model_table", "\nUNION ALL\n".join(_doc_record(n, *c) for n, c in CARDS.items()))
def model_table(spark, folder):
    return rounded(
        quality.model_table(
            {n: (scored_documents(spark, folder, *c), "y", "pred", "score") for n, c in CARDS.items()}
        )
    )


@query(
    "risk_bands",
    f"""SELECT CASE WHEN score >= 0.7 THEN 'BAJO' WHEN score >= 0.4 THEN 'MEDIO' ELSE 'ALTO' END AS risk_level,
    CASE pred WHEN 1 THEN 'approve' ELSE 'reject' END AS verdict, count(*) AS n, round(avg(score), 6) AS mean_score
    FROM {_SCORES} GROUP BY 1, 2""",
)
def risk_bands(spark, folder):
    scored = scored_lines(spark, folder)
    return rounded(
        scored.groupBy(
            risk_band(F.col("score")).alias("risk_level"), verdict(F.col("pred")).alias("verdict")
        ).agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_score"))
    )


@query(
    "bad_rate",
    f"SELECT round(avg(CASE WHEN pred = 0 THEN 1.0 ELSE 0.0 END), 6) AS bad_rate FROM {_SCORES}",
)
def bad_rate(spark, folder):
    counts = quality.confusion(scored_lines(spark, folder), "y", "pred")
    return rounded(quality.class_metrics(counts).select("bad_rate"))


_CENTRED = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]
_CARD = {"l_extendedprice": 0.00002, "l_quantity": -0.03, "l_discount": 4.0, "l_tax": 1.5}


@query(
    "attribution_importance",
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS feature, round(avg(abs({w} * ({c} - m))), 6) AS importance
        FROM lineitem, (SELECT avg({c}) AS m FROM lineitem)"""
        for c, w in _CARD.items()
    ),
)
def attribution_importance(spark, folder):
    lines = table(spark, folder, "lineitem").select(*_CENTRED)
    means = lines.agg(*[F.avg(c).alias(c) for c in _CENTRED]).first()
    parts = lines.select(*[(F.lit(w) * (F.col(c) - means[c])).alias(c) for c, w in _CARD.items()])
    return rounded(quality.attribution_importance(parts, {c: c for c in _CENTRED}))


@query(
    "top_features",
    """SELECT feature, round(importance, 6) AS importance FROM (
    SELECT 'brand ' || p_brand AS feature, avg(p_retailprice) AS importance FROM part GROUP BY p_brand)
    ORDER BY round(importance, 6) DESC, feature LIMIT 10""",
)
def top_features(spark, folder):
    brands = (
        table(spark, folder, "part")
        .groupBy("p_brand")
        .agg(F.round(F.avg("p_retailprice"), 6).alias("importance"))
    )
    named = brands.select(F.concat(F.lit("brand "), "p_brand").alias("feature"), "importance")
    return quality.top_features(named)
