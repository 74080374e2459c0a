"""Quality of a scored table: confusion, class metrics, AUC, curves, cost sweep."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.functions import no_nan
from driftwell.operators.ordered import (
    PairFacts,
    pair_walk,
    ranged_counts,
    running_counts,
)
from driftwell.session import scratch_path

# Cost of a missed positive and of a false alarm, and the sweep grid.
COST_FN = 5.0
COST_FP = 1.0
SWEEP_LO, SWEEP_HI, SWEEP_STEPS = 0.1, 0.9, 33

# Names of the logged metrics.
METRICS = (
    "f1_score_test",
    "accuracy_test",
    "precision_test",
    "recall_test",
    "auc_test",
    "bad_rate_test",
)


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """One row: tn, fp, fn, tp."""
    y, p = F.col(label), F.col(predicted)
    return df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def class_metrics(counts: DataFrame) -> DataFrame:
    """Metrics of class 1 from a confusion row; a zero denominator gives 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *[c for c in counts.columns if c not in ("tp", "fp", "fn", "tn")],
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ratio(tn + fn, tp + tn + fp + fn).alias("bad_rate"),
    )


def class_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """(class, precision, recall, f1, support) per class, then accuracy and averages.

    The pair counts are few (classes squared), whatever the size of the table.
    """
    pairs = (
        df.groupBy(F.col(label).cast("int").alias("y"), F.col(predicted).cast("int").alias("p"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("y", "p", "n", F.stack(F.lit(2), F.lit("truth"), F.col("y"), F.lit("given"), F.col("p")).alias("role", "class"))
    )
    hit = F.when(F.col("y") == F.col("p"), F.col("n"))
    per_class = pairs.groupBy("class").agg(
        F.coalesce(F.sum(F.when(F.col("role") == "truth", hit)), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(F.col("role") == "truth", F.col("n"))), F.lit(0)).alias("support"),
        F.coalesce(F.sum(F.when(F.col("role") == "given", F.col("n"))), F.lit(0)).alias("given"),
    )
    measured = per_class.select(
        F.col("class").cast("string").alias("class"),
        ratio(F.col("tp"), F.col("given")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("given") + F.col("support")).alias("f1"),
        "support",
        "tp",
    )
    weight = F.col("support").cast("double")
    wide = measured.agg(
        *[F.avg(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")],
        *[
            ratio(F.sum(F.col(m) * weight), F.sum(weight)).alias(f"weighted_{m}")
            for m in ("precision", "recall", "f1")
        ],
        ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.sum("support").alias("support"),
    )
    cells: list[Column] = []
    for kind in ("macro", "weighted"):
        cells += [F.lit(f"{kind} avg")]
        cells += [F.col(f"{kind}_{m}") for m in ("precision", "recall", "f1")]
    cells += [F.lit("accuracy"), F.lit(None).cast("double"), F.lit(None).cast("double"), F.col("accuracy")]
    summary = wide.select(
        F.stack(F.lit(3), *cells).alias("class", "precision", "recall", "f1"), "support"
    )
    return measured.drop("tp").unionByName(summary)


def unranked_rows(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row (n_rows, n_ranked, n_unlabelled, n_unscored): what the ranking measures
    leave out. A row without both counts as unlabelled."""
    labelled = F.coalesce(F.col(label).isin(0, 1), F.lit(False))
    scored = no_nan(F.col(score)).isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(labelled & scored).alias("n_ranked"),
        F.count_if(~labelled).alias("n_unlabelled"),
        F.count_if(labelled & ~scored).alias("n_unscored"),
    )


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row (n_1, n_0, auc): the share of pairs ranked right, ties half.

    With one class only the value is .5.
    """
    counts, facts = _score_counts(df, label, score)
    walked = pair_walk(counts.withColumnRenamed("range", "slot"), facts)
    pairs = F.col("n_1").cast("double") * F.col("n_0")
    # A table without rows still gets its row.
    return walked.agg(
        F.coalesce(F.first("n_a"), F.lit(0)).alias("n_1"),
        F.coalesce(F.first("n_b"), F.lit(0)).alias("n_0"),
        F.first("u").alias("u"),
    ).select("n_1", "n_0", F.coalesce(F.try_divide("u", pairs), F.lit(0.5)).alias("auc"))


def _score_counts(df: DataFrame, label: str, score: str) -> tuple[DataFrame, PairFacts]:
    """(range, value, n_a, n_b) of label 1 and 0 per distinct score.

    Rows that can be ranked have label 0 or 1 and a score; NaN is a missing score. The
    table is passed over once, and a row's score is computed once; sizes and ranges follow
    from the written counts.
    """
    y = F.col(label)
    tallies = df.groupBy(F.col(score).alias("value")).agg(
        F.count_if(y == 1).alias("n_a"), F.count_if(y == 0).alias("n_b")
    )
    path = scratch_path(df.sparkSession, "scores")
    tallies.write.parquet(path)
    # Not before: a filter on the score would go below the grouping and compute it again.
    ranked = df.sparkSession.read.parquet(path).withColumn("value", no_nan(F.col("value"))).where(
        F.col("value").isNotNull() & (F.col("n_a") + F.col("n_b") > 0)
    )
    return ranged_counts(ranked, score)


def roc_points(df: DataFrame, label: str, score: str, drop_collinear: bool = True) -> DataFrame:
    """(threshold, fp, tp, fpr, tpr), one row per kept score.

    ``drop_collinear`` leaves out inner points where the curve goes straight on, as
    plotting needs. The start (0, 0) above the highest score is row threshold = inf.
    """
    counts, facts = _score_counts(df, label, score)
    n1, n0 = facts.n_a[score], facts.n_b[score]
    run = running_counts(counts)
    if drop_collinear:
        turns = (F.col("n_a") != F.col("next_a")) | (F.col("n_b") != F.col("next_b"))
        run = run.where(F.col("first") | F.col("next_a").isNull() | turns)
    points = run.select(
        F.col("value").alias("threshold"), F.col("run_b").alias("fp"), F.col("run_a").alias("tp")
    )
    start = df.sparkSession.createDataFrame(
        [(float("inf"), 0, 0)], "threshold double, fp long, tp long"
    )
    return points.unionByName(start).select(
        "threshold",
        "fp",
        "tp",
        ratio(F.col("fp"), F.lit(n0)).alias("fpr"),
        ratio(F.col("tp"), F.lit(n1)).alias("tpr"),
    )


def pr_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, precision, recall) per distinct score, and the end (1, 0) at inf."""
    counts, facts = _score_counts(df, label, score)
    run = running_counts(counts)
    recall = (
        ratio(F.col("run_a"), F.lit(facts.n_a[score])) if facts.n_a[score] else F.lit(1.0)
    )
    points = run.select(
        F.col("value").alias("threshold"),
        ratio(F.col("run_a"), F.col("run_a") + F.col("run_b")).alias("precision"),
        recall.alias("recall"),
    )
    end = df.sparkSession.createDataFrame(
        [(float("inf"), 1.0, 0.0)], "threshold double, precision double, recall double"
    )
    return points.unionByName(end)


def sweep_thresholds(lo=SWEEP_LO, hi=SWEEP_HI, steps=SWEEP_STEPS) -> list[float]:
    step = (hi - lo) / (steps - 1)
    return [*[lo + i * step for i in range(steps - 1)], hi]


def cost_sweep(
    df: DataFrame,
    label: str,
    score: str,
    thresholds: Sequence[float] | None = None,
    cost_fn: float = COST_FN,
    cost_fp: float = COST_FP,
) -> DataFrame:
    """(threshold, fp, fn, cost) for every threshold, from one pass over the table.

    A row only has to say how many thresholds its score reaches; the running sums
    go over that handful of steps, not over scores.
    """
    grid = sorted(thresholds or sweep_thresholds())
    reached = sum(((F.col(score) >= F.lit(t)).cast("int") for t in grid[1:]), (F.col(score) >= F.lit(grid[0])).cast("int"))
    rows = df.withColumn(score, no_nan(F.col(score))).where(
        F.col(label).isin(0, 1) & F.col(score).isNotNull()
    )
    counts = rows.groupBy(reached.alias("step")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    blank = df.sparkSession.createDataFrame(
        [(i, float(t), 0, 0) for i, t in enumerate(grid, start=1)],
        "step int, threshold double, pos long, neg long",
    )
    stepped = (
        counts.select("step", F.lit(None).cast("double").alias("threshold"), "pos", "neg")
        .unionByName(blank)
        .groupBy("step")
        .agg(F.max("threshold").alias("threshold"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    order = Window.orderBy("step")  # one row per threshold only
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return (
        stepped.withColumn("fn", F.coalesce(F.sum("pos").over(below), F.lit(0)))
        .withColumn("fp", F.sum("neg").over(onward))
        .where(F.col("threshold").isNotNull())
        .select("threshold", "fp", "fn", (cost_fn * F.col("fn") + cost_fp * F.col("fp")).alias("cost"))
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    """One row: the cheapest threshold, the lowest one on a tie."""
    return sweep.agg(F.min(F.struct("cost", "threshold")).alias("best")).select(
        "best.threshold", "best.cost"
    )


def metric_record(df: DataFrame, label: str, predicted: str, score: str) -> DataFrame:
    """One row with the six test metrics."""
    measured = class_metrics(confusion(df, label, predicted))
    ranked = auc(df, label, score).select("auc")
    # Two one-row tables laid over each other.
    return (
        measured.unionByName(ranked, allowMissingColumns=True)
        .agg(*[F.max(c).alias(c) for c in [*measured.columns, "auc"]])
        .select(
            F.col("f1").alias("f1_score_test"),
            F.col("accuracy").alias("accuracy_test"),
            F.col("precision").alias("precision_test"),
            F.col("recall").alias("recall_test"),
            F.col("auc").alias("auc_test"),
            F.col("bad_rate").alias("bad_rate_test"),
        )
    )


def model_table(scored: Mapping[str, tuple[DataFrame, str, str, str]]) -> DataFrame:
    """Rows (model, roc_auc, accuracy, precision, recall, f1), best F1 then AUC first.

    ``scored`` maps a model name to (table, label, prediction, score).
    """
    rows = None
    for name, (df, label, predicted, score) in scored.items():
        m = metric_record(df, label, predicted, score).select(
            F.lit(name).alias("model"),
            F.col("auc_test").alias("roc_auc"),
            F.col("accuracy_test").alias("accuracy"),
            F.col("precision_test").alias("precision"),
            F.col("recall_test").alias("recall"),
            F.col("f1_score_test").alias("f1"),
        )
        rows = m if rows is None else rows.unionByName(m)
    return rows.orderBy(F.desc("f1"), F.desc("roc_auc"), "model")


def top_features(importance: DataFrame, n: int = 10) -> DataFrame:
    """The n most important rows of (feature, importance)."""
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def attribution_importance(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """(feature, importance): mean absolute attribution; {attribution column: feature}."""
    wide = df.agg(*[F.avg(F.abs(F.col(c))).alias(f"a{i}") for i, c in enumerate(columns)])
    cells: list[Column] = []
    for i, name in enumerate(columns.values()):
        cells += [F.lit(name), F.col(f"a{i}")]
    return wide.select(F.stack(F.lit(len(columns)), *cells).alias("feature", "importance"))
