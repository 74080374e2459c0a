from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.operators import clean as cleaning
from driftwell.operators import drift, models, prep, quality, split
from driftwell.operators.attribution import global_attribution
from driftwell.operators.models import PROBABILITY_GOOD
from driftwell.operators.profile import describe_columns
from driftwell.session import scratch_path
from driftwell.sources import tables
from driftwell.sources.runlog import RunLog, run_record, write_json_record
from driftwell.spec import TableSpec


@dataclass(frozen=True)
class TrainOptions:
    """Settings of one training job; lists left out are taken from the schema."""

    label: str
    key: Sequence[str]
    numeric: Sequence[str] | None = None
    categorical: Sequence[str] | None = None
    test_share: float = 0.2
    scale: bool = False
    booster: Mapping[str, object] = field(default_factory=dict)
    experiment: str = "credit risk boosted trees"
    description: str = "Boosted-tree pipeline for credit risk"
    attribute_rows: bool = True


@dataclass
class TrainResult:
    model: PipelineModel
    metrics: dict[str, float]
    drift: DataFrame
    importance: DataFrame | None
    scored_test: DataFrame
    columns: DataFrame


def clean_table(
    spark: SparkSession,
    source: str,
    target: str,
    spec: TableSpec,
    options: cleaning.CleanOptions | None = None,
    fmt: str | None = None,
) -> cleaning.FittedCleaner:
    """Scan, clean, write and check a table."""
    raw = (
        tables.read_raw_csv(spark, source)
        if source.rstrip("/").endswith(".csv")
        else tables.read_table(spark, source)
    )
    cleaned, fitted = cleaning.clean(raw, spec, options)
    tables.write_table(cleaned, target, fmt)
    # Checked as written, so the cleaning itself runs once.
    written = tables.read_table(spark, target, cleaned.schema, fmt)
    cleaning.require_clean(written, spec.label)
    return fitted


def train_and_test(
    df: DataFrame, label: str, key: Sequence[str], test_share: float = 0.2
) -> tuple[DataFrame, DataFrame]:
    """Stratified parts, written once to the shared folder.

    Training reads them many times; a written table survives lost executors.
    """
    parts = split.stratified_split(df, label, key, test_share)
    path = scratch_path(df.sparkSession, "split")
    # Partitioned by part, so each side reads only its own files.
    parts.withColumn("is_test", F.col("is_test").cast("int")).write.partitionBy(
        "is_test"
    ).parquet(path)
    kept = df.sparkSession.read.parquet(path)
    return (
        kept.where(F.col("is_test") == 0).drop("is_test"),
        kept.where(F.col("is_test") == 1).drop("is_test"),
    )


def train(
    df: DataFrame,
    options: TrainOptions,
    log: RunLog | None = None,
    model_path: str | None = None,
    metrics_path: str | None = None,
) -> TrainResult:
    """Split, compare both parts, prepare, fit, evaluate, attribute, save, log.

    A run that fails is logged as such before its error goes on.
    """
    run = log.start_run(options.experiment, options.description) if log else None
    try:
        return _train(df, options, log, run, model_path, metrics_path)
    except Exception:
        if run:
            log.end_run(run, "FAILED")
        raise


def _train(df, options, log, run, model_path, metrics_path) -> TrainResult:
    spark = df.sparkSession
    skip = [options.label, *options.key]
    found_numeric, found_other = drift.split_columns(df, skip)
    numeric = list(options.numeric if options.numeric is not None else found_numeric)
    categorical = list(options.categorical if options.categorical is not None else found_other)

    fit_rows, test_rows = train_and_test(df, options.label, options.key, options.test_share)
    report = drift.drift_report(drift.pair(fit_rows, test_rows, [*numeric, *categorical]))
    prepared = prep.fit_preprocessor(fit_rows, numeric, categorical, options.scale)
    booster = models.boosted_trees(options.label, **options.booster)
    model = models.fit_model(fit_rows, prepared, booster, options.label)

    scored = models.add_predictions(test_rows, model)
    metrics = metric_values(scored, options.label)
    importance = None
    if options.attribute_rows:
        names = prep.feature_names(prepared)
        importance = global_attribution(prepared.transform(test_rows), model.stages[-1], names)

    if model_path:
        tables.save_model(model, model_path)
        if run:
            write_json_record(spark, run_record(run), f"{model_path.rstrip('/')}_metadata")
    params = {p.name: v for p, v in booster.extractParamMap().items()}
    if metrics_path:
        write_json_record(spark, {**metrics, "params": params}, metrics_path)
    if run:
        run.log_params(params)
        run.log_metrics(metrics)
        if model_path:
            run.log_artifact(model_path)
        log.end_run(run)
    return TrainResult(
        model,
        metrics,
        report,
        quality.top_features(importance) if importance is not None else None,
        scored,
        describe_columns(df.select(*numeric, *categorical)),
    )


def metric_values(scored: DataFrame, label: str, score: str = PROBABILITY_GOOD) -> dict[str, float]:
    return quality.metric_record(scored, label, "prediction", score).first().asDict()


@dataclass
class Evaluation:
    metrics: dict[str, float]
    confusion: DataFrame
    report: DataFrame
    roc: DataFrame
    pr: DataFrame
    importance: DataFrame | None


def evaluate(
    spark: SparkSession,
    model_path: str,
    test: DataFrame,
    label: str,
    output: str | None = None,
    attribute_rows: bool = True,
) -> Evaluation:
    """Score a labelled table with a saved model; optionally write every table."""
    model = tables.load_model(model_path)
    # Scored once, then read by each measure.
    path = scratch_path(spark, "scored")
    models.add_predictions(test, model).write.parquet(path)
    scored = spark.read.parquet(path)
    importance = None
    if attribute_rows:
        prepared = PipelineModel(model.stages[:-1])
        importance = quality.top_features(
            global_attribution(
                prepared.transform(test), model.stages[-1], prep.feature_names(prepared)
            )
        )
    result = Evaluation(
        metric_values(scored, label),
        quality.confusion(scored, label, "prediction"),
        quality.class_report(scored, label, "prediction"),
        quality.roc_points(scored, label, PROBABILITY_GOOD),
        quality.pr_points(scored, label, PROBABILITY_GOOD),
        importance,
    )
    if output:
        named = {
            "confusion": result.confusion,
            "class_report": result.report,
            "roc": result.roc,
            "pr": result.pr,
        }
        if importance is not None:
            named["importance"] = importance
        for name, table in named.items():
            tables.write_table(table, f"{output.rstrip('/')}/{name}")
        write_json_record(spark, result.metrics, f"{output.rstrip('/')}/metrics")
    return result


def score_table(
    spark: SparkSession,
    source: str,
    model_path: str,
    target: str,
    schema=None,
    fmt: str | None = None,
) -> DataFrame:
    """Batch scoring: read, append ``prediction``, write; same rows in and out."""
    rows = tables.read_table(spark, source, schema)
    scored = models.add_predictions(rows, tables.load_model(model_path)).drop(
        models.PROBABILITY_BAD, models.PROBABILITY_GOOD
    )
    tables.write_table(scored, target, fmt)
    return tables.read_table(spark, target, scored.schema, fmt)


@dataclass
class MonitorResult:
    sizes: DataFrame
    report: DataFrame
    rollup: DataFrame
    predictions: DataFrame | None
    scores: DataFrame | None


def monitor(
    reference: DataFrame,
    current: DataFrame,
    skip: Sequence[str] = (),
    model: PipelineModel | None = None,
) -> MonitorResult:
    """Input drift with its roll-up; with a model also drift of the predictions."""
    paired = drift.pair(reference, current)
    report = drift.drift_report(paired, skip=skip)
    predictions = scores = None
    if model is not None:
        # Scored once; the drift measures read two columns of the written table.
        path = scratch_path(paired.sparkSession, "monitor")
        models.add_predictions(paired, model).select(
            drift.IS_REFERENCE, PROBABILITY_GOOD
        ).write.parquet(path)
        scored = paired.sparkSession.read.parquet(path)
        predictions = drift.prediction_drift(scored, PROBABILITY_GOOD)
        scores = scored.select(
            F.when(F.col(drift.IS_REFERENCE), "reference").otherwise("current").alias("dataset"),
            F.col(PROBABILITY_GOOD).alias("probability"),
        )
    sizes = paired.groupBy(drift.IS_REFERENCE).agg(F.count(F.lit(1)).alias("rows"))
    return MonitorResult(sizes, report, drift.drift_rollup(report), predictions, scores)
