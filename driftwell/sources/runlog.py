"""Run log as three growing tables: runs, run_params, run_metrics."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS = (
    "run_id string, experiment string, name string, start_ms long, end_ms long, "
    "status string, description string, artifacts array<string>"
)
RUN_PARAMS = "run_id string, key string, value string"
RUN_METRICS = "run_id string, key string, ts_ms long, value double, step long"
#: Tells the rows of one call of ``end_run`` from those of another.
ATTEMPT = "attempt"
TABLES = {"runs": RUNS, "run_params": RUN_PARAMS, "run_metrics": RUN_METRICS}


@dataclass
class Run:
    """An open run; written once, on ``end_run``, so a failed job leaves no half record."""

    experiment: str
    name: str
    description: str = ""
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    start_ms: int = field(default_factory=lambda: int(time.time() * 1000))
    params: dict[str, str] = field(default_factory=dict)
    metrics: list[tuple[str, int, float, int]] = field(default_factory=list)
    artifacts: list[str] = field(default_factory=list)

    def log_params(self, params: Mapping[str, object]) -> None:
        self.params.update({k: str(v) for k, v in params.items()})

    def log_metrics(self, metrics: Mapping[str, float], step: int = 0) -> None:
        now = int(time.time() * 1000)
        self.metrics += [(k, now, float(v), step) for k, v in metrics.items()]

    def log_artifact(self, path: str) -> None:
        self.artifacts.append(path)


class RunLog:
    """Three tables below ``path``. Parameters and metrics of a run are written first, its
    row in ``runs`` last: that row commits the run. Readers leave out what isn't committed,
    and of a run that was written twice, as after a failure between the steps, they take
    the attempt that its row names."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def start_run(self, experiment: str, description: str = "") -> Run:
        stamp = datetime.now(timezone.utc).strftime("%Y-%m-%d_%H-%M-%S")
        return Run(experiment, f"run_{stamp}", description)

    def end_run(self, run: Run, status: str = "FINISHED") -> None:
        """Write the run; safe to call again after a failure, also after a success."""
        end, attempt = int(time.time() * 1000), uuid.uuid4().hex
        self.write_parts(run, attempt)
        row = (run.run_id, run.experiment, run.name, run.start_ms, end, status, run.description, run.artifacts)
        self._append("runs", [row], attempt)  # commits the run

    def write_parts(self, run: Run, attempt: str) -> None:
        """What a run has logged, not yet committed."""
        self._append("run_params", [(run.run_id, k, v) for k, v in run.params.items()], attempt)
        self._append("run_metrics", [(run.run_id, *m) for m in run.metrics], attempt)

    def _append(self, name: str, rows: list, attempt: str) -> None:
        # Tables without rows are written too, so that they can be read.
        frame = self.spark.createDataFrame(rows, TABLES[name]).withColumn(ATTEMPT, F.lit(attempt))
        frame.coalesce(1).write.mode("append").parquet(f"{self.path}/{name}")

    def table(self, name: str) -> DataFrame:
        """A table of committed runs: of several commits of a run the last one counts."""
        runs = self._raw("runs")
        last = runs.groupBy("run_id").agg(F.max_by(ATTEMPT, F.struct("end_ms", ATTEMPT)).alias(ATTEMPT))
        return self._raw(name).join(last, ["run_id", ATTEMPT], "left_semi").drop(ATTEMPT)

    def _raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(f"{TABLES[name]}, {ATTEMPT} string").parquet(f"{self.path}/{name}")


def run_record(run: Run) -> dict[str, str]:
    """Metadata stored next to a model; the keys are fixed values."""
    return {
        "run_id": run.run_id,
        "training_timestamp_utc": datetime.now(timezone.utc).isoformat(),
        "model_description": run.description,
    }


def write_json_record(spark: SparkSession, record: Mapping[str, object], path: str) -> None:
    """One JSON object, as a text table with one row."""
    text = json.dumps(record, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


# --------------------------------------------------------------------------
# reading and ranking
# --------------------------------------------------------------------------


def parse_metric_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """Lines ``epoch_ms value step`` to typed columns, exact repeats removed.

    Other columns (run, key) are kept; a line that does not parse is dropped
    (``unparsed_lines`` counts them).
    """
    parts = F.split(F.trim(F.col(text)), r"\s+")
    keep = [c for c in lines.columns if c != text]
    return (
        lines.select(
            *keep,
            F.try_element_at(parts, F.lit(1)).try_cast("long").alias("ts_ms"),
            F.try_element_at(parts, F.lit(2)).try_cast("double").alias("value"),
            F.try_element_at(parts, F.lit(3)).try_cast("long").alias("step"),
        )
        .where(F.col("ts_ms").isNotNull() & F.col("value").isNotNull())
        .dropDuplicates()
    )


def _decoded(name: Column) -> Column:
    """A path part as it was written: percent codes read back, a plus sign kept."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def unparsed_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """One row (n_lines, n_unparsed): how many lines ``parse_metric_lines`` leaves out."""
    parts = F.split(F.trim(F.col(text)), r"\s+")
    read = (
        F.try_element_at(parts, F.lit(1)).try_cast("long").isNotNull()
        & F.try_element_at(parts, F.lit(2)).try_cast("double").isNotNull()
    )
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(~read).alias("n_unparsed"))


def read_metric_files(spark: SparkSession, glob: str) -> DataFrame:
    """Metric files ``.../<run>/metrics/<key>`` to (run_id, key, ts_ms, value, step)."""
    lines = spark.read.text(glob).select("value", F.col("_metadata.file_path").alias("path"))
    parts = F.split("path", "/")
    named = lines.select(
        "value",
        _decoded(F.element_at(parts, -3)).alias("run_id"),
        _decoded(F.element_at(parts, -1)).alias("key"),
    )
    return parse_metric_lines(named)


def read_param_files(spark: SparkSession, glob: str) -> DataFrame:
    """Parameter files ``.../<run>/params/<key>`` to (run_id, key, value)."""
    lines = spark.read.option("wholetext", True).text(glob)
    parts = F.split("_metadata.file_path", "/")
    return lines.select(
        _decoded(F.element_at(parts, -3)).alias("run_id"),
        _decoded(F.element_at(parts, -1)).alias("key"),
        F.trim("value").alias("value"),
    )


def time_text(ts_ms: Column) -> Column:
    """Milliseconds since 1970 as text to the second, UTC."""
    zero = F.lit("1970-01-01").cast("timestamp_ntz")
    whole = F.floor(ts_ms / 1000)
    return F.date_format(zero + F.make_dt_interval(secs=whole), "yyyy-MM-dd HH:mm:ss")


def tidy_name(key: Column) -> Column:
    """A metric's name in lower case, anything but letters, digits and _ as one _."""
    return F.regexp_replace(F.lower(key), "[^a-z0-9_]+", "_")


def short_number(value: Column) -> Column:
    """Four decimals, as text."""
    return F.format_string("%.4f", value.cast("double"))


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """(run_id, key, value): the last value by time, then step."""
    return metrics.groupBy("run_id", "key").agg(
        F.max_by("value", F.struct("ts_ms", "step", "value")).alias("value")
    )


def run_leaderboard(
    metrics: DataFrame, keys: Sequence[str], order: Sequence[str], n: int | None = None
) -> DataFrame:
    """One row per run with a column per metric, best first by ``order``.

    With ``n`` this is a top-n, which Spark keeps as n rows per task.
    """
    wide = (
        metrics.where(F.col("key").isin(list(keys)))
        .groupBy("run_id")
        .agg(
            *[
                F.max_by(
                    F.when(F.col("key") == k, F.col("value")),
                    F.when(F.col("key") == k, F.struct("ts_ms", "step", "value")),
                ).alias(k)
                for k in keys
            ]
        )
    )
    ranked = wide.orderBy(*[F.desc_nulls_last(k) for k in order], "run_id")
    return ranked.limit(n) if n else ranked


def run_inventory(
    runs: DataFrame, params: DataFrame, metrics: DataFrame, artifacts: Column | None = None
) -> DataFrame:
    """(experiment, n_runs, with_params, with_metrics, with_artifacts).

    Parameters and metrics collapse to one row per run before they meet the runs.
    """
    has_params = params.groupBy("run_id").agg(F.lit(True).alias("p"))
    has_metrics = metrics.groupBy("run_id").agg(F.lit(True).alias("m"))
    art = artifacts if artifacts is not None else F.size("artifacts") > 0
    return (
        runs.select("run_id", "experiment", F.coalesce(art, F.lit(False)).alias("a"))
        .join(has_params, "run_id", "left")
        .join(has_metrics, "run_id", "left")
        .groupBy("experiment")
        .agg(
            F.count(F.lit(1)).alias("n_runs"),
            F.count_if("p").alias("with_params"),
            F.count_if("m").alias("with_metrics"),
            F.count_if("a").alias("with_artifacts"),
        )
    )
