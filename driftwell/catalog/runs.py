"""Order lines read as a run log: an order is a run, its lines are logged metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.catalog.registry import query, rounded, table
from driftwell.session import scratch_path
from driftwell.sources import runlog, tables

KEYS = ["m1", "m2", "m3"]
_METRICS = """(SELECT CAST(l_orderkey AS VARCHAR) AS run_id, 'm' || CAST(l_linenumber AS VARCHAR) AS key,
   epoch_ms(l_shipdate) AS ts_ms, l_extendedprice AS value, l_suppkey AS step FROM lineitem)"""
_LAST = f"""(SELECT run_id, key, max_by(value, (ts_ms, step, value)) AS value FROM
   (SELECT run_id, key, ts_ms, step, value FROM {_METRICS}) GROUP BY run_id, key)"""


def metrics(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("run_id"),
        F.concat(F.lit("m"), F.col("l_linenumber").cast("string")).alias("key"),
        _millis("l_shipdate").alias("ts_ms"),
        F.col("l_extendedprice").alias("value"),
        F.col("l_suppkey").alias("step"),
    )


def _millis(column):
    """Milliseconds since 1970 of a timestamp without zone."""
    zero = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_diff("MILLISECOND", zero, F.col(column))


def metric_lines(spark, folder):
    """The same log as text, each line twice as trackers tend to leave it."""
    text = F.concat_ws(
        " ", F.col("ts_ms").cast("string"), F.col("value").cast("string"), F.col("step").cast("string")
    )
    return metrics(spark, folder).select(
        "run_id", "key", F.explode(F.array(text, F.concat(text, F.lit(" ")))).alias("value")
    )


@query("metric_lines", f"SELECT DISTINCT run_id, key, ts_ms, value, step FROM {_METRICS}")
def parsed_lines(spark, folder):
    return runlog.parse_metric_lines(metric_lines(spark, folder))


@query("latest_metrics", f"SELECT run_id, key, value FROM {_LAST}")
def latest_metrics(spark, folder):
    return runlog.latest_metrics(metrics(spark, folder))


@query(
    "run_leaderboard",
    f"""SELECT run_id, max(value) FILTER (key = 'm1') AS m1, max(value) FILTER (key = 'm2') AS m2,
    max(value) FILTER (key = 'm3') AS m3 FROM {_LAST} WHERE key IN ('m1', 'm2', 'm3') GROUP BY run_id
    ORDER BY m2 DESC NULLS LAST, m1 DESC NULLS LAST, run_id LIMIT 20""",
)
def run_leaderboard(spark, folder):
    return runlog.run_leaderboard(metrics(spark, folder), KEYS, ["m2", "m1"], 20)


@query(
    "run_inventory",
    """SELECT o_orderpriority AS experiment, count(*) AS n_runs,
    count(*) FILTER (o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')) AS with_params,
    count(*) FILTER (o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS with_metrics,
    count(*) FILTER (o_orderstatus = 'F') AS with_artifacts FROM orders GROUP BY 1""",
)
def run_inventory(spark, folder):
    runs = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderpriority").alias("experiment"),
        "o_orderstatus",
    )
    params = (
        table(spark, folder, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .select(F.col("l_orderkey").cast("string").alias("run_id"))
    )
    return runlog.run_inventory(
        runs, params, metrics(spark, folder), F.col("o_orderstatus") == "F"
    )


@query(
    "csv_round_trip",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def csv_round_trip(spark, folder):
    customer = table(spark, folder, "customer")
    path = scratch_path(spark, "customer") + ".csv"
    tables.write_table(customer, path)
    return tables.read_table(spark, path, customer.schema)


@query("json_round_trip", "SELECT doc_id, quality, toxic FROM labels")
def json_round_trip(spark, folder):
    labels = table(spark, folder, "labels")
    path = scratch_path(spark, "labels") + ".json"
    tables.write_table(labels, path)
    return tables.read_table(spark, path, labels.schema)


@query(
    "metric_files",
    f"""SELECT run_id, key, ts_ms, value, step FROM (SELECT DISTINCT * FROM {_METRICS})""",
)
def metric_files(spark, folder):
    """The log as a text table partitioned like a tracker's folders, read back and parsed."""
    path = scratch_path(spark, "metrics")
    text = metric_lines(spark, folder).select(
        F.concat_ws("\t", "run_id", "key", "value").alias("value")
    )
    text.write.text(path)
    parts = F.split("value", "\t")
    read = spark.read.text(path).select(
        parts[0].alias("run_id"), parts[1].alias("key"), parts[2].alias("value")
    )
    return rounded(runlog.parse_metric_lines(read), 9)


@query(
    "run_log",
    """SELECT experiment, 'FINISHED' AS status, unnest(['customers', 'balance']) AS key, unnest([n, b]) AS value,
    experiment AS param FROM (SELECT n_name AS experiment, CAST(count(*) AS DOUBLE) AS n, round(sum(c_acctbal), 2) AS b
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1 GROUP BY 1)""",
)
def run_log(spark, folder):
    """A run for each nation of a region, with what its customers come to; one is ended
    twice, as after a failure, and one never, and neither shows."""
    nations = table(spark, folder, "nation").where(F.col("n_regionkey") == 1)
    customers = table(spark, folder, "customer")
    measured = customers.join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(
        F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("b")
    )
    log = runlog.RunLog(spark, scratch_path(spark, "run-log"))
    for number, r in enumerate(measured.orderBy("n_name").collect()):  # a region's few nations
        run = log.start_run(r["n_name"])
        run.log_params({"nation": r["n_name"]})
        run.log_metrics({"customers": r["n"], "balance": r["b"]})
        log.end_run(run)
        if not number:
            log.end_run(run)
    lost = log.start_run("lost")
    lost.log_metrics({"customers": 1})
    log.write_parts(lost, "unfinished")
    params = log.table("run_params").select("run_id", F.col("value").alias("param"))
    metrics_ = log.table("run_metrics").select("run_id", "key", "value")
    runs = log.table("runs").select("run_id", "experiment", "status")
    return runs.join(metrics_, "run_id").join(params, "run_id").select("experiment", "status", "key", "value", "param")


@query(
    "run_times",
    """SELECT run_id, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S') AS at, regexp_replace(lower(key), '[^a-z0-9_]+', '_', 'g') AS name,
    printf('%.4f', value / 7) AS shown FROM (SELECT run_id, ts_ms, 'Max ' || key || ' (n)' AS key, value FROM """ + _METRICS + """)""",
)
def run_times(spark, folder):
    """Metrics as a page lists them: times as text, tidy names, four decimals."""
    return metrics(spark, folder).select(
        "run_id",
        runlog.time_text(F.col("ts_ms")).alias("at"),
        runlog.tidy_name(F.concat(F.lit("Max "), F.col("key"), F.lit(" (n)"))).alias("name"),
        runlog.short_number(F.col("value") / 7).alias("shown"),
    )
