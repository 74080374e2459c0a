from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from driftwell import session
from driftwell.operators import models, prep
from driftwell.operators.validate import Rule
from driftwell.sources import runlog, tables
from driftwell.streaming import scoring, windows


def events(spark, n=400, start="2024-01-01"):
    base = F.lit(start).cast("timestamp").cast("long")
    return spark.range(n).select(
        (base + F.col("id") * 1800).cast("timestamp").alias("ts"),
        (F.col("id") * 37 % 101).cast("double").alias("value"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("kind"),
    )


def test_stream_equals_batch_on_closed_windows(spark, tmp_path):
    df = events(spark)
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    spec = windows.reference_bins(df.limit(200), ["value"], ["kind"])
    reference = windows.reference_counts(df.limit(200), spec)
    stream = windows.watch_stream(
        spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")),
        spec, "ts", str(tmp_path / "counts"), str(tmp_path / "cp"), watermark="1 hour",
    )
    stream.awaitTermination()
    batch = windows.window_counts(df, spec, "ts")
    got = spark.read.parquet(str(tmp_path / "counts"))
    last = df.agg(F.max("ts") - F.expr("INTERVAL 1 HOUR")).first()[0]
    want = batch.where(F.col("window_end") <= F.lit(last))
    key = lambda d: sorted(tuple(r) for r in d.collect())
    assert key(got) == key(want) and got.count() > 0
    a = key(windows.window_drift(got, reference).drop("psi"))
    b = key(windows.window_drift(want, reference).drop("psi"))
    assert a == b


def test_late_rows_are_left_out_and_counted(spark, tmp_path):
    df = events(spark, 200)
    source = tmp_path / "in"
    df.coalesce(1).write.parquet(str(source))
    spec = windows.reference_bins(df, ["value"])

    def run():
        arrivals = spark.readStream.schema(df.schema).parquet(str(source))
        q = windows.watch_stream(arrivals, spec, "ts", str(tmp_path / "counts"), str(tmp_path / "cp"))
        q.awaitTermination()
        return q

    run()
    before = spark.read.parquet(str(tmp_path / "counts")).agg(F.sum("n")).first()[0]
    # Three days later, together with rows long before the watermark.
    events(spark, 40, "2024-01-08").unionByName(events(spark, 10)).coalesce(1).write.mode("append").parquet(str(source))
    q = run()
    assert windows.late_rows(q) > 0
    total = spark.read.parquet(str(tmp_path / "counts")).where("window_start < '2024-01-05'").agg(F.sum("n")).first()[0]
    assert before <= total <= 200


def test_window_drift_counts_bins_a_window_lacks(spark):
    df = events(spark, 96)
    spec = windows.reference_bins(df, [], ["kind"])
    reference = windows.reference_counts(df, spec)
    only_a = df.where("kind = 'a'")
    row = windows.window_drift(windows.window_counts(only_a, spec, "ts"), reference).first()
    import math

    a, b = 1 / 3, 2 / 3
    want = (1 - a) * math.log(1 / a) + (1e-4 - b) * math.log(1e-4 / b)
    assert math.isclose(row["psi"], want, rel_tol=1e-9) and row["drift"]


def test_sliding_windows_overlap(spark):
    df = events(spark, 480)
    spec = windows.reference_bins(df, ["value"])
    n = windows.window_counts(df, spec, "ts", "7 days", "1 day").agg(F.sum("n")).first()[0]
    assert n == 7 * 480


def test_scoring_stream(spark, tmp_path):
    df = spark.range(300).select(
        "id", (F.col("id") % 50).cast("double").alias("x"), (F.col("id") % 50 > 20).cast("int").alias("y")
    )
    fitted = prep.fit_preprocessor(df, ["x"])
    model = models.fit_model(df, fitted, models.baseline_models("y")["LogisticRegression"], "y")
    df.write.parquet(str(tmp_path / "in"))
    arrivals = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = scoring.score_stream(
        arrivals, model, [Rule("x", 5, 45)], str(tmp_path / "ok"), str(tmp_path / "bad"), str(tmp_path / "cp")
    )
    q.awaitTermination()
    ok, bad = spark.read.parquet(str(tmp_path / "ok")), spark.read.parquet(str(tmp_path / "bad"))
    assert ok.count() + bad.count() == 300
    assert ok.where("x < 5 or x > 45").count() == 0
    assert bad.select("failures.column").first()[0] == ["x"]
    batch = {r["id"]: r["prediction"] for r in models.add_predictions(df, model).collect()}
    assert all(batch[r["id"]] == r["prediction"] for r in ok.collect())


def test_run_log_round_trip(spark, tmp_path):
    log = runlog.RunLog(spark, str(tmp_path / "log"))
    for i in range(3):
        run = log.start_run("exp", "demo")
        run.log_params({"depth": i})
        run.log_metrics({"f1": 0.5 + i / 10, "auc": 0.7})
        if i:
            run.log_artifact("model")
        log.end_run(run)
    board = runlog.run_leaderboard(log.table("run_metrics"), ["f1", "auc"], ["f1", "auc"]).collect()
    assert [round(r["f1"], 1) for r in board] == [0.7, 0.6, 0.5]
    row = runlog.run_inventory(log.table("runs"), log.table("run_params"), log.table("run_metrics")).first()
    assert tuple(row) == ("exp", 3, 3, 3, 2)


def test_metric_files(spark, tmp_path):
    for run, lines in (("r1", ["1000 0.8 0", "1000 0.8 0", "2000 0.9 1"]), ("r2", ["1500 0.7 0", "broken"])):
        folder = tmp_path / run / "metrics"
        folder.mkdir(parents=True)
        (folder / "auc").write_text("\n".join(lines) + "\n")
        params = tmp_path / run / "params"
        params.mkdir()
        (params / "depth").write_text("5\n")
    metrics = runlog.read_metric_files(spark, f"{tmp_path}/*/metrics/*")
    assert metrics.count() == 3
    latest = {r["run_id"]: r["value"] for r in runlog.latest_metrics(metrics).collect()}
    assert latest == {"r1": 0.9, "r2": 0.7}
    params = runlog.read_param_files(spark, f"{tmp_path}/*/params/*").collect()
    assert {(r["run_id"], r["key"], r["value"]) for r in params} == {("r1", "depth", "5"), ("r2", "depth", "5")}


@pytest.mark.parametrize("ending", ["csv", "json", "orc", "parquet"])
def test_tables_come_back_as_written(spark, tmp_path, ending):
    df = spark.createDataFrame([(1, "a", 0.5), (2, None, -1.0)], "k long, s string, x double")
    path = str(tmp_path / "deep" / f"t.{ending}")
    tables.write_table(df, path)
    tables.write_table(df, path)  # replaced, not added to
    back = tables.read_table(spark, path, df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_json_record(spark, tmp_path):
    runlog.write_json_record(spark, {"f1": 0.5, "params": {"d": 3}}, str(tmp_path / "m"))
    text = spark.read.text(str(tmp_path / "m")).first()[0]
    assert json.loads(text) == {"f1": 0.5, "params": {"d": 3}}


def test_shared_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    got = session.shared_dir(spark)
    assert got == named if named else got == session.shared_dir(spark)
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_late_rows_go_to_their_own_table(spark, tmp_path):
    df = events(spark, 200)
    source, out = tmp_path / "in", tmp_path / "out"

    def run():
        arrivals = spark.readStream.schema(df.schema).parquet(str(source))
        q = windows.split_late(arrivals, "ts", f"{out}/on", f"{out}/late", str(tmp_path / "cp"), "1 hour")
        q.awaitTermination()

    df.coalesce(1).write.parquet(str(source))
    run()
    # Days later, with rows long before the watermark, one at its edge and one without time.
    newest = df.agg(F.max("ts")).first()[0]
    edge = df.limit(1).withColumn("ts", F.lit(newest) - F.expr("INTERVAL 1 HOUR"))
    untimed = df.limit(1).withColumn("ts", F.lit(None).cast("timestamp"))
    more = events(spark, 40, "2024-01-08").unionByName(events(spark, 10)).unionByName(edge).unionByName(untimed)
    more.coalesce(1).write.mode("append").parquet(str(source))
    run()
    on_time, late = (spark.read.parquet(f"{out}/{p}") for p in ("on", "late"))
    assert (on_time.count(), late.count()) == (241, 11)
    assert late.where("ts is null").count() == 1
    assert on_time.agg(F.max("batch")).first()[0] == 1


def test_only_whole_runs_are_read(spark, tmp_path):
    log = runlog.RunLog(spark, str(tmp_path / "log"))
    run = log.start_run("e")
    run.log_params({"a": 1})
    run.log_metrics({"m": 0.5})
    log.write_parts(run, "broken")  # fails before the commit
    log.end_run(run, "FAILED")
    log.end_run(run)  # written once more
    other = log.start_run("f")
    other.log_metrics({"m": 1.5})
    log.write_parts(other, "never")
    assert [(r["experiment"], r["status"]) for r in log.table("runs").collect()] == [("e", "FINISHED")]
    assert [(r["key"], r["value"]) for r in log.table("run_params").collect()] == [("a", "1")]
    assert [r["value"] for r in log.table("run_metrics").collect()] == [0.5]


def test_texts_of_times_names_and_numbers(spark):
    df = spark.createDataFrame([(1700000000123, "F1 score (test)", 0.123456), (0, "auc", None)], "ts long, k string, v double")
    got = [tuple(r) for r in df.select(runlog.time_text(F.col("ts")), runlog.tidy_name(F.col("k")), runlog.short_number(F.col("v"))).collect()]
    assert got[0] == ("2023-11-14 22:13:20", "f1_score_test_", "0.1235") and got[1][:2] == ("1970-01-01 00:00:00", "auc")


def test_requests_as_json(spark):
    from pyspark.sql import types as T

    from driftwell.operators import requests

    texts = [
        '{"applications": [{"age": 30, "name": "x"}, {"age": 200}]}', '{"applications": []}', '{"applications": [{"age": 30}',
        None, "", "[]", '{"other": 1}', '{"applications": [{"age": "thirty"}]}', '{"applications": [{"age": 18}, {"age": 99}]}',
        '{"applications": [' + ", ".join(['{"age": 20}'] * 101) + "]}",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "n long, body string").withColumnRenamed("n", "id")
    kind = T.StructType([T.StructField("age", T.IntegerType())])
    answered = requests.answer_requests(requests.parse_requests(df, "body", kind), [Rule("age", 18, 99)])
    rows = {r["id"]: r for r in answered.collect()}
    status = [rows[i]["status"] for i in range(len(texts))]
    assert status == [
        "invalid", "wrong_size", "malformed", "malformed", "malformed", "malformed", "malformed", "invalid", "accepted", "wrong_size",
    ]
    assert json.loads(rows[0]["reply"]) == {"status": "invalid", "n": 2, "errors": [{"position": 1, "column": "age", "value": "200"}]}
    assert rows[2]["malformed"] == texts[2]
    taken = requests.accepted_applications(answered).orderBy("position").collect()
    assert [(r["id"], r["position"], r["age"]) for r in taken] == [(8, 0, 18), (8, 1, 99)]
