from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwell.catalog.registry import (
    DECILES,
    moment,
    psi_sum,
    query,
    rounded,
    table,
    union_all,
)
from driftwell.session import scratch_path
from driftwell.streaming import windows

CUT = "2024-01-11"
NUMERIC, TEXT = ["value"], ["event_type"]
_REF = f"ts < TIMESTAMP '{CUT}'"
_EDGES = f"(SELECT list_sort(list_distinct(quantile_cont(value, {DECILES}))) AS e FROM events WHERE {_REF})"
_BIN = "CAST(len([x FOR x IN e[2:len(e) - 1] IF value > x]) AS VARCHAR)"


def _drift_sql(span, watermark_hours=None):
    """``span`` is a SELECT of (window_start, column, bin) from the events."""
    closed = (
        f"WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL {watermark_hours} HOUR FROM events)"
        if watermark_hours is not None
        else ""
    )
    reference = f"""(SELECT "column", bin, count(*) AS n FROM
        (SELECT 'value' AS "column", {_BIN} AS bin FROM events, {_EDGES} WHERE {_REF}
         UNION ALL SELECT 'event_type', event_type FROM events WHERE {_REF}) GROUP BY 1, 2)"""
    return f"""
    WITH counts AS (SELECT window_start, "column", bin, count(*) AS n FROM ({span}) GROUP BY 1, 2, 3),
      ref AS (SELECT "column", bin, n / sum(n) OVER (PARTITION BY "column") AS share FROM {reference}),
      keys AS (SELECT DISTINCT window_start, "column" FROM counts),
      grid AS (SELECT window_start, k."column" AS c, bin FROM keys k JOIN ref r ON k."column" = r."column"
               UNION SELECT window_start, "column", bin FROM counts),
      full_grid AS (SELECT g.window_start, g.c, coalesce(n, 0) AS n, coalesce(share, 0) AS share,
          sum(coalesce(n, 0)) OVER (PARTITION BY g.window_start, g.c) AS total
        FROM grid g LEFT JOIN counts k ON g.window_start = k.window_start AND g.c = k."column" AND g.bin = k.bin
        LEFT JOIN ref r ON g.c = r."column" AND g.bin = r.bin)
    SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, c AS "column", CAST(max(total) AS BIGINT) AS n,
      round({psi_sum('share', '(n / total)')}, 6) AS psi, {psi_sum('share', '(n / total)')} > 0.2 AS drift
    FROM full_grid {closed} GROUP BY window_start, c"""


_DAYS = f"""SELECT date_trunc('day', ts) AS window_start, 'value' AS "column", {_BIN} AS bin FROM events, {_EDGES}
   UNION ALL SELECT date_trunc('day', ts), 'event_type', event_type FROM events"""
_WEEKS = union_all(
    [
        f"""SELECT date_trunc('day', ts) - INTERVAL {i} DAY AS window_start, 'value' AS "column", {_BIN} AS bin FROM events, {_EDGES}
        UNION ALL SELECT date_trunc('day', ts) - INTERVAL {i} DAY, 'event_type', event_type FROM events"""
        for i in range(7)
    ]
)


def _parts(spark, folder):
    events = table(spark, folder, "events")
    reference = events.where(F.col("ts") < moment(CUT))
    spec = windows.reference_bins(reference, NUMERIC, TEXT)
    return events, spec, windows.reference_counts(reference, spec)


def _shown(drift):
    return rounded(
        drift.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))
    )


@query("windowed_drift", _drift_sql(_DAYS))
def windowed_drift(spark, folder):
    events, spec, reference = _parts(spark, folder)
    counts = windows.window_counts(events, spec, "ts", "1 day")
    return _shown(windows.window_drift(counts, reference))


@query("sliding_drift", _drift_sql(_WEEKS))
def sliding_drift(spark, folder):
    events, spec, reference = _parts(spark, folder)
    counts = windows.window_counts(events, spec, "ts", "7 days", "1 day")
    return _shown(windows.window_drift(counts, reference))


@query("stream_windowed_drift", _drift_sql(_DAYS, watermark_hours=1))
def stream_windowed_drift(spark, folder):
    """The stream closes a window once the watermark has passed its end."""
    events, spec, reference = _parts(spark, folder)
    arrivals = (
        spark.readStream.schema(events.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(folder)
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )
    path = scratch_path(spark, "windows")
    stream = windows.watch_stream(
        arrivals, spec, "ts", f"{path}/counts", f"{path}/checkpoint", watermark="1 hour"
    )
    stream.awaitTermination()
    schema = T.StructType(
        [
            T.StructField("window_start", T.TimestampType()),
            T.StructField("window_end", T.TimestampType()),
            T.StructField("column", T.StringType()),
            T.StructField("bin", T.StringType()),
            T.StructField("n", T.LongType()),
        ]
    )
    counts = spark.read.schema(schema).parquet(f"{path}/counts")
    return _shown(windows.window_drift(counts, reference))


@query(
    "drift_summary",
    f"""SELECT window_start, count(*) AS n_columns, count(*) FILTER (drift) AS n_drift
    FROM ({_drift_sql(_DAYS)}) GROUP BY 1""",
)
def drift_summary(spark, folder):
    return windows.drift_summary(windowed_drift(spark, folder))


@query("stream_late_rows", "SELECT event_id, event_type FROM events")
def stream_late_rows(spark, folder):
    """Rows on time and late rows of a stream that arrives out of order: together they are
    the rows that came, none lost or doubled."""
    events = table(spark, folder, "events")
    path = scratch_path(spark, "arrivals")
    events.repartition(3, "event_id").write.parquet(f"{path}/in")
    arrivals = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    stream = windows.split_late(arrivals, "ts", f"{path}/on-time", f"{path}/late", f"{path}/checkpoint", "1 day")
    stream.awaitTermination()
    kinds = T.StructType([*events.schema.fields, T.StructField("batch", T.LongType())])
    both = [spark.read.schema(kinds).parquet(f"{path}/{part}") for part in ("on-time", "late")]
    return both[0].unionByName(both[1]).select("event_id", "event_type")
