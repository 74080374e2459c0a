"""Drift per event-time window against a fixed reference.

The stream keeps counts per (window, column, bin), a state bounded by windows x
columns x bins; the index itself is a small batch step over the finished counts.
The same two functions serve a plain table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from driftwell.functions import bin_right_closed, no_nan
from driftwell.operators.drift import PSI_LIMIT, decile_edges, psi_term


@dataclass(frozen=True)
class ReferenceBins:
    """Bin edges of numeric columns; text columns are compared by value."""

    edges: dict[str, list[float]]
    text: tuple[str, ...] = ()

    def cells(self) -> list[Column]:
        out: list[Column] = []
        for c, e in self.edges.items():
            out += [F.lit(c), bin_right_closed(no_nan(F.col(c)), e).cast("string")]
        for c in self.text:
            out += [F.lit(c), F.col(c).cast("string")]
        return out

    def long(self, df: DataFrame, *keep: Column) -> DataFrame:
        n = len(self.edges) + len(self.text)
        return df.select(*keep, F.stack(F.lit(n), *self.cells()).alias("column", "bin"))


def reference_bins(
    reference: DataFrame, numeric: Sequence[str], text: Sequence[str] = (), bins: int = 10
) -> ReferenceBins:
    edges = decile_edges(reference, {c: F.col(c) for c in numeric}, bins) if numeric else {}
    return ReferenceBins(edges, tuple(text))


def reference_counts(reference: DataFrame, spec: ReferenceBins) -> DataFrame:
    """(column, bin, n_ref)."""
    return (
        spec.long(reference)
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("n_ref"))
    )


def _whole_slides(size: str, slide: str) -> bool:
    """Whether "7 days" is a whole number of "1 day"; only for lengths in one unit."""
    (n, unit), (m, other) = (x.split() if len(x.split()) == 2 else (x, "") for x in (size, slide))
    if unit.rstrip("s") != other.rstrip("s") or not (n.isdigit() and m.isdigit()):
        return False
    return unit.rstrip("s") not in ("month", "year", "") and int(n) % int(m) == 0


def window_counts(
    df: DataFrame,
    spec: ReferenceBins,
    time: str,
    size: str = "1 day",
    slide: str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """(window_start, window_end, column, bin, n) of tumbling or sliding windows.

    On a table, windows that are whole slides long add up the counts of their slides, so
    that an event is counted once and not once for every window it lies in.
    """
    rows = df.withWatermark(time, watermark) if watermark else df
    long = spec.long(rows, F.col(time).alias("at"))
    if slide and not df.isStreaming and _whole_slides(size, slide):
        counted = (
            long.groupBy(F.window("at", slide).alias("s"), "column", "bin")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("s.start").alias("at"), "column", "bin", "n")
            .groupBy(F.window("at", size, slide).alias("w"), "column", "bin")
            .agg(F.sum("n").alias("n"))
        )
    else:
        span = F.window("at", size, slide) if slide else F.window("at", size)
        counted = long.groupBy(span.alias("w"), "column", "bin").agg(F.count(F.lit(1)).alias("n"))
    return (
        counted.select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "column",
            "bin",
            "n",
        )
    )


def window_drift(counts: DataFrame, reference: DataFrame) -> DataFrame:
    """(window_start, column, n, psi, drift) from window and reference counts.

    Bins that a window lacks still count: their part is the reference's own term
    summed over all bins minus the bins present.
    """
    ref_sizes = reference.groupBy("column").agg(F.sum("n_ref").alias("size_ref"))
    shares = reference.join(F.broadcast(ref_sizes), "column").select(  # columns x bins rows
        "column", "bin", (F.col("n_ref") / F.col("size_ref")).alias("share")
    )
    absent = psi_term(F.col("share"), F.lit(0.0))
    whole = shares.groupBy("column").agg(F.sum(absent).alias("all_absent"))
    sizes = counts.groupBy("window_start", "column").agg(F.sum("n").alias("size"))
    same_bin = (counts["column"] == shares["column"]) & counts["bin"].eqNullSafe(shares["bin"])
    joined = (
        counts.join(shares, same_bin, "left")
        .select("window_start", counts["column"], "n", "share")
        .join(sizes, ["window_start", "column"])
    )
    share = F.coalesce("share", F.lit(0.0))
    term = psi_term(share, F.col("n") / F.col("size"))
    present_absent = F.when(F.col("share").isNotNull(), absent).otherwise(F.lit(0.0))
    return (
        joined.groupBy("window_start", "column")
        .agg(
            F.first("size").alias("n"),
            F.sum(term).alias("present"),
            F.sum(present_absent).alias("covered"),
        )
        .join(F.broadcast(whole), "column")  # one row per column
        .withColumn("psi", F.col("present") + F.col("all_absent") - F.col("covered"))
        .select("window_start", "column", "n", "psi", (F.col("psi") > PSI_LIMIT).alias("drift"))
    )


def watch_stream(
    arrivals: DataFrame,
    spec: ReferenceBins,
    time: str,
    counts_path: str,
    checkpoint: str,
    size: str = "1 day",
    slide: str | None = None,
    watermark: str = "1 hour",
    available_now: bool = True,
) -> StreamingQuery:
    """Append the counts of every closed window to a parquet table.

    Rows later than the watermark are left out, as windows must close; add a
    ``LateRows`` listener to the session's streams for their running total. A window is
    appended once the watermark has passed its end, so the last ones wait for later rows.
    """
    counts = window_counts(arrivals, spec, time, size, slide, watermark)
    writer = (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", counts_path)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def split_late(
    arrivals: DataFrame,
    time: str,
    on_time_path: str,
    late_path: str,
    checkpoint: str,
    watermark: str = "1 hour",
    available_now: bool = True,
) -> StreamingQuery:
    """Write every arriving row to one of two tables: on time, or late.

    A row is late if its time lies more than ``watermark`` before the latest time of all
    batches before its own, which is when a window may have closed without it; a missing
    time is late. Each table is partitioned by batch, and a batch that runs again replaces
    its part, so no row is lost or doubled: rows on time and rows late make the rows in.
    """
    spark = arrivals.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        newest = None
        if number:
            before = spark.read.parquet(f"{on_time_path}_newest").where(F.col("batch") < number)
            newest = before.agg(F.max("newest")).first()[0]
        late = F.col(time).isNull()
        if newest is not None:
            late = late | (F.col(time) < F.lit(newest) - F.expr(f"INTERVAL {watermark}"))
        marked = batch.withColumn("is_late__", F.coalesce(late, F.lit(True))).persist()
        try:
            for path, part in ((on_time_path, ~F.col("is_late__")), (late_path, F.col("is_late__"))):
                rows = marked.where(part).drop("is_late__").withColumn("batch", F.lit(number))
                rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
            marked.agg(F.max(time).alias("newest"), F.lit(number).alias("batch")).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("batch").parquet(f"{on_time_path}_newest")
        finally:
            marked.unpersist()

    writer = arrivals.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


class LateRows(StreamingQueryListener):
    """Running total of groups dropped for lateness, by query run; whole, unlike the few
    last reports that a query remembers. ``spark.streams.addListener(LateRows())``."""

    def __init__(self) -> None:
        self.total: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.total.setdefault(str(event.runId), 0)

    def onQueryProgress(self, event) -> None:
        dropped = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        run = str(event.progress.runId)
        self.total[run] = self.total.get(run, 0) + dropped

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def late_rows(query: StreamingQuery) -> int:
    """Groups dropped for lateness so far, from the recent progress reports."""
    return sum(
        op.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for op in progress.stateOperators
    )


def drift_summary(windows: DataFrame) -> DataFrame:
    """(window_start, n_columns, n_drift): what an alert looks at."""
    return windows.groupBy("window_start").agg(
        F.count(F.lit(1)).alias("n_columns"), F.count_if("drift").alias("n_drift")
    )
