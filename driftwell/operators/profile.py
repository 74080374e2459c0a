"""Profiles: counts, shares, describe, histograms, correlation, comparisons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwell.functions import no_nan
from driftwell.operators.drift import split_columns
from driftwell.operators.ordered import column_facts, quantiles

QUARTILES = (0.25, 0.5, 0.75)
# A codebook up to this many rows is sent to every task; a larger one is shuffled.
BROADCAST_ROWS = 100_000


def _missing(df: DataFrame, column: str) -> Column:
    kind = dict(df.dtypes)[column]
    c = F.col(column)
    return c.isNull() | F.isnan(c) if kind in ("double", "float") else c.isNull()


def table_shape(df: DataFrame) -> DataFrame:
    """One row: rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "columns", F.lit(len(df.columns))
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, dtype, rows, non_null, nulls): one pass, one row per column."""
    names = list(columns or df.columns)
    kinds = dict(df.dtypes)
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(_missing(df, c)).alias(f"m{i}") for i, c in enumerate(names)],
    )
    cells: list[Column] = []
    for i, c in enumerate(names):
        cells += [F.lit(c), F.lit(kinds[c]), F.col(f"m{i}")]
    return wide.select(
        "rows", F.stack(F.lit(len(names)), *cells).alias("column", "dtype", "nulls")
    ).select("column", "dtype", "rows", (F.col("rows") - F.col("nulls")).alias("non_null"), "nulls")


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value, n, share) for every column in one shuffle; missing is a value.

    Shares divide by the row count, which is the same for every column.
    """
    counts = _counted(df, list(columns or df.columns))
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(totals), "column").select(  # one row per column
        "column", "value", "n", (F.col("n") / F.col("total")).alias("share")
    )


def _counted(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, value, n) of every column."""
    cells: list[Column] = []
    for c in names:
        cells += [F.lit(c), F.col(c).cast("string")]
    return (
        df.select(F.stack(F.lit(len(names)), *cells).alias("column", "value"))
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """(label, n, share) of each label value."""
    return value_counts(df, [label]).select(
        F.col("value").alias("label"), "n", "share"
    )


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, distinct_values), a missing value counting as one; one scan."""
    return (
        _counted(df, list(columns or df.columns))
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("distinct_values"))
    )


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max), quartiles exact."""
    exprs = {c: F.col(c) for c in columns}
    quarts = quantiles(df, {c: (e, QUARTILES) for c, e in exprs.items()})
    aggs = []
    for i, c in enumerate(columns):
        v = no_nan(F.col(c))
        aggs += [
            F.count(v).alias(f"n{i}"),
            F.avg(v).alias(f"mean{i}"),
            F.stddev_samp(v).alias(f"std{i}"),
            F.min(v).alias(f"lo{i}"),
            F.max(v).alias(f"hi{i}"),
        ]
    cells: list[Column] = []
    for i, c in enumerate(columns):
        q25, q50, q75 = (F.lit(q).cast("double") for q in quarts[c])
        cells += [F.lit(c), F.col(f"n{i}"), F.col(f"mean{i}"), F.col(f"std{i}"), F.col(f"lo{i}")]
        cells += [q25, q50, q75, F.col(f"hi{i}")]
    return df.agg(*aggs).select(
        F.stack(F.lit(len(columns)), *cells).alias(
            "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
        )
    )


def compare_profiles(left: DataFrame, right: DataFrame, suffixes=("original", "modified")) -> DataFrame:
    """Full outer join of two per-column tables on ``column``, other names suffixed."""
    a, b = (
        t.select("column", *[F.col(c).alias(f"{c}_{s}") for c in t.columns if c != "column"])
        for t, s in zip((left, right), suffixes)
    )
    return a.join(b, "column", "full_outer")


def compare_schemas(left: DataFrame, right: DataFrame, suffixes=("original", "modified")) -> DataFrame:
    """Type, row and non-null count of every column of either table."""
    picked = ("column", "non_null", "dtype", "rows")
    return compare_profiles(
        null_profile(left).select(*picked), null_profile(right).select(*picked), suffixes
    )


def compare_describe(
    left: DataFrame, right: DataFrame, left_columns, right_columns, suffixes=("original", "modified")
) -> DataFrame:
    return compare_profiles(
        describe_numeric(left, left_columns), describe_numeric(right, right_columns), suffixes
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 20) -> DataFrame:
    """(column, bin, lo, hi, n): equal-width bins over the column's own range.

    The last bin holds the maximum; empty bins are listed with n = 0. Infinite values
    have no place in bins of a width and aren't counted.
    """
    finite = {c: F.when(F.abs(no_nan(F.col(c))) < F.lit(float("inf")), F.col(c)) for c in columns}
    facts = column_facts(df, finite)
    spark = df.sparkSession
    edges, cells = [], []
    for c in columns:
        lo, hi = facts[c].lo, facts[c].hi
        if lo is None:
            continue
        width = (hi - lo) / bins
        count = bins if width else 1
        edges += [
            (c, i, lo + i * width, hi if i == count - 1 else lo + (i + 1) * width)
            for i in range(count)
        ]
        v = no_nan(finite[c])
        at = F.floor((v - F.lit(lo)) / F.lit(width)) if width else F.when(v.isNotNull(), F.lit(0))
        cells += [F.lit(c), F.when(at.isNotNull(), F.least(at, F.lit(count - 1))).cast("int")]
    frame = spark.createDataFrame(edges, "column string, bin int, lo double, hi double")
    if not cells:
        return frame.withColumn("n", F.lit(0).cast("long"))
    counts = (
        df.select(F.stack(F.lit(len(cells) // 2), *cells).alias("column", "bin"))
        .where(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return frame.join(counts, ["column", "bin"], "left").select(
        "column", "bin", "lo", "hi", F.coalesce("n", F.lit(0)).alias("n")
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_a, column_b, r) for every ordered pair, pairwise complete.

    One pass to see which columns have holes, one for all pairs.
    """
    view = df.select(*[no_nan(F.col(c)).alias(c) for c in columns])
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    counts = view.agg(F.count(F.lit(1)).alias("rows__"), *[F.count(c).alias(c) for c in columns])
    seen = counts.first()
    holes = {c for c in columns if seen[c] < seen["rows__"]}

    def spread(c: str, other: str, alone: Column) -> Column:
        # Only where the other column has holes does the pair see other rows.
        return F.stddev_pop(F.when(F.col(other).isNotNull(), F.col(c))) if other in holes else alone

    # From covariance and deviations, as `corr` itself fails on a constant column.
    wide = view.agg(
        *[
            F.try_divide(
                F.covar_pop(a, b),
                spread(a, b, F.stddev_pop(a)) * spread(b, a, F.stddev_pop(b)),
            ).alias(f"r{k}")
            for k, (a, b) in enumerate(pairs)
        ],
        *[F.var_samp(c).alias(f"v{i}") for i, c in enumerate(columns)],
    )
    cells: list[Column] = []
    for i, c in enumerate(columns):
        cells += [F.lit(c), F.lit(c), F.when(F.col(f"v{i}") > 0, F.lit(1.0))]
    for k, (a, b) in enumerate(pairs):
        r = no_nan(F.col(f"r{k}"))
        cells += [F.lit(a), F.lit(b), r, F.lit(b), F.lit(a), r]
    return wide.select(
        F.stack(F.lit(len(cells) // 3), *cells).alias("column_a", "column_b", "r")
    )


def crosstab(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """(column, value, label, n, row_share): every column against the label, long form."""
    cells: list[Column] = []
    for c in columns:
        cells += [F.lit(c), F.col(c).cast("string")]
    counts = (
        df.select(
            F.col(label).cast("string").alias("label"),
            F.stack(F.lit(len(columns)), *cells).alias("column", "value"),
        )
        .where(F.col("value").isNotNull() & F.col("label").isNotNull())
        .groupBy("column", "value", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Partitioned by the category, each group holding one row per label.
    row_total = F.sum("n").over(Window.partitionBy("column", "value"))
    return counts.select(
        "column", "value", "label", "n", (F.col("n") / row_total).alias("row_share")
    )


def crosstab_wide(df: DataFrame, column: str, label: str, labels: Sequence) -> DataFrame:
    """One row per category with a count and a share column per label value."""
    counts = df.groupBy(column).agg(
        *[F.count_if(F.col(label) == v).alias(f"n_{v}") for v in labels]
    )
    total = sum((F.col(f"n_{v}") for v in labels[1:]), F.col(f"n_{labels[0]}"))
    return counts.select(
        "*", *[F.try_divide(F.col(f"n_{v}"), total).alias(f"share_{v}") for v in labels]
    )


def box_stats(df: DataFrame, columns: Sequence[str], label: str, labels: Sequence) -> DataFrame:
    """Box-plot numbers per column and label value: Tukey whiskers, quartiles, outliers.

    Each (column, label) pair is a conditional column, so quartiles of all pairs come
    from the same passes.
    """
    pairs = [(c, v) for c in columns for v in labels]
    named = {f"x{i}": F.when(F.col(label) == v, F.col(c)) for i, (c, v) in enumerate(pairs)}
    quarts = quantiles(df, {k: (e, QUARTILES) for k, e in named.items()})
    aggs, cells = [], []
    for i, (c, v) in enumerate(pairs):
        q25, q50, q75 = quarts[f"x{i}"]
        x = no_nan(named[f"x{i}"])
        if q25 is None:
            continue
        reach = 1.5 * (q75 - q25)
        inside = x.between(F.lit(q25 - reach), F.lit(q75 + reach))
        aggs += [
            F.min(F.when(inside, x)).alias(f"lo{i}"),
            F.max(F.when(inside, x)).alias(f"hi{i}"),
            F.count_if(x.isNotNull() & ~inside).alias(f"out{i}"),
            F.count(x).alias(f"n{i}"),
        ]
        cells += [F.lit(c), F.lit(str(v)), F.col(f"n{i}"), F.col(f"lo{i}")]
        cells += [F.lit(q25), F.lit(q50), F.lit(q75), F.col(f"hi{i}"), F.col(f"out{i}")]
    if not cells:
        return df.sparkSession.createDataFrame(
            [],
            "column string, label string, n long, whisker_lo double, q25 double, "
            "q50 double, q75 double, whisker_hi double, outliers long",
        )
    return df.agg(*aggs).select(
        F.stack(F.lit(len(cells) // 9), *cells).alias(
            "column", "label", "n", "whisker_lo", "q25", "q50", "q75", "whisker_hi", "outliers"
        )
    )


def describe_columns(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """(column, kind, dtype): which columns preparation treats as numeric or categorical."""
    numeric, other = split_columns(df, skip)
    kinds = dict(df.dtypes)
    rows = [(c, "numeric", kinds[c]) for c in numeric] + [(c, "categorical", kinds[c]) for c in other]
    return df.sparkSession.createDataFrame(rows, "column string, kind string, dtype string")


def decode_labels(
    df: DataFrame, codebook: DataFrame, columns: Mapping[str, str], else_label: str | None = None
) -> DataFrame:
    """Add a label column per coded column: {coded column: new name}.

    ``codebook`` is (column, code, label); of several labels of one code the first in
    text order holds. Its size is checked: a small one goes to every task, a larger one
    is joined by shuffle, where adaptive execution splits a hot code.
    """
    codebook = codebook.groupBy("column", "code").agg(F.min("label").alias("label"))
    small = codebook.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    out = df
    for c, name in columns.items():
        book = codebook.where(F.col("column") == c).select(
            F.col("code").cast(_type_of(df, c)).alias(c), F.col("label").alias(name)
        )
        out = out.join(F.broadcast(book) if small else book, c, "left")
        if else_label is not None:
            out = out.withColumn(name, F.coalesce(name, F.lit(else_label)))
    return out.select(*df.columns, *columns.values())


def _type_of(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def first_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first n rows by an order that decides ties; each task keeps only n rows."""
    return df.orderBy(*order).limit(n)


def unpivot_scores(df: DataFrame, columns: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Score columns to (dataset, probability) rows: {score column: dataset name}."""
    cells: list[Column] = []
    for c, name in columns.items():
        cells += [F.lit(name), F.col(c)]
    return df.select(
        *keep, F.stack(F.lit(len(columns)), *cells).alias("dataset", "probability")
    )


def stack_scores(reference: DataFrame, current: DataFrame, score: str) -> DataFrame:
    """Scores of two tables of any size as (dataset, probability) rows."""
    sides = (("reference", reference), ("current", current))
    a, b = (t.select(F.lit(n).alias("dataset"), F.col(score).alias("probability")) for n, t in sides)
    return a.unionByName(b)


def profile(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> dict[str, DataFrame]:
    """The exploratory tables of one dataset, by name."""
    return {
        "shape": table_shape(df),
        "nulls": null_profile(df),
        "describe": describe_numeric(df, numeric),
        "histogram": histogram(df, numeric),
        "values": value_counts(df, categorical),
        "correlation": correlation_matrix(df, numeric),
    }
