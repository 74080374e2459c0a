"""Distribution drift between a reference and a current table.

Operators take one table with a boolean that marks the reference rows; ``pair``
builds it from two tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwell.functions import (
    bin_right_closed,
    kolmogorov_series,
    ks_exact_p,
)
from driftwell.operators.counts import SideCounts, count_sides, reference_quantiles
from driftwell.operators.ordered import ColumnFacts, pair_walk, quantiles

# Thresholds and the share that stands in for an empty class.
EMPTY_SHARE = 1e-4
PSI_LIMIT = 0.2
KS_ALPHA = 0.05
CONTINUOUS_ABOVE = 20
ROLLUP_CRITICAL_PCT = 20

IS_REFERENCE = "is_reference"


def pair(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Stack both tables with a marker column; only shared columns are kept.

    A column typed differently on the two sides takes the reference's type, so
    1 and 1.0 are the same category.
    """
    names = list(columns or [c for c in reference.columns if c in current.columns])
    types = {f.name: f.dataType for f in reference.schema.fields}
    ref = reference.select(*names, F.lit(True).alias(IS_REFERENCE))
    cur = current.select(
        *[F.col(c).cast(types[c]).alias(c) for c in names],
        F.lit(False).alias(IS_REFERENCE),
    )
    return ref.unionByName(cur)


def mark(df: DataFrame, is_reference: Column) -> DataFrame:
    """Mark the rows of one table where the condition holds as the reference."""
    return df.withColumn(IS_REFERENCE, F.coalesce(is_reference, F.lit(False)))


def split_columns(df: DataFrame, skip: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, other) column names from the schema."""
    skip = {IS_REFERENCE, *skip}
    fields = [f for f in df.schema.fields if f.name not in skip]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    return numeric, [f.name for f in fields if f.name not in numeric]


def psi_term(base: Column, current: Column) -> Column:
    """(c - b) * ln(c / b) with an empty class given EMPTY_SHARE."""
    b = F.when(base > 0, base).otherwise(F.lit(EMPTY_SHARE))
    c = F.when(current > 0, current).otherwise(F.lit(EMPTY_SHARE))
    return (c - b) * F.ln(c / b)


def ks_p_value(df: DataFrame, method: str = "asymptotic") -> DataFrame:
    """Add ``p_value`` and ``p_method`` to rows with n_a, n_b and d.

    ``method``: the limit law, or "exact" (its work grows with the power 1.5 of the
    sizes, for each row of the result). Tables of every size are treated alike; an empty sample gives D = 0,
    p = 1.
    """
    m, n = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    lam = F.col("d") * F.sqrt(m * n / (m + n))
    usable = (F.col("n_a") > 0) & (F.col("n_b") > 0) & F.col("d").isNotNull()
    exact = {"exact": F.lit(True), "asymptotic": F.lit(False)}[method]
    out = df.withColumn("p_method", F.when(usable & exact, "exact").otherwise("asymptotic"))
    series = kolmogorov_series(lam)
    if method == "asymptotic":
        p = series
    else:
        p_exact = ks_exact_p(
            *[F.when(exact, F.col(c)) for c in ("n_a", "n_b", "d")]
        )
        out = out.withColumn("p_exact__", p_exact)
        p = F.coalesce(F.col("p_exact__"), series)
    return (
        out.withColumn("p_value", F.when(usable, p).otherwise(F.lit(1.0)))
        .withColumn("d", F.when(usable, F.col("d")).otherwise(F.lit(0.0)))
        .drop("p_exact__")
    )


def ks_two_sample(
    df: DataFrame,
    columns: Sequence[str],
    is_reference: Column | None = None,
    p_method: str = "asymptotic",
) -> DataFrame:
    """(column, n_ref, n_cur, d, p_value, p_method) of a two-sample KS test.

    Columns that are not numeric get D = 0, p = 1.
    """
    side = F.col(IS_REFERENCE) if is_reference is None else is_reference
    numeric, _ = split_columns(df.select(*columns))
    return _ks_from(count_sides(df, numeric, [], side), columns, p_method)


def _ks_from(counts: SideCounts, columns: Sequence[str], p_method: str) -> DataFrame:
    walked = [c for c in columns if c in counts.numeric] if counts.rows_a + counts.rows_b else []
    blanks = counts.table.sparkSession.createDataFrame(
        [(c, 0, 0, 0.0) for c in columns if c not in walked],
        "column string, n_a long, n_b long, d double",
    )
    tested = blanks
    if walked:
        tested = pair_walk(counts.slotted(walked), counts.pair_facts(walked)).select("column", "n_a", "n_b", "d")
        if len(walked) < len(columns):
            tested = tested.unionByName(blanks)
    return ks_p_value(tested, p_method).select(
        "column",
        F.col("n_a").alias("n_ref"),
        F.col("n_b").alias("n_cur"),
        "d",
        "p_value",
        "p_method",
    )


# --------------------------------------------------------------------------
# PSI
# --------------------------------------------------------------------------


def decile_edges(
    df: DataFrame,
    columns: Mapping[str, Column],
    bins: int = 10,
    rows: Column | None = None,
    facts: Mapping[str, ColumnFacts] | None = None,
) -> dict[str, list[float]]:
    """Equal-frequency edges (interpolated quantiles, duplicates removed)."""
    picked = {
        name: (F.when(rows, c) if rows is not None else c) for name, c in columns.items()
    }
    grid = [i / bins for i in range(bins + 1)]
    got = quantiles(df, {name: (c, grid) for name, c in picked.items()}, facts)
    return {name: sorted({v for v in got[name] if v is not None}) for name in columns}


def psi(
    df: DataFrame,
    columns: Sequence[str],
    is_reference: Column | None = None,
    bins: int = 10,
    widen_edges: bool = True,
    binned: str = "continuous",
) -> DataFrame:
    """(column, psi, classes) of the population stability index.

    Numeric columns with many distinct reference values are cut into
    equal-frequency bins of the reference; all else is compared value by value,
    missing counting as a value. ``binned="numeric"`` bins every numeric column,
    and ``widen_edges=False`` lets values outside the reference range fall into
    the missing class: together the older form of the index.
    """
    side = F.col(IS_REFERENCE) if is_reference is None else is_reference
    numeric, other = split_columns(df.select(*columns))
    return _psi_from(count_sides(df, numeric, other, side), columns, bins, widen_edges, binned)


def _psi_from(
    counts: SideCounts, columns: Sequence[str], bins: int, widen_edges: bool = True, binned: str = "continuous"
) -> DataFrame:
    """The index from counts by value: edges are quantiles of the reference's counts, and
    only the counts are dealt to bins."""
    cut = [
        c for c in counts.numeric
        if c in columns and (binned == "numeric" or counts.facts[c].distinct_a > CONTINUOUS_ABOVE)
    ]
    got = reference_quantiles(counts, cut, [i / bins for i in range(bins + 1)])
    edges = {c: sorted({v for v in got[c] if v is not None}) for c in cut}
    value = F.when(F.lit(False), F.lit(0.0))
    for c in cut:
        if len(edges[c]) >= 2:
            here = F.col("id") == counts.names.index(c)
            value = value.when(here, bin_right_closed(F.col("value"), edges[c], widen_edges).cast("double"))
    table = counts.table.where(F.col("id").isin(counts.ids(columns)))
    binned_counts = (
        table.groupBy(F.col("id").alias("column"), value.otherwise(F.col("value")).alias("value"), "text")
        .agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    )
    names = F.create_map(*[F.lit(x) for pair_ in enumerate(counts.names) for x in pair_])
    return psi_from_counts(binned_counts).withColumn("column", names[F.col("column")])


def side_counts(df: DataFrame, side: Column, cells: Sequence[Column]) -> DataFrame:
    """(column, value, n_a, n_b) from (column, value) cell pairs of one value type."""
    return (
        df.select(
            side.alias("side__"),
            F.stack(F.lit(len(cells) // 2), *cells).alias("column", "value"),
        )
        .groupBy("column", "value")
        .agg(F.count_if("side__").alias("n_a"), F.count_if(~F.col("side__")).alias("n_b"))
    )


def psi_from_counts(counts: DataFrame) -> DataFrame:
    """PSI per column from (column, n_a, n_b), one row per value or bin.

    Two aggregations, both map-side combined: sizes per column, then the sum. A bin
    empty on both sides adds nothing, as both shares become EMPTY_SHARE.
    """
    sizes = counts.groupBy("column").agg(
        F.sum("n_a").alias("size_a"), F.sum("n_b").alias("size_b")
    )
    term = psi_term(
        F.try_divide("n_a", "size_a"), F.try_divide("n_b", "size_b")
    )
    return (
        counts.join(F.broadcast(sizes), "column")  # one row per column
        .groupBy("column")
        .agg(F.sum(term).alias("psi"), F.count(F.lit(1)).alias("classes"))
    )


def aligned_shares(
    df: DataFrame, columns: Sequence[str], is_reference: Column | None = None
) -> DataFrame:
    """(column, value, share_ref, share_cur) over the union of values, absent as 0.

    Both sides are counted in one grouping, so nothing has to be joined to align.
    """
    side = F.col(IS_REFERENCE) if is_reference is None else is_reference
    cells = []
    for c in columns:
        cells += [F.lit(c), F.col(c).cast("string")]
    counts = side_counts(df, side, cells)
    sizes = counts.groupBy("column").agg(
        F.sum("n_a").alias("size_a"), F.sum("n_b").alias("size_b")
    )
    return counts.join(F.broadcast(sizes), "column").select(  # one row per column
        "column",
        "value",
        F.coalesce(F.try_divide("n_a", "size_a"), F.lit(0.0)).alias("share_ref"),
        F.coalesce(F.try_divide("n_b", "size_b"), F.lit(0.0)).alias("share_cur"),
    )


# --------------------------------------------------------------------------
# reports
# --------------------------------------------------------------------------

REPORT_COLUMNS = ["column", "kind", "metric", "value", "drift", "p_method"]


def drift_report(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    skip: Sequence[str] = (),
    is_reference: Column | None = None,
    rule: str = "distinct",
    p_method: str = "asymptotic",
) -> DataFrame:
    """(column, kind, metric, value, drift, p_method): one row per column, all in one job.

    ``rule="distinct"``: numeric columns with more than 20 distinct reference
    values are tested by KS (p < .05 is drift), all else by PSI over values
    (> .2 is drift). ``rule="dtype"``: KS for every numeric column. p_method is null for
    PSI. A side without rows counts as empty classes.
    """
    side = F.col(IS_REFERENCE) if is_reference is None else is_reference
    names = list(columns) if columns else [c for c in df.columns if c != IS_REFERENCE]
    names = [c for c in names if c not in skip]
    numeric, text = split_columns(df.select(*names))
    counts = count_sides(df, numeric, text, side)
    sizes = F.lit(float(counts.rows_a)), F.lit(float(counts.rows_b))
    stability = psi_term(
        F.coalesce(F.try_divide("n_a", sizes[0]), F.lit(0.0)),
        F.coalesce(F.try_divide("n_b", sizes[1]), F.lit(0.0)),
    )
    # KS where it decides, else the index over values; both from the written counts.
    tested = [c for c in numeric if rule == "dtype" or counts.facts[c].distinct_a > CONTINUOUS_ABOVE]
    tested = tested if counts.rows_a + counts.rows_b else []
    rest = [c for c in names if c not in tested]
    name = F.create_map(*[F.lit(x) for pair_ in enumerate(counts.names) for x in pair_])
    distinct = F.create_map(*[F.lit(x) for c in names for x in (c, counts.facts[c].distinct_a)])
    parts = []
    if tested:
        walked = pair_walk(counts.slotted(tested), counts.pair_facts(tested))
        parts.append(walked.select("column", "n_a", "n_b", "d", F.lit(None).cast("double").alias("psi")))
    if rest:
        nothing = F.lit(0).cast("long")
        known = counts.table.where(F.col("id").isin(counts.ids(rest)))
        parts.append(
            known.groupBy("id")
            .agg(F.sum(stability).alias("psi"))
            .select(
                name[F.col("id")].alias("column"), nothing.alias("n_a"), nothing.alias("n_b"), F.lit(None).cast("double").alias("d"), "psi"
            )
        )
    walked = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    walked = walked.withColumn("distinct_a", distinct[F.col("column")])
    is_numeric = F.col("column").isin(numeric) if numeric else F.lit(False)
    by_ks = is_numeric if rule == "dtype" else is_numeric & (F.col("distinct_a") > CONTINUOUS_ABOVE)
    return (
        ks_p_value(walked.withColumn("d", F.when(by_ks, F.col("d"))), p_method)
        .withColumn("by_ks", by_ks)
        .select(
            "column",
            F.when(F.col("by_ks"), "continuous").otherwise("discrete").alias("kind"),
            F.when(F.col("by_ks"), "ks_p_value").otherwise("psi").alias("metric"),
            F.when(F.col("by_ks"), F.col("p_value")).otherwise(F.col("psi")).alias("value"),
            F.when(F.col("by_ks"), F.col("p_value") < KS_ALPHA)
            .otherwise(F.col("psi") > PSI_LIMIT)
            .alias("drift"),
            F.when(F.col("by_ks"), F.col("p_method")).alias("p_method"),
        )
    )


def drift_rollup(report: DataFrame) -> DataFrame:
    """One row: columns checked, drifted, percent (0 of none) and status."""
    pct = F.coalesce(F.try_divide(F.col("n_drift") * 100.0, "n_columns"), F.lit(0.0))
    return (
        report.agg(
            F.count(F.lit(1)).alias("n_columns"), F.count_if("drift").alias("n_drift")
        )
        .withColumn("pct_drift", pct)
        .withColumn(
            "status",  # fixed values: the three labels
            F.when(F.col("pct_drift") > ROLLUP_CRITICAL_PCT, "CRÍTICO")
            .when(F.col("pct_drift") > 0, "ADVERTENCIA")
            .otherwise("ESTABLE"),
        )
    )


def prediction_drift(
    df: DataFrame,
    score: str,
    is_reference: Column | None = None,
    bins: int = 10,
    p_method: str = "asymptotic",
) -> DataFrame:
    """One row for the score column: PSI over bins, KS, and a flag for each and either."""
    side = F.col(IS_REFERENCE) if is_reference is None else is_reference
    counts = count_sides(df, *split_columns(df.select(score)), side)
    index = _psi_from(counts, [score], bins)
    test = _ks_from(counts, [score], p_method)
    return index.join(test, "column").select(
        "column",
        "psi",
        "d",
        "p_value",
        (F.col("psi") > PSI_LIMIT).alias("drift_psi"),
        (F.col("p_value") < KS_ALPHA).alias("drift_ks"),
        ((F.col("psi") > PSI_LIMIT) | (F.col("p_value") < KS_ALPHA)).alias("drift"),
    )
