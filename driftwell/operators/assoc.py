"""Association of columns with a two-valued label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwell.functions import chi_square_p, normal_two_sided_p
from driftwell.operators.ordered import pair_counts, pair_facts, pair_walk
from driftwell.operators.profile import crosstab


def mann_whitney(df: DataFrame, columns: Sequence[str], label: str, with_p: bool = True) -> DataFrame:
    """(column, n_1, n_0, u, z[, p_value]): label 1 against label 0, two-sided.

    U counts pairs where the label-1 value is higher, ties as half. z has the tie
    correction and the continuity correction of 1/2 toward the mean; it is the
    larger of the two one-sided ones, so never negative beyond the correction.
    """
    rows = df.where(F.col(label).isin(0, 1))
    is_one = F.col(label) == 1
    facts = pair_facts(rows, list(columns), is_one)
    walked = pair_walk(pair_counts(rows, list(columns), is_one, facts), facts)
    n1, n0 = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    n = n1 + n0
    spread = F.sqrt(n1 * n0 / 12.0 * ((n + 1) - F.try_divide(F.col("tie_term"), n * (n - 1))))
    higher = F.greatest(F.col("u"), n1 * n0 - F.col("u"))
    out = walked.select(
        "column",
        F.col("n_a").alias("n_1"),
        F.col("n_b").alias("n_0"),
        "u",
        F.try_divide(higher - n1 * n0 / 2.0 - 0.5, spread).alias("z"),
    )
    if not with_p:
        return out
    # With the correction z may fall just below 0, where p is 1.
    return out.withColumn(
        "p_value", F.when(F.col("z") <= 0, 1.0).otherwise(normal_two_sided_p(F.col("z")))
    )


def chi_square(df: DataFrame, columns: Sequence[str], label: str, with_p: bool = True) -> DataFrame:
    """(column, chi2, dof[, p_value]) of independence; 2 x 2 tables get Yates' correction.

    Works on the contingency counts. The total of a value comes from its own few cells;
    the totals per label are joined, by whichever join their size allows.
    """
    cells = crosstab(df, columns, label).select("column", "value", "label", "n")
    by_label = cells.groupBy("column", "label").agg(F.sum("n").alias("col_n"))
    sizes = by_label.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_labels"), F.sum("col_n").alias("total")
    )
    one_value = Window.partitionBy("column", "value")
    expected = F.col("row_n") * F.col("col_n") / F.col("total")
    off = F.col("n") - expected
    joined = (
        cells.withColumn("row_n", F.sum("n").over(one_value))
        .withColumn("first", F.row_number().over(one_value.orderBy("label")) == 1)
        .join(by_label, ["column", "label"])
        .join(F.broadcast(sizes), "column")  # one row per column
        .groupBy("column", "n_labels", "total")
        .agg(
            F.sum(off * off / expected).alias("present_part"),
            F.sum(expected).alias("present_e"),
            F.count(F.lit(1)).alias("present"),
            F.count_if("first").alias("n_values"),
            F.max(F.abs(off)).alias("gap"),
            F.min("row_n").alias("row_lo"),
            F.min("col_n").alias("col_lo"),
        )
    )
    dof = (F.col("n_values") - 1) * (F.col("n_labels") - 1)
    # An absent cell has O = 0 and adds its E; all E together make the total.
    absent_part = F.when(
        F.col("present") == F.col("n_values") * F.col("n_labels"), F.lit(0.0)
    ).otherwise(F.col("total") - F.col("present_e"))
    # In a 2 x 2 table |O - E| is the same in every cell, and the sum of 1 / E is
    # total^3 over the product of the four margins.
    total = F.col("total").cast("double")
    shrunk = F.greatest(F.col("gap") - 0.5, F.lit(0.0))
    margins = (
        F.col("row_lo") * (total - F.col("row_lo")) * F.col("col_lo") * (total - F.col("col_lo"))
    )
    corrected = F.try_divide(total * total * total * shrunk * shrunk, margins)
    out = joined.select(
        "column",
        F.when(dof == 1, corrected)
        .when(dof == 0, F.lit(0.0))
        .otherwise(F.col("present_part") + absent_part)
        .alias("chi2"),
        dof.alias("dof"),
    )
    return out.withColumn("p_value", chi_square_p(F.col("chi2"), F.col("dof"))) if with_p else out


def associate(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str
) -> dict[str, DataFrame]:
    """Both tests over all columns, by name."""
    return {
        "mann_whitney": mann_whitney(df, numeric, label),
        "chi_square": chi_square(df, categorical, label),
    }
