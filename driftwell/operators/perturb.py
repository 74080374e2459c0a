"""Stress a table: scale, shift, collapse, mask, redraw, invert and permute columns.

Random steps draw from the row key and a seed, never from task order, so a lost
task that runs again yields the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.functions import keyed_uniform, recode
from driftwell.operators.ordered import dense_index
from driftwell.session import range_buckets


@dataclass(frozen=True)
class Scale:
    """Multiply by a random factor in [lo, hi) and round half to even."""

    column: str
    lo: float
    hi: float

    def apply(self, draw: Column) -> Column:
        return F.bround(F.col(self.column) * (self.lo + (self.hi - self.lo) * draw), 0)


@dataclass(frozen=True)
class Collapse:
    """Replace codes by others."""

    column: str
    mapping: Mapping

    def apply(self, draw: Column) -> Column:
        return recode(F.col(self.column), self.mapping)


@dataclass(frozen=True)
class Mask:
    """Overwrite a random share of the rows with a constant."""

    column: str
    share: float
    value: object

    def apply(self, draw: Column) -> Column:
        return F.when(draw < self.share, F.lit(self.value)).otherwise(F.col(self.column))


@dataclass(frozen=True)
class Shift:
    column: str
    by: float

    def apply(self, draw: Column) -> Column:
        return F.col(self.column) + F.lit(self.by)


@dataclass(frozen=True)
class Redraw:
    """Replace by a uniform whole number in [lo, hi)."""

    column: str
    lo: int
    hi: int

    def apply(self, draw: Column) -> Column:
        return F.floor(F.lit(self.lo) + F.lit(self.hi - self.lo) * draw)


@dataclass(frozen=True)
class Choice:
    """Replace by one of a few values, equally likely."""

    column: str
    values: Sequence

    def apply(self, draw: Column) -> Column:
        options = F.array(*[F.lit(v) for v in self.values])
        return F.element_at(options, (F.floor(draw * len(self.values)) + 1).cast("int"))


@dataclass(frozen=True)
class Invert:
    """Turn an ordinal scale lo..hi around; values off the scale become missing."""

    column: str
    lo: int
    hi: int

    def apply(self, draw: Column) -> Column:
        c = F.col(self.column)
        return F.when(c.between(self.lo, self.hi), F.lit(self.lo + self.hi) - c)


@dataclass(frozen=True)
class Permute:
    """Shuffle the listed columns independently: marginals stay, the joint breaks."""

    columns: Sequence[str]


def perturb(df: DataFrame, steps: Sequence, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Apply the steps in order. ``key`` must identify a row."""
    out = df
    for i, step in enumerate(steps):
        if isinstance(step, Permute):
            out = permute_columns(out, step.columns, key, f"{seed}-{i}")
            continue
        kind = df.schema[step.column].dataType
        draw = keyed_uniform(key, f"{seed}-{i}-{step.column}")
        out = out.withColumn(step.column, step.apply(draw).cast(kind))
    return out


#: Rows of one slice that is numbered by one task, about.
SLICE_ROWS = 1_000_000


def permute_columns(
    df: DataFrame,
    columns: Sequence[str],
    key: Sequence[str],
    seed: str = "42",
    buckets: int | None = None,
) -> DataFrame:
    """Give every row, per column, the value of another row.

    Rows and values are numbered in two orders of hashed keys and joined on the
    number. Hashes of distinct keys spread evenly over equal slices, of about SLICE_ROWS
    rows where there are more than the shuffle tasks would give; a key that repeats is
    refused.
    """
    buckets = buckets or slices(df, key)
    out = numbered_rows(df, key, seed, buckets).drop(*columns)
    for c in columns:
        out = out.join(numbered_values(df, c, key, seed, buckets), "row__")
    return out.select(*df.columns)


def slices(df: DataFrame, key: Sequence[str]) -> int:
    """Into how many slices rows are numbered; refuses a key that repeats."""
    rows = require_row_key(df, key)
    return max(4 * range_buckets(df.sparkSession), -(-rows // SLICE_ROWS))


def numbered_rows(df: DataFrame, key: Sequence[str], seed: str, buckets: int) -> DataFrame:
    """The rows, ``row__`` being their number; it's the same for all columns to permute."""
    drawn = df.withColumn("draw__", keyed_uniform(key, f"{seed}-rows"))
    return dense_index(drawn, "draw__", key, "row__", buckets).drop("draw__")


def numbered_values(df: DataFrame, column: str, key: Sequence[str], seed: str, buckets: int) -> DataFrame:
    """(row__, column): the values, numbered in the column's own order."""
    drawn = df.select(
        *key, F.col(column).alias("value__"), keyed_uniform(key, f"{seed}-{column}").alias("draw__")
    )
    return dense_index(drawn, "draw__", key, "row__", buckets).select("row__", F.col("value__").alias(column))


def require_row_key(df: DataFrame, key: Sequence[str]) -> int:
    """The number of rows; refuses a key that two rows share, as it doesn't identify rows,
    at any table size.

    Counted exactly, groups combined before they are shuffled.
    """
    groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    seen = groups.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    if (seen["most"] or 0) > 1:
        raise ValueError(f"key {list(key)} repeats, so it doesn't identify rows")
    return seen["rows"] or 0


# The three stress scenarios for the credit table.
CRISIS = (
    Scale("amount", 5.0, 10.0),
    Collapse("savings", {3: 1, 4: 1, 5: 1}),
    Mask("status", 0.5, 1),
    Shift("age", 15),
    Mask("employment_duration", 0.6, 1),
    Mask("property", 0.7, 4),
)
CHAOS = (
    Redraw("status", 1, 5),
    Invert("credit_history", 0, 4),
    Choice("duration", (4, 72)),
    Redraw("amount", 250, 20000),
)
CONCEPT = (
    Permute(("status", "duration", "amount", "age", "credit_history", "savings")),
)
