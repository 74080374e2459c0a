"""Range rules per record: one pass marks every broken rule of every row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.spec import TableSpec

FAILURES = "failures"
# Fixed value: most applications one request may carry.
REQUEST_CAP = 100


@dataclass(frozen=True)
class Rule:
    """Value must be present and within [lo, hi]; ``whole`` also asks for no fraction."""

    column: str
    lo: float
    hi: float
    whole: bool = True

    @property
    def name(self) -> str:
        return f"{self.column} in [{self.lo}, {self.hi}]"

    def broken(self) -> Column:
        return self.fails(F.col(self.column))

    def fails(self, c: Column) -> Column:
        """Whether a value breaks the rule; a missing one does."""
        ok = c.between(self.lo, self.hi)
        if self.whole:
            ok = ok & (c == F.floor(c))
        return ~F.coalesce(ok, F.lit(False))


def rules_of(spec: TableSpec) -> list[Rule]:
    out = []
    for f in spec.fields:
        lo, hi = f.check_range
        if f.kind != "label" and lo is not None:
            out.append(Rule(f.name, lo, hi))
    return out


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``failures``: array of (column, value) for every broken rule."""
    marks = F.array(
        *[
            F.when(
                r.broken(),
                F.struct(
                    F.lit(r.column).alias("column"),
                    F.col(r.column).cast("string").alias("value"),
                ),
            )
            for r in rules
        ]
    )
    return df.withColumn(FAILURES, F.filter(marks, lambda m: m.isNotNull()))


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their failures)."""
    checked = check_rules(df, rules)
    return (
        checked.where(F.size(FAILURES) == 0).drop(FAILURES),
        checked.where(F.size(FAILURES) > 0),
    )


def reject_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(column, rejected) for every rule, also those nobody broke: one row leaves the scan."""
    wide = df.agg(*[F.count_if(r.broken()).alias(f"r{i}") for i, r in enumerate(rules)])
    cells: list[Column] = []
    for i, r in enumerate(rules):
        cells += [F.lit(r.column), F.col(f"r{i}")]
    return wide.select(F.stack(F.lit(len(rules)), *cells).alias("column", "rejected"))


def explode_requests(df: DataFrame, applications: str, cap: int = REQUEST_CAP) -> DataFrame:
    """One row per application of a request that carries a list of them.

    ``batch_ok`` is false for the rows of an empty or over-long request.
    """
    n = F.coalesce(F.size(applications), F.lit(0))
    return (
        df.withColumn("batch_ok", (n >= 1) & (n <= cap))
        .withColumn("application", F.explode_outer(applications))
        .select(*[c for c in df.columns if c != applications], "batch_ok", "application.*")
    )


def whole_requests(df: DataFrame, request: str, rules: Sequence[Rule]) -> DataFrame:
    """(request, valid): a request passes only if each of its records does.

    A plain aggregate with map-side combining, so a huge request is no hot task.
    """
    broken = rules[0].broken()
    for r in rules[1:]:
        broken = broken | r.broken()
    return df.groupBy(request).agg((~F.bool_or(broken)).alias("valid"))
