"""Values of two samples counted once; quantiles, bins, indexes and walks follow from that.

The input is read in one scan: its columns are stacked to narrow cells and counted by
value, combined before the shuffle, and the counts are written. A value that a third of
the rows share is one row. Everything after works on the counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.functions import no_nan
from driftwell.operators.ordered import PairFacts, interpolated, sample_cuts, value_ranges
from driftwell.session import scratch_path

#: Distinct values that one range of a column has, about.
RANGE_VALUES = 1_000_000


@dataclass(frozen=True)
class ColumnCounts:
    """Of one column: non-missing rows, and distinct values with missing as one, on both
    sides; distinct non-missing values of both together."""

    n_a: int
    n_b: int
    distinct_a: int
    distinct_b: int
    values: int


@dataclass(frozen=True)
class SideCounts:
    """``table``: id (place in ``names``), value (numbers) or text, n_a, n_b."""

    table: DataFrame
    names: list[str]
    numeric: list[str]
    facts: dict[str, ColumnCounts]
    rows_a: int
    rows_b: int
    cuts: dict[str, list[float]]

    def ids(self, columns: Iterable[str]) -> list[int]:
        wanted = set(columns)
        return [i for i, c in enumerate(self.names) if c in wanted]

    def pair_facts(self, columns: Sequence[str]) -> PairFacts:
        """What a walk over some numeric columns needs to know."""
        return PairFacts(
            list(columns),
            {c: self.cuts[c] for c in columns},
            {c: self.facts[c].n_a for c in columns},
            {c: self.facts[c].n_b for c in columns},
            self.rows_a,
            self.rows_b,
        )

    def slotted(self, columns: Sequence[str]) -> DataFrame:
        """Rows of some numeric columns with their slot, as `pair_walk` takes them."""
        facts = self.pair_facts(columns)
        rows = self.table.where(F.col("id").isin(self.ids(columns)))
        cut = {f"v{i}": self.cuts[c] for i, c in enumerate(columns) if self.cuts[c]}
        rows = rows.withColumns(
            {f"v{i}": F.when(F.col("id") == self.names.index(c), F.col("value")) for i, c in enumerate(columns) if self.cuts[c]}
        )
        rows = value_ranges(rows, cut)
        place = F.when(F.col("value").isNull(), 0)
        for i, c in enumerate(columns):
            here = F.col(f"v{i}__range") + 1 if self.cuts[c] else F.lit(1)
            place = place.when(F.col("id") == self.names.index(c), here)
        number = F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (self.names.index(c), i)])
        slot = (number[F.col("id")] * F.lit(facts.slots) + place).cast("int")
        return rows.select(slot.alias("slot"), "value", "n_a", "n_b")


def count_sides(df: DataFrame, numeric: Sequence[str], text: Sequence[str], is_a: Column) -> SideCounts:
    """Count all columns by value and side in one scan; NaN counts as missing."""
    names = [*numeric, *text]
    if not names:
        nothing = df.sparkSession.createDataFrame([], "id int, value double, text string, n_a long, n_b long")
        return SideCounts(nothing, [], [], {}, 0, 0, {})
    none = F.lit(None)
    cells = []
    for i, c in enumerate(names):
        column = F.col(f"`{c}`")
        number = no_nan(column) if c in numeric else none.cast("double")
        cells += [F.lit(i), number, none.cast("string") if c in numeric else column.cast("string")]
    stacked = df.select(is_a.alias("is_a__"), F.stack(F.lit(len(names)), *cells).alias("id", "value", "text"))
    counted = stacked.groupBy("id", "value", "text").agg(
        F.count_if("is_a__").alias("n_a"), F.count_if(~F.col("is_a__")).alias("n_b")
    )
    spark = df.sparkSession
    path = scratch_path(spark, "side-counts")
    counted.write.parquet(path)
    table = spark.read.parquet(path)
    known = F.col("value").isNotNull() | F.col("text").isNotNull()
    seen = {
        names[r["id"]]: r
        for r in table.groupBy("id")
        .agg(
            F.sum(F.when(known, F.col("n_a")).otherwise(0)).alias("n_a"),
            F.sum(F.when(known, F.col("n_b")).otherwise(0)).alias("n_b"),
            F.count_if(F.col("n_a") > 0).alias("distinct_a"),
            F.count_if(F.col("n_b") > 0).alias("distinct_b"),
            F.count_if(known).alias("values"),
            F.sum("n_a").alias("rows_a"),
            F.sum("n_b").alias("rows_b"),
        )
        .collect()
    }
    parts = ("n_a", "n_b", "distinct_a", "distinct_b", "values")
    facts = {c: ColumnCounts(*(seen[c][p] for p in parts)) if c in seen else ColumnCounts(0, 0, 0, 0, 0) for c in names}
    first = next(iter(seen.values()), None)
    cuts = _cuts(table, names, numeric, facts)
    return SideCounts(table, names, list(numeric), facts, first["rows_a"] if first else 0, first["rows_b"] if first else 0, cuts)


def _cuts(table, names, numeric, facts) -> dict[str, list[float]]:
    """Cuts between ranges of about RANGE_VALUES distinct values."""
    ranges = {c: -(-facts[c].values // RANGE_VALUES) for c in numeric}
    long = [c for c in numeric if ranges[c] > 1]
    cuts: dict[str, list[float]] = {c: [] for c in numeric}
    if long:
        view = table.select(*[F.when(F.col("id") == names.index(c), F.col("value")).alias(c) for c in long])
        cuts |= sample_cuts(view, {c: (facts[c].values, ranges[c]) for c in long})
    return cuts


def reference_quantiles(counts: SideCounts, columns: Sequence[str], fractions: Sequence[float]) -> dict[str, list[float | None]]:
    """Exact quantiles of side a, linear between neighbours."""
    ranks = {c: {k for q in fractions for k in interpolated(counts.facts[c].n_a, q)[:2]} for c in columns}
    found = order_statistics(counts, {c: r for c, r in ranks.items() if counts.facts[c].n_a})
    out: dict[str, list[float | None]] = {}
    for c in columns:
        out[c] = []
        for q in fractions:
            low, high, part = interpolated(counts.facts[c].n_a, q)
            out[c].append(found[c][low] + (found[c][high] - found[c][low]) * part if counts.facts[c].n_a else None)
    return out


def order_statistics(counts: SideCounts, wanted: Mapping[str, Iterable[int]]) -> dict[str, dict[int, float]]:
    """The k-th smallest values (from 1) of side a.

    Where a column has several ranges, their totals tell which of them hold a wanted rank,
    and only those are sorted.
    """
    columns = [c for c in wanted]
    found: dict[str, dict[int, float]] = {c: {} for c in columns}
    if not columns:
        return found
    slots = counts.pair_facts(columns).slots
    rows = counts.slotted(columns).where((F.col("n_a") > 0) & F.col("value").isNotNull())
    totals: dict[int, list[tuple[int, int]]] = {i: [] for i in range(len(columns))}
    if slots > 2:
        for r in rows.groupBy("slot").agg(F.sum("n_a").alias("n")).orderBy("slot").collect():
            totals[r["slot"] // slots].append((r["slot"], r["n"]))
    else:
        totals = {i: [(i * slots + 1, counts.facts[c].n_a)] for i, c in enumerate(columns)}
    inside: dict[int, list[int]] = {}
    before: dict[int, int] = {}
    for i, c in enumerate(columns):
        ends = np.cumsum([n for _, n in totals[i]])
        for k in sorted(set(wanted[c])):
            if 1 <= k <= counts.facts[c].n_a:
                at = int(np.searchsorted(ends, k))
                slot = totals[i][at][0]
                before[slot] = int(ends[at] - totals[i][at][1])
                inside.setdefault(slot, []).append(k - before[slot])
    if not inside:
        return found
    walk = Window.partitionBy("slot").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranks = F.create_map(*[x for s, ks in inside.items() for x in (F.lit(s), F.array(*[F.lit(k).cast("long") for k in ks]))])
    upto = rows.where(F.col("slot").isin(list(inside))).withColumn("upto", F.sum("n_a").over(walk))
    hits = F.filter(ranks[F.col("slot")], lambda k: (k <= F.col("upto")) & (k > F.col("upto") - F.col("n_a")))
    for r in upto.select("slot", "value", F.explode(hits).alias("k")).collect():
        found[columns[r["slot"] // slots]][r["k"] + before[r["slot"]]] = r["value"]
    return found
