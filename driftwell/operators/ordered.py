"""Work that needs values in order, without ever putting one column in one task.

Two building blocks:

* ``rank_values`` / ``quantiles``: exact order statistics. A sample suggests a bracket
  around each wanted rank, counting all rows makes the bracket certain, and only the
  rows inside a (small, checked) bracket are counted by value and walked.
* ``pair_walk`` / ``running_counts``: running counts of two samples. Rows are first
  collapsed to counts per distinct value (map-side combined, so a hot value is one
  row), the values are cut into ranges, each range is walked on its own, and the
  range totals are combined.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.functions import no_nan
from driftwell.session import range_buckets

# A bracket with at most this many distinct values may be walked by one task. Above
# it, narrowing is not only safer but faster, as its passes use every core.
WALK_LIMIT = 200_000
# approx_count_distinct is within a few percent; this margin makes the check safe.
DISTINCT_MARGIN = 1.25
SKETCH_ACCURACY = 10_000
# Rows a bracket is guessed from. It bounds what the sketches of all tasks together
# send to their one merging task; a wrong guess costs a round, never a result.
GUESS_ROWS = 10_000_000
# A guess reaches this many standard errors of the sample to each side.
GUESS_ERRORS = 6


# --------------------------------------------------------------------------
# exact order statistics
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class ColumnFacts:
    """What one pass tells about a column; missing values are not counted in n."""

    rows: int
    n: int
    distinct: int
    lo: float | None
    hi: float | None


def column_facts(df: DataFrame, columns: Mapping[str, Column]) -> dict[str, ColumnFacts]:
    """Row count, non-missing count, rough distinct count, min and max: one pass."""
    named = _numeric_view(df, columns)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for name in columns:
        c = F.col(_q(name))
        aggs += [
            F.count(c).alias(f"{name}__n"),
            F.approx_count_distinct(c).alias(f"{name}__d"),
            F.min(c).alias(f"{name}__lo"),
            F.max(c).alias(f"{name}__hi"),
        ]
    row = named.agg(*aggs).first()
    return {
        name: ColumnFacts(
            row["rows"],
            row[f"{name}__n"],
            row[f"{name}__d"],
            row[f"{name}__lo"],
            row[f"{name}__hi"],
        )
        for name in columns
    }


@dataclass
class _Bracket:
    """Values in [lo, hi]: ``size`` rows, ``below`` rows under lo, wanted ranks inside."""

    name: str
    ranks: list[int]
    lo: float
    hi: float
    below: int
    size: int
    distinct: int


def rank_values(
    df: DataFrame,
    wanted: Mapping[str, tuple[Column, Iterable[int]]],
    facts: Mapping[str, ColumnFacts] | None = None,
    walk_limit: int = WALK_LIMIT,
    guesses: Mapping[str, Mapping[int, tuple[float, float]]] | None = None,
) -> dict[str, dict[int, float]]:
    """The k-th smallest non-missing values (1-based), exactly, as Python floats.

    Ranks outside 1..n are left out of the result. ``guesses`` gives an interval that
    is likely to hold a rank's value, for columns of known distribution.
    """
    columns = {name: c for name, (c, _) in wanted.items()}
    if facts is None:
        facts = column_facts(df, columns)
    found: dict[str, dict[int, float]] = {name: {} for name in wanted}
    brackets: list[_Bracket] = []
    guessed: list[tuple[_Bracket, int, float, float]] = []
    for name, (_, ranks) in wanted.items():
        known = facts[name]
        inner = []
        for k in sorted(set(ranks)):
            if guesses and k in guesses.get(name, {}) and 1 <= k <= known.n:
                whole = _Bracket(name, [k], known.lo, known.hi, 0, known.n, known.distinct)
                guessed.append((whole, k, *guesses[name][k]))
            elif k == 1 and known.n:
                found[name][k] = known.lo
            elif k == known.n and known.n:
                found[name][k] = known.hi
            elif 1 < k < known.n:
                inner.append(k)
        if inner:
            brackets.append(
                _Bracket(name, inner, known.lo, known.hi, 0, known.n, known.distinct)
            )

    view = _numeric_view(df, columns)
    if guessed:
        brackets += _certify(view, guessed)
    small, large = _by_size(brackets, walk_limit)
    while large:
        small_again, large = _by_size(_narrow(view, large), walk_limit)
        small += small_again
    if small:
        _walk_brackets(view, small, facts, found)
    return found


def _by_size(brackets: list[_Bracket], limit: int):
    walkable = [
        b for b in brackets if b.lo == b.hi or b.distinct * DISTINCT_MARGIN <= limit
    ]
    return walkable, [b for b in brackets if b not in walkable]


def _narrow(view: DataFrame, brackets: list[_Bracket]) -> list[_Bracket]:
    """One smaller bracket per rank, guessed from a sample and made certain by counts.

    Two passes whatever the number of columns and ranks; each round leaves about a
    thousandth of the rows inside, so two or three rounds do for 10^12 rows.
    """
    picked = view.withColumn("pick__", F.rand(11))
    sketches = []
    for i, b in enumerate(brackets):
        sampled = min(b.size, GUESS_ROWS)
        slack = 2 / SKETCH_ACCURACY + GUESS_ERRORS * 0.5 / math.sqrt(sampled)
        points = []
        for k in b.ranks:
            share = (k - b.below) / b.size
            points += [max(0.0, share - slack), min(1.0, share + slack)]
        listed = ", ".join(f"{p!r}D" for p in points)
        value = _inside(b)
        if b.size > GUESS_ROWS:
            value = F.when(F.col("pick__") < GUESS_ROWS / b.size, value)
        sketches.append(
            F.percentile_approx(
                value, F.expr(f"array({listed})"), F.lit(SKETCH_ACCURACY)
            ).alias(f"p{i}")
        )
    row = picked.agg(*sketches).first()
    return _certify(
        view,
        [
            (b, k, row[f"p{i}"][2 * j], row[f"p{i}"][2 * j + 1])
            for i, b in enumerate(brackets)
            for j, k in enumerate(b.ranks)
        ],
    )


def _certify(
    view: DataFrame, parts: list[tuple[_Bracket, int, float, float]]
) -> list[_Bracket]:
    """Count what lies below and inside each guessed interval (bracket, rank, lo, hi)."""
    aggs = []
    for i, (b, _, lo, hi) in enumerate(parts):
        c = F.col(_q(b.name))
        aggs += [
            F.count_if(c < lo).alias(f"below{i}"),
            F.count_if(c <= hi).alias(f"upto{i}"),
            F.max(F.when(c < lo, c)).alias(f"under{i}"),
            F.min(F.when(c > hi, c)).alias(f"over{i}"),
            F.approx_count_distinct(F.when(c.between(lo, hi), c)).alias(f"distinct{i}"),
        ]
    seen = view.agg(*aggs).first()
    out = []
    for i, (b, k, lo, hi) in enumerate(parts):
        below, upto = seen[f"below{i}"], seen[f"upto{i}"]
        if k <= below:  # the sketch overshot: the rank is under its lower bound
            part = _Bracket(
                b.name, [k], b.lo, seen[f"under{i}"], b.below, below - b.below, b.distinct
            )
        elif k > upto:
            part = _Bracket(
                b.name, [k], seen[f"over{i}"], b.hi, upto, b.below + b.size - upto, b.distinct
            )
        else:
            part = _Bracket(b.name, [k], lo, hi, below, upto - below, seen[f"distinct{i}"])
        if (part.lo, part.hi) == (b.lo, b.hi):
            part = _halve(view, part)
        out.append(part)
    return out


def _halve(view: DataFrame, b: _Bracket) -> _Bracket:
    """Cut a bracket at its middle value, for when a sketch made no progress."""
    c = F.col(_q(b.name))
    middle = b.lo + (b.hi - b.lo) / 2
    row = view.agg(
        F.count_if(c <= middle).alias("n"),
        F.max(F.when(c <= middle, c)).alias("under"),
        F.min(F.when(c > middle, c)).alias("over"),
    ).first()
    k = b.ranks[0]
    if k <= row["n"]:
        hi = row["under"]
        stuck = hi == b.hi
        return _Bracket(
            b.name, b.ranks, b.lo, hi, b.below, row["n"] - b.below, 0 if stuck else b.distinct
        )
    return _Bracket(
        b.name, b.ranks, row["over"], b.hi, row["n"], b.below + b.size - row["n"], b.distinct
    )


def _inside(b: _Bracket) -> Column:
    c = F.col(_q(b.name))
    return F.when(c.between(F.lit(float(b.lo)), F.lit(float(b.hi))), c)


def _walk_brackets(view, brackets, facts, found) -> None:
    cells = []
    for i, b in enumerate(brackets):
        whole = b.lo == facts[b.name].lo and b.hi == facts[b.name].hi
        cells += [F.lit(i), F.col(_q(b.name)) if whole else _inside(b)]
    counts = (
        view.select(F.stack(F.lit(len(brackets)), *cells).alias("bracket", "value"))
        .where(F.col("value").isNotNull())
        .groupBy("bracket", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy("bracket").orderBy("value")
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    hit = None
    for i, b in enumerate(brackets):
        ranks = F.array(*[F.lit(k - b.below) for k in b.ranks])
        here = F.filter(
            ranks, lambda k: (k <= F.col("upto")) & (k > F.col("upto") - F.col("n"))
        )
        test = F.col("bracket") == i
        hit = F.when(test, here) if hit is None else hit.when(test, here)
    rows = (
        counts.withColumn("upto", upto)
        .select("bracket", "value", F.explode(hit).alias("k"))
        .collect()
    )
    for r in rows:
        b = brackets[r["bracket"]]
        found[b.name][r["k"] + b.below] = r["value"]


def quantiles(
    df: DataFrame,
    wanted: Mapping[str, tuple[Column, Sequence[float]]],
    facts: Mapping[str, ColumnFacts] | None = None,
    walk_limit: int = WALK_LIMIT,
) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation between neighbours."""
    columns = {name: c for name, (c, _) in wanted.items()}
    if facts is None:
        facts = column_facts(df, columns)
    requests = {}
    for name, (c, fractions) in wanted.items():
        requests[name] = (c, [k for q in fractions for k in interpolated(facts[name].n, q)[:2]])
    values = rank_values(df, requests, facts, walk_limit)
    out: dict[str, list[float | None]] = {}
    for name, (_, fractions) in wanted.items():
        n, got = facts[name].n, values[name]
        out[name] = []
        for q in fractions:
            if n == 0:
                out[name].append(None)
                continue
            low, high, part = interpolated(n, q)
            out[name].append(got[low] + (got[high] - got[low]) * part)
    return out


def interpolated(n: int, q: float) -> tuple[int, int, float]:
    """Ranks below and above the quantile of n values, and the part of the way between."""
    at = (n - 1) * q
    return math.floor(at) + 1, math.ceil(at) + 1, at - math.floor(at)


# --------------------------------------------------------------------------
# two samples walked in value order
# --------------------------------------------------------------------------


# Sampled rows per value range that the range cuts are drawn from, on the driver. Cuts
# only say where the work is divided; every row is counted whatever they are.
CUT_ROWS = 40
# Rows of one range at most, about: tables with more rows have more ranges.
RANGE_ROWS = 2_000_000
# Up to this many rows one range does.
ONE_RANGE_ROWS = 20_000


@dataclass(frozen=True)
class PairFacts:
    """Per column: range cuts and the non-missing size of both samples."""

    names: list[str]
    cuts: dict[str, list[float]]
    n_a: dict[str, int]
    n_b: dict[str, int]
    rows_a: int
    rows_b: int

    @property
    def slots(self) -> int:
        """Slots per column: the ranges of the most finely cut one, and the missing."""
        return max((len(v) for v in self.cuts.values()), default=0) + 2


def pair_facts(
    df: DataFrame,
    columns: Sequence[str],
    is_a: Column,
    buckets: int | None = None,
) -> PairFacts:
    """Sample sizes by one counting pass, then cuts that balance rows over ranges.

    There are as many ranges as shuffle tasks, and more where a range would have more than
    RANGE_ROWS rows.
    """
    view = df.select(
        is_a.alias("is_a__"), *[no_nan(F.col(_q(c))).alias(c) for c in columns]
    )
    aggs = [F.count_if("is_a__").alias("rows_a"), F.count_if(~F.col("is_a__")).alias("rows_b")]
    for c in columns:
        value = F.col(_q(c))
        aggs.append(F.count(F.when(F.col("is_a__"), value)).alias(f"{c}__a"))
        aggs.append(F.count(F.when(~F.col("is_a__"), value)).alias(f"{c}__b"))
    row = view.agg(*aggs).first()
    rows = row["rows_a"] + row["rows_b"]
    buckets = buckets or max(range_buckets(df.sparkSession), -(-rows // RANGE_ROWS))
    cuts: dict[str, list[float]] = {c: [] for c in columns}
    if columns and buckets > 1 and rows > ONE_RANGE_ROWS:
        cuts = sample_cuts(view.select(*map(_q, columns)), {c: (rows, buckets) for c in columns})
    return PairFacts(
        list(columns),
        cuts,
        {c: row[f"{c}__a"] for c in columns},
        {c: row[f"{c}__b"] for c in columns},
        row["rows_a"],
        row["rows_b"],
    )


def sample_cuts(view: DataFrame, sizes: Mapping[str, tuple[int, int]]) -> dict[str, list[float]]:
    """Cuts of each column into ranges, from a sample that the driver sorts; ``sizes``: rows
    that the column has a value in, and ranges wanted. Rows may leave columns empty."""
    draw, cuts = F.rand(7), {}
    shares = {c: min(1.0, CUT_ROWS * ranges / max(1, rows)) for c, (rows, ranges) in sizes.items()}
    named = view.withColumn("draw__", draw).where(F.col("draw__") < max(shares.values()))
    kept = named.select(*[F.when(F.col("draw__") < shares[c], F.col(_q(c))).alias(c) for c in sizes])
    sample = kept.where(F.coalesce(*[F.col(_q(c)) for c in sizes]).isNotNull()).toPandas()
    for c, (_, ranges) in sizes.items():
        values = np.sort(sample[c].dropna().to_numpy(dtype=float))
        values = values[np.isfinite(values)]
        places = np.arange(1, ranges) * len(values) // ranges
        cuts[c] = sorted(set(values[places].tolist())) if len(values) else []
    return cuts


def value_ranges(df: DataFrame, cuts: Mapping[str, list[float]], suffix: str = "__range") -> DataFrame:
    """Add the range number of every cut column (missing values get none)."""
    cut = [c for c in cuts if cuts[c]]
    out = df
    if cut:
        out = Bucketizer(
            splitsArray=[[float("-inf"), *cuts[c], float("inf")] for c in cut],
            inputCols=cut,
            outputCols=[c + suffix for c in cut],
            handleInvalid="keep",
        ).transform(out)
    return out.withColumns(
        {
            c + suffix: (
                F.when(F.col(_q(c)).isNotNull(), F.col(_q(c + suffix)).cast("int"))
                if c in cut
                else F.when(F.col(_q(c)).isNotNull(), F.lit(0))
            )
            for c in cuts
        }
    )


def pair_counts(
    df: DataFrame, columns: Sequence[str], is_a: Column, facts: PairFacts
) -> DataFrame:
    """(slot, value) -> rows of sample a and of sample b, one row per distinct value.

    A slot is a range of one column: column position * slots + range + 1, and
    column position * slots for missing values. All columns are counted in one shuffle of narrow
    rows, after map-side combining.
    """
    base = df.select(is_a.alias("is_a__"), *[no_nan(F.col(_q(c))).alias(c) for c in columns])
    ranged = value_ranges(base, {c: facts.cuts[c] for c in columns})
    cells: list[Column] = []
    for i, c in enumerate(columns):
        place = F.coalesce(F.col(_q(c + "__range")) + 1, F.lit(0))
        cells += [F.lit(i * facts.slots) + place, F.col(_q(c))]
    return (
        ranged.select("is_a__", F.stack(F.lit(len(columns)), *cells).alias("slot", "value"))
        .groupBy("slot", "value")
        .agg(
            F.count_if("is_a__").alias("n_a"),
            F.count_if(~F.col("is_a__")).alias("n_b"),
        )
    )


def pair_walk(counts: DataFrame, facts: PairFacts, term: Column | None = None) -> DataFrame:
    """Per column: sizes, D, pairs where a is above b, tie term, distinct values.

    Each range is walked alone; a range then contributes its totals and the local
    extremes of the difference of the running shares, which shift by what the
    earlier ranges hold. Only (columns x ranges) rows take part in that last step.
    ``distinct_a``/``distinct_b`` count a missing value as one. ``term``, any
    expression over n_a, n_b, rows_a and rows_b, is summed over all values.
    """
    spark = counts.sparkSession
    sizes = spark.createDataFrame(
        [
            (i, c, int(facts.n_a[c]), int(facts.n_b[c]), facts.rows_a, facts.rows_b)
            for i, c in enumerate(facts.names)
        ],
        "id int, name string, size_a long, size_b long, rows_a long, rows_b long",
    )
    walk = (
        Window.partitionBy("slot")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ordered = F.col("slot") % facts.slots > 0
    column = F.floor(F.col("slot") / facts.slots).cast("int")
    local = (
        counts.withColumn("run_a", F.sum("n_a").over(walk))
        .withColumn("run_b", F.sum("n_b").over(walk))
        .join(F.broadcast(sizes), column == F.col("id"), "left")  # one row per column
    )
    gap = F.when(ordered, _share("run_a", "size_a") - _share("run_b", "size_b"))
    ties = (F.col("n_a") + F.col("n_b")).cast("double")
    above = F.col("n_a").cast("double") * (
        F.col("run_b") - F.col("n_b") + F.col("n_b") / F.lit(2.0)
    )
    ranges = local.groupBy("slot").agg(
        F.first("id").alias("id"),
        F.first("name").alias("column"),
        F.first("size_a").alias("size_a"),
        F.first("size_b").alias("size_b"),
        F.coalesce(F.sum(F.when(ordered, F.col("n_a"))), F.lit(0)).alias("a"),
        F.coalesce(F.sum(F.when(ordered, F.col("n_b"))), F.lit(0)).alias("b"),
        F.max(gap).alias("gap_hi"),
        F.min(gap).alias("gap_lo"),
        F.sum(F.when(ordered, above)).alias("above"),
        F.sum(F.when(ordered, ties * ties * ties - ties)).alias("tie_term"),
        F.count_if(F.col("n_a") > 0).alias("distinct_a"),
        F.count_if(F.col("n_b") > 0).alias("distinct_b"),
        F.sum(term if term is not None else F.lit(None).cast("double")).alias("term"),
    )
    before = (
        Window.partitionBy("id")
        .orderBy("slot")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shifted = ranges.withColumn(
        "a_before", F.coalesce(F.sum("a").over(before), F.lit(0))
    ).withColumn("b_before", F.coalesce(F.sum("b").over(before), F.lit(0)))
    shift = _share("a_before", "size_a") - _share("b_before", "size_b")
    return (
        shifted.withColumn("shift", shift)
        .groupBy("id")
        .agg(
            F.first("column").alias("column"),
            F.first("size_a").alias("n_a"),
            F.first("size_b").alias("n_b"),
            F.greatest(
                F.max(F.abs(F.col("shift") + F.col("gap_hi"))),
                F.max(F.abs(F.col("shift") + F.col("gap_lo"))),
            ).alias("d"),
            F.sum(F.col("above") + F.col("a").cast("double") * F.col("b_before")).alias("u"),
            F.sum("tie_term").alias("tie_term"),
            F.sum("distinct_a").alias("distinct_a"),
            F.sum("distinct_b").alias("distinct_b"),
            F.sum("term").alias("term"),
        )
        .drop("id")
    )


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def ranged_counts(counts: DataFrame, name: str) -> tuple[DataFrame, PairFacts]:
    """(range, value, n_a, n_b) and facts of one column from (value, n_a, n_b), one row per
    distinct value. Ranges balance the values, as these are what is walked."""
    row = counts.agg(F.count("value").alias("values"), F.sum("n_a").alias("a"), F.sum("n_b").alias("b")).first()
    a, b = row["a"] or 0, row["b"] or 0
    buckets = max(range_buckets(counts.sparkSession), -(-row["values"] // RANGE_ROWS))
    cuts: dict[str, list[float]] = {"value": []}
    if buckets > 1 and row["values"] > ONE_RANGE_ROWS:
        cuts = sample_cuts(counts.select("value"), {"value": (row["values"], buckets)})
    place = F.coalesce(F.col("value__range") + 1, F.lit(0)).alias("range")
    ranged = value_ranges(counts, cuts).select(place, "value", "n_a", "n_b")
    return ranged, PairFacts([name], {name: cuts["value"]}, {name: a}, {name: b}, a, b)


def running_counts(
    counts: DataFrame,
    descending: bool = True,
) -> DataFrame:
    """Running totals of n_a and n_b over (range, value), one row per value.

    Adds ``run_a``, ``run_b`` (this value included) and the neighbour counts
    ``next_a``/``next_b`` (NULL on the last value) and ``first`` (true on the first).
    Range totals, one row per range, are the only thing every task gets to see.
    """
    sign = F.desc if descending else F.asc
    walk = Window.partitionBy("range").orderBy(sign("value"))
    upto = walk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lead_edge = F.max_by if descending else F.min_by
    totals = counts.groupBy("range").agg(
        F.sum("n_a").alias("range_a"),
        F.sum("n_b").alias("range_b"),
        lead_edge(F.struct("n_a", "n_b"), "value").alias("edge"),
    )
    order = Window.orderBy(sign("range"))  # one row per range only
    offsets = totals.select(
        "range",
        (F.sum("range_a").over(order) - F.col("range_a")).alias("before_a"),
        (F.sum("range_b").over(order) - F.col("range_b")).alias("before_b"),
        F.lead("edge").over(order).alias("next_edge"),
        (F.row_number().over(order) == 1).alias("first_range"),
    )
    return (
        counts.join(F.broadcast(offsets), "range", "left")
        .withColumn("run_a", F.col("before_a") + F.sum("n_a").over(upto))
        .withColumn("run_b", F.col("before_b") + F.sum("n_b").over(upto))
        .withColumn(
            "next_a", F.coalesce(F.lead("n_a").over(walk), F.col("next_edge.n_a"))
        )
        .withColumn(
            "next_b", F.coalesce(F.lead("n_b").over(walk), F.col("next_edge.n_b"))
        )
        .withColumn(
            "first", F.col("first_range") & (F.row_number().over(walk) == 1)
        )
        .drop("before_a", "before_b", "next_edge", "first_range")
    )


def dense_index(df: DataFrame, draw: str, ties: Sequence[str], index: str, buckets: int) -> DataFrame:
    """1-based position of every row in the order of a uniform [0, 1) column.

    ``draw`` is uniform by construction, so equal slices of [0, 1) hold equal
    shares of the rows; the slices are numbered on their own and shifted.
    """
    sliced = df.withColumn("slice__", F.floor(F.col(draw) * buckets).cast("int"))
    totals = sliced.groupBy("slice__").agg(F.count(F.lit(1)).alias("n__"))
    order = Window.orderBy("slice__")  # one row per slice only
    offsets = totals.select(
        "slice__", (F.sum("n__").over(order) - F.col("n__")).alias("before__")
    )
    within = Window.partitionBy("slice__").orderBy(draw, *ties)
    return (
        sliced.join(F.broadcast(offsets), "slice__", "left")
        .withColumn(index, F.col("before__") + F.row_number().over(within))
        .drop("slice__", "before__")
    )


# --------------------------------------------------------------------------


def _numeric_view(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    return df.select(*[no_nan(c).alias(name) for name, c in columns.items()])


def _q(name: str) -> str:
    return f"`{name}`"
