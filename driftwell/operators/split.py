"""Ordered and stratified splits with exact sizes, without ranking every row."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.functions import keyed_uniform, no_nan
from driftwell.operators.ordered import ColumnFacts, column_facts, rank_values
from driftwell.session import scratch_path


def as_number(df: DataFrame, column: str) -> Column:
    """Order-preserving double of a number, date or timestamp (microseconds)."""
    kind = dict(df.dtypes)[column]
    c = F.col(column)
    if kind == "timestamp_ntz":  # through no zone: clock changes would break the order
        clock = (F.hour(c) * 60 + F.minute(c)) * 60 + F.extract(F.lit("SECOND"), c)
        return F.unix_date(c.cast("date")) * F.lit(86_400e6) + clock * F.lit(1e6)
    if kind.startswith("timestamp"):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if kind == "date":
        return F.unix_date(c).cast("double")
    return no_nan(c)


def ordered_split(df: DataFrame, order: str, share: float = 0.7) -> DataFrame:
    """Add ``is_reference``: true for the first ``share`` of rows by the order column.

    The cut is the value at position int(n * share); rows that tie with it belong to
    the current part, so no value is on both sides. Missing values are current.
    """
    position = as_number(df, order)
    facts = column_facts(df, {"o": position})
    n = facts["o"].n
    k = int(n * share) + 1
    if n == 0 or k > n:
        return df.withColumn("is_reference", position.isNotNull())
    cut = rank_values(df, {"o": (position, [k])}, facts)["o"][k]
    return df.withColumn("is_reference", F.coalesce(position < F.lit(cut), F.lit(False)))


def class_sizes(df: DataFrame, label: str) -> dict[object, int]:
    """Rows per label value (a label has few)."""
    rows = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r[label]: r["n"] for r in rows}


def allocate(sizes: dict[object, int], total: int) -> dict[object, int]:
    """Share ``total`` over the classes in proportion; largest remainders get the rest."""
    whole = sum(sizes.values())
    exact = {k: n * total / whole for k, n in sizes.items()}
    out = {k: math.floor(v) for k, v in exact.items()}
    left = total - sum(out.values())
    order = sorted(sizes, key=lambda k: (-(exact[k] - out[k]), str(k)))
    for k in order[:left]:
        out[k] += 1
    return out


#: Up to so many classes their draws are cut by order statistics, one column a class, and
#: rows aren't shuffled; more classes are cut by a table of bounds.
FEW_CLASSES = 256
#: Rows of a class that one task ranks, about.
SLICE_ROWS = 1_000_000


def stratified_split(
    df: DataFrame,
    label: str,
    key: Sequence[str],
    test_share: float = 0.2,
    salt: str = "split-42",
) -> DataFrame:
    """Add ``is_test``: within each class the rows with the smallest keyed draws.

    Sizes are exact for a unique key: ceil(share * n) test rows, spread over the
    classes in proportion. Rows that agree in the key go to the same part.
    """
    few = _few_sizes(df, label)
    if few is not None:
        rows = sum(few.values())
        train = allocate(few, rows - math.ceil(test_share * rows))
        quota = {k: n - train[k] for k, n in few.items()}
        cut = _cut_classes(df, label, key, few, {k: [q] for k, q in quota.items()}, salt)
    else:
        sizes = _sizes(df, label)
        rows = sizes.agg(F.sum("n")).first()[0] or 0
        quotas = _allocated(sizes, rows, rows - math.ceil(test_share * rows))
        cut = _cut_by_table(df, label, key, quotas.select(CLASS, "n", F.array(F.col("n") - F.col("share")).alias("cuts")), salt)
    return cut.select(*df.columns, (F.col("part__") == 0).alias("is_test"))


def stratified_folds(
    df: DataFrame,
    label: str,
    key: Sequence[str],
    folds: int = 5,
    salt: str = "folds-42",
    name: str = "fold",
) -> DataFrame:
    """Add a fold number 0..folds-1; within each class fold sizes differ by at most 1."""
    few = _few_sizes(df, label)
    if few is not None:
        cuts = {
            k: [sum(n // folds + (i < n % folds) for i in range(j + 1)) for j in range(folds - 1)]
            for k, n in few.items()
        }
        cut = _cut_classes(df, label, key, few, cuts, salt)
    else:
        n = F.col("n")
        ends = [F.floor(n / folds) * (j + 1) + F.least(n % folds, F.lit(j + 1)) for j in range(folds - 1)]
        cut = _cut_by_table(df, label, key, _sizes(df, label).select(CLASS, "n", F.array(*ends).alias("cuts")), salt)
    return cut.select(*df.columns, F.col("part__").alias(name))


CLASS = "class__"


def _sizes(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(F.col(label).alias(CLASS)).agg(F.count(F.lit(1)).alias("n"))


def _few_sizes(df: DataFrame, label: str) -> dict[object, int] | None:
    """Rows per class, or None if there are more than FEW_CLASSES."""
    rows = _sizes(df, label).limit(FEW_CLASSES + 1).collect()
    return {r[CLASS]: r["n"] for r in rows} if len(rows) <= FEW_CLASSES else None


def _allocated(sizes: DataFrame, rows: int, total: int) -> DataFrame:
    """`allocate` as a table: class, n, share. The classes with the largest remainders are
    found by sorting in ranges, whatever their number."""
    exact = F.col("n") * F.lit(total) / F.lit(max(rows, 1))
    shares = sizes.withColumns({"share": F.floor(exact), "rest": exact - F.floor(exact)})
    order = [F.desc("rest"), F.coalesce(F.col(CLASS).cast("string"), F.lit("None")).asc()]
    path = scratch_path(sizes.sparkSession, "classes")
    placed = shares.repartitionByRange(*order).sortWithinPartitions(*order)
    # Of a sorted range its number, and the class's place in it.
    placed.withColumn("place", F.monotonically_increasing_id()).write.parquet(path)
    placed = sizes.sparkSession.read.parquet(path).withColumn("range", F.shiftright("place", 33))
    left = total - (placed.agg(F.sum("share")).first()[0] or 0)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = placed.groupBy("range").agg(F.count(F.lit(1)).alias("held"), F.min("place").alias("first"))
    offsets = offsets.select("range", (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    more = (F.col("place") + F.col("shift") < F.lit(left)).cast("long")
    return placed.join(F.broadcast(offsets), "range").select(CLASS, "n", (F.col("share") + more).alias("share"))


def _cut_by_table(df: DataFrame, label: str, key: Sequence[str], cuts: DataFrame, salt: str) -> DataFrame:
    """Number the parts of each class by the ranks of a keyed draw, from a table class, n,
    cuts (ascending ranks).

    Only labels and draws are ranked, a large class in slices of its draws; their bounds
    are joined to the rows by class.
    """
    drawn = df.withColumn("draw__", keyed_uniform(key, salt))
    slim = drawn.select(F.col(label).alias("of__"), "draw__").join(cuts, F.col("of__").eqNullSafe(F.col(CLASS)))
    slices = F.ceil(F.col("n") / SLICE_ROWS)
    slim = slim.withColumn("slice", F.least(F.floor(F.col("draw__") * slices), slices - 1))
    # The class as a text, so that a missing one is joined like others.
    slim = slim.withColumn("of__", F.coalesce(F.concat(F.lit("="), F.col(CLASS).cast("string")), F.lit("")))
    whole = Window.partitionBy("of__").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = slim.groupBy("of__", "slice").agg(F.count(F.lit(1)).alias("held")).select(
        "of__", "slice", F.coalesce(F.sum("held").over(whole), F.lit(0)).alias("before")
    )
    inside = F.rank().over(Window.partitionBy("of__", "slice").orderBy("draw__"))
    ranked = slim.withColumn("inside", inside).join(before, ["of__", "slice"]).withColumn("rank", F.col("before") + F.col("inside"))
    cell = F.posexplode("cuts").alias("place", "cut")
    bounds = (
        ranked.select(CLASS, "draw__", "rank", cell)
        .groupBy(CLASS, "place")
        .agg(F.max(F.when(F.col("rank") <= F.col("cut"), F.col("draw__"))).alias("bound"))
        .groupBy(CLASS)
        .agg(F.collect_list(F.coalesce("bound", F.lit(-1.0))).alias("bounds"))  # one per cut
    )
    joined = drawn.join(bounds, F.col(label).eqNullSafe(F.col(CLASS)))
    part = F.aggregate("bounds", F.lit(0), lambda n, bound: n + (F.col("draw__") > bound).cast("int"))
    return joined.withColumn("part__", part)


def _cut_classes(df, label, key, rows_of, cuts, salt) -> DataFrame:
    """Number the parts of each class (``rows_of`` it) by the ranks of a keyed draw.

    The draws at the cut ranks are found as order statistics, one conditional
    column per class; then every row compares its own draw.
    """
    drawn = df.withColumn("draw__", keyed_uniform(key, salt))
    classes = list(cuts)
    same = {k: F.col(label).eqNullSafe(F.lit(k)) for k in classes}
    wanted = {
        f"c{i}": (F.when(same[k], F.col("draw__")), [r for r in cuts[k] if r >= 1])
        for i, k in enumerate(classes)
    }
    sizes = {f"c{i}": n for i, n in enumerate(rows_of[k] for k in classes)}
    facts = {c: ColumnFacts(n, n, n, 0.0, 1.0) for c, n in sizes.items()}
    # A draw's rank is near its share; twelve standard errors make a sure bracket.
    guesses = {
        c: {
            r: (r / sizes[c] - 6 / math.sqrt(sizes[c]), r / sizes[c] + 6 / math.sqrt(sizes[c]))
            for r in ranks
        }
        for c, (_, ranks) in wanted.items()
    }
    found = rank_values(drawn, wanted, facts, guesses=guesses)
    part = None
    for i, k in enumerate(classes):
        place: Column = F.lit(0)
        for rank in cuts[k]:
            bound = found[f"c{i}"].get(rank, -1.0)
            place = place + (F.col("draw__") > F.lit(bound)).cast("int")
        part = (F if part is None else part).when(same[k], place)
    return drawn.withColumn("part__", part if part is not None else F.lit(0))
