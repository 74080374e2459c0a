"""From a dirty text table to a typed table with known domains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwell.functions import clip, keep_listed, no_nan, recode, to_number
from driftwell.operators.ordered import column_facts, quantiles, rank_values
from driftwell.spec import TableSpec

# Label codes of the package cleaner and of the exploratory one.
LABEL_CODES = {1: 1, 2: 0}
LABEL_CODES_EXPLORATORY = {2: 1, 3: 0}
WINSOR_SHARE = 0.01


@dataclass(frozen=True)
class CleanOptions:
    label_codes: Mapping[int, int] = field(default_factory=lambda: dict(LABEL_CODES))
    valid_labels: tuple[int, ...] = (0, 1)
    # "exact" keeps a half median until the integer cast cuts it; "half_even" rounds it.
    median_rounding: str = "exact"
    winsor_share: float = WINSOR_SHARE
    winsor_columns: Sequence[str] | None = None
    # "clip" moves a code to the nearest bound; "list" turns it into missing.
    domain: str = "clip"
    drop_duplicates: bool = False


@dataclass(frozen=True)
class FittedCleaner:
    """What cleaning learned: fills and winsor bounds, a few numbers per column."""

    fills: dict[str, float]
    bounds: dict[str, tuple[float, float]]
    rows_in: int
    rows_kept: int


# --------------------------------------------------------------------------
# single steps
# --------------------------------------------------------------------------


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename what is there; unknown names are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def coerce_numbers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Every (listed) column to double, junk to NULL, in one projection."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    todo = columns or df.columns
    return df.withColumns(
        {
            c: no_nan(F.col(c))
            if isinstance(kinds[c], T.NumericType)
            else to_number(F.col(c))
            for c in todo
        }
    )


def remap_codes(df: DataFrame, column: str, mapping: Mapping) -> DataFrame:
    return df.withColumn(column, recode(F.col(column), mapping))


def keep_valid(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def removed_count(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """(rows_in, rows_kept, rows_removed) of a validity filter, in one pass."""
    valid = F.coalesce(F.col(column).isin(list(values)), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(valid).alias("rows_kept"),
        F.count_if(~valid).alias("rows_removed"),
    )


def clip_domain(df: DataFrame, domains: Mapping[str, tuple]) -> DataFrame:
    return df.withColumns({c: clip(F.col(c), lo, hi) for c, (lo, hi) in domains.items()})


def restrict_to_list(df: DataFrame, lists: Mapping[str, Sequence]) -> DataFrame:
    return df.withColumns({c: keep_listed(F.col(c), v) for c, v in lists.items()})


def drop_duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(columns)) if columns else df.dropDuplicates()


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(rows_in, rows_kept, rows_removed) of a duplicate removal.

    Copies collapse before the shuffle, so a hot group of copies is one row.
    """
    names = list(columns) if columns else df.columns
    groups = df.groupBy(*names).agg(F.count(F.lit(1)).alias("copies__"))
    return groups.agg(
        F.coalesce(F.sum("copies__"), F.lit(0)).alias("rows_in"),
        F.count(F.lit(1)).alias("rows_kept"),
        F.coalesce(F.sum(F.col("copies__") - 1), F.lit(0)).alias("rows_removed"),
    )


def align_columns(df: DataFrame, expected: Sequence[str], fill=0) -> DataFrame:
    """Expected columns in order; an absent one is filled."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(fill).alias(c) for c in expected])


def fill_defaults(df: DataFrame, defaults: Mapping[str, float]) -> DataFrame:
    """Given values win over defaults; absent columns are created."""
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v)
            for c, v in defaults.items()
        }
    )


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent non-missing value per column, the smallest on a tie.

    Values are counted as groups (combined map-side), so a column of any
    cardinality stays spread; one row per column reaches the driver.
    """
    if not columns:
        return {}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out: dict[str, object] = {}
    for kind, part in _numeric_groups(columns, kinds):
        cells: list[Column] = []
        for c in part:
            cells += [F.lit(c), no_nan(F.col(c)) if kind == "double" else F.col(c).cast(kind)]
        rows = (
            df.select(F.stack(F.lit(len(part)), *cells).alias("column", "value"))
            .where(F.col("value").isNotNull())
            .groupBy("column", "value")
            .agg(F.count(F.lit(1)).alias("n"))
            .groupBy("column")
            .agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("best"))
            .collect()
        )
        out.update({r["column"]: r["best"]["value"] for r in rows})
    return out


def _numeric_groups(columns: Sequence[str], kinds: Mapping) -> list[tuple[str, list[str]]]:
    """Columns that can be stacked without losing digits: whole numbers, floats, each
    decimal type, and all else as text."""
    groups: dict[str, list[str]] = {}
    for c in columns:
        kind = kinds[c]
        if isinstance(kind, T.IntegralType):
            name = "bigint"
        elif isinstance(kind, T.DecimalType):
            name = kind.simpleString()
        else:
            name = "double" if isinstance(kind, T.NumericType) else "string"
        groups.setdefault(name, []).append(c)
    return list(groups.items())


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    got = quantiles(df, {c: (F.col(c), [0.5]) for c in columns})
    return {c: got[c][0] for c in columns}


def impute(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """Fill missing values; a column that has no fill is left alone, and a column keeps
    its type where the fill fits it (a half as the median of whole numbers doesn't)."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    filled = {}
    for c, v in fills.items():
        if v is None:
            continue
        whole = isinstance(kinds[c], (T.IntegralType, T.DecimalType))
        if whole and (not isinstance(v, float) or v.is_integer()):
            filled[c] = F.coalesce(F.col(c), F.lit(int(v) if isinstance(v, float) else v).cast(kinds[c]))
        else:
            filled[c] = F.coalesce(no_nan(F.col(c)) if isinstance(v, float) else F.col(c), F.lit(v))
    return df.withColumns(filled)


def winsor_ranks(n: int, share: float = WINSOR_SHARE) -> tuple[int, int]:
    """1-based ranks whose values become the lower and upper bound."""
    k = int(share * n)
    return k + 1, n - k


def winsorize(df: DataFrame, columns: Sequence[str], share: float = WINSOR_SHARE) -> DataFrame:
    """The lowest and highest ``share`` of values move to the next value inside.

    Equals clamping to two order statistics, so no row has to be ranked.
    """
    wanted = {c: F.col(c) for c in columns}
    facts = column_facts(df, wanted)
    ranks = {c: winsor_ranks(facts[c].n, share) for c in columns}
    found = rank_values(df, {c: (F.col(c), ranks[c]) for c in columns}, facts)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {
            c: clip(
                F.col(c),
                *[F.lit(found[c][k]).cast(kinds[c]) for k in ranks[c]],
            )
            for c in columns
            if facts[c].n
        }
    )


def final_checks(df: DataFrame, label: str, valid_labels: Sequence[int] = (0, 1)) -> DataFrame:
    """One row: missing cells in total and rows whose label is not valid."""
    bad_label = ~F.coalesce(F.col(label).isin(list(valid_labels)), F.lit(False))
    missing = [F.count_if(F.col(c).isNull()) for c in df.columns]
    total = missing[0]
    for m in missing[1:]:
        total = total + m
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        total.alias("missing_cells"),
        F.count_if(bad_label).alias("invalid_labels"),
    )


def require_clean(df: DataFrame, label: str, valid_labels: Sequence[int] = (0, 1)) -> None:
    row = final_checks(df, label, valid_labels).first()
    if row["missing_cells"]:
        raise ValueError(f"{row['missing_cells']} missing cells are left")
    if row["invalid_labels"]:
        raise ValueError(f"{row['invalid_labels']} rows carry a label outside {valid_labels}")


# --------------------------------------------------------------------------
# the whole cleaner
# --------------------------------------------------------------------------


def _typed(raw: DataFrame, spec: TableSpec, options: CleanOptions) -> tuple[DataFrame, Column]:
    """Steps that need nothing learned, and the test for rows with a valid label."""
    df = coerce_numbers(drop_columns(rename_columns(raw, spec.renames), spec.junk))
    if spec.label not in df.columns:
        return df, F.lit(True)
    codes = {float(k): float(v) for k, v in options.label_codes.items()}
    df = remap_codes(df, spec.label, codes)
    return df, F.col(spec.label).isin([float(v) for v in options.valid_labels])


def fit_cleaner(raw: DataFrame, spec: TableSpec, options: CleanOptions | None = None) -> FittedCleaner:
    """Learn fills and bounds in three passes, whatever the number of columns.

    The order statistics of the imputed column follow from those of the column
    as it stands, because imputing only inserts copies of the median; so no pass
    over imputed data is needed.
    """
    options = options or CleanOptions()
    typed, valid = _typed(raw, spec, options)
    rows = typed.where(valid)
    present = [c for c in rows.columns if c != spec.label]
    numeric = [c for c in spec.names("numeric") if c in present]
    rounded = [
        c
        for c in spec.names("numeric", "integer")
        if c in present and (c in numeric or options.median_rounding == "half_even")
    ]
    winsor = [c for c in (options.winsor_columns or numeric) if c in present]
    # Kept and removed rows are counted in the pass that gathers the facts.
    watched = {c: F.when(valid, F.col(c)) for c in present}
    watched["kept__"] = F.when(valid, F.lit(1.0))
    facts = column_facts(typed, watched)
    kept, rows_in = facts["kept__"].n, facts["kept__"].rows

    wanted: dict[str, tuple[Column, list[int]]] = {}
    for c in dict.fromkeys([*rounded, *winsor]):
        n, holes = facts[c].n, kept - facts[c].n
        ranks = [(n + 1) // 2, n // 2 + 1]
        if c in winsor:
            for k in winsor_ranks(kept, options.winsor_share):
                ranks += [k, k - holes]
        wanted[c] = (F.col(c), [k for k in ranks if 1 <= k <= n])
    values = rank_values(rows, wanted, facts)

    fills: dict[str, float] = {}
    bounds: dict[str, tuple[float, float]] = {}
    for c in wanted:
        n, holes, got = facts[c].n, kept - facts[c].n, values[c]
        median = (got[(n + 1) // 2] + got[n // 2 + 1]) / 2 if n else None
        if median is not None and options.median_rounding == "half_even":
            median = float(round(median))
        if c in rounded and holes:
            fills[c] = 0.0 if median is None else median
        if c in winsor and kept:
            fill = fills.get(c, 0.0)
            low, high = winsor_ranks(kept, options.winsor_share)
            bounds[c] = (
                _rank_after_fill(low, n, holes, fill, got),
                _rank_after_fill(high, n, holes, fill, got),
            )
    coded = [
        c
        for c in spec.names("category")
        if c in present and facts[c].n < kept and facts[c].n > 0
    ]
    fills.update(modes(rows, coded))
    return FittedCleaner(fills, bounds, rows_in, kept)


def _rank_after_fill(k: int, n: int, holes: int, fill: float, got: Mapping[int, float]) -> float:
    """k-th smallest once ``holes`` copies of ``fill`` join the n sorted values."""
    if k <= n and got[k] <= fill:
        return got[k]
    if k - holes >= 1:
        return max(fill, got[k - holes])
    return fill


def apply_cleaner(
    raw: DataFrame, spec: TableSpec, fitted: FittedCleaner, options: CleanOptions | None = None
) -> DataFrame:
    """The cleaned table: one lazy projection over the scan."""
    options = options or CleanOptions()
    typed, valid = _typed(raw, spec, options)
    df = typed.where(valid)
    types = {f.name: f.dataType for f in spec.clean_schema().fields}
    out = {}
    for c in df.columns:
        value = F.coalesce(F.col(c), F.lit(float(fitted.fills.get(c, 0.0))))
        if c in fitted.bounds:
            value = clip(value, *fitted.bounds[c])
        declared = spec.field(c) if c in types else None
        if declared and declared.kind == "category" and declared.lo is not None:
            if options.domain == "clip":
                value = clip(value, float(declared.lo), float(declared.hi))
            else:
                value = F.when(value.between(declared.lo, declared.hi), value)
        # Casting a double to an integer cuts toward zero.
        out[c] = value.cast(types[c]) if c in types else value
    df = df.select(*[v.alias(c) for c, v in out.items()])
    return drop_duplicate_rows(df) if options.drop_duplicates else df


def clean(
    raw: DataFrame, spec: TableSpec, options: CleanOptions | None = None
) -> tuple[DataFrame, FittedCleaner]:
    fitted = fit_cleaner(raw, spec, options)
    return apply_cleaner(raw, spec, fitted, options), fitted


def clean_stats(spark, fitted: FittedCleaner) -> DataFrame:
    """What the cleaner learned as a table (column, what, value)."""
    rows = [("*", "rows_in", float(fitted.rows_in)), ("*", "rows_kept", float(fitted.rows_kept))]
    rows += [(c, "fill", float(v)) for c, v in fitted.fills.items()]
    for c, (lo, hi) in fitted.bounds.items():
        rows += [(c, "lower_bound", float(lo)), (c, "upper_bound", float(hi))]
    return spark.createDataFrame(rows, "column string, what string, value double")
