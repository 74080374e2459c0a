from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


_entries: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, folder of the tables)."""

    def add(run: Query) -> Query:
        if name in _entries:
            raise ValueError(f"{name} is registered twice")
        _entries[name] = Entry(run, sql)
        return run

    return add


def entries() -> dict[str, Entry]:
    return dict(_entries)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles cut to what two engines agree on; summing order moves the rest."""
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


# --- SQL building blocks ---------------------------------------------------


def uniform_sql(keys: Sequence[str], salt: str) -> str:
    parts = ", ".join([*[f"CAST({k} AS VARCHAR)" for k in keys], f"'{salt}'"])
    return (
        f"(CAST(CAST('0x' || substr(md5(concat_ws('|', {parts})), 1, 13) AS UBIGINT) AS DOUBLE)"
        " / 4503599627370496.0)"
    )


def union_all(parts: Sequence[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def psi_sum(a: str = "a", b: str = "b") -> str:
    """Index from two share expressions that may be 0."""
    p = f"CASE WHEN {a} > 0 THEN {a} ELSE 0.0001 END"
    q = f"CASE WHEN {b} > 0 THEN {b} ELSE 0.0001 END"
    return f"sum((({q}) - ({p})) * ln(({q}) / ({p})))"


def psi_by_value(source: str, column: str, ref: str, value: str | None = None) -> str:
    """SELECT psi, classes of one column compared value by value."""
    return f"""
SELECT '{column}' AS "column", {psi_sum('sa', 'sb')} AS psi, count(*) AS classes
FROM (SELECT a / sum(a) OVER () AS sa, b / sum(b) OVER () AS sb
      FROM (SELECT {value or column} AS v, count(*) FILTER ({ref}) AS a,
                   count(*) FILTER (NOT ({ref})) AS b
            FROM {source} GROUP BY 1))"""


DECILES = "[0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]"


def psi_by_bin(source: str, column: str, ref: str, widen: bool = True) -> str:
    """SELECT psi, classes of one column cut at the reference deciles."""
    inside = "TRUE" if widen else "v >= e[1] AND v <= e[len(e)]"
    return f"""
SELECT '{column}' AS "column", {psi_sum('sa', 'sb')} AS psi, count(*) AS classes
FROM (SELECT a / sum(a) OVER () AS sa, b / sum(b) OVER () AS sb
      FROM (SELECT CASE WHEN {inside} THEN len([x FOR x IN e[2:len(e) - 1] IF v > x]) END AS bin,
                   count(*) FILTER (r) AS a, count(*) FILTER (NOT r) AS b
            FROM (SELECT CAST({column} AS DOUBLE) AS v, ({ref}) AS r FROM {source}),
                 (SELECT list_sort(list_distinct(quantile_cont(CAST({column} AS DOUBLE), {DECILES}))) AS e
                  FROM {source} WHERE {ref})
            GROUP BY 1))"""


def ks_sql(source: str, column: str, ref: str) -> str:
    """SELECT column, n_ref, n_cur, d of one column."""
    return f"""
SELECT '{column}' AS "column", max(na) AS n_ref, max(nb) AS n_cur,
       max(abs(ra / na - rb / nb)) AS d
FROM (SELECT sum(a) OVER (ORDER BY v) AS ra, sum(b) OVER (ORDER BY v) AS rb,
             sum(a) OVER () AS na, sum(b) OVER () AS nb
      FROM (SELECT {column} AS v, count(*) FILTER ({ref}) AS a,
                   count(*) FILTER (NOT ({ref})) AS b
            FROM {source} WHERE {column} IS NOT NULL GROUP BY 1))"""


def kolmogorov_sql(lam: str) -> str:
    terms = (
        f"list_sum([CASE WHEN j % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * j * j * ({lam}) * ({lam}))"
        " FOR j IN range(1, 101)])"
    )
    return f"(CASE WHEN ({lam}) < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, {terms})) END)"


KS_LAMBDA = "d * sqrt(CAST(n_ref AS DOUBLE) * n_cur / (CAST(n_ref AS DOUBLE) + n_cur))"


def simpson_sql(f: str, lo: str, hi: str, steps: int = 4000) -> str:
    """Integral of ``f``, an expression of t, by Simpson's rule."""
    weight = f"CASE WHEN j = 0 OR j = {steps} THEN 1 WHEN j % 2 = 1 THEN 4 ELSE 2 END"
    cell = f.replace("@t", f"(({lo}) + j * (({hi}) - ({lo})) / {steps}.0)")
    return f"((({hi}) - ({lo})) / {3 * steps}.0 * list_sum([({weight}) * ({cell}) FOR j IN range(0, {steps + 1})]))"


def normal_p_sql(z: str) -> str:
    """Two-sided p of a normal statistic that is not negative, by integration."""
    return simpson_sql("exp(-@t * @t / 2) * sqrt(2 / pi())", z, f"({z}) + 14")


def chi_p_sql(x: str, dof: str) -> str:
    """Upper tail of chi-square with at least 2 degrees of freedom, by integration."""
    a = f"(({dof}) / 2.0)"
    return simpson_sql(f"exp(({a} - 1) * ln(@t) - @t - lgamma({a}))", f"(({x}) / 2)", f"(({x}) / 2 + 40 * sqrt({a}) + 80)")
