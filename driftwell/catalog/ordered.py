from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.catalog.registry import query, rounded, table, union_all
from driftwell.functions import bin_right_closed
from driftwell.operators import clean
from driftwell.operators.drift import decile_edges
from driftwell.operators.ordered import quantiles
from driftwell.operators.split import ordered_split


@query(
    "winsorize",
    """WITH r AS (SELECT *, row_number() OVER (ORDER BY c_acctbal) AS k, count(*) OVER () AS n FROM customer),
    b AS (SELECT max(c_acctbal) FILTER (k = CAST(floor(0.01 * n) AS BIGINT) + 1) AS lo,
                 max(c_acctbal) FILTER (k = n - CAST(floor(0.01 * n) AS BIGINT)) AS hi FROM r)
    SELECT c_custkey, greatest(lo, least(hi, c_acctbal)) AS c_acctbal FROM customer, b""",
)
def winsorize(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return clean.winsorize(customer, ["c_acctbal"])


@query(
    "winsorize_lines",
    """WITH q AS (SELECT count(*) AS n FROM lineitem),
    p AS (SELECT l_extendedprice AS v, row_number() OVER (ORDER BY l_extendedprice) AS k FROM lineitem),
    b AS (SELECT max(v) FILTER (k = CAST(floor(0.01 * n) AS BIGINT) + 1) AS lo,
                 max(v) FILTER (k = n - CAST(floor(0.01 * n) AS BIGINT)) AS hi FROM p, q),
    w AS (SELECT l_returnflag, greatest(lo, least(hi, l_extendedprice)) AS v FROM lineitem, b)
    SELECT l_returnflag, count(*) AS n, round(min(v), 6) AS lo, round(max(v), 6) AS hi, round(avg(v), 6) AS mean
    FROM w GROUP BY 1""",
)
def winsorize_lines(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice")
    out = clean.winsorize(lines, ["l_extendedprice"])
    v = F.col("l_extendedprice")
    return rounded(
        out.groupBy("l_returnflag").agg(
            F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"), F.avg(v).alias("mean")
        )
    )


# Missing values are made from content. A median may end in half a cent, so totals keep
# four digits, which leaves no ties to rounding.
@query(
    "median_mode_impute",
    """WITH d AS (SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate,
        CASE WHEN l_tax <> 0.08 THEN l_extendedprice END AS price,
        CASE WHEN l_discount <> 0.1 THEN l_returnflag END AS flag,
        CASE WHEN l_discount <> 0.02 THEN l_linenumber END AS line FROM lineitem),
    f AS (SELECT quantile_cont(price, 0.5) AS m FROM d),
    c AS (SELECT flag FROM d WHERE flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1),
    l AS (SELECT line FROM d WHERE line IS NOT NULL GROUP BY line ORDER BY count(*) DESC, line LIMIT 1)
    SELECT coalesce(d.flag, c.flag) AS flag, coalesce(d.line, l.line) AS line, count(*) AS n,
           round(min(coalesce(price, m)), 6) AS lo, round(max(coalesce(price, m)), 6) AS hi,
           round(sum(coalesce(price, m)), 4) AS total
    FROM d, f, c, l GROUP BY 1, 2""",
)
def median_mode_impute(spark, folder):
    lines = table(spark, folder, "lineitem")
    dirty = lines.select(
        F.when(F.col("l_tax") != 0.08, F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_discount") != 0.1, F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_discount") != 0.02, F.col("l_linenumber")).alias("line"),
    )
    fills = clean.medians(dirty, ["price"]) | clean.modes(dirty, ["flag", "line"])
    filled = clean.impute(dirty, fills).withColumn("line", F.col("line").cast("int"))
    out = filled.groupBy("flag", "line").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("price").alias("lo"),
        F.max("price").alias("hi"),
        F.round(F.sum("price"), 4).alias("total"),
    )
    return rounded(out)


@query(
    "decile_bins",
    """WITH e AS (SELECT list_sort(list_distinct(quantile_cont(l_extendedprice,
        [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e FROM lineitem)
    SELECT CAST(len([x FOR x IN e[2:len(e) - 1] IF l_extendedprice > x]) AS INTEGER) AS bin,
           count(*) AS n, round(min(l_extendedprice), 6) AS lo, round(max(l_extendedprice), 6) AS hi
    FROM lineitem, e GROUP BY 1""",
)
def decile_bins(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_extendedprice")
    price = F.col("l_extendedprice")
    edges = decile_edges(lines, {"p": price})["p"]
    return rounded(
        lines.groupBy(bin_right_closed(price, edges).alias("bin")).agg(
            F.count(price).alias("n"), F.min(price).alias("lo"), F.max(price).alias("hi")
        )
    )


_POINTS = (0.01, 0.25, 0.5, 0.75, 0.99)
_QUANTILED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey")


@query(
    "exact_quantiles",
    union_all(
        [
            f"""SELECT '{c}' AS "column", CAST({q} AS DOUBLE) AS q,
            round(quantile_cont(CAST({c} AS DOUBLE), {q}), 6) AS value FROM lineitem"""
            for c in _QUANTILED
            for q in _POINTS
        ]
    ),
)
def exact_quantiles(spark, folder):
    lines = table(spark, folder, "lineitem").select(*_QUANTILED)
    got = quantiles(lines, {c: (F.col(c), _POINTS) for c in _QUANTILED})
    rows = [(c, q, v) for c in _QUANTILED for q, v in zip(_POINTS, got[c])]
    return rounded(spark.createDataFrame(rows, "column string, q double, value double"))


@query(
    "ordered_split",
    """WITH r AS (SELECT *, row_number() OVER (ORDER BY o_orderdate) AS k, count(*) OVER () AS n FROM orders),
    c AS (SELECT max(o_orderdate) AS cut FROM r WHERE k = CAST(floor(n * 0.7) AS BIGINT) + 1)
    SELECT o_orderkey, o_orderdate < cut AS is_reference FROM orders, c""",
)
def ordered_halves(spark, folder):
    return ordered_split(table(spark, folder, "orders"), "o_orderdate", 0.7).select(
        "o_orderkey", "is_reference"
    )
