from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.catalog.drift import _SPLIT
from driftwell.catalog.registry import query, rounded, table, uniform_sql
from driftwell.operators import perturb as p
from driftwell.operators.split import stratified_folds, stratified_split

KEY = ["o_orderkey"]


@query("stratified_split", f"SELECT o_orderkey, is_test FROM {_SPLIT}")
def stratified(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return stratified_split(orders, "o_orderstatus", KEY).select("o_orderkey", "is_test")


_MANY = _SPLIT.replace("o_orderstatus", "o_custkey").replace("DESC, k)", "DESC, CAST(k AS VARCHAR))")


@query("stratified_split_many", f"SELECT o_orderkey, is_test FROM {_MANY}")
def stratified_many(spark, folder):
    """As many classes as there are customers."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return stratified_split(orders, "o_custkey", KEY).select("o_orderkey", "is_test")


@query(
    "stratified_folds",
    f"""SELECT o_orderkey, CAST(CASE WHEN k <= (n % 5) * (n // 5 + 1) THEN (k - 1) // (n // 5 + 1)
      ELSE (n % 5) + (k - 1 - (n % 5) * (n // 5 + 1)) // (n // 5) END AS INTEGER) AS fold
    FROM (SELECT o_orderkey, count(*) OVER (PARTITION BY o_orderstatus) AS n,
      row_number() OVER (PARTITION BY o_orderstatus ORDER BY {uniform_sql(KEY, 'folds-42')}, o_orderkey) AS k FROM orders)""",
)
def folds(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return stratified_folds(orders, "o_orderstatus", KEY).select("o_orderkey", "fold")


def _orders(spark, folder, *columns):
    return table(spark, folder, "orders").select("o_orderkey", *columns)


@query(
    "perturb_scale",
    f"""SELECT o_orderkey, round_even(o_totalprice * (5.0 + 5.0 * {uniform_sql(KEY, '42-0-o_totalprice')}), 0) AS o_totalprice
    FROM orders""",
)
def perturb_scale(spark, folder):
    return p.perturb(_orders(spark, folder, "o_totalprice"), [p.Scale("o_totalprice", 5.0, 10.0)], KEY)


@query(
    "perturb_collapse",
    "SELECT p_partkey, CASE WHEN p_size IN (3, 4, 5) THEN 1 ELSE p_size END AS p_size FROM part",
)
def perturb_collapse(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_size")
    return p.perturb(part, [p.Collapse("p_size", {3: 1, 4: 1, 5: 1})], ["p_partkey"])


@query(
    "perturb_mask",
    f"""SELECT o_orderkey, CASE WHEN {uniform_sql(KEY, '42-0-o_orderstatus')} < 0.5 THEN 'P' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN {uniform_sql(KEY, '42-1-o_orderpriority')} < 0.7 THEN '5-LOW' ELSE o_orderpriority END AS o_orderpriority FROM orders""",
)
def perturb_mask(spark, folder):
    steps = [p.Mask("o_orderstatus", 0.5, "P"), p.Mask("o_orderpriority", 0.7, "5-LOW")]
    return p.perturb(_orders(spark, folder, "o_orderstatus", "o_orderpriority"), steps, KEY)


@query("perturb_shift", "SELECT c_custkey, c_acctbal + 15 AS c_acctbal FROM customer")
def perturb_shift(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return p.perturb(customer, [p.Shift("c_acctbal", 15)], ["c_custkey"])


@query(
    "perturb_random",
    f"""SELECT p_partkey, CAST(floor(1 + 4 * {uniform_sql(['p_partkey'], '42-0-p_size')}) AS INTEGER) AS p_size,
    CASE WHEN {uniform_sql(['p_partkey'], '42-1-p_retailprice')} < 0.5 THEN 4.0::DOUBLE ELSE 72.0::DOUBLE END AS p_retailprice FROM part""",
)
def perturb_random(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice")
    steps = [p.Redraw("p_size", 1, 5), p.Choice("p_retailprice", (4.0, 72.0))]
    return p.perturb(part, steps, ["p_partkey"])


@query(
    "invert_scale",
    "SELECT l_orderkey, 8 - l_linenumber AS l_linenumber FROM lineitem",
)
def invert_scale(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    return p.perturb(lines, [p.Invert("l_linenumber", 1, 7)], ["l_orderkey"])


def _permuted(column):
    return f"""(SELECT {column}, row_number() OVER (ORDER BY {uniform_sql(KEY, f'42-0-{column}')}, o_orderkey) AS k FROM orders)"""


@query(
    "permute_columns",
    f"""SELECT o_orderkey, b.o_totalprice, c.o_orderpriority, a.o_orderstatus
    FROM (SELECT *, row_number() OVER (ORDER BY {uniform_sql(KEY, '42-0-rows')}, o_orderkey) AS k FROM orders) a
    JOIN {_permuted('o_totalprice')} b ON a.k = b.k JOIN {_permuted('o_orderpriority')} c ON a.k = c.k""",
)
def permute_columns(spark, folder):
    orders = _orders(spark, folder, "o_totalprice", "o_orderpriority", "o_orderstatus")
    return p.perturb(orders, [p.Permute(("o_totalprice", "o_orderpriority"))], KEY)


@query(
    "permuted_marginals",
    """SELECT 'o_totalprice' AS "column", count(*) AS n, count(DISTINCT o_totalprice) AS distinct_values,
    round(sum(o_totalprice), 2) AS total FROM orders
    UNION ALL SELECT 'o_custkey', count(*), count(DISTINCT o_custkey), sum(o_custkey)::DOUBLE FROM orders""",
)
def permuted_marginals(spark, folder):
    orders = _orders(spark, folder, "o_totalprice", "o_custkey")
    mixed = p.perturb(orders, [p.Permute(("o_totalprice", "o_custkey"))], KEY)
    parts = [
        mixed.groupBy(c).agg(F.count(F.lit(1)).alias("n")).agg(
            F.lit(c).alias("column"),
            F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("distinct_values"),
            F.round(F.sum(F.col(c).cast("double") * F.col("n")), 2).alias("total"),
        )
        for c in ("o_totalprice", "o_custkey")
    ]
    return rounded(parts[0].unionByName(parts[1]))
