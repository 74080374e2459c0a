from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.catalog.registry import (
    KS_LAMBDA,
    kolmogorov_sql,
    ks_sql,
    moment,
    psi_by_bin,
    psi_by_value,
    query,
    rounded,
    table,
    uniform_sql,
    union_all,
)
from driftwell.operators import drift
from driftwell.operators.models import scorecard
from driftwell.operators.split import stratified_split

CUT = "1999-01-01"
LINE_REF = f"l_shipdate < TIMESTAMP '{CUT}'"
ORDER_REF = f"o_orderdate < TIMESTAMP '{CUT}'"
LINE_COLUMNS = [
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_linenumber",
    "l_returnflag",
    "l_linestatus",
]
LINE_NUMERIC = LINE_COLUMNS[:5]


def lines(spark, folder):
    return drift.mark(table(spark, folder, "lineitem"), F.col("l_shipdate") < moment(CUT))


def orders(spark, folder):
    return drift.mark(table(spark, folder, "orders"), F.col("o_orderdate") < moment(CUT))


def _psi_select(parts):
    return f'SELECT "column", round(psi, 6) AS psi, classes FROM ({union_all(parts)})'


@query(
    "psi_numeric",
    _psi_select(
        [psi_by_bin("lineitem", c, LINE_REF) for c in ("l_extendedprice", "l_quantity", "l_partkey")]
    ),
)
def psi_numeric(spark, folder):
    return rounded(
        drift.psi(lines(spark, folder), ["l_extendedprice", "l_quantity", "l_partkey"])
    )


@query(
    "psi_categorical",
    _psi_select(
        [psi_by_value("lineitem", c, LINE_REF) for c in ("l_returnflag", "l_linestatus", "l_discount", "l_linenumber")]
    ),
)
def psi_categorical(spark, folder):
    columns = ["l_returnflag", "l_linestatus", "l_discount", "l_linenumber"]
    return rounded(drift.psi(lines(spark, folder), columns))


# The current side is stretched so that values leave the reference range.
_STRETCHED = f"""(SELECT o_orderdate,
    CASE WHEN {ORDER_REF} THEN o_totalprice ELSE o_totalprice * 1.25 - 20000 END AS amount
    FROM orders)"""


@query("psi_unwidened", _psi_select([psi_by_bin(_STRETCHED, "amount", ORDER_REF, widen=False)]))
def psi_unwidened(spark, folder):
    df = orders(spark, folder)
    amount = F.when(F.col("is_reference"), F.col("o_totalprice")).otherwise(
        F.col("o_totalprice") * 1.25 - 20000
    )
    return rounded(
        drift.psi(
            df.withColumn("amount", amount), ["amount"], widen_edges=False, binned="numeric"
        )
    )


_KS = union_all([ks_sql("lineitem", c, LINE_REF) for c in LINE_NUMERIC])


@query(
    "ks_two_sample",
    f"""SELECT "column", CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur,
    round(d, 6) AS d, round({kolmogorov_sql(KS_LAMBDA)}, 6) AS p_value,
    'asymptotic' AS p_method FROM ({_KS})""",
)
def ks_two_sample(spark, folder):
    return rounded(
        drift.ks_two_sample(lines(spark, folder), LINE_NUMERIC, p_method="asymptotic")
    )


def _report_sql(ks_columns, psi_columns, source="lineitem", ref=LINE_REF):
    by_ks = union_all([ks_sql(source, c, ref) for c in ks_columns])
    by_psi = union_all([psi_by_value(source, c, ref) for c in psi_columns])
    return f"""
SELECT "column", 'continuous' AS kind, 'ks_p_value' AS metric, round(p, 6) AS value, p < 0.05 AS drift,
       'asymptotic' AS p_method
FROM (SELECT "column", {kolmogorov_sql(KS_LAMBDA)} AS p FROM ({by_ks}))
UNION ALL
SELECT "column", 'discrete', 'psi', round(psi, 6), psi > 0.2, NULL FROM ({by_psi})"""


_LINE_REPORT = _report_sql(
    ["l_quantity", "l_extendedprice"],
    ["l_discount", "l_tax", "l_linenumber", "l_returnflag", "l_linestatus"],
)


@query("drift_report", _LINE_REPORT)
def drift_report(spark, folder):
    return rounded(
        drift.drift_report(lines(spark, folder), LINE_COLUMNS, p_method="asymptotic")
    )


@query("drift_report_by_dtype", _report_sql(LINE_NUMERIC, ["l_returnflag", "l_linestatus"]))
def drift_report_by_dtype(spark, folder):
    return rounded(
        drift.drift_report(lines(spark, folder), LINE_COLUMNS, rule="dtype", p_method="asymptotic")
    )


@query(
    "drift_rollup",
    f"""SELECT n_columns, n_drift, round(pct, 6) AS pct_drift,
    CASE WHEN pct > 20 THEN 'CRÍTICO' WHEN pct > 0 THEN 'ADVERTENCIA' ELSE 'ESTABLE' END AS status
    FROM (SELECT count(*) AS n_columns, count(*) FILTER (drift) AS n_drift,
                 count(*) FILTER (drift) * 100.0 / count(*) AS pct FROM ({_LINE_REPORT}))""",
)
def drift_rollup(spark, folder):
    report = drift.drift_report(lines(spark, folder), LINE_COLUMNS, p_method="asymptotic")
    return rounded(drift.drift_rollup(report))


# Largest remainders decide the odd rows; each class gives its smallest draws.
_SPLIT = f"""(WITH sizes AS (
    SELECT o_orderstatus AS k, count(*) AS n, sum(count(*)) OVER () AS total FROM orders GROUP BY 1),
  plan AS (SELECT k, n, total - CAST(ceil(0.2 * total) AS BIGINT) AS train,
                  n * (total - CAST(ceil(0.2 * total) AS BIGINT)) / total AS exact FROM sizes),
  quota AS (SELECT k, n - (floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, k)
        <= train - sum(floor(exact)) OVER () THEN 1 ELSE 0 END) AS q FROM plan)
  SELECT o.*, row_number() OVER (PARTITION BY o_orderstatus
      ORDER BY {uniform_sql(['o_orderkey'], 'split-42')}, o_orderkey) <= q AS is_test
  FROM orders o JOIN quota ON o_orderstatus = k)"""
_TT_REPORT = _report_sql(["o_totalprice"], ["o_orderpriority"], _SPLIT, "NOT is_test")


@query("train_test_drift", _TT_REPORT)
def train_test_drift(spark, folder):
    parts = stratified_split(table(spark, folder, "orders"), "o_orderstatus", ["o_orderkey"])
    return rounded(
        drift.drift_report(
            parts,
            ["o_totalprice", "o_orderpriority"],
            is_reference=~F.col("is_test"),
            p_method="asymptotic",
        )
    )


_SCORED = f"""(SELECT l_shipdate, 1.0 / (1.0 + exp(-(-1.0 + 0.00003 * l_extendedprice
    + CASE WHEN {LINE_REF} THEN -0.02 ELSE -0.035 END * l_quantity))) AS score FROM lineitem)"""


@query(
    "prediction_drift",
    f"""SELECT p."column", round(psi, 6) AS psi, round(d, 6) AS d, round(pv, 6) AS p_value,
    psi > 0.2 AS drift_psi, pv < 0.05 AS drift_ks, psi > 0.2 OR pv < 0.05 AS drift
    FROM ({psi_by_bin(_SCORED, 'score', LINE_REF)}) p
    JOIN (SELECT *, {kolmogorov_sql(KS_LAMBDA)} AS pv FROM ({ks_sql(_SCORED, 'score', LINE_REF)})) k
    ON p."column" = k."column" """,
)
def prediction_drift(spark, folder):
    df = lines(spark, folder).withColumn(
        "slope", F.when(F.col("is_reference"), -0.02).otherwise(-0.035) * F.col("l_quantity")
    )
    scored = scorecard(df, -1.0, {"l_extendedprice": 0.00003, "slope": 1.0})
    return rounded(
        drift.prediction_drift(scored.select("is_reference", "score"), "score", p_method="asymptotic")
    )


@query(
    "aligned_shares",
    union_all(
        [
            f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value,
            round(count(*) FILTER ({ORDER_REF}) / (SELECT count(*) FROM orders WHERE {ORDER_REF}), 6) AS share_ref,
            round(count(*) FILTER (NOT ({ORDER_REF})) / (SELECT count(*) FROM orders WHERE NOT ({ORDER_REF})), 6) AS share_cur
            FROM orders GROUP BY {c}"""
            for c in ("o_orderstatus", "o_orderpriority", "o_custkey")
        ]
    ),
)
def aligned_shares(spark, folder):
    return rounded(
        drift.aligned_shares(
            orders(spark, folder), ["o_orderstatus", "o_orderpriority", "o_custkey"]
        )
    )


_SMALL = "(SELECT s_acctbal, s_nationkey < 12 AS ref FROM supplier)"
#: A lattice path's mass by steps to the right, and what has left the band so far.
_EXIT_SQL = """
WITH RECURSIVE facts AS (SELECT least(n_ref, n_cur)::BIGINT AS m, greatest(n_ref, n_cur)::BIGINT AS n, n_ref, n_cur, d,
    round(d * n_ref * n_cur) AS lim FROM ({ks})),
walk AS (
  SELECT 0 AS t, m, n, lim, list_transform(range(m + 1), lambda x: CASE WHEN x = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS mass,
         0.0::DOUBLE AS gone FROM facts
  UNION ALL
  SELECT t + 1, m, n, lim,
         list_transform(moved, lambda v, x: CASE WHEN abs((x - 1) * n - (t + 2 - x) * m) >= lim THEN 0.0::DOUBLE ELSE v END),
         gone + list_sum(list_transform(moved, lambda v, x: CASE WHEN abs((x - 1) * n - (t + 2 - x) * m) >= lim THEN v ELSE 0.0::DOUBLE END))
  FROM (SELECT *, list_transform(mass, lambda v, x: v * (1 - (m - x + 1) / (m + n - t)::DOUBLE)
          + CASE WHEN x > 1 THEN mass[x - 1] * (m - x + 2) / (m + n - t)::DOUBLE ELSE 0 END) AS moved FROM walk WHERE t < m + n))
SELECT 's_acctbal' AS "column", n_ref::BIGINT AS n_ref, n_cur::BIGINT AS n_cur, round(d, 6) AS d,
       round((SELECT gone FROM walk WHERE t = m + n), 6) AS p_value, 'exact' AS p_method FROM facts"""


@query("ks_exact", _EXIT_SQL.format(ks=ks_sql(_SMALL, "s_acctbal", "ref")))
def ks_exact(spark, folder):
    """Two small samples, with the p-value by path counting."""
    rows = drift.mark(table(spark, folder, "supplier"), F.col("s_nationkey") < 12)
    return rounded(drift.ks_two_sample(rows, ["s_acctbal"], p_method="exact"))
