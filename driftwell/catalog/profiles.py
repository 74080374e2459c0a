from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.catalog.registry import chi_p_sql, normal_p_sql, query, rounded, table, union_all
from driftwell.operators import assoc, profile

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey"]
CODED = ["l_returnflag", "l_linestatus", "l_linenumber", "l_discount", "l_tax"]


@query("table_shape", 'SELECT count(*) AS "rows", 11 AS "columns" FROM lineitem')
def table_shape(spark, folder):
    return profile.table_shape(table(spark, folder, "lineitem"))


@query(
    "null_profile",
    union_all(
        [
            f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(*) AS "rows", count({e}) AS non_null,
            count(*) - count({e}) AS nulls FROM orders"""
            for c, t, e in (
                ("o_orderkey", "bigint", "o_orderkey"),
                ("o_totalprice", "double", "CASE WHEN o_totalprice >= 50000 THEN 1 END"),
                ("o_orderstatus", "string", "CASE WHEN o_orderstatus <> 'P' THEN 1 END"),
                ("o_orderpriority", "string", "o_orderpriority"),
            )
        ]
    ),
)
def null_profile(spark, folder):
    o = table(spark, folder, "orders")
    holed = o.select(
        "o_orderkey",
        F.when(F.col("o_totalprice") >= 50000, F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_orderpriority",
    )
    return profile.null_profile(holed)


@query(
    "value_counts",
    union_all(
        [
            f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n,
            round(count(*) / sum(count(*)) OVER (), 6) AS share FROM lineitem GROUP BY {c}"""
            for c in CODED
        ]
    ),
)
def value_counts(spark, folder):
    return rounded(profile.value_counts(table(spark, folder, "lineitem"), CODED))


@query(
    "class_balance",
    """SELECT CAST(quality AS VARCHAR) AS label, count(*) AS n,
    round(count(*) / sum(count(*)) OVER (), 6) AS share FROM labels GROUP BY quality""",
)
def class_balance(spark, folder):
    return rounded(profile.class_balance(table(spark, folder, "labels"), "quality"))


@query(
    "distinct_counts",
    union_all(
        [
            f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS distinct_values FROM lineitem"""
            for c in [*CODED, "l_partkey", "l_extendedprice"]
        ]
    ),
)
def distinct_counts(spark, folder):
    return profile.distinct_counts(
        table(spark, folder, "lineitem"), [*CODED, "l_partkey", "l_extendedprice"]
    )


def _describe_sql(source, columns, names=None):
    return union_all(
        [
            f"""SELECT '{n}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean,
            round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS "min",
            round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75,
            round(CAST(max({c}) AS DOUBLE), 6) AS "max" FROM {source}"""
            for c, n in zip(columns, names or columns)
        ]
    )


@query("describe_numeric", _describe_sql("lineitem", NUMERIC))
def describe_numeric(spark, folder):
    return rounded(profile.describe_numeric(table(spark, folder, "lineitem"), NUMERIC))


def _side(spark, folder, name, prefix):
    df = table(spark, folder, name)
    return df.withColumnsRenamed({c: c.removeprefix(prefix) for c in df.columns})


_CUSTOMER = [("custkey", "bigint"), ("name", "string"), ("nationkey", "int"), ("acctbal", "double"), ("mktsegment", "string")]
_SUPPLIER = [("suppkey", "bigint"), ("name", "string"), ("nationkey", "int"), ("acctbal", "double")]


def _schema_sql(source, prefix, columns):
    return union_all(
        [
            f"""SELECT '{c}' AS "column", count({prefix}{c}) AS nn, '{t}' AS ty, count(*) AS r FROM {source}"""
            for c, t in columns
        ]
    )


@query(
    "compare_schemas",
    f"""SELECT coalesce(a."column", b."column") AS "column", CAST(a.nn AS DOUBLE) AS non_null_original, a.ty AS dtype_original,
    CAST(a.r AS DOUBLE) AS rows_original, CAST(b.nn AS DOUBLE) AS non_null_modified, b.ty AS dtype_modified, CAST(b.r AS DOUBLE) AS rows_modified
    FROM ({_schema_sql('customer', 'c_', _CUSTOMER)}) a
    FULL OUTER JOIN ({_schema_sql('supplier', 's_', _SUPPLIER)}) b ON a."column" = b."column" """,
)
def compare_schemas(spark, folder):
    out = profile.compare_schemas(
        _side(spark, folder, "customer", "c_"), _side(spark, folder, "supplier", "s_")
    )
    return _counts_as_double(out, "non_null", "rows")


def _counts_as_double(df, *names):
    """A column of one side only has no counts on the other; doubles carry that alike."""
    both = [f"{n}_{side}" for n in names for side in ("original", "modified")]
    return df.withColumns({c: F.col(c).cast("double") for c in both})


_STATS = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]


@query(
    "compare_describe",
    f"""SELECT coalesce(a."column", b."column") AS "column",
    {', '.join(f'CAST(a."{s}" AS DOUBLE) AS {s}_original' for s in _STATS)},
    {', '.join(f'CAST(b."{s}" AS DOUBLE) AS {s}_modified' for s in _STATS)}
    FROM ({_describe_sql('customer', ['c_custkey', 'c_nationkey', 'c_acctbal'], ['custkey', 'nationkey', 'acctbal'])}) a
    FULL OUTER JOIN ({_describe_sql('supplier', ['s_suppkey', 's_nationkey', 's_acctbal'], ['suppkey', 'nationkey', 'acctbal'])}) b
    ON a."column" = b."column" """,
)
def compare_describe(spark, folder):
    out = profile.compare_describe(
        _side(spark, folder, "customer", "c_"),
        _side(spark, folder, "supplier", "s_"),
        ["custkey", "nationkey", "acctbal"],
        ["suppkey", "nationkey", "acctbal"],
    )
    return rounded(_counts_as_double(out, "count"))


def _histogram_sql(column, bins=20):
    return f"""
    SELECT '{column}' AS "column", CAST(i AS INTEGER) AS bin, round(lo + i * w, 6) AS lo,
      round(CASE WHEN i = {bins - 1} THEN hi ELSE lo + (i + 1) * w END, 6) AS hi, coalesce(n, 0) AS n
    FROM (SELECT min({column}) AS lo, max({column}) AS hi, (max({column}) - min({column})) / {bins} AS w FROM lineitem),
      (SELECT unnest(range(0, {bins})) AS i)
    LEFT JOIN (SELECT least(CAST(floor(({column} - l) / ww) AS BIGINT), {bins - 1}) AS b, count(*) AS n
      FROM lineitem, (SELECT min({column}) AS l, (max({column}) - min({column})) / {bins} AS ww FROM lineitem)
      GROUP BY 1) ON b = i"""


@query("histogram", union_all([_histogram_sql(c) for c in ("l_extendedprice", "l_quantity")]))
def histogram(spark, folder):
    return rounded(
        profile.histogram(table(spark, folder, "lineitem"), ["l_extendedprice", "l_quantity"])
    )


@query(
    "correlation_matrix",
    union_all(
        [
            f"""SELECT '{a}' AS column_a, '{b}' AS column_b,
            {'1.0::DOUBLE' if a == b else f'round(corr({a}, {b}), 6) + 0'} AS r FROM {'(SELECT 1)' if a == b else 'lineitem'}"""
            for a in NUMERIC
            for b in NUMERIC
        ]
    ),
)
def correlation_matrix(spark, folder):
    df = profile.correlation_matrix(table(spark, folder, "lineitem"), NUMERIC)
    return rounded(df).withColumn("r", F.col("r") + F.lit(0.0))


@query(
    "crosstab_share",
    union_all(
        [
            f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, l_linestatus AS label, count(*) AS n,
            round(count(*) / sum(count(*)) OVER (PARTITION BY {c}), 6) AS row_share
            FROM lineitem GROUP BY {c}, l_linestatus"""
            for c in ("l_returnflag", "l_linenumber", "l_suppkey")
        ]
    ),
)
def crosstab_share(spark, folder):
    lines = table(spark, folder, "lineitem")
    return rounded(
        profile.crosstab(lines, ["l_returnflag", "l_linenumber", "l_suppkey"], "l_linestatus")
    )


@query(
    "crosstab_wide",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "n_F", count(*) FILTER (o_orderstatus = 'O') AS "n_O",
    count(*) FILTER (o_orderstatus = 'P') AS "n_P", round(count(*) FILTER (o_orderstatus = 'F') / count(*), 6) AS "share_F",
    round(count(*) FILTER (o_orderstatus = 'O') / count(*), 6) AS "share_O",
    round(count(*) FILTER (o_orderstatus = 'P') / count(*), 6) AS "share_P" FROM orders GROUP BY 1""",
)
def crosstab_wide(spark, folder):
    return rounded(
        profile.crosstab_wide(
            table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"]
        )
    )


def _box_sql(column, flag):
    return f"""
    SELECT '{column}' AS "column", '{flag}' AS label, count(*) AS n,
      round(min(v) FILTER (v BETWEEN a - r AND c + r), 6) AS whisker_lo, round(a, 6) AS q25, round(b, 6) AS q50,
      round(c, 6) AS q75, round(max(v) FILTER (v BETWEEN a - r AND c + r), 6) AS whisker_hi,
      count(*) FILTER (NOT (v BETWEEN a - r AND c + r)) AS outliers
    FROM (SELECT {column} AS v FROM lineitem WHERE l_returnflag = '{flag}'),
      (SELECT quantile_cont({column}, 0.25) AS a, quantile_cont({column}, 0.5) AS b, quantile_cont({column}, 0.75) AS c,
              1.5 * (quantile_cont({column}, 0.75) - quantile_cont({column}, 0.25)) AS r
       FROM lineitem WHERE l_returnflag = '{flag}')
    GROUP BY a, b, c, r"""


@query(
    "box_stats",
    union_all([_box_sql(c, f) for c in ("l_quantity", "l_extendedprice", "l_tax") for f in "ANR"]),
)
def box_stats(spark, folder):
    lines = table(spark, folder, "lineitem")
    return rounded(
        profile.box_stats(
            lines, ["l_quantity", "l_extendedprice", "l_tax"], "l_returnflag", ["A", "N", "R"]
        )
    )


_GOOD = "(l_linestatus = 'F')"


def _mw_sql(column):
    return f"""
    SELECT '{column}' AS "column", CAST(max(n1) AS BIGINT) AS n_1, CAST(max(n0) AS BIGINT) AS n_0,
      sum(p * (before + q / 2.0)) AS u, sum(CAST(p + q AS DOUBLE) ** 3 - (p + q)) AS ties
    FROM (SELECT *, sum(q) OVER (ORDER BY v) - q AS before, sum(p) OVER () AS n1, sum(q) OVER () AS n0
      FROM (SELECT {column} AS v, count(*) FILTER ({_GOOD}) AS p, count(*) FILTER (NOT {_GOOD}) AS q
            FROM lineitem GROUP BY 1))"""


@query(
    "mann_whitney",
    f"""SELECT "column", n_1, n_0, round(u, 6) AS u, round(z, 6) AS z,
    round(CASE WHEN z <= 0 THEN 1 ELSE {normal_p_sql("z")} END, 6) AS p_value FROM (SELECT *,
    (greatest(u, CAST(n_1 AS DOUBLE) * n_0 - u) - CAST(n_1 AS DOUBLE) * n_0 / 2 - 0.5) /
      sqrt(CAST(n_1 AS DOUBLE) * n_0 / 12 * ((n_1 + n_0 + 1) - ties / (CAST(n_1 + n_0 AS DOUBLE) * (n_1 + n_0 - 1)))) AS z
    FROM ({union_all([_mw_sql(c) for c in ('l_quantity', 'l_extendedprice', 'l_discount', 'l_tax')])}))""",
)
def mann_whitney(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn(
        "good", (F.col("l_linestatus") == "F").cast("int")
    )
    return rounded(
        assoc.mann_whitney(
            lines, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "good"
        )
    )


def _chi_sql(column, label="o_orderstatus", source="orders"):
    return f"""
    SELECT '{column}' AS "column",
      CASE WHEN (count(DISTINCT v) - 1) * (count(DISTINCT g) - 1) = 1
        THEN sum(greatest(abs(o - e) - 0.5, 0) ** 2 / e) ELSE sum((o - e) ** 2 / e) END AS chi2,
      (count(DISTINCT v) - 1) * (count(DISTINCT g) - 1) AS dof
    FROM (SELECT v, g, coalesce(n, 0) AS o, CAST(rn AS DOUBLE) * cn / total AS e
      FROM (SELECT {column} AS v, count(*) AS rn FROM {source} GROUP BY 1)
      CROSS JOIN (SELECT {label} AS g, count(*) AS cn FROM {source} GROUP BY 1)
      CROSS JOIN (SELECT count(*) AS total FROM {source})
      LEFT JOIN (SELECT {column} AS vv, {label} AS gg, count(*) AS n FROM {source} GROUP BY 1, 2)
        ON v = vv AND g = gg)"""


_PAIRED = "(SELECT *, o_orderstatus = 'F' AS done, o_totalprice > 250000 AS big FROM orders)"


@query(
    "chi_square",
    f"""SELECT "column", round(chi2, 6) AS chi2, dof, round({chi_p_sql("chi2", "dof")}, 6) AS p_value FROM (
    {_chi_sql('o_orderpriority')} UNION ALL {_chi_sql('o_custkey')})""",
)
def chi_square(spark, folder):
    return rounded(
        assoc.chi_square(
            table(spark, folder, "orders"), ["o_orderpriority", "o_custkey"], "o_orderstatus"
        )
    )


@query(
    "chi_square_yates",
    f"""SELECT "column", round(chi2, 6) AS chi2, dof, round({normal_p_sql("sqrt(chi2)")}, 6) AS p_value
    FROM ({_chi_sql('big', 'done', _PAIRED)})""",
)
def chi_square_yates(spark, folder):
    o = table(spark, folder, "orders").select(
        (F.col("o_orderstatus") == "F").alias("done"), (F.col("o_totalprice") > 250000).alias("big")
    )
    return rounded(assoc.chi_square(o, ["big"], "done"))


@query(
    "decode_labels",
    """SELECT c_custkey, c_nationkey, c_mktsegment, n_name AS nation,
    coalesce(r_name, 'N/A') AS region FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON c_nationkey = r_regionkey""",
)
def decode_labels(spark, folder):
    nations = table(spark, folder, "nation").select(
        F.lit("c_nationkey").alias("column"),
        F.col("n_nationkey").cast("string").alias("code"),
        F.col("n_name").alias("label"),
    )
    regions = table(spark, folder, "region").select(
        F.lit("c_nationkey").alias("column"),
        F.col("r_regionkey").cast("string").alias("code"),
        F.col("r_name").alias("label"),
    )
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    named = profile.decode_labels(customer, nations, {"c_nationkey": "nation"})
    return profile.decode_labels(named, regions, {"c_nationkey": "region"}, else_label="N/A")


@query(
    "unpivot_scores",
    """SELECT doc_id, 'Referencia' AS dataset, CAST(n_chars AS DOUBLE) / (n_chars + 1000) AS probability FROM documents
    UNION ALL SELECT doc_id, 'Actual', CAST(n_chars AS DOUBLE) / (n_chars + 2000) FROM documents""",
)
def unpivot_scores(spark, folder):
    docs = table(spark, folder, "documents").select(
        "doc_id",
        (F.col("n_chars") / (F.col("n_chars") + 1000)).alias("ref"),
        (F.col("n_chars") / (F.col("n_chars") + 2000)).alias("cur"),
    )
    return profile.unpivot_scores(docs, {"ref": "Referencia", "cur": "Actual"}, ["doc_id"])


@query(
    "stack_scores",
    """SELECT 'reference' AS dataset, c_acctbal AS probability FROM customer
    UNION ALL SELECT 'current', s_acctbal FROM supplier""",
)
def stack_scores(spark, folder):
    return profile.stack_scores(
        table(spark, folder, "customer").withColumnRenamed("c_acctbal", "score"),
        table(spark, folder, "supplier").withColumnRenamed("s_acctbal", "score"),
        "score",
    )


@query(
    "first_rows",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice LIMIT 10""",
)
def first_rows(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )
    return profile.first_rows(lines, lines.columns, 10)
