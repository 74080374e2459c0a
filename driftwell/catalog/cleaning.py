from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwell.catalog.registry import query, table
from driftwell.functions import is_number, to_number
from driftwell.operators import clean, requests, validate
from driftwell.operators.validate import Rule
from driftwell.spec import Field, TableSpec

# The order table in the role of a dirty application table, all text. The dirt is a
# function of row content, so both engines make the same.
ORDER_SPEC = TableSpec(
    fields=(
        Field("order_key", "integer", source="nr"),
        Field("amount", "numeric", source="hoehe"),
        Field("days", "numeric", source="laufzeit"),
        Field("purpose", "category", 6, 10, source="verw"),
        Field("priority", "category", 1, 5, source="rang"),
        Field("good", "label", source="kredit"),
    ),
    junk=("mixed_type_col",),
)

_RAW = """(SELECT CAST(o_orderkey AS VARCHAR) AS nr,
  CASE o_orderpriority WHEN '2-HIGH' THEN 'abc' WHEN '5-LOW' THEN '' ELSE CAST(o_totalprice AS VARCHAR) END AS hoehe,
  CASE WHEN month(o_orderdate) = 2 THEN 'nan' ELSE ' ' || CAST(day(o_orderdate) AS VARCHAR) || '.0 ' END AS laufzeit,
  CASE WHEN month(o_orderdate) = 7 THEN '1d' ELSE CAST(year(o_orderdate) - 1990 AS VARCHAR) END AS verw,
  substr(o_orderpriority, 1, 1) AS rang,
  CASE WHEN o_totalprice < 1500 THEN NULL WHEN o_orderstatus = 'F' THEN '1' WHEN o_orderstatus = 'O' THEN '2 ' ELSE '3' END AS kredit
  FROM orders)"""


def raw_orders(spark, folder):
    o = table(spark, folder, "orders")
    price, day = F.col("o_totalprice"), F.col("o_orderdate")
    return o.select(
        F.col("o_orderkey").cast("string").alias("nr"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "abc")
        .when(F.col("o_orderpriority") == "5-LOW", "")
        .otherwise(price.cast("string"))
        .alias("hoehe"),
        F.when(F.month(day) == 2, "nan")
        .otherwise(F.concat(F.lit(" "), F.dayofmonth(day).cast("string"), F.lit(".0 ")))
        .alias("laufzeit"),
        F.when(F.month(day) == 7, "1d")
        .otherwise((F.year(day) - 1990).cast("string"))
        .alias("verw"),
        F.substring("o_orderpriority", 1, 1).alias("rang"),
        F.when(price < 1500, F.lit(None).cast("string"))
        .when(F.col("o_orderstatus") == "F", "1")
        .when(F.col("o_orderstatus") == "O", "2 ")
        .otherwise("3")
        .alias("kredit"),
        F.concat(F.lit("x"), F.col("o_custkey").cast("string")).alias("mixed_type_col"),
    )


@query(
    "clean_table",
    f"""WITH t AS (SELECT CAST(nr AS BIGINT) AS order_key,
        TRY_CAST(nullif(hoehe, '') AS DOUBLE) AS amount,
        CASE WHEN laufzeit <> 'nan' THEN TRY_CAST(trim(laufzeit) AS DOUBLE) END AS days,
        CASE WHEN verw <> '1d' THEN TRY_CAST(verw AS DOUBLE) END AS purpose,
        CAST(rang AS INTEGER) AS priority,
        CASE trim(kredit) WHEN '1' THEN 1 WHEN '2' THEN 0 WHEN '3' THEN 3 END AS good FROM {_RAW}),
      v AS (SELECT * FROM t WHERE good IN (0, 1)),
      m AS (SELECT quantile_cont(amount, 0.5) AS ma, quantile_cont(days, 0.5) AS md FROM v),
      p AS (SELECT purpose AS mp FROM v WHERE purpose IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
      f AS (SELECT order_key, coalesce(amount, ma) AS amount, coalesce(days, md) AS days,
                   coalesce(purpose, mp) AS purpose, priority, good FROM v, m, p),
      k AS (SELECT amount, days, row_number() OVER (ORDER BY amount) AS ra,
                   row_number() OVER (ORDER BY days) AS rd, count(*) OVER () AS n FROM f),
      b AS (SELECT max(amount) FILTER (ra = floor(0.01 * n) + 1) AS alo, max(amount) FILTER (ra = n - floor(0.01 * n)) AS ahi,
                   max(days) FILTER (rd = floor(0.01 * n) + 1) AS dlo, max(days) FILTER (rd = n - floor(0.01 * n)) AS dhi FROM k)
    SELECT order_key, CAST(trunc(greatest(alo, least(ahi, amount))) AS BIGINT) AS amount,
           CAST(trunc(greatest(dlo, least(dhi, days))) AS BIGINT) AS days,
           CAST(greatest(6, least(10, purpose)) AS INTEGER) AS purpose,
           priority, CAST(good AS BIGINT) AS good FROM f, b""",
)
def clean_table(spark, folder):
    return clean.clean(raw_orders(spark, folder), ORDER_SPEC)[0]


@query(
    "coerce_numbers",
    """SELECT o_orderkey, CAST(NULL AS DOUBLE) AS priority_text,
      CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority_code,
      o_totalprice AS price, FALSE AS priority_is_number,
      CASE WHEN o_orderstatus = 'F' THEN 10.5 WHEN o_orderstatus = 'O' THEN -2000.0 END AS spelled
      FROM orders""",
)
def coerce_numbers(spark, folder):
    o = table(spark, folder, "orders")
    spelled = (
        F.when(F.col("o_orderstatus") == "F", " +10.5 ")
        .when(F.col("o_orderstatus") == "O", "-2e3")
        .otherwise("1_0")
    )
    return o.select(
        "o_orderkey",
        to_number(F.col("o_orderpriority")).alias("priority_text"),
        to_number(F.concat(F.substring("o_orderpriority", 1, 1), F.lit(" "))).alias("priority_code"),
        to_number(F.col("o_totalprice").cast("string")).alias("price"),
        is_number(F.col("o_orderpriority")).alias("priority_is_number"),
        to_number(spelled).alias("spelled"),
    )


@query(
    "rename_and_drop",
    "SELECT s_suppkey AS key, s_name AS name, s_acctbal AS balance FROM supplier",
)
def rename_and_drop(spark, folder):
    df = clean.rename_columns(
        table(spark, folder, "supplier"),
        {"s_suppkey": "key", "s_name": "name", "s_acctbal": "balance", "absent": "nothing"},
    )
    return clean.drop_columns(df, ["s_nationkey", "mixed_type_col"])


@query(
    "remap_codes",
    """SELECT p_partkey, CASE p_size WHEN 3 THEN 1 WHEN 4 THEN 1 WHEN 5 THEN 1 ELSE p_size END AS p_size,
    CASE p_type WHEN 'ECONOMY' THEN 'E' ELSE p_type END AS p_type FROM part""",
)
def remap_codes(spark, folder):
    df = clean.remap_codes(table(spark, folder, "part"), "p_size", {3: 1, 4: 1, 5: 1})
    return clean.remap_codes(df, "p_type", {"ECONOMY": "E"}).select("p_partkey", "p_size", "p_type")


_LABELLED = """(SELECT doc_id, quality + 2 * toxic AS code FROM labels)"""


@query(
    "filter_valid_target",
    f"SELECT doc_id, CAST(code AS INTEGER) AS code FROM {_LABELLED} WHERE code IN (0, 1)",
)
def filter_valid_target(spark, folder):
    df = table(spark, folder, "labels").select(
        "doc_id", (F.col("quality") + 2 * F.col("toxic")).alias("code")
    )
    return clean.keep_valid(df, "code", [0, 1])


@query(
    "removed_count",
    f"""SELECT count(*) AS rows_in, count(*) FILTER (code IN (0, 1)) AS rows_kept,
    count(*) FILTER (code NOT IN (0, 1)) AS rows_removed FROM {_LABELLED}""",
)
def removed_count(spark, folder):
    df = table(spark, folder, "labels").select(
        (F.col("quality") + 2 * F.col("toxic")).alias("code")
    )
    return clean.removed_count(df, "code", [0, 1])


@query(
    "clip_domain",
    """SELECT p_partkey, greatest(5, least(40, p_size)) AS p_size,
    greatest(950.0, least(1500.0, p_retailprice)) AS p_retailprice FROM part""",
)
def clip_domain(spark, folder):
    df = clean.clip_domain(
        table(spark, folder, "part"), {"p_size": (5, 40), "p_retailprice": (950.0, 1500.0)}
    )
    return df.select("p_partkey", "p_size", "p_retailprice")


@query(
    "restrict_to_list",
    """SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def restrict_to_list(spark, folder):
    df = clean.restrict_to_list(
        table(spark, folder, "orders"),
        {"o_orderstatus": ["F", "O"], "o_orderpriority": ["1-URGENT", "2-HIGH"]},
    )
    return df.select("o_orderkey", "o_orderstatus", "o_orderpriority")


PART_RULES = [Rule("p_size", 2, 45), Rule("p_retailprice", 905, 1800, whole=False), Rule("p_partkey", 10, 10**12)]
_BAD_SIZE = "NOT (p_size BETWEEN 2 AND 45)"
_BAD_PRICE = "NOT (p_retailprice BETWEEN 905 AND 1800)"
_BAD_KEY = "NOT (p_partkey BETWEEN 10 AND 1000000000000)"


@query(
    "validate_rules",
    f"""SELECT p_partkey, concat_ws(',', CASE WHEN {_BAD_SIZE} THEN 'p_size' END,
    CASE WHEN {_BAD_PRICE} THEN 'p_retailprice' END, CASE WHEN {_BAD_KEY} THEN 'p_partkey' END) AS broken,
    {_BAD_SIZE} OR {_BAD_PRICE} OR {_BAD_KEY} AS rejected FROM part""",
)
def validate_rules(spark, folder):
    checked = validate.check_rules(table(spark, folder, "part"), PART_RULES)
    return checked.select(
        "p_partkey",
        F.array_join("failures.column", ",").alias("broken"),
        (F.size("failures") > 0).alias("rejected"),
    )


@query(
    "reject_counts",
    f"""SELECT 'p_size' AS "column", count(*) FILTER ({_BAD_SIZE}) AS rejected FROM part
    UNION ALL SELECT 'p_retailprice', count(*) FILTER ({_BAD_PRICE}) FROM part
    UNION ALL SELECT 'p_partkey', count(*) FILTER ({_BAD_KEY}) FROM part""",
)
def reject_counts(spark, folder):
    return validate.reject_counts(table(spark, folder, "part"), PART_RULES)


@query(
    "whole_requests",
    """SELECT o_custkey, NOT bool_or(o_totalprice < 5000 OR o_totalprice > 480000) AS valid
    FROM orders GROUP BY o_custkey""",
)
def whole_requests(spark, folder):
    return validate.whole_requests(
        table(spark, folder, "orders"), "o_custkey", [Rule("o_totalprice", 5000, 480000, whole=False)]
    )


@query(
    "explode_requests",
    """SELECT o_custkey, o_orderkey % 24 + 1 <= 20 AS batch_ok, o_orderkey * 100 + i AS o_orderkey, o_totalprice + i AS o_totalprice
    FROM (SELECT *, unnest(range(1, o_orderkey % 24 + 2)) AS i FROM orders)""",
)
def explode_requests(spark, folder):
    # Each order as a request that carries up to 24 applications.
    places = F.sequence(F.lit(1).cast("long"), F.col("o_orderkey") % 24 + 1)
    lists = F.transform(
        places,
        lambda i: F.struct((F.col("o_orderkey") * 100 + i).alias("o_orderkey"), (F.col("o_totalprice") + i).alias("o_totalprice")),
    )
    nested = table(spark, folder, "orders").select("o_custkey", lists.alias("applications"))
    return validate.explode_requests(nested, "applications", cap=20)


_REQUEST_RULES = [Rule("customer", 5, 1_000_000_000), Rule("month", 1, 11)]
_APPLICATION = T.StructType([T.StructField("customer", T.LongType()), T.StructField("month", T.IntegerType())])


def request_texts(spark, folder):
    """Each order as a request for two applications; some texts are cut off, some lists are
    empty, some values missing."""
    orders = table(spark, folder, "orders")
    key = F.col("o_orderkey")
    one = F.struct(F.col("o_custkey").alias("customer"), F.month("o_orderdate").alias("month"))
    other = F.struct((F.col("o_custkey") - 20).alias("customer"), F.when(key % 7 > 0, F.lit(3)).alias("month"))
    none = F.array().cast("array<struct<customer: bigint, month: int>>")
    body = F.to_json(F.struct(F.when(key % 10 == 1, none).otherwise(F.array(one, other)).alias("applications")))
    return orders.select("o_orderkey", F.when(key % 10 == 0, F.substring(body, 1, 20)).otherwise(body).alias("request"))


_REPLY_SQL = """
WITH apps AS (SELECT o_orderkey, o_orderkey % 10 AS kind, [o_custkey, o_custkey - 20] AS customers,
                     [month(o_orderdate), CASE WHEN o_orderkey % 7 > 0 THEN 3 END] AS months FROM orders),
marked AS (SELECT *, list_concat(
    CASE WHEN customers[1] < 5 THEN ['{"position":0,"column":"customer","value":"' || customers[1] || '"}'] ELSE [] END,
    CASE WHEN months[1] > 11 THEN ['{"position":0,"column":"month","value":"' || months[1] || '"}'] ELSE [] END,
    CASE WHEN customers[2] < 5 THEN ['{"position":1,"column":"customer","value":"' || customers[2] || '"}'] ELSE [] END,
    CASE WHEN months[2] IS NULL THEN ['{"position":1,"column":"month"}'] ELSE [] END) AS errors FROM apps),
judged AS (SELECT o_orderkey, CASE WHEN kind = 0 THEN 'malformed' WHEN kind = 1 THEN 'wrong_size' WHEN len(errors) > 0 THEN 'invalid' ELSE 'accepted' END AS status,
                  CASE WHEN kind < 2 THEN 0 ELSE 2 END AS n, CASE WHEN kind < 2 THEN [] ELSE errors END AS errors FROM marked)
SELECT o_orderkey, status, '{"status":"' || status || '","n":' || n || ',"errors":[' || array_to_string(errors, ',') || ']}' AS reply FROM judged"""


@query("json_requests", _REPLY_SQL)
def json_requests(spark, folder):
    parsed = requests.parse_requests(request_texts(spark, folder), "request", _APPLICATION)
    return requests.answer_requests(parsed, _REQUEST_RULES).select("o_orderkey", "status", "reply")


@query("drop_duplicates", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def drop_duplicates(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    return clean.drop_duplicate_rows(lines)


@query(
    "duplicate_count",
    """SELECT CAST(sum(n) AS BIGINT) AS rows_in, count(*) AS rows_kept, CAST(sum(n - 1) AS BIGINT) AS rows_removed
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def duplicate_count(spark, folder):
    return clean.duplicate_count(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "align_columns",
    "SELECT c_acctbal, c_custkey, 0 AS credit_limit, c_mktsegment FROM customer",
)
def align_columns(spark, folder):
    return clean.align_columns(
        table(spark, folder, "customer"), ["c_acctbal", "c_custkey", "credit_limit", "c_mktsegment"]
    )


@query(
    "fill_defaults",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 100.0 ELSE c_acctbal END AS c_acctbal,
    CAST(3.0 AS DOUBLE) AS housing FROM customer""",
)
def fill_defaults(spark, folder):
    df = table(spark, folder, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal")
    )
    return clean.fill_defaults(df, {"c_acctbal": 100.0, "housing": 3.0})


@query(
    "final_checks",
    f"""SELECT count(*) AS "rows",
      count(*) FILTER (amount IS NULL) + count(*) FILTER (code NOT IN (0, 1, 2, 3)) AS missing_cells,
      count(*) FILTER (code NOT IN (0, 1)) AS invalid_labels
    FROM (SELECT code, CASE WHEN code <> 2 THEN doc_id END AS amount FROM {_LABELLED})""",
)
def final_checks(spark, folder):
    code = F.col("quality") + 2 * F.col("toxic")
    df = table(spark, folder, "labels").select(
        code.alias("code"), F.when(code != 2, F.col("doc_id")).alias("amount")
    )
    return clean.final_checks(df, "code", [0, 1])


@query(
    "standardise_text_dirt",
    f"""SELECT CAST(TRY_CAST(nullif(hoehe, '') AS DOUBLE) IS NULL AS BOOLEAN) AS missing, count(*) AS n
    FROM {_RAW} GROUP BY 1""",
)
def standardise_text_dirt(spark, folder):
    df = clean.coerce_numbers(raw_orders(spark, folder), ["hoehe"])
    return df.groupBy(F.col("hoehe").isNull().alias("missing")).agg(F.count(F.lit(1)).alias("n"))
