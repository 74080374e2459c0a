"""Scoring requests as JSON text: parsed by a schema, checked, answered as JSON text.

A request is an object with a list of applications. Everything happens in the request's
own row: nothing is exploded, grouped or collected, however long a list is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwell.operators.validate import REQUEST_CAP, Rule

CORRUPT = "corrupt__"


def parse_requests(df: DataFrame, text: str, application: T.StructType, applications: str = "applications") -> DataFrame:
    """Replace the text by ``applications`` (array of the struct, null if malformed) and
    ``malformed``: the text as it came where it isn't such an object, else null.

    A field that is missing or of another type is null in its application; the rules say
    whether that is an error. A missing list is malformed, an empty one isn't.
    """
    schema = T.StructType(
        [T.StructField(applications, T.ArrayType(application)), T.StructField(CORRUPT, T.StringType())]
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    read = df.withColumn("read__", F.from_json(F.col(text), schema, options))
    bad = F.col(f"read__.{applications}").isNull()
    keep = [F.col(f"`{c}`") for c in df.columns if c != text]
    return read.select(
        *keep,
        F.col(f"read__.{applications}").alias(applications),
        F.when(bad, F.coalesce(F.col(text), F.lit(""))).alias("malformed"),
    )


def _errors(applications: Column, rules: Sequence[Rule]) -> Column:
    """Array of (position, column, value), by application and rule."""

    def of(application: Column, position: Column) -> Column:
        marks = [
            F.when(
                r.fails(application[r.column]),
                F.struct(
                    position.alias("position"),
                    F.lit(r.column).alias("column"),
                    application[r.column].cast("string").alias("value"),
                ),
            )
            for r in rules
        ]
        return F.filter(F.array(*marks), lambda m: m.isNotNull())

    return F.flatten(F.transform(applications, of))


def answer_requests(
    parsed: DataFrame, rules: Sequence[Rule], applications: str = "applications", cap: int = REQUEST_CAP
) -> DataFrame:
    """Add status, n, errors and reply (JSON text) to parsed requests.

    status: malformed, wrong_size (no application or more than ``cap``), invalid (errors
    says which fields of which application) or accepted. A request is taken whole or not
    at all. A missing value has no ``value`` in the reply.
    """
    n = F.coalesce(F.size(applications), F.lit(0))
    none = F.array().cast("array<struct<position: int, column: string, value: string>>")
    sized = (n >= 1) & (n <= cap)
    checked = parsed.withColumn("n", F.greatest(n, F.lit(0))).withColumn(
        "errors", F.when(sized, _errors(F.col(applications), rules)).otherwise(none)
    )
    status = (
        F.when(F.col("malformed").isNotNull(), "malformed")
        .when(~sized, "wrong_size")
        .when(F.size("errors") > 0, "invalid")
        .otherwise("accepted")
    )
    answered = checked.withColumn("status", status)
    return answered.withColumn("reply", F.to_json(F.struct("status", "n", "errors")))


def accepted_applications(answered: DataFrame, applications: str = "applications") -> DataFrame:
    """One row per application of an accepted request, with its place in the request."""
    keep = [c for c in answered.columns if c not in (applications, "malformed", "errors", "reply", "status", "n")]
    return (
        answered.where(F.col("status") == "accepted")
        .select(*[F.col(f"`{c}`") for c in keep], F.posexplode(applications).alias("position", "application"))
        .select(*[F.col(f"`{c}`") for c in keep], "position", "application.*")
    )
