"""What several operators share: words, buckets, running totals, scratch tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.session import scratch_path

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def count_words(text: Column) -> Column:
    """Number of words as a long: the pieces between gaps less the empty ones at either end."""
    t = F.coalesce(text, F.lit(""))
    pieces = F.size(F.split(t, GAP))
    ends = F.when(t == "", 1).otherwise(
        F.when(t.rlike("^" + GAP), 1).otherwise(0) + F.when(t.rlike(GAP + r"\z"), 1).otherwise(0)
    )
    blank = ~t.rlike(WORD)
    return F.when(blank, F.lit(0)).otherwise(pieces - ends).cast("long")


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case; other letters stay, whatever the locale."""
    return F.translate(text, UPPER, LOWER)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo; a null id has remainder 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)), F.lit(0))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: later steps don't repeat the work,
    and a lost executor takes nothing with it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running_total(
    df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str], value: str, out: str
) -> DataFrame:
    """Adds the sum of ``value`` over earlier rows of the same keys, by (bucket, order).

    Two levels: within each bucket, then over the buckets' totals, so that a key with a
    third of all rows is as many tasks as it has buckets.
    """
    inner = Window.partitionBy(*keys, bucket).orderBy(*order)
    outer = Window.partitionBy(*keys).orderBy(bucket)
    before = inner.rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_total"))
    offsets = totals.select(
        *keys,
        bucket,
        F.coalesce(
            F.sum("_total").over(outer.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_offset"),
    )
    return (
        df.withColumn("_inner", F.coalesce(F.sum(value).over(before), F.lit(0)))
        .join(offsets, [*keys, bucket])
        .withColumn(out, (F.col("_offset") + F.col("_inner")).cast("long"))
        .drop("_inner", "_offset")
    )


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def literal_rows(spark, names: Sequence[str], rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A small fixed table made of literals, without any job."""
    if not rows:
        return spark.createDataFrame([], schema)
    cells = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r, strict=True)]) for r in rows])
    table = spark.range(1).select(F.inline(cells))
    kinds = [f.strip().split(" ") for f in schema.split(",")]
    return table.select(*[F.col(n).cast(k).alias(n) for n, k in kinds])
