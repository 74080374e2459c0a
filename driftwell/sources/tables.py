from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str | None = None
) -> DataFrame:
    """CSV with a header, JSON lines, ORC or parquet, by ``fmt`` or the path's ending.

    Give CSV and JSON a schema: without one they are read twice to guess it.
    """
    fmt = fmt or _format_of(path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt == "csv":
        return reader.option("header", True).option("enforceSchema", False).csv(path)
    return reader.format(fmt).load(path)


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with every column as text, for the cleaner; columns come from the header."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def write_table(
    df: DataFrame, path: str, fmt: str | None = None, mode: str = "overwrite", partition_by=()
) -> None:
    """Write without an index column; parents are created, old content replaced."""
    fmt = fmt or _format_of(path)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def _format_of(path: str) -> str:
    for ending, fmt in ((".csv", "csv"), (".json", "json"), (".orc", "orc")):
        if path.rstrip("/").endswith(ending):
            return fmt
    return "parquet"


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
