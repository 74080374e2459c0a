"""Binary files written by Spark itself.

Rows of bytes become files through the text writer, which copies a string's bytes as they
are: a file per task, committed as Spark commits any output, in any store that Spark
writes. The writer puts a separator after every row; formats choose one that they skip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_frames(frames: DataFrame, path: str, separator: str, rows_per_file: int = 0) -> None:
    """One row of the single binary column after the other; ``rows_per_file``: the rows
    after which a task starts a new file, 0 for one file a task."""
    (name,) = frames.columns
    frames.select(F.col(name).cast("string").alias("value")).write.option("lineSep", separator).option(
        "compression", "none"
    ).option("maxRecordsPerFile", rows_per_file).text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows path, content of all files that aren't empty."""
    return spark.read.format("binaryFile").load(path).where(F.col("length") > 0).select("path", "content")
