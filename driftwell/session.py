"""Settings read from the running session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_stand_in: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and written intermediates.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset and all
    runs on this machine, as in tests, one of its folders per application stands in.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not (spark.sparkContext.master + "[").startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    app = spark.sparkContext.applicationId
    if app not in _stand_in:
        _stand_in[app] = tempfile.mkdtemp(prefix="run-")
    return _stand_in[app]


def use_shared_checkpoints(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def scratch_path(spark: SparkSession, label: str) -> str:
    """New path below the shared folder, never used before."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def range_buckets(spark: SparkSession) -> int:
    """How many value ranges ordered work is cut into: as many as shuffle tasks."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
