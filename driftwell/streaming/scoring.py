from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from driftwell.operators.models import score_records
from driftwell.operators.validate import Rule, split_valid


def score_stream(
    arrivals: DataFrame,
    model,
    rules: Sequence[Rule],
    scored_path: str,
    rejects_path: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Check arriving records, score the valid ones, keep the others with reasons.

    A batch that runs again after a failure rewrites its own folder, so each record
    ends up in the output once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # Both outputs read the batch; it is fetched and checked once.
        batch = batch.persist()
        try:
            valid, rejected = split_valid(batch, rules)
            score_records(valid, model).write.mode("overwrite").parquet(
                f"{scored_path}/batch_id={batch_id}"
            )
            rejected.write.mode("overwrite").parquet(f"{rejects_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = arrivals.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
