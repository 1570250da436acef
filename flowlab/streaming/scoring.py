"""The scoring flow over arriving rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from flowlab.plans.scoring import score


def score_stream(
    stream: DataFrame, models: dict[str, PipelineModel], out: str, checkpoint: str,
    keep: Sequence[str] = (), trigger: dict | None = None,
) -> StreamingQuery:
    """Score each micro-batch into its own folder, so a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        score(batch, models, keep).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
