"""Ingest CSV files as they arrive.

An addition of ours on top of the batch ingest: late and corrected measurements are plain
upserts. The number of a micro-batch is published with the version it made, so one that is
replayed after its commit is known and left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import ingest
from ..sources.measurements import stream_measurements
from ..sources.store import commit_ingest, last_batch, load_model


def ingest_stream(
    spark: SparkSession, folder: str, root: str, checkpoint: str, text_values: bool = False
) -> StreamingQuery:
    """Ingest the files that are in ``folder`` now or came since the last call, then stop."""

    def apply(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        if number <= last_batch(session, root, checkpoint):
            return
        rows = batch.withColumn(
            "arrival",
            F.struct("arrival", F.monotonically_increasing_id().alias("row")),
        )
        result = ingest(load_model(session, root), rows, text_values)
        commit_ingest(session, result, root, checkpoint, number)

    return (
        stream_measurements(spark, folder)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
