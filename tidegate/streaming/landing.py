"""The load as a stream over the landing folder.

The stream carries the file listing, not the rows: a schema gate needs to see
headers first, and a streaming CSV source would fix one schema for all files.
Each micro-batch runs the batch load on the files of its listing that are not
checkpointed, so a replayed micro-batch or a file that came back under a known
name loads nothing twice. Files of one micro-batch load in name order, a capped
number at a time; across micro-batches the order of arrival counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidegate.plans.ingest import Load, LoadConfig
from tidegate.sources import listing


def start(spark: SparkSession, config: LoadConfig, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Load what lands: everything pending and stop, or every ``every`` (``5 minutes``)."""

    def load_batch(batch: DataFrame, _: int) -> None:
        Load(batch.sparkSession, config).run_all(batch)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    stream = listing.stream_files(spark, config.landing)
    return (
        stream.writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
