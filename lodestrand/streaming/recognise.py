"""Incremental type recognition: new rows of an item store are typed as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestrand.operators.recognise import recognise
from lodestrand.schema import ITEM
from lodestrand.session import scratch


def typed_stream(spark: SparkSession, path: str, *, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the ITEM rows in the Parquet files of a folder, recognised. Row-local, so it needs no state."""
    return recognise(spark.readStream.schema(ITEM).option("maxFilesPerTrigger", files_per_batch).parquet(path))


def run_once(spark: SparkSession, source: str, target: str, checkpoint: str | None = None) -> None:
    """Type what is new in `source` since the last call with this checkpoint, append it to `target`, and end. Rows are
    neither lost nor doubled when a run is broken off: the checkpoint holds what was read and the sink's log what was written."""
    query = typed_stream(spark, source).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint or scratch(spark, "stream")).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
