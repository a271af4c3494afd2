"""The daily load as an incremental file stream.

Shards land as Parquet files in one folder per day. A file stream notices new
files; each micro-batch then makes the days it names equal to all the files
that have landed for them, so a day that arrives in several files, batches or
runs keeps every row, and a repeated batch changes nothing. A restarted query
resumes from its checkpoint. ``availableNow`` runs it as a scheduled job: load
what has landed, then stop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmetrics.schema import RAW_SCHEMA
from playmetrics.session import scratch_path
from playmetrics.sources.raw_table import RawTable, folder_shards


def _rebuild_days(spark: SparkSession, landing: str, raw_path: str, pattern: str):
    def rebuild(batch: DataFrame, batch_id: int) -> None:
        shards = folder_shards(spark, landing, pattern)
        names = {r[0] for r in batch.select("folder").distinct().collect()}  # days, not rows
        days = [d for d in shards.days() if d.strftime(pattern) in names]
        if len(days) < len(names):
            raise ValueError(f"landed folders that name no day: {sorted(names)}")
        RawTable(spark, raw_path).replace(shards, days)
    return rebuild


def start_shard_stream(spark: SparkSession, landing: str, raw_path: str,
                       checkpoint_location: str | None = None, available_now: bool = True,
                       processing_time: str = "1 hour", pattern: str = "events_%Y%m%d",
                       files_per_batch: int | None = None):
    """Start the stream; returns the ``StreamingQuery``.

    The checkpoint defaults to a fresh folder under the cluster's shared
    checkpoint directory; pass a stable location to resume across runs.
    """
    location = checkpoint_location or scratch_path(spark, "shard-stream")
    reader = spark.readStream.schema(RAW_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("folder")
    source = reader.parquet(f"{landing.rstrip('/')}/*").select(folder)
    writer = (source.writeStream.foreachBatch(_rebuild_days(spark, landing, raw_path, pattern))
              .option("checkpointLocation", location))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time))
    return writer.start()


def load_landed_shards(spark: SparkSession, landing: str, raw_path: str,
                       checkpoint_location: str, **options) -> None:
    """Load every shard that has landed since the last run, then return."""
    query = start_shard_stream(spark, landing, raw_path, checkpoint_location, **options)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
