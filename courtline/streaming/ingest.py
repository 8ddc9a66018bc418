"""Incremental bronze ingestion with Structured Streaming.

The raw data arrives as one parquet folder per season.  Instead of re-reading
every season on each pipeline refresh, the file stream source remembers which
files it has already taken (offsets in the checkpoint), so a refresh appends
only new files to bronze, exactly once, and a restarted or failed run resumes
from the checkpoint.  ``availableNow`` processes everything present now and
stops, which is how a scheduled pipeline refresh runs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from courtline.session import scratch_path


def season_file_stream(spark: SparkSession, source_dir: str, schema: StructType,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of the season folders (``season=...`` partitions)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(source_dir)


def ingest_to_bronze(spark: SparkSession, source_dir: str, target_dir: str, schema: StructType,
                     checkpoint: str | None = None, partition_by: str | None = "season",
                     wait: bool = True) -> StreamingQuery:
    """Append files not yet seen under ``source_dir`` to the bronze folder."""
    checkpoint = checkpoint or scratch_path(spark, "bronze-ingest-checkpoint")
    w = (season_file_stream(spark, source_dir, schema).writeStream
         .format("parquet")
         .option("path", target_dir)
         .option("checkpointLocation", checkpoint)
         .outputMode("append")
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(partition_by)
    q = w.start()
    if wait:
        q.awaitTermination()
    return q
