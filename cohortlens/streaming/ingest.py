"""Streaming form of the event-log sink (IO3 / IO4 for an append-only log).

The analytics themselves are batch (every operator reads whole tables); this module only keeps
the date-partitioned events table current as new files land, so batch jobs prune on
``event_date``. Progress and exactly-once file tracking live in a checkpoint folder that belongs
to the sink: a later session goes on where this one stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortlens.sources import schemas
from cohortlens.sources.readers import coerce_timestamps


def read_event_stream(spark: SparkSession, source_dir: str, fmt: str = "parquet",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Events arriving as files in ``source_dir``, read with the declared schema (no inference)."""
    reader = spark.readStream.format(fmt)
    if fmt == "csv":
        text = schemas.EVENTS.simpleString().replace("timestamp_ntz", "string")
        reader = reader.option("header", True).schema(text)
    else:
        reader = reader.schema(schemas.EVENTS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.load(source_dir)
    return coerce_timestamps(df, ["event_timestamp"]) if fmt == "csv" else df


def ingest_events(spark: SparkSession, source_dir: str, sink_dir: str, fmt: str = "parquet",
                  checkpoint: str | None = None, once: bool = False) -> StreamingQuery:
    """Append new event files to ``sink_dir`` partitioned by ``event_date``.

    ``once=True`` processes everything available and stops (``availableNow`` trigger), which is
    how a scheduled batch refresh runs; otherwise the query keeps running.
    """
    checkpoint = checkpoint or f"{sink_dir.rstrip('/')}/_ingest_checkpoint"  # readers skip names that begin with _
    events = read_event_stream(spark, source_dir, fmt).withColumn("event_date", F.to_date("event_timestamp"))
    writer = (events.writeStream.format("parquet").outputMode("append").option("path", sink_dir)
              .option("checkpointLocation", checkpoint).partitionBy("event_date"))
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start()
