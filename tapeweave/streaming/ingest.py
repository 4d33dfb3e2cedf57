"""Incremental forms of the batch operators for Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeweave.operators.staging import upsert

EVENTS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def event_stream(spark: SparkSession, path: str, files_per_batch: int = 8) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def tumbling(events: DataFrame, *, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts and sums by window and type; rows later than `late` are left out once the watermark has passed."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("total")).select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "event_type", "events", "total")


def sliding(events: DataFrame, *, width: str = "2 days", step: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts and sums by overlapping windows; rows later than `late` are left out once the watermark has passed."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width, step)).agg(F.count("*").alias("events"), F.sum("value").alias("total")).select(F.col("window.start").alias("window_start"), "events", "total")


def sessions(events: DataFrame, *, gap: str = "6 hours", late: str = "2 days") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("events")).select("user_id", F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "events")


def upsert_batches(stream: DataFrame, path: str, checkpoint: str, keys: list[str], schema: T.StructType, prepare: Callable[[DataFrame], DataFrame] = lambda df: df):
    """Run the stream over what is there and merge each batch into the table at path by key.

    A batch is written beside the version it replaces, under its own number; a batch that is run again
    writes the same version again, so replays change nothing. Late rows are merged like others.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = spark.read.schema(schema).parquet(f"{path}/v={number - 1}") if number else spark.createDataFrame([], schema)
        upsert(old, prepare(batch).select(*schema.names), keys).write.mode("overwrite").parquet(f"{path}/v={number}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
