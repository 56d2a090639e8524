"""Structured Streaming: the batch operators over arriving files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_files(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def windowed_counts(events: DataFrame, time: str = "ts", late: str = "10 minutes", width: str = "1 hour", key: str = "event_type") -> DataFrame:
    """Rows and pages by tumbling window and key; rows later than the watermark are dropped."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def dedup_urls(urls: DataFrame, time: str = "ts", late: str = "1 hour", key: str = "url_hash") -> DataFrame:
    """The first row of a key within the watermark's reach."""
    return urls.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def for_each(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Runs a batch operator on every micro-batch; batch numbers name the output folders, so a batch that is repeated after
    a failure overwrites its own."""

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()
