"""Streaming forms of the stateful operators.

The batch operators keep late rows; a watermark would drop them, so the streams
below use one only where state must be bounded, and say how long that is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postloom.session import checkpoint_dir


def first_seen(stream: DataFrame, keys: list[str], event_time: str, remember: str = "30 days") -> DataFrame:
    """Each key once within the time that it is remembered."""
    return stream.filter(F.col(event_time).isNotNull()).withWatermark(event_time, remember).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, event_time: str, kind: str, value: str, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows and sum of values for each kind and window."""
    return (
        stream.withWatermark(event_time, late)
        .groupBy(F.window(event_time, window), kind)
        .agg(F.count("*").alias("n"), F.sum(value).alias("total"))
        .select(F.col("window.start").alias("window_start"), kind, "n", "total")
    )


def merge_batches(stream: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Every micro-batch handed to ``merge`` (with its number, so a repeated one can be recognised)."""
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drained(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """All that a finite stream gives, as a table written to the shared checkpoint folder under ``name``.

    Appended rows are added batch by batch, of a complete result each batch
    replaces the last; nothing passes through the driver.
    """
    spark: SparkSession = stream.sparkSession
    folder = f"{checkpoint_dir(spark)}/stream-{name}"
    out = f"{folder}/rows"
    spark.createDataFrame([], stream.schema).write.mode("overwrite").parquet(out)

    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True)
    query = writer.foreachBatch(write).start() if mode == "complete" else writer.format("parquet").option("path", out).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
