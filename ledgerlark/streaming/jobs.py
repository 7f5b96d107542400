"""Streaming forms of recency, title de-duplication and log routing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from ledgerlark.operators.posts import fill_feed_defaults, recent
from ledgerlark.functions.times import epoch_ms
from ledgerlark.sources.files import route_by_level, write_logs


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def stream_recent(posts: DataFrame, as_of: datetime | str, days: int = 7) -> DataFrame:
    """Defaults, time and recency of feed posts; stateless."""
    parsed = fill_feed_defaults(posts).withColumn("parsed_time", epoch_ms(F.col("created_at")))
    return recent(parsed, as_of, days, keep_null=True)


def stream_dedup(posts: DataFrame, title: str = "title", time: str = "parsed_time", delay: str = "7 days") -> DataFrame:
    """First *arrived* post per title; state is dropped once the watermark passes.

    Unlike the batch form the kept row is the first to arrive, not the first in
    row order.
    """
    stamped = posts.withColumn(time, F.col(time).cast("timestamp"))
    return stamped.withWatermark(time, delay).dropDuplicatesWithinWatermark([title])


def run_to_end(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is available, write parquet, stop."""
    query = (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_route_logs(log: DataFrame, path: str, checkpoint: str, console_level: str = "WARNING") -> StreamingQuery:
    """Routes each micro-batch to its sinks.

    A batch writes to its own directory and replaces it when it is run again,
    so a restart after a failure does not repeat records.
    """

    def route(batch: DataFrame, batch_id: int) -> None:
        write_logs(route_by_level(batch, console_level), f"{path}/batch={batch_id}", mode="overwrite")

    return (
        log.writeStream.foreachBatch(route)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
