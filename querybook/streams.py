"""Streaming forms, run to the end of what is available and compared with the batch answer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.session import fresh_path
from ledgerlark.streaming import jobs
from querybook.base import query, table
from querybook.logs import _LEVEL, shaped_log
from querybook.views import AS_OF


def _events(spark, sf):
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return stream


@query("stream_recent", f"""
SELECT event_id, coalesce(author, '未知作者') AS author, parsed_time FROM (
  SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN 'u' || user_id END AS author,
         CASE WHEN event_id % 13 <> 0 THEN date_trunc('millisecond', ts) END AS parsed_time FROM events)
WHERE parsed_time IS NULL OR parsed_time >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY""")
def _recent(spark, sf):
    e = F.col("event_id")
    posts = _events(spark, sf).select(
        "event_id",
        F.when(e % 7 != 0, F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("author"),
        F.when(e % 13 == 0, F.lit(0).cast("bigint")).otherwise(F.unix_millis(F.col("ts").cast("timestamp"))).alias("created_at"),
    )
    out = fresh_path(spark, "stream_recent")
    jobs.run_to_end(jobs.stream_recent(posts, AS_OF).select("event_id", "author", "parsed_time"), out, fresh_path(spark, "cp"))
    return spark.read.parquet(out)


@query("stream_dedup", "SELECT DISTINCT 'post ' || (event_id % 900) AS title FROM events")
def _dedup(spark, sf):
    """Which copy arrives first is open, so the titles are compared."""
    posts = _events(spark, sf).select(
        F.concat(F.lit("post "), (F.col("event_id") % 900).cast("string")).alias("title"), F.col("ts").alias("parsed_time")
    )
    out = fresh_path(spark, "stream_dedup")
    jobs.run_to_end(jobs.stream_dedup(posts, delay="40 days").select("title"), out, fresh_path(spark, "cp"))
    return spark.read.parquet(out)


@query("stream_route_logs", f"""
SELECT sink, level, count(*) AS records FROM (SELECT {_LEVEL} AS level FROM events), (SELECT unnest(['info', 'error', 'debug', 'alert']) AS sink)
WHERE sink = 'debug' OR sink = 'info' AND level <> 'DEBUG' OR sink = 'error' AND level IN ('ERROR', 'CRITICAL')
   OR sink = 'alert' AND level IN ('WARNING', 'ERROR', 'CRITICAL') GROUP BY ALL""")
def _route(spark, sf):
    out = fresh_path(spark, "stream_logs")
    jobs.stream_route_logs(shaped_log(_events(spark, sf)), out, fresh_path(spark, "cp")).awaitTermination()
    return spark.read.parquet(out).groupBy("sink", "level").agg(F.count("*").alias("records"))
