"""Run logs derived from events: level by event type, duration by value."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.functions import logs as G
from ledgerlark.operators import sessions as H
from ledgerlark.session import fresh_path
from ledgerlark.sources.files import rotated, route_by_level, write_logs, write_rotated
from querybook.base import query, table

# Event type to level; one level each.
LEVELS = {"view": "DEBUG", "click": "INFO", "purchase": "WARNING", "error": "ERROR", "signup": "CRITICAL"}
_LEVEL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LEVELS.items()) + " END"


def run_log(spark, sf):
    ev = table(spark, sf, "events")
    return shaped_log(ev)


def shaped_log(ev):
    e = F.col("event_id")
    level = F.lit(None).cast("string")
    for kind, name in LEVELS.items():
        level = F.when(F.col("event_type") == kind, name).otherwise(level)
    status = F.when(e % 10 == 0, 404).when(e % 10 == 1, 500).otherwise(200)
    seconds = F.when(e % 6 == 0, F.lit(None).cast("double")).otherwise(F.col("value"))
    message = F.when(
        e % 4 == 3, F.concat(F.lit("page - "), e.cast("string"))
    ).otherwise(G.request_line(F.concat(F.lit("http://h/"), e.cast("string")), status, seconds))
    return ev.select("event_id", "ts", level.alias("level"), F.lit("crawler").alias("logger"), message.alias("message"))


@query("route_logs", f"""
SELECT event_id, level, sink FROM (SELECT event_id, {_LEVEL} AS level FROM events), (SELECT unnest(['info', 'error', 'debug', 'alert']) AS sink)
WHERE sink = 'debug' OR sink = 'info' AND level <> 'DEBUG' OR sink = 'error' AND level IN ('ERROR', 'CRITICAL')
   OR sink = 'alert' AND level IN ('WARNING', 'ERROR', 'CRITICAL')""")
def _route(spark, sf):
    path = fresh_path(spark, "logs")
    write_logs(route_by_level(run_log(spark, sf)), path)
    return spark.read.parquet(path).select("event_id", "level", "sink")


_MAX_BYTES, _KEPT = 20_000, 5


@query("rotate_logs", f"""
WITH lines AS (
  SELECT sink, event_id, level || ' - m' || event_id || ' - ' || strftime(ts, '%Y-%m-%d %H:%M:%S') AS line
  FROM (SELECT event_id, ts, {_LEVEL} AS level FROM events), (SELECT unnest(['info', 'error', 'debug', 'alert']) AS sink)
  WHERE sink = 'debug' OR sink = 'info' AND level <> 'DEBUG' OR sink = 'error' AND level IN ('ERROR', 'CRITICAL')
     OR sink = 'alert' AND level IN ('WARNING', 'ERROR', 'CRITICAL')),
sized AS (SELECT *, strlen(line) + 1 AS size, sum(strlen(line) + 1) OVER (PARTITION BY sink ORDER BY event_id) AS upto,
  {_MAX_BYTES} - max(strlen(line) + 1) OVER (PARTITION BY sink) + 1 AS width FROM lines),
placed AS (SELECT *, CAST((upto - size) // width AS BIGINT) AS file FROM sized),
kept AS (SELECT *, max(file) OVER (PARTITION BY sink) AS newest FROM placed)
SELECT sink, file, count(*) AS lines, CAST(sum(size) AS BIGINT) AS bytes FROM kept WHERE newest - file < {_KEPT} GROUP BY ALL""")
def _rotate(spark, sf):
    """Lines of every sink in files of limited size, the newest kept, written and read back."""
    path = fresh_path(spark, "rotated")
    routed = route_by_level(run_log(spark, sf).withColumn("m", F.concat(F.lit("m"), F.col("event_id").cast("string"))))
    lines = routed.select("sink", F.col("event_id").alias("seq"), G.log_line(F.col("level"), F.col("m"), F.col("ts")).alias("line"))
    write_rotated(rotated(lines, "seq", _MAX_BYTES, _KEPT), path)
    back = spark.read.schema("value string, sink string, file bigint").format("text").load(path)
    return back.groupBy("sink", "file").agg(
        F.count("*").alias("lines"), F.sum(F.octet_length("value") + 1).cast("bigint").alias("bytes")
    )


@query("request_stats", """
WITH r AS (SELECT CASE event_id % 10 WHEN 0 THEN 404 WHEN 1 THEN 500 ELSE 200 END AS status,
    CASE WHEN event_id % 6 <> 0 AND value <> 0 THEN round(value, 2) END AS seconds FROM events WHERE event_id % 4 <> 3)
SELECT status, count(*) AS requests, count(seconds) AS timed, round(sum(seconds), 2) AS total_seconds,
  round(avg(seconds), 4) AS mean_seconds, max(seconds) AS max_seconds FROM r GROUP BY status""")
def _stats(spark, sf):
    return H.request_stats(run_log(spark, sf))


# Ratio of neighbouring buckets at a relative error of one per cent.
_G = "(CAST(1.01 AS DOUBLE) / CAST(0.99 AS DOUBLE))"


@query("request_quantiles", f"""
WITH r AS (SELECT CASE event_id % 10 WHEN 0 THEN 404 WHEN 1 THEN 500 ELSE 200 END AS status, round(value, 2) AS seconds
    FROM events WHERE event_id % 4 <> 3 AND event_id % 6 <> 0 AND value <> 0),
b AS (SELECT status, CASE WHEN seconds > 0 THEN CAST(ceil(ln(seconds) / ln({_G})) AS INTEGER) END AS bucket, count(*) AS n FROM r GROUP BY ALL),
u AS (SELECT *, sum(n) OVER (PARTITION BY status ORDER BY bucket NULLS FIRST) AS upto, sum(n) OVER (PARTITION BY status) AS total,
    coalesce(2 * pow({_G}, bucket) / ({_G} + 1), 0) AS middle FROM b)
SELECT status, round(min(middle) FILTER (upto >= ceil(total * CAST(0.5 AS DOUBLE))), 6) AS p50,
  round(min(middle) FILTER (upto >= ceil(total * CAST(0.95 AS DOUBLE))), 6) AS p95 FROM u GROUP BY status""")
def _quantiles(spark, sf):
    """Sketches stored by day, read back and merged over all days."""
    path = fresh_path(spark, "sketches")
    H.request_sketches(run_log(spark, sf)).write.partitionBy("day").parquet(path)
    return H.sketch_quantiles(spark.read.parquet(path), (0.5, 0.95))


@query("log_line", f"""
SELECT event_id, {_LEVEL} || ' - m' || event_id || ' - ' || strftime(ts, '%Y-%m-%d %H:%M:%S') AS info_line,
  {_LEVEL} || ' - run.py:' || (event_id % 100) || ' - m' || event_id || ' - ' || strftime(ts, '%Y-%m-%d %H:%M:%S') AS error_line,
  {_LEVEL} || ' - run.py:' || (event_id % 100) || ' - main - m' || event_id || ' - ' || strftime(ts, '%Y-%m-%d %H:%M:%S') AS debug_line,
  date_trunc('second', ts) AS back_ts, 'm' || event_id AS back_message FROM events""")
def _line(spark, sf):
    e = F.col("event_id")
    log = run_log(spark, sf).withColumn("m", F.concat(F.lit("m"), e.cast("string")))
    args = (F.col("level"), F.col("m"), F.col("ts"))
    info = G.log_line(*args)
    back = G.parse_info_line(info)
    return log.select(
        e, info.alias("info_line"),
        G.log_line(*args, file=F.lit("run.py"), line=e % 100).alias("error_line"),
        G.log_line(*args, file=F.lit("run.py"), line=e % 100, func=F.lit("main")).alias("debug_line"),
        back["ts"].alias("back_ts"), back["message"].alias("back_message"),
    )
