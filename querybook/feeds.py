"""Feed pages: flattening, times, previews, canonical outputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.functions import times as TM
from ledgerlark.functions.text import preview, profile_url
from ledgerlark.operators import posts
from ledgerlark.sources.feeds import failed_pages, flatten_feed
from querybook.base import query, table
from querybook.views import AS_OF, DAYS, FEED_SQL, feed_pages

WITH = f"WITH {FEED_SQL}"
LIMIT = f"(TIMESTAMP '{AS_OF}' - INTERVAL {DAYS} DAY)"


@query("feed_flatten", WITH + """
SELECT stock_code, page, source_kind, pos, id, title, text, source, url, created_at, retweet_count, reply_count, fav_count,
       author, author_id, profile_image_url FROM flat""")
def _feed_flatten(spark, sf):
    return flatten_feed(feed_pages(spark, sf))


@query("feed_failed_pages", """
SELECT DISTINCT 'f' || (event_id // 100) AS stock_code, CAST((event_id // 20) % 5 + 1 AS INTEGER) AS page
FROM events WHERE (event_id // 20) % 37 = 36""")
def _failed(spark, sf):
    return failed_pages(feed_pages(spark, sf))


@query("source_filter", WITH + "SELECT stock_code, page, pos, id FROM flat WHERE source_kind = 'news'")
def _source_filter(spark, sf):
    return flatten_feed(posts.of_kind(feed_pages(spark, sf), "news")).select("stock_code", "page", "pos", "id")


@query("epoch_ms", WITH + "SELECT stock_code, page, pos, parsed AS parsed_time FROM flat")
def _epoch_ms(spark, sf):
    flat = flatten_feed(feed_pages(spark, sf))
    return flat.select("stock_code", "page", "pos", TM.epoch_ms(F.col("created_at")).alias("parsed_time"))


@query("format_time", WITH + """
SELECT stock_code, page, pos, coalesce(strftime(parsed, '%Y-%m-%d %H:%M:%S'), '未知时间') AS time,
       coalesce(strftime(parsed, '%Y-%m-%d %H:%M:%S'), '') AS parsed_time FROM flat""")
def _format_time(spark, sf):
    flat = flatten_feed(feed_pages(spark, sf))
    t = TM.epoch_ms(F.col("created_at"))
    return flat.select(
        "stock_code", "page", "pos",
        TM.format_time(t, posts.UNKNOWN_TIME).alias("time"), TM.format_time(t, "").alias("parsed_time"),
    )


@query("preview", WITH + """
SELECT stock_code, page, pos, CASE WHEN title <> '' THEN title WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END AS preview,
       CASE WHEN title <> '' THEN title ELSE text END AS news_preview FROM flat""")
def _preview(spark, sf):
    flat = flatten_feed(feed_pages(spark, sf))
    return flat.select(
        "stock_code", "page", "pos",
        preview(F.col("title"), F.col("text")).alias("preview"),
        preview(F.col("title"), F.col("text"), None).alias("news_preview"),
    )


@query("profile_url", WITH + """
SELECT stock_code, page, pos, CASE WHEN id IS NULL OR id = '0' THEN '' ELSE 'https://xueqiu.com' || profile_image_url END AS url FROM flat""")
def _profile_url(spark, sf):
    flat = flatten_feed(feed_pages(spark, sf))
    url = profile_url(F.col("id"), F.col("profile_image_url"), posts.FEED_HOST)
    return flat.select("stock_code", "page", "pos", url.alias("url"))


# The first page missing (malformed or without a list) ends the reading of its stock.
KEPT_SQL = f"""
, seen AS (
  SELECT *, coalesce(parsed < {LIMIT}, false) AS is_stale FROM flat),
stats AS (
  SELECT stock_code, page, count(*) AS items, count(*) FILTER (is_stale) AS stale FROM seen GROUP BY ALL),
stops AS (
  SELECT stock_code, min(stop) AS stop_page FROM (
    SELECT stock_code, page AS stop FROM stats WHERE stale > items * CAST(0.8 AS DOUBLE)
    UNION ALL
    SELECT stock_code, p FROM (SELECT DISTINCT stock_code FROM stats), (SELECT unnest(range(2, 7)) AS p)
    WHERE (stock_code, p) NOT IN (SELECT (stock_code, page) FROM stats)
    UNION ALL
    SELECT 'f' || (event_id // 100), (event_id // 20) % 5 FROM events WHERE (event_id // 20) % 37 = 36
  ) GROUP BY stock_code),
kept AS (
  SELECT seen.* FROM seen JOIN stops USING (stock_code) WHERE page <= stop_page AND NOT is_stale)
"""


@query("feed_discussions", WITH + KEPT_SQL + f"""
SELECT stock_code, title, text AS content, coalesce(author, '未知作者') AS author, author_id,
       coalesce(strftime(parsed, '%Y-%m-%d %H:%M:%S'), '未知时间') AS time,
       coalesce(strftime(parsed, '%Y-%m-%d %H:%M:%S'), '') AS parsed_time,
       retweet_count, coalesce(reply_count, 0) AS reply_count, fav_count, coalesce(source, '雪球') AS source,
       CASE WHEN id IS NULL OR id = '0' THEN '' ELSE 'https://xueqiu.com' || profile_image_url END AS url,
       page, '{AS_OF}' AS crawl_time FROM kept""")
def _feed_discussions(spark, sf):
    pages = feed_pages(spark, sf)
    return posts.feed_discussions(flatten_feed(pages), AS_OF, DAYS, failed=failed_pages(pages))


@query("feed_news", WITH + KEPT_SQL + f"""
SELECT stock_code, title, text AS content,
       coalesce(strftime(parsed, '%Y-%m-%d %H:%M:%S'), '未知时间') AS time,
       coalesce(strftime(parsed, '%Y-%m-%d %H:%M:%S'), '') AS parsed_time,
       coalesce(source, '雪球') AS source, url, page, '{AS_OF}' AS crawl_time FROM kept""")
def _feed_news(spark, sf):
    pages = feed_pages(spark, sf)
    return posts.feed_news(flatten_feed(pages), AS_OF, DAYS, failed=failed_pages(pages))


@query("parse_relative_time", """
SELECT event_id, CASE event_id % 8
  WHEN 0 THEN TIMESTAMP '2024-12-01 12:00:30' - to_minutes(event_id % 600)
  WHEN 1 THEN TIMESTAMP '2024-12-01 12:00:30' - to_hours(event_id % 90)
  WHEN 2 THEN TIMESTAMP '2024-12-01 12:00:30' - to_days(CAST(event_id % 400 AS INTEGER))
  WHEN 3 THEN TIMESTAMP '2024-11-30 00:00:00' + (ts - date_trunc('day', ts)) - (ts - date_trunc('minute', ts))
  WHEN 4 THEN TIMESTAMP '2024-11-29 00:00:00' + (ts - date_trunc('day', ts)) - (ts - date_trunc('minute', ts))
  WHEN 5 THEN date_trunc('minute', ts)
  WHEN 6 THEN date_trunc('day', ts) END AS parsed_time FROM events""")
def _parse_relative_time(spark, sf):
    e = F.col("event_id")
    clock = F.date_format("ts", "HH:mm")
    text = (
        F.when(e % 8 == 0, F.concat((e % 600).cast("string"), F.lit("分钟前")))
        .when(e % 8 == 1, F.concat((e % 90).cast("string"), F.lit("小时前")))
        .when(e % 8 == 2, F.concat((e % 400).cast("string"), F.lit("天前")))
        .when(e % 8 == 3, F.concat(F.lit("昨天 "), clock))
        .when(e % 8 == 4, F.concat(F.lit("前天 "), clock))
        .when(e % 8 == 5, F.date_format("ts", "yyyy-MM-dd HH:mm"))
        .when(e % 8 == 6, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise("刚刚")
    )
    parsed = TM.parse_relative_time(text, "2024-12-01 12:00:30")
    return table(spark, sf, "events").select("event_id", parsed.alias("parsed_time"))
