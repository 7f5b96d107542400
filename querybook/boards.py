"""Discussion boards: extraction, defaults, recency, paging, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.text import resolve_url
from ledgerlark.functions.times import parse_board_time
from ledgerlark.operators import posts
from ledgerlark.plans import flows
from querybook.base import query, table
from querybook.views import AS_OF, BOARD_ITEMS_SQL, BOARD_PAGES_SQL, DAYS, board_items, board_pages


def parsed_items(spark: SparkSession, sf: str) -> DataFrame:
    filled = posts.fill_board_defaults(board_items(spark, sf))
    return filled.withColumn("parsed_time", parse_board_time(F.col("time"), AS_OF))


WITH = f"WITH {BOARD_ITEMS_SQL}"


@query("board_items", f"WITH {BOARD_PAGES_SQL} SELECT stock_code, page, row_no - 1 AS pos, title, href, author, time, read_count, reply_count FROM shown")
def _board_items(spark, sf):
    return posts.extract_board_items(board_pages(spark, sf))


@query("parse_board_time", """
SELECT event_id, CASE WHEN event_id % 31 = 5 THEN NULL
  WHEN date_trunc('minute', ts) > TIMESTAMP '2024-01-20 00:00:00' THEN date_trunc('minute', ts) - INTERVAL 1 YEAR
  ELSE date_trunc('minute', ts) END AS parsed_time FROM events""")
def _parse_board_time(spark, sf):
    ev = table(spark, sf, "events")
    text = F.when(F.col("event_id") % 31 == 5, F.lit("未知时间")).otherwise(F.date_format("ts", "MM-dd HH:mm"))
    return ev.select("event_id", parse_board_time(text, "2024-01-20 00:00:00").alias("parsed_time"))


@query("recency", WITH + f"""
SELECT event_id, stock_code, page, parsed_time FROM filled
WHERE parsed_time >= TIMESTAMP '{AS_OF}' - INTERVAL {DAYS} DAY""")
def _recency(spark, sf):
    kept = posts.recent(parsed_items(spark, sf), AS_OF, DAYS, keep_null=False)
    return kept.select("event_id", "stock_code", "page", "parsed_time")


@query("recency_feed", WITH + f"""
SELECT event_id, parsed_time FROM filled
WHERE parsed_time IS NULL OR parsed_time >= TIMESTAMP '{AS_OF}' - INTERVAL {DAYS} DAY""")
def _recency_feed(spark, sf):
    return posts.recent(parsed_items(spark, sf), AS_OF, DAYS, keep_null=True).select("event_id", "parsed_time")


@query("default_fill", WITH + "SELECT event_id, title, author, time, read_count, reply_count FROM filled")
def _default_fill(spark, sf):
    cols = ["event_id", "title", "author", "time", "read_count", "reply_count"]
    return posts.fill_board_defaults(board_items(spark, sf)).select(*cols)


@query("require_title", WITH + "SELECT event_id, title FROM items WHERE title IS NOT NULL")
def _require_title(spark, sf):
    return posts.require_title(board_items(spark, sf)).select("event_id", "title")


@query("tag_columns", f"""
SELECT event_id, CAST(user_id AS VARCHAR) AS stock_code, '东方财富' AS source, '{AS_OF}' AS crawl_time FROM events""")
def _tag_columns(spark, sf):
    rows = table(spark, sf, "events").select("event_id", F.col("user_id").cast("string").alias("stock_code"))
    return posts.tag_columns(rows, AS_OF, posts.BOARD_SOURCE)


@query("bad_row_skip", WITH + """
SELECT event_id, CASE WHEN title IS NULL THEN 'title' WHEN parsed_time IS NULL THEN 'time' END AS error FROM filled""")
def _bad_row_skip(spark, sf):
    items = parsed_items(spark, sf)
    checks = {"title": F.col("title").isNotNull(), "time": F.col("parsed_time").isNotNull()}
    return posts.split_bad(items, checks).select("event_id", F.col("_error").alias("error"))


@query("request_grid", """
SELECT stock_code, CAST(page AS INTEGER) AS page, 'http://guba.eastmoney.com/list,' || stock_code || '_' || page || '.html' AS url
FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS stock_code FROM events), (SELECT unnest(range(1, 6)) AS page)""")
def _request_grid(spark, sf):
    codes = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("stock_code")).distinct()
    return posts.request_grid(codes, 5)


@query("page_staleness", WITH + """
SELECT stock_code, page, items, stale, kept, stale / CAST(items AS DOUBLE) AS stale_share FROM stats""")
def _page_staleness(spark, sf):
    return posts.page_stats(parsed_items(spark, sf), AS_OF, DAYS)


@query("early_stop", WITH + """
SELECT event_id, m.stock_code, m.page, pos FROM marked m JOIN stops USING (stock_code)
WHERE m.page <= stop_page AND is_kept""")
def _early_stop(spark, sf):
    items = parsed_items(spark, sf)
    kept = posts.early_stop(items, posts.page_stats(items, AS_OF, DAYS))
    fresh = posts.recent(posts.require_title(kept), AS_OF, DAYS, keep_null=False)
    return fresh.select("event_id", "stock_code", "page", "pos")


@query("crawl_stats", WITH + """
SELECT stock_code, sum(kept) AS kept_rows, count(*) AS pages_read, sum(stale) AS stale_rows
FROM stats JOIN stops USING (stock_code) WHERE page <= stop_page GROUP BY stock_code""")
def _crawl_stats(spark, sf):
    stats = posts.page_stats(parsed_items(spark, sf), AS_OF, DAYS)
    return posts.crawl_stats(stats, posts.stop_pages(stats))


@query("time_range", WITH + """
SELECT stock_code, min(parsed_time) AS earliest, max(parsed_time) AS latest FROM filled GROUP BY stock_code""")
def _time_range(spark, sf):
    return posts.time_range(parsed_items(spark, sf), "stock_code")


@query("head_n", "SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 5")
def _head_n(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", "value")
    return posts.head_n(rows, F.desc("value"), "event_id", n=5)


@query("page_cap", WITH + "SELECT event_id, stock_code, page FROM items WHERE page <= 3")
def _page_cap(spark, sf):
    from ledgerlark.operators.tables import cap_pages

    return cap_pages(board_items(spark, sf), 3).select("event_id", "stock_code", "page")


@query("ordinals", WITH + "SELECT event_id, stock_code, CAST(rn AS BIGINT) AS pos FROM (SELECT CAST(user_id AS VARCHAR) AS stock_code, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)")
def _ordinals(spark, sf):
    from ledgerlark.operators.cleaning import ordinals
    from ledgerlark.plans.chunked import dense_chunk

    rows = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("stock_code"), "event_id")
    return ordinals(rows, ["stock_code"], [F.col("event_id")], dense_chunk(F.col("event_id")))


@query("ordinals_by_value", """
SELECT event_id, CAST(user_id AS VARCHAR) AS stock_code,
       row_number() OVER (PARTITION BY user_id ORDER BY round(value), event_id DESC) AS pos FROM events""")
def _ordinals_by_value(spark, sf):
    """Positions by a value that many rows share; later ids go first among equals."""
    from ledgerlark.operators.cleaning import ordinals

    rows = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("stock_code"), "event_id", F.round("value").alias("value")
    )
    return ordinals(rows, ["stock_code"], [F.asc("value"), F.desc("event_id")]).select("event_id", "stock_code", "pos")


BOARD_POSTS_SELECT = f"""
SELECT m.stock_code, title, author, time, strftime(parsed_time, '%Y-%m-%d %H:%M:%S') AS parsed_time, read_count, reply_count,
       CASE WHEN starts_with(href, '//') THEN 'http:' || href WHEN starts_with(href, '/') THEN 'http://guba.eastmoney.com' || href
            ELSE href END AS url,
       '东方财富' AS source, m.page, '{AS_OF}' AS crawl_time
FROM marked m JOIN stops USING (stock_code) WHERE m.page <= stop_page AND is_kept"""


@query("board_posts", WITH + BOARD_POSTS_SELECT)
def _board_posts(spark, sf):
    return posts.board_posts(board_items(spark, sf), AS_OF, DAYS)


@query("board_feed", f"""
WITH {BOARD_PAGES_SQL},
marked AS (
  SELECT * REPLACE (coalesce(author, '未知作者') AS author, coalesce(read_count, '0') AS read_count),
    date_trunc('minute', ts) AS parsed_time,
    title IS NOT NULL AND date_trunc('minute', ts) < TIMESTAMP '{AS_OF}' - INTERVAL {DAYS} DAY AS is_stale,
    title IS NOT NULL AND date_trunc('minute', ts) >= TIMESTAMP '{AS_OF}' - INTERVAL {DAYS} DAY AS is_kept FROM shown),
stats AS (SELECT stock_code, page, count(*) AS items, count(*) FILTER (is_stale) AS stale FROM marked GROUP BY ALL),
stops AS (SELECT stock_code, coalesce(min(page) FILTER (stale > items * CAST(0.8 AS DOUBLE)), max(page)) AS stop_page FROM stats GROUP BY ALL)
""" + BOARD_POSTS_SELECT)
def _board_feed(spark, sf):
    return flows.board_feed(board_pages(spark, sf), AS_OF, DAYS)


@query("resolve_url_board", """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'http://h/' || event_id WHEN 1 THEN 'http://guba.eastmoney.com/h/' || event_id
  ELSE 'h/' || event_id END AS url FROM events""")
def _resolve_url_board(spark, sf):
    e = F.col("event_id")
    href = F.concat(F.when(e % 3 == 0, "//h/").when(e % 3 == 1, "/h/").otherwise("h/"), e.cast("string"))
    return table(spark, sf, "events").select("event_id", resolve_url(href, posts.BOARD_HOST, "board").alias("url"))
