"""Views derived from the given tables, and the same views for the SQL side.

A derived page gathers twenty consecutive dense keys, so building a page never
gathers an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.plans.ranged import ranks_by_range
from querybook.base import table

AS_OF = "2024-01-31 00:00:00"
DAYS = 7
PER_PAGE = 20


def _if(cond: Column, value: Column | str | None, other: Column | str | None = None) -> Column:
    v = value if isinstance(value, Column) else F.lit(value)
    o = other if isinstance(other, Column) else F.lit(other)
    return F.when(cond, v).otherwise(o)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partitioned by key over all cores: what follows is bound by CPU, not by bytes."""
    spark = df.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, key)


# --- board posts from events, paged by value ------------------------------------------------


def board_items(spark: SparkSession, sf: str) -> DataFrame:
    """Posts of each user, pages of twenty in order of falling value.

    The rank is counted over ranges of (user, value, id), so no user's posts are sorted as a whole.
    """
    ev = table(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    ranked = ranks_by_range(ev, ["user_id"], [F.desc("value"), F.col("event_id").asc()], "_rn")
    e = F.col("event_id")
    return ranked.select(
        F.col("user_id").cast("string").alias("stock_code"),
        (F.floor((F.col("_rn") - 1) / PER_PAGE) + 1).cast("int").alias("page"),
        ((F.col("_rn") - 1) % PER_PAGE + 1).cast("int").alias("pos"),
        "event_id",
        _if(e % 50 == 7, None, F.concat(F.lit("post "), (e % 900).cast("string"))).alias("title"),
        _if(e % 7 == 0, None, F.concat(F.lit("user "), (e % 40).cast("string"))).alias("author"),
        _if(e % 31 == 5, _if(e % 62 == 5, None, "刚刚"), F.date_format("ts", "MM-dd HH:mm")).alias("time"),
        _if(e % 11 == 3, None, (e % 97).cast("string")).alias("read_count"),
        _if(e % 13 == 4, None, (e % 17).cast("string")).alias("reply_count"),
        F.concat(_if(e % 3 == 0, "//caifuhao.cn/", _if(e % 3 == 1, "/news/", "news/")), e.cast("string")).alias("href"),
    )


BOARD_ITEMS_SQL = f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events),
items AS (
  SELECT CAST(user_id AS VARCHAR) AS stock_code,
         CAST((rn - 1) // {PER_PAGE} + 1 AS INTEGER) AS page,
         CAST((rn - 1) % {PER_PAGE} + 1 AS INTEGER) AS pos,
         event_id, ts,
         CASE WHEN event_id % 50 = 7 THEN NULL ELSE 'post ' || (event_id % 900) END AS title,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'user ' || (event_id % 40) END AS author,
         CASE WHEN event_id % 31 = 5 THEN CASE WHEN event_id % 62 = 5 THEN NULL ELSE '刚刚' END
              ELSE strftime(ts, '%m-%d %H:%M') END AS time,
         CASE WHEN event_id % 11 = 3 THEN NULL ELSE CAST(event_id % 97 AS VARCHAR) END AS read_count,
         CASE WHEN event_id % 13 = 4 THEN NULL ELSE CAST(event_id % 17 AS VARCHAR) END AS reply_count,
         CASE event_id % 3 WHEN 0 THEN '//caifuhao.cn/' WHEN 1 THEN '/news/' ELSE 'news/' END || event_id AS href
  FROM ranked),
filled AS (
  SELECT * REPLACE (coalesce(author, '未知作者') AS author, coalesce(time, '未知时间') AS time,
                    coalesce(read_count, '0') AS read_count, coalesce(reply_count, '0') AS reply_count),
         CASE WHEN event_id % 31 <> 5 THEN date_trunc('minute', ts) END AS parsed_time
  FROM items),
marked AS (
  SELECT *, title IS NOT NULL AND coalesce(parsed_time < TIMESTAMP '{AS_OF}' - INTERVAL {DAYS} DAY, false) AS is_stale,
         title IS NOT NULL AND coalesce(parsed_time >= TIMESTAMP '{AS_OF}' - INTERVAL {DAYS} DAY, false) AS is_kept
  FROM filled),
stats AS (
  SELECT stock_code, page, count(*) AS items, count(*) FILTER (is_stale) AS stale, count(*) FILTER (is_kept) AS kept
  FROM marked GROUP BY ALL),
stops AS (
  SELECT stock_code, coalesce(min(page) FILTER (stale > items * CAST(0.8 AS DOUBLE)), max(page)) AS stop_page
  FROM stats GROUP BY ALL)
"""


# --- board pages as markup ------------------------------------------------------------------


def _paged_html(rows: DataFrame, key: str, row_html: str) -> DataFrame:
    """Rows of one page in key order; a page holds at most twenty dense keys by construction."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col(row_html).alias("h"))))
    return spread(rows, "pid").groupBy("pid").agg(F.array_join(F.transform(listed, lambda r: r["h"]), "").alias("rows_html"))


def board_pages(spark: SparkSession, sf: str) -> DataFrame:
    """(stock_code, page, html): board pages of twenty consecutive events."""
    ev = table(spark, sf, "events")
    e = F.col("event_id")
    es = e.cast("string")
    cell = lambda *parts: F.concat(F.lit("<td>"), *[p if isinstance(p, Column) else F.lit(p) for p in parts], F.lit("</td>"))
    row = F.concat(
        F.lit('<tr class="listitem odd">'),
        cell(_if(e % 11 == 3, "", F.concat(F.lit('<div class="read">'), (e % 97).cast("string"), F.lit("</div>")))),
        cell('<div class="reply"> ', (e % 17).cast("string"), " </div>"),
        cell(_if(e % 50 == 7, "<span>none</span>", F.concat(
            F.lit('<div class="title"><a href="'),
            _if(e % 3 == 0, "//caifuhao.cn/", _if(e % 3 == 1, "/news/", "news/")), es,
            F.lit('"> post&nbsp;'), es, F.lit(" <em>new</em></a></div>")))),
        cell(_if(e % 7 == 0, "", F.concat(F.lit('<div class="author"><a href="/u">user '), (e % 40).cast("string"), F.lit("</a></div>")))),
        cell('<div class="update">', F.date_format("ts", "MM-dd HH:mm"), "</div>"),
        F.lit("</tr>"),
    )
    rows = ev.select(F.floor(e / PER_PAGE).alias("pid"), "event_id", row.alias("h"))
    pages = _paged_html(rows, "event_id", "h")
    return pages.select(
        F.concat(F.lit("b"), F.floor(F.col("pid") / 5).cast("string")).alias("stock_code"),
        (F.col("pid") % 5 + 1).cast("int").alias("page"),
        F.concat(
            F.lit('<html><body><!-- <tbody class="listbody"> --><table><tbody class="listbody"><tr class="head"><td>x</td></tr>'),
            F.col("rows_html"),
            F.lit("</tbody></table></body></html>"),
        ).alias("html"),
    )


BOARD_PAGES_SQL = f"""
shown AS (
  SELECT 'b' || (event_id // 100) AS stock_code, CAST((event_id // {PER_PAGE}) % 5 + 1 AS INTEGER) AS page,
         CAST(event_id % {PER_PAGE} + 2 AS INTEGER) AS row_no, event_id, ts,
         CASE WHEN event_id % 50 = 7 THEN NULL ELSE 'post' || chr(160) || event_id || 'new' END AS title,
         CASE WHEN event_id % 50 = 7 THEN NULL ELSE
           CASE event_id % 3 WHEN 0 THEN '//caifuhao.cn/' WHEN 1 THEN '/news/' ELSE 'news/' END || event_id END AS href,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'user ' || (event_id % 40) END AS author,
         strftime(ts, '%m-%d %H:%M') AS time,
         CASE WHEN event_id % 11 = 3 THEN NULL ELSE CAST(event_id % 97 AS VARCHAR) END AS read_count,
         CAST(event_id % 17 AS VARCHAR) AS reply_count
  FROM events)
"""


# --- feed pages as JSON ---------------------------------------------------------------------


def feed_pages(spark: SparkSession, sf: str) -> DataFrame:
    """(stock_code, page, json): twenty posts a page; some pages malformed, some without a list."""
    ev = table(spark, sf, "events")
    e = F.col("event_id")
    post = F.struct(
        _if(e % 19 == 0, None, e.cast("string")).alias("id"),
        _if(e % 4 == 0, "", F.concat(F.lit("标题 "), e.cast("string"))).alias("title"),
        F.repeat(F.concat(F.lit("正文"), e.cast("string"), F.lit(" ")), (e % 30).cast("int")).alias("text"),
        _if(e % 13 == 0, F.lit(0).cast("bigint"), F.unix_millis(F.col("ts").cast("timestamp"))).alias("created_at"),
        _if(e % 5 == 0, None, F.concat(F.lit("src "), (e % 3).cast("string"))).alias("source"),
        F.concat(F.lit("http://n/"), e.cast("string")).alias("url"),
        (e % 6).cast("int").alias("retweet_count"),
        _if(e % 6 == 1, F.lit(None).cast("int"), (e % 8).cast("int")).alias("reply_count"),
        (e % 9).cast("int").alias("fav_count"),
        F.struct(
            _if(e % 7 == 0, None, F.concat(F.lit("user "), (e % 40).cast("string"))).alias("screen_name"),
            (e % 40).cast("string").alias("id"),
            F.concat(F.lit("/pic/"), (e % 40).cast("string")).alias("profile_image_url"),
        ).alias("user"),
    )
    rows = ev.select(F.floor(e / PER_PAGE).alias("pid"), "event_id", post.alias("post"))
    listed = F.array_sort(F.collect_list(F.struct("event_id", "post")))
    pages = spread(rows, "pid").groupBy("pid").agg(
        F.to_json(F.struct(F.transform(listed, lambda r: r["post"]).alias("list"))).alias("full")
    )
    p = F.col("pid")
    return pages.select(
        F.concat(F.lit("f"), F.floor(p / 5).cast("string")).alias("stock_code"),
        (p % 5 + 1).cast("int").alias("page"),
        _if(p % 2 == 0, "all", "news").alias("source_kind"),
        _if(p % 37 == 36, '{"list": [', _if(p % 41 == 40, '{"count": 0}', F.col("full"))).alias("json"),
    )


FEED_SQL = f"""
flat AS (
  SELECT 'f' || (event_id // 100) AS stock_code, CAST((event_id // {PER_PAGE}) % 5 + 1 AS INTEGER) AS page,
         CASE WHEN (event_id // {PER_PAGE}) % 2 = 0 THEN 'all' ELSE 'news' END AS source_kind,
         CAST(event_id % {PER_PAGE} + 1 AS INTEGER) AS pos, event_id,
         CASE WHEN event_id % 19 <> 0 THEN CAST(event_id AS VARCHAR) END AS id,
         CASE WHEN event_id % 4 = 0 THEN '' ELSE '标题 ' || event_id END AS title,
         repeat('正文' || event_id || ' ', CAST(event_id % 30 AS BIGINT)) AS text,
         CASE WHEN event_id % 13 = 0 THEN 0 ELSE epoch_us(ts) // 1000 END AS created_at,
         CASE WHEN event_id % 13 <> 0 THEN date_trunc('millisecond', ts) END AS parsed,
         CASE WHEN event_id % 5 <> 0 THEN 'src ' || (event_id % 3) END AS source,
         'http://n/' || event_id AS url,
         CAST(event_id % 6 AS INTEGER) AS retweet_count,
         CASE WHEN event_id % 6 <> 1 THEN CAST(event_id % 8 AS INTEGER) END AS reply_count,
         CAST(event_id % 9 AS INTEGER) AS fav_count,
         CASE WHEN event_id % 7 <> 0 THEN 'user ' || (event_id % 40) END AS author,
         CAST(event_id % 40 AS VARCHAR) AS author_id,
         '/pic/' || (event_id % 40) AS profile_image_url
  FROM events
  WHERE (event_id // {PER_PAGE}) % 37 <> 36 AND (event_id // {PER_PAGE}) % 41 <> 40)
"""


# --- disclosure pages from orders -----------------------------------------------------------


def stock_of(pid: Column) -> Column:
    """Five pages a stock; first digit in turn 6, 0, 3."""
    n = F.floor(pid / 5)
    first = F.element_at(F.array(F.lit("6"), F.lit("0"), F.lit("3")), (n % 3 + 1).cast("int"))
    return F.concat(first, F.format_string("%05d", n))


def disclosure_pages(spark: SparkSession, sf: str) -> DataFrame:
    """(pid, stock_code, page, html): three tables a page, the third with twenty orders.

    Pages differ in where the table's title is found (``pid % 9``), in links
    (``k % 4``, missing on some rows), blanks in the date column and empty rows.
    """
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    ks = k.cast("string")
    pid = F.floor(k / PER_PAGE)
    d = F.date_format("o_orderdate", "yyyy-MM-dd")
    link = (
        F.when((pid % 7 == 6) & (k % 5 == 4), F.concat(F.lit("说明"), ks))
        .when(k % 4 == 0, F.concat(F.lit('<a href="/disc/'), ks, F.lit('.pdf">订单'), ks, F.lit("公告 "), d, F.lit("</a>")))
        .when(k % 4 == 1, F.concat(F.lit('<a class="x" href="//static.host/'), ks, F.lit('.pdf"> 公告'), ks, F.lit(" </a>")))
        .when(k % 4 == 2, F.concat(F.lit('<a href="./d/'), ks, F.lit('">通知&amp;'), ks, F.lit("</a>")))
        .otherwise(F.concat(F.lit("<a href='http://x.cn/"), ks, F.lit("'>订单"), ks, F.lit('</a> <a href="other/'), ks, F.lit('">附件'), ks, F.lit("</a>")))
    )
    date = F.when(k % 3 == 0, d).when(k % 3 == 1, "").otherwise(" ")
    row = F.concat(
        F.lit("<tr><td>"), date, F.lit("</td><td>"), link, F.lit("</td><td> "), F.col("o_orderstatus"),
        F.lit("</td><td><b>"), F.col("o_orderpriority"), F.lit("</b></td></tr>"),
    )
    rows = o.select(pid.alias("pid"), "o_orderkey", row.alias("h"))
    p = F.col("pid")
    ps = p.cast("string")
    c = p % 9
    before = F.when(c == 0, F.concat(F.lit("<h1>公司公告"), ps, F.lit("</h1>"))).when(
        c == 1, F.concat(F.lit("<h1>"), ps, F.lit("</h1><h2>公告<i>列表</i>"), ps, F.lit("</h2>"))
    ).otherwise("")
    box = F.when(c == 4, ' class="box title-box"').when(c == 5, ' id="list-title"').otherwise("")
    attrs = F.when(c == 6, F.concat(F.lit(' id="tbl'), ps, F.lit('"'))).when(
        c == 7, ' class="table table-hover disclosure wide"'
    ).otherwise("")
    caption = F.when(c == 2, F.concat(F.lit("<caption>表 "), ps, F.lit("</caption>"))).otherwise("")
    after = F.when(c == 3, F.concat(F.lit("<h3>后置标题"), ps, F.lit("</h3>"))).otherwise("")
    gap = F.when(p % 4 == 1, "<tr></tr>").otherwise("")
    last = (p % 6 + 1).cast("int")
    numbers = F.array_join(
        F.transform(F.sequence(F.lit(1), last), lambda n: F.concat(F.lit('<a href="#" data-pi="'), (n - 1).cast("string"), F.lit('">'), n.cast("string"), F.lit("</a>"))), ""
    )
    paging = F.when(p % 5 == 4, F.concat(F.lit("<p>共"), last.cast("string"), F.lit("页</p>"))).otherwise(
        F.concat(F.lit('<div class="pagination"><ul class="paginator-ul">'), numbers, F.lit("</ul><a>下一页</a></div>"))
    )
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><title> 披露"), ps, F.lit(' </title><meta name="description" content="第'), ps,
        F.lit('页"><style>td{color:red}</style><script>var t="<table><tr><td>x</td></tr></table>";</script></head><body>'
              '<div class="nav"><table><tr><td><a href="/">首页</a></td></tr></table>'
              "<table><tr><td>搜索</td><td>"), ps, F.lit("</td></tr></table></div>"),
        before, F.lit("<div"), box, F.lit("><br><table"), attrs, F.lit(">"), caption,
        F.lit("<tr><th>公告时间</th><th>公告标题</th><th>状态</th><th>级别</th></tr>"), gap, F.col("rows_html"),
        F.lit("</table>"), after, F.lit("</div>"), paging, F.lit("</body></html>"),
    )
    return _paged_html(rows, "o_orderkey", "h").select(
        "pid", stock_of(p).alias("stock_code"), (p % 5 + 1).cast("int").alias("page"), html.alias("html")
    )


ORDER_ROWS_SQL = f"""
keyed AS (
  SELECT o_orderkey AS k, o_orderkey // {PER_PAGE} AS pid, CAST(o_orderkey % {PER_PAGE} + 1 AS INTEGER) AS r,
         strftime(o_orderdate, '%Y-%m-%d') AS d, o_orderstatus AS s, o_orderpriority AS p,
         (o_orderkey // {PER_PAGE}) % 7 = 6 AND o_orderkey % 5 = 4 AS bare
  FROM orders),
lines AS (
  SELECT *, CASE (pid // 5) % 3 WHEN 0 THEN '6' WHEN 1 THEN '0' ELSE '3' END || printf('%05d', pid // 5) AS stock_code,
         CAST(pid % 5 + 1 AS INTEGER) AS page,
         CASE WHEN k % 3 = 0 THEN d ELSE '' END AS dated,
         CASE WHEN bare THEN '说明' || k WHEN k % 4 = 0 THEN '订单' || k || '公告 ' || d WHEN k % 4 = 1 THEN '公告' || k
              WHEN k % 4 = 2 THEN '通知&' || k ELSE '订单' || k || '附件' || k END AS label,
         CASE WHEN bare THEN NULL WHEN k % 4 = 0 THEN '/disc/' || k || '.pdf' WHEN k % 4 = 1 THEN '//static.host/' || k || '.pdf'
              WHEN k % 4 = 2 THEN './d/' || k ELSE 'http://x.cn/' || k END AS href
  FROM keyed),
sited AS (
  SELECT *,
         CASE WHEN href IS NULL THEN '' WHEN k % 4 = 0 THEN 'https://www.sse.com.cn' || href
              WHEN k % 4 = 1 THEN 'https:' || href ELSE href END AS url_aligned,
         CASE WHEN href IS NULL THEN NULL WHEN k % 4 IN (0, 1) THEN 'http://www.szse.cn' || href
              WHEN k % 4 = 2 THEN 'http://www.szse.cn/d/' || k ELSE href END AS url_inline
  FROM lines),
pids AS (
  SELECT pid, any_value(stock_code) AS stock_code, any_value(page) AS page, pid % 9 AS c, count(*) AS n
  FROM lines GROUP BY pid)
"""

PAGE_TITLE_SQL = """
CASE c WHEN 0 THEN '公司公告' || pid WHEN 1 THEN '公告列表' || pid WHEN 2 THEN '表 ' || pid WHEN 3 THEN '后置标题' || pid
       WHEN 4 THEN 'title-box' WHEN 5 THEN 'list-title' END
"""
