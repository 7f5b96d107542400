"""Discussion boards and feeds: shaping, recency, paging and run statistics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import markup as M
from ledgerlark.functions.text import profile_url, resolve_url
from ledgerlark.functions.times import cutoff, epoch_ms, format_time, moment, parse_board_time
from ledgerlark.plans.emit import each
from ledgerlark.schemas import BOARD_POSTS, FEED_DISCUSSIONS, FEED_NEWS

# Defaults of missing fields and the constants of each source.
UNKNOWN_AUTHOR = "未知作者"
UNKNOWN_TIME = "未知时间"
BOARD_SOURCE = "东方财富"
FEED_SOURCE = "雪球"
BOARD_HOST = "http://guba.eastmoney.com"
FEED_HOST = "https://xueqiu.com"
BOARD_PAGE_URL = BOARD_HOST + "/list,%s_%d.html"
STALE_SHARE = 0.8
RECENT_DAYS = 7


# --- extraction -----------------------------------------------------------------------------


def extract_board_items(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per ``tr.listitem`` of the first ``tbody.listbody``; missing elements are null.

    Keeps the page's other columns and adds ``pos`` (1-based), title, href,
    author, time, read_count and reply_count.
    """
    rows = M.row_array(M.applied(M.visible(F.col(html)), "bb", M.element_sql("bb", "listbody", "tbody")))
    listed = f"x -> array_contains({M.class_list_sql(M.open_tag_sql('x'))}, 'listitem')"
    items = F.call_function("filter", rows, F.expr(listed))
    keep = [c for c in pages.columns if c != html]
    row = each(pages, keep, items, "_at", "_row")
    row = row.select(*keep, (F.col("_at") + 1).alias("pos"), M.all_matches(F.col("_row"), M.CELL).alias("_c"))

    def classed(cell: Column, name: str) -> Column:
        return M.applied(cell, "bc", M.element_sql("bc", name))

    c = F.col("_c")
    title = F.get(M.link_array(classed(F.get(c, 2), "title")), 0)
    row = row.withColumn("_title", title)
    return row.select(
        *keep,
        "pos",
        F.col("_title.text").alias("title"),
        F.when(F.col("_title").isNotNull(), F.coalesce(F.col("_title.href"), F.lit(""))).alias("href"),
        F.get(M.link_array(classed(F.get(c, 3), "author")), 0)["text"].alias("author"),
        M.node_text(classed(F.get(c, 4), "update")).alias("time"),
        M.node_text(classed(F.get(c, 0), "read")).alias("read_count"),
        M.node_text(classed(F.get(c, 1), "reply")).alias("reply_count"),
    )


# --- defaults, requirements, tags -----------------------------------------------------------


# Defaults by column.
BOARD_DEFAULTS = {"author": UNKNOWN_AUTHOR, "time": UNKNOWN_TIME, "read_count": "0", "reply_count": "0"}
FEED_DEFAULTS = {
    "title": "", "text": "", "author": UNKNOWN_AUTHOR, "author_id": "", "source": FEED_SOURCE,
    "retweet_count": 0, "reply_count": 0, "fav_count": 0,
}


def fill_present(df: DataFrame, defaults: dict) -> DataFrame:
    """Defaults for those of the columns the table has."""
    return df.fillna({c: v for c, v in defaults.items() if c in df.columns})


def fill_board_defaults(df: DataFrame) -> DataFrame:
    return fill_present(df, BOARD_DEFAULTS)


def fill_feed_defaults(df: DataFrame) -> DataFrame:
    """Missing and null JSON keys get the same default."""
    return fill_present(df, FEED_DEFAULTS)


def require_title(df: DataFrame) -> DataFrame:
    return df.filter(F.col("title").isNotNull())


def of_kind(df: DataFrame, kind: str = "all", col: str = "source_kind") -> DataFrame:
    """``all``, or one source kind as a filter that reaches the scan."""
    return df if kind == "all" else df.filter(F.col(col) == kind)


def tag_columns(df: DataFrame, as_of: datetime | str, source: str) -> DataFrame:
    return df.withColumns(
        {"source": F.lit(source), "crawl_time": F.date_format(moment(as_of), "yyyy-MM-dd HH:mm:ss")}
    )


def split_bad(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Adds ``_error``: the first failed check's name, null for good rows.

    Checks are non-throwing conditions; a condition that is null has failed.
    Callers filter on ``_error`` for the good and the quarantined output.
    """
    error = F.lit(None).cast("string")
    for name, good in reversed(checks.items()):
        error = F.when(~F.coalesce(good, F.lit(False)), name).otherwise(error)
    return df.withColumn("_error", error)


# --- recency --------------------------------------------------------------------------------


def is_stale(parsed: Column, as_of: datetime | str, days: int = RECENT_DAYS) -> Column:
    """Strictly older than the limit; a null time is not stale."""
    return F.coalesce(parsed < cutoff(as_of, days), F.lit(False))


def recent(
    df: DataFrame, as_of: datetime | str, days: int = RECENT_DAYS, *, keep_null: bool, col: str = "parsed_time"
) -> DataFrame:
    """Rows not older than ``days``; boards drop unparsed times, feeds keep them."""
    fresh = F.col(col) >= cutoff(as_of, days)
    return df.filter(fresh | F.col(col).isNull() if keep_null else fresh)


# --- paging ---------------------------------------------------------------------------------


def request_grid(codes: DataFrame, max_pages: int, template: str = BOARD_PAGE_URL) -> DataFrame:
    """One row per stock and page with its URL; a generator, not a join."""
    grid = codes.select("stock_code", F.explode(F.sequence(F.lit(1), F.lit(max_pages))).alias("page"))
    return grid.withColumn("url", F.format_string(template, "stock_code", "page"))


def page_stats(
    items: DataFrame, as_of: datetime | str, days: int = RECENT_DAYS, *, keep_null: bool = False
) -> DataFrame:
    """Per stock and page: all items, stale, kept, and the stale share of all items."""
    usable = F.col("title").isNotNull() if "title" in items.columns else F.lit(True)
    stale = usable & is_stale(F.col("parsed_time"), as_of, days)
    fresh = F.col("parsed_time") >= cutoff(as_of, days)
    if keep_null:
        fresh = fresh | F.col("parsed_time").isNull()
    return (
        items.groupBy("stock_code", "page")
        .agg(
            F.count("*").alias("items"),
            F.count_if(stale).alias("stale"),
            F.count_if(usable & fresh).alias("kept"),
        )
        .withColumn("stale_share", F.col("stale") / F.col("items"))
    )


def stop_pages(
    stats: DataFrame,
    max_pages: int | None = None,
    threshold: float = STALE_SHARE,
    failed: DataFrame | None = None,
) -> DataFrame:
    """Last page that is read, per stock.

    Reading stops after a page whose stale share is above the threshold, at the
    first empty page after page 1, and before a failed page.  Works on page
    counts only, by aggregation: no window over a stock, however many pages,
    and one pass over the counts.
    An empty page is one without a row in ``stats``.
    """
    number = stats.schema["page"].dataType
    first = F.lit(1).cast(number)
    stale = F.col("stale") > F.col("items") * F.lit(threshold)
    # Each page tells of itself and asks for the next; page 1 counts as reached.
    told = F.array(
        F.struct(F.col("page"), F.lit(True).alias("seen"), stale.alias("stale")),
        F.struct((F.col("page") + 1).cast(number).alias("page"), F.lit(False).alias("seen"), F.lit(False).alias("stale")),
        F.struct((first + 1).cast(number).alias("page"), F.lit(False).alias("seen"), F.lit(False).alias("stale")),
    )
    pages = stats.select("stock_code", F.inline(told)).groupBy("stock_code", "page")
    ends = pages.agg(F.bool_or("seen").alias("seen"), F.bool_or("stale").alias("stale")).filter("stale OR NOT seen")
    stops = ends.select("stock_code", "page")
    if failed is not None:
        stops = stops.unionByName(failed.select("stock_code", (F.col("page") - 1).cast(number).alias("page")))
    out = stops.groupBy("stock_code").agg(F.min("page").alias("stop_page"))
    if max_pages is not None:
        out = out.withColumn("stop_page", F.least("stop_page", F.lit(max_pages)))
    return out


def early_stop(
    items: DataFrame,
    stats: DataFrame,
    max_pages: int | None = None,
    threshold: float = STALE_SHARE,
    failed: DataFrame | None = None,
) -> DataFrame:
    """Items of the pages that are read.  Fresh rows of the stopping page stay."""
    stops = stop_pages(stats, max_pages, threshold, failed)
    return items.join(stops, "stock_code").filter(F.col("page") <= F.col("stop_page")).drop("stop_page")


def crawl_stats(stats: DataFrame, stops: DataFrame) -> DataFrame:
    """Per stock over the pages read: kept rows, non-empty pages, stale rows."""
    return (
        stats.join(stops, "stock_code")
        .filter(F.col("page") <= F.col("stop_page"))
        .groupBy("stock_code")
        .agg(
            F.sum("kept").alias("kept_rows"),
            F.count("page").alias("pages_read"),
            F.sum("stale").alias("stale_rows"),
        )
    )


def time_range(df: DataFrame, *keys: str, col: str = "parsed_time") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(col).alias("earliest"), F.max(col).alias("latest"))


def head_n(df: DataFrame, *order: str | Column, n: int = 5) -> DataFrame:
    """First ``n`` rows in row order; each task keeps only ``n`` rows."""
    return df.orderBy(*order).limit(n)


# --- canonical outputs ----------------------------------------------------------------------


def board_posts(
    items: DataFrame, as_of: datetime | str, days: int = RECENT_DAYS, max_pages: int | None = None
) -> DataFrame:
    """Board items to the canonical post table: parse, stop, filter, tag."""
    parsed = fill_board_defaults(items).withColumn("parsed_time", parse_board_time(F.col("time"), as_of))
    kept = early_stop(parsed, page_stats(parsed, as_of, days), max_pages)
    fresh = recent(require_title(kept), as_of, days, keep_null=False)
    out = tag_columns(fresh, as_of, BOARD_SOURCE).withColumns(
        {
            "parsed_time": F.date_format("parsed_time", "yyyy-MM-dd HH:mm:ss"),
            "url": resolve_url(F.col("href"), BOARD_HOST, "board"),
            "page": F.col("page").cast("int"),
        }
    )
    return out.select(*BOARD_POSTS.fieldNames())


def feed_posts(flat: DataFrame, as_of: datetime | str, days: int, max_pages: int | None, failed: DataFrame | None) -> DataFrame:
    parsed = fill_feed_defaults(flat).withColumn("parsed_time", epoch_ms(F.col("created_at")))
    stats = page_stats(parsed, as_of, days, keep_null=True)
    kept = recent(early_stop(parsed, stats, max_pages, failed=failed), as_of, days, keep_null=True)
    return kept.withColumns(
        {
            "content": F.col("text"),
            "time": format_time(F.col("parsed_time"), UNKNOWN_TIME),
            "parsed_time": format_time(F.col("parsed_time"), ""),
            "crawl_time": F.date_format(moment(as_of), "yyyy-MM-dd HH:mm:ss"),
            "page": F.col("page").cast("int"),
        }
    )


def feed_discussions(
    flat: DataFrame,
    as_of: datetime | str,
    days: int = RECENT_DAYS,
    max_pages: int | None = None,
    failed: DataFrame | None = None,
) -> DataFrame:
    posts = feed_posts(flat, as_of, days, max_pages, failed)
    url = profile_url(F.col("id"), F.col("profile_image_url"), FEED_HOST)
    return posts.withColumn("url", url).select(*FEED_DISCUSSIONS.fieldNames())


def feed_news(
    flat: DataFrame,
    as_of: datetime | str,
    days: int = RECENT_DAYS,
    max_pages: int | None = None,
    failed: DataFrame | None = None,
) -> DataFrame:
    posts = feed_posts(flat, as_of, days, max_pages, failed)
    return posts.withColumn("url", F.coalesce("url", F.lit(""))).select(*FEED_NEWS.fieldNames())
