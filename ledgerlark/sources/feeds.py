"""Feed pages: JSON text with a ``list`` of posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.plans.emit import each
from ledgerlark.schemas import FEED_PAGE


def parse_feed(pages: DataFrame, json_col: str = "json") -> DataFrame:
    """Adds ``_page`` (the parsed page) and ``_ok`` (false for malformed JSON)."""
    parsed = F.from_json(F.col(json_col), FEED_PAGE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    # A JSON object is a readable page even without the key; anything else is not.
    return pages.withColumn("_page", parsed).withColumn(
        "_ok", F.coalesce(F.try_parse_json(json_col).isNotNull() & F.col(json_col).rlike(r"^\s*\{"), F.lit(False))
    )


def failed_pages(pages: DataFrame, json_col: str = "json") -> DataFrame:
    """Pages whose JSON is malformed: reading of that stock stops before them."""
    return parse_feed(pages, json_col).filter(~F.col("_ok")).select("stock_code", "page")


def flatten_feed(pages: DataFrame, json_col: str = "json") -> DataFrame:
    """One row per element of ``list``; no ``list`` means no row."""
    keep = [c for c in pages.columns if c != json_col]
    posts = each(parse_feed(pages, json_col).filter("_ok"), keep, "_page.list", "_at", "p")
    return posts.select(
        *keep,
        (F.col("_at") + 1).alias("pos"),
        "p.id", "p.title", "p.text", "p.source", "p.url", "p.created_at",
        "p.retweet_count", "p.reply_count", "p.fav_count",
        F.col("p.user.screen_name").alias("author"),
        F.col("p.user.id").alias("author_id"),
        "p.user.profile_image_url",
    )
