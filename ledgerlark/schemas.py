"""Schemas of the landed inputs and of the canonical outputs."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names.split()]


FEED_USER = T.StructType(_strings("screen_name id profile_image_url"))

FEED_POST = T.StructType(
    [
        *_strings("id title text source url"),
        T.StructField("created_at", T.LongType()),
        T.StructField("retweet_count", T.IntegerType()),
        T.StructField("reply_count", T.IntegerType()),
        T.StructField("fav_count", T.IntegerType()),
        T.StructField("user", FEED_USER),
    ]
)

FEED_PAGE = T.StructType([T.StructField("list", T.ArrayType(FEED_POST))])

LINK = T.StructType(_strings("href text"))

BOARD_POSTS = T.StructType(
    [
        *_strings("stock_code title author time parsed_time read_count reply_count url source"),
        T.StructField("page", T.IntegerType()),
        *_strings("crawl_time"),
    ]
)

FEED_DISCUSSIONS = T.StructType(
    [
        *_strings("stock_code title content author author_id time parsed_time"),
        T.StructField("retweet_count", T.IntegerType()),
        T.StructField("reply_count", T.IntegerType()),
        T.StructField("fav_count", T.IntegerType()),
        *_strings("source url"),
        T.StructField("page", T.IntegerType()),
        *_strings("crawl_time"),
    ]
)

FEED_NEWS = T.StructType(
    [
        *_strings("stock_code title content time parsed_time source url"),
        T.StructField("page", T.IntegerType()),
        *_strings("crawl_time"),
    ]
)

ANNOUNCEMENTS = T.StructType(_strings("date title url source extraction_method"))

TABLE_SUMMARY = T.StructType(
    [
        T.StructField("index", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("rows", T.IntegerType()),
        T.StructField("columns", T.IntegerType()),
        T.StructField("filename", T.StringType()),
    ]
)

STATEMENT_LONG_HK = T.StructType(
    [
        *_strings("FISCAL_YEAR DATE_TYPE_CODE STD_ITEM_NAME"),
        T.StructField("AMOUNT", T.DoubleType()),
    ]
)

FIELD_MAP = T.StructType(
    [
        T.StructField("statement", T.StringType(), False),
        T.StructField("ord", T.IntegerType(), False),
        *_strings("a_field hk_item zh en"),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("ts", T.TimestampNTZType()),
        *_strings("level logger message"),
    ]
)
