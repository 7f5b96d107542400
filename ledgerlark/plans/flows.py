"""End-to-end flows composed from the operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.text import venue
from ledgerlark.operators import cleaning, posts, tables
from ledgerlark.session import landed
from ledgerlark.sources import files


def board_feed(pages: DataFrame, as_of: datetime | str, days: int = 7, max_pages: int | None = None) -> DataFrame:
    """Board pages (stock_code, page, html) to canonical posts.

    The stop rule and the posts both need the items, so the items land first
    and the markup is read once.
    """
    items = landed(posts.extract_board_items(pages), "board_items")
    return posts.board_posts(items, as_of, days, max_pages)


def disclosure_rows(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """Disclosure pages (stock_code, page, html) to the merged announcement rows of each stock.

    First table after the skipped ones, header once, pages in order.  The tables
    land before merging: row counts and rows are two reads of them.
    """
    read = pages if max_pages is None else tables.cap_pages(pages, max_pages)
    first = tables.extract_tables(read, "inline", max_tables=1, titles=False)
    return tables.merge_pages(landed(first, "first_tables"))


def disclosure_merged(
    pages: DataFrame, path: str, max_pages: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(lines, results): the merged table of each stock with filled dates, written below ``path``, and what came of it.

    ``lines`` reads the written files back: (stock_code, line).  A stock whose pages
    hold no table has no file and a failed result.
    """
    read = pages if max_pages is None else tables.cap_pages(pages, max_pages)
    found = landed(tables.extract_tables(read, "inline", max_tables=1, titles=False), "first_tables")
    files.write_lines(tables.merged_lines(tables.merged_pages(found)), path)
    requested = read.groupBy("stock_code").agg(F.count("*").alias("total_pages"))
    skipped = F.when(F.col("page") == 1, 0).otherwise(1)
    counts = found.select("stock_code", (F.size("data") - skipped).alias("n_rows"))
    return files.read_lines(pages.sparkSession, path), tables.multi_page_results(requested, counts)


def disclosure_tables(pages: DataFrame, mode: str) -> DataFrame:
    """Tables as they are saved: titled, header promoted, dates filled in announcement tables."""
    found = tables.promote_header(tables.extract_tables(pages, mode), mode)
    if mode == "inline":
        wanted = cleaning.wants_date_fill(F.col("title"), F.col("header"), F.col("body"))
        at, blank = cleaning.date_column(F.col("header")), "trim"
    else:
        named = F.array_position("header", cleaning.DATE_COLUMN).cast("int")
        wanted = F.col("title").contains(cleaning.NOTICE_WORD) & (named > 0)
        at, blank = named - 1, "empty"
    filled = cleaning.ffill_rows(F.col("body"), at, blank=blank)
    return found.withColumn("body", F.when(wanted, filled).otherwise(F.col("body")))


def of_venue(pages: DataFrame, name: str) -> DataFrame:
    """Pages of one exchange's stocks."""
    return pages.filter(venue(F.col("stock_code")) == name)


def run_batch(codes: DataFrame, pages: DataFrame, name: str, mode: str) -> DataFrame:
    """Results of all requested stocks of one exchange; one without a landed page has failed.

    Pages become small rows first, and those are joined, so no markup is shuffled.
    """
    wanted = of_venue(codes.select("stock_code").distinct(), name)
    keys = [c for c in pages.columns if c != "html"]
    results = tables.stock_results(of_venue(pages, name), keys, mode)
    return wanted.join(results, "stock_code", "left").select(
        F.coalesce("success", F.lit(False)).alias("success"),
        *keys,
        F.coalesce("tables_count", F.lit(0)).alias("tables_count"),
        F.coalesce("saved_files", F.array().cast("array<string>")).alias("saved_files"),
        F.coalesce("base_dir", F.lit("")).alias("base_dir"),
        F.when(F.col("success").isNull(), tables.page_failed(F.col("stock_code"), mode)).otherwise(F.col("error")).alias("error"),
    )
