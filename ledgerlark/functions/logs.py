"""Log-line formatting and parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity by level name.
LEVEL_RANK = {"DEBUG": 10, "INFO": 20, "WARNING": 30, "ERROR": 40, "CRITICAL": 50}

# Line layout by sink.
INFO_LINE = "%s - %s - %s"
ERROR_LINE = "%s - %s:%d - %s - %s"
DEBUG_LINE = "%s - %s:%d - %s - %s - %s"


def level_rank(level: Column) -> Column:
    chain = F.lit(None).cast("int")
    for name, rank in reversed(LEVEL_RANK.items()):
        chain = F.when(level == name, rank).otherwise(chain)
    return chain


def log_line(
    level: Column,
    message: Column,
    ts: Column,
    file: Column | None = None,
    line: Column | None = None,
    func: Column | None = None,
    clock: str = "yyyy-MM-dd HH:mm:ss",
) -> Column:
    """Info layout; with ``file`` and ``line`` the error layout; with ``func`` too the debug layout."""
    when = F.date_format(ts, clock)
    if file is None:
        return F.format_string(INFO_LINE, level, message, when)
    if func is None:
        return F.format_string(ERROR_LINE, level, file, line, message, when)
    return F.format_string(DEBUG_LINE, level, file, line, func, message, when)


def parse_info_line(col: Column) -> dict[str, Column]:
    """Inverse of the info layout; the message may itself hold `` - ``."""
    shape = r"(?s)^([A-Z]+) - (.*) - (\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})$"
    return {
        "level": F.regexp_extract(col, shape, 1),
        "message": F.regexp_extract(col, shape, 2),
        "ts": F.nullif(F.regexp_extract(col, shape, 3), F.lit("")).try_cast("timestamp_ntz"),
    }


def request_line(url: Column, status: Column, seconds: Column) -> Column:
    """One request as a message; a missing or zero duration is left out."""
    head = F.format_string("请求: %s | 状态: %d", url, status)
    return F.when(
        F.coalesce(seconds, F.lit(0.0)) != 0,
        F.concat(head, F.format_string(" | 耗时: %.2fs", seconds)),
    ).otherwise(head)


def parse_request_line(col: Column) -> dict[str, Column]:
    shape = r"^请求: (.*) \| 状态: (\d+)(?: \| 耗时: ([0-9.]+)s)?$"
    return {
        "url": F.regexp_extract(col, shape, 1),
        "status": F.regexp_extract(col, shape, 2).try_cast("int"),
        "seconds": F.regexp_extract(col, shape, 3).try_cast("double"),
    }


def result_line(stock_code: Column, kept: Column, pages: Column) -> Column:
    return F.format_string("股票 %s 爬取完成 | 页数: %d | 新闻数: %d", stock_code, pages, kept)
