"""Literal edge cases of the scalar functions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlark.functions import logs, text, times


def values(spark, inputs, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


def test_board_time(spark):
    got = values(
        spark,
        ["07-06 12:32", "07-06", "12-31 08:00", "02-29", "13-01", "07-06 12:32:10", "未知时间", "07-06  12:32", ""],
        lambda c: times.parse_board_time(c, "2026-12-01 00:00:00"),
    )
    assert got == [dt.datetime(2026, 7, 6, 12, 32), dt.datetime(2026, 7, 6), dt.datetime(2025, 12, 31, 8)] + [None] * 6


def test_relative_time(spark):
    got = values(
        spark,
        ["5分钟前", "2小时前", "3天前", "昨天 14:30", "前天 14:30", "2024-12-01 10:30", "2024-12-01", "刚刚", "x分钟前", "昨天 25:00", "2024-13-01", "99999999999天前"],
        lambda c: times.parse_relative_time(c, "2024-12-01 12:00:00"),
    )
    d = dt.datetime
    assert got == [
        d(2024, 12, 1, 11, 55), d(2024, 12, 1, 10), d(2024, 11, 28, 12), d(2024, 11, 30, 14, 30), d(2024, 11, 29, 14, 30),
        d(2024, 12, 1, 10, 30), d(2024, 12, 1), None, None, None, None, None,
    ]


@pytest.mark.parametrize(
    ("rule", "inputs", "expected"),
    [
        ("aligned", ["//h/x", "/x", "x"], ["https://h/x", "H/x", "x"]),
        ("inline", ["/x", "./x", "x", "http://h", ""], ["H/x", "H/x", "H/x", "http://h", "H/"]),
        ("board", ["//h/x", "/x", "x"], ["http://h/x", "H/x", "x"]),
        ("announcement", ["//h/x", "/x", "x", "https://h"], ["H//h/x", "H/x", "H/x", "https://h"]),
    ],
)
def test_resolve_url(spark, rule, inputs, expected):
    assert values(spark, inputs, lambda c: text.resolve_url(c, "H", rule)) == expected


def test_codes(spark):
    codes = ["00020.HK", "600519", "002594", "300474", "AB"]
    assert values(spark, codes, text.market_symbol) == ["00020", "SH600519", "SZ002594", "SZ300474", "AB"]
    assert values(spark, ["00020.HK", "6005191"], text.norm_code) == ["00020", "600519"]
    assert values(spark, ["002594", "300474", "600036", "688981", "60051", "800001"], text.venue) == [
        "Shenzhen", "Shenzhen", "Shanghai", "Shanghai", None, None,
    ]


def test_dates_and_names(spark):
    assert values(spark, ["12-31 2024/01/02", "2024年01月02日", "03-04", "none"], text.extract_date) == [
        "2024/01/02", "2024年01月02日", "03-04", "",
    ]
    name = lambda i, squash: lambda c: text.safe_filename(F.lit(i), c, squash)
    assert values(spark, ["a/b:c d"], name(3, False)) == ["03_a_b_c d.csv"]
    assert values(spark, ["a/b:c d"], name(3, True)) == ["03_a_b_c_d.csv"]
    assert values(spark, ["x" * 60], name(103, False)) == ["103_" + "x" * 50 + ".csv"]
    assert values(spark, ["", "12", "t", "x" * 100, None], text.valid_title) == [False, False, True, False, False]
    assert values(spark, ["半年度报告", "年报", "三季报", "x"], text.report_kind) == ["half_year", "annual", "quarterly", None]


def test_preview(spark):
    long = "x" * 101
    assert values(spark, ["t", long, "short"], lambda c: text.preview(F.when(c == "t", "t").otherwise(""), c)) == [
        "t", "x" * 100 + "...", "short",
    ]


def test_epoch(spark):
    df = spark.createDataFrame([(0,), (None,), (1704067200123,)], "v bigint")
    got = [r[0] for r in df.select(times.epoch_ms(F.col("v"))).collect()]
    assert got == [None, None, dt.datetime(2024, 1, 1, 0, 0, 0, 123000)]


def test_log_lines_round_trip(spark):
    df = spark.createDataFrame([("ERROR", "a - b", dt.datetime(2024, 1, 2, 3, 4, 5))], "l string, m string, t timestamp_ntz")
    line = logs.log_line(F.col("l"), F.col("m"), F.col("t"))
    back = logs.parse_info_line(line)
    row = df.select(line, back["level"], back["message"], back["ts"]).first()
    assert tuple(row) == ("ERROR - a - b - 2024-01-02 03:04:05", "ERROR", "a - b", dt.datetime(2024, 1, 2, 3, 4, 5))
    parsed = logs.parse_request_line(F.lit("请求: http://h | x | 状态: 200 | 耗时: 1.25s"))
    assert tuple(df.select(parsed["url"], parsed["status"], parsed["seconds"]).first()) == ("http://h | x", 200, 1.25)
