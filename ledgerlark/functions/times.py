"""Time functions.  ``as_of`` stands for "now" and is always a parameter."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"


def moment(as_of: datetime | str | Column) -> Column:
    """Literal or column as a timestamp without zone."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def _stamp(year: Column, month: Column, day: Column, hour: Column, minute: Column) -> Column:
    parts = [p.try_cast("int") for p in (year, month, day, hour, minute)]
    return F.try_make_timestamp_ntz(*parts, F.lit(0).cast("decimal(16,6)"))


def parse_board_time(col: Column, as_of: datetime | str | Column) -> Column:
    """``M-D`` or ``M-D H:M`` in the year of ``as_of``, or the year before.

    A date that does not exist in the current year is null even if it existed
    in the year before.
    """
    now = moment(as_of)
    shape = r"^(\d+)-(\d+)(?: (\d+):(\d+))?$"
    month, day, hour, minute = (F.regexp_extract(col, shape, g) for g in (1, 2, 3, 4))
    hour = F.when(hour == "", "0").otherwise(hour)
    minute = F.when(minute == "", "0").otherwise(minute)
    this_year = _stamp(F.year(now), month, day, hour, minute)
    last_year = _stamp(F.year(now) - 1, month, day, hour, minute)
    return F.when(this_year > now, last_year).otherwise(this_year)


def parse_relative_time(col: Column, as_of: datetime | str | Column) -> Column:
    """``n分钟前`` / ``n小时前`` / ``n天前`` / ``昨天 H:M`` / ``前天 H:M`` / ISO date."""
    now = moment(as_of)

    def ago(suffix: str, unit: str, per_day: int) -> Column:
        n = F.replace(col, F.lit(suffix), F.lit("")).try_cast("int")
        # Beyond some two thousand years back there is no such date.
        n = F.when(n.between(-730_000 * per_day, 730_000 * per_day), n)
        return now - F.make_dt_interval(**{unit: n})

    def clock(prefix: str, days_back: int) -> Column:
        rest = F.replace(col, F.lit(prefix + " "), F.lit(""))
        hour = F.regexp_extract(rest, r"^(\d+):(\d+)$", 1)
        minute = F.regexp_extract(rest, r"^(\d+):(\d+)$", 2)
        day = now - F.make_dt_interval(days=F.lit(days_back))
        return _stamp(F.year(day), F.month(day), F.day(day), hour, minute)

    iso = r"^(\d{4})-(\d{2})-(\d{2})(?: (\d+):(\d+))?$"
    y, m, d, hh, mm = (F.regexp_extract(col, iso, g) for g in range(1, 6))
    hh = F.when(hh == "", "0").otherwise(hh)
    mm = F.when(mm == "", "0").otherwise(mm)
    return (
        F.when(col.contains("分钟前"), ago("分钟前", "mins", 1440))
        .when(col.contains("小时前"), ago("小时前", "hours", 24))
        .when(col.contains("天前"), ago("天前", "days", 1))
        .when(col.contains("昨天"), clock("昨天", 1))
        .when(col.contains("前天"), clock("前天", 2))
        .when(col.rlike(iso), _stamp(y, m, d, hh, mm))
    )


def epoch_ms(col: Column) -> Column:
    """Epoch milliseconds to a session-zone timestamp; 0 and missing are null."""
    return F.timestamp_millis(F.nullif(col, F.lit(0).cast("bigint"))).cast("timestamp_ntz")


def format_time(col: Column, missing: str = "") -> Column:
    return F.coalesce(F.date_format(col, SECOND_FORMAT), F.lit(missing))


def cutoff(as_of: datetime | str | Column, days: int) -> Column:
    return moment(as_of) - F.make_dt_interval(days=F.lit(days))
