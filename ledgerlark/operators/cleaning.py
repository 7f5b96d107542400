"""Forward fill, keep-first de-duplication, ordinals, header repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions.text import blank_to_null
from ledgerlark.plans import chunked
from ledgerlark.plans.ranged import ranks_by_range

# How a date column is recognised.
DATE_WORDS = ("时间", "日期")
DATE_COLUMN = "公告时间"
NOTICE_WORD = "公告"


def ffill(
    df: DataFrame,
    col: str,
    keys: Sequence[str],
    order: str,
    chunk: Column,
    blank: str = "trim",
    leading: str | None = None,
) -> DataFrame:
    """Forward fill in row order.

    ``blank='empty'`` treats only ``''`` as a gap, ``'trim'`` also white space.
    Gaps before the first value become ``leading``: null by default, ``'keep'``
    leaves them as they were.
    """
    value = blank_to_null(F.col(col)) if blank == "trim" else F.nullif(F.col(col), F.lit(""))
    # Filled from the untrimmed original, so a value keeps its own white space.
    known = F.when(value.isNotNull(), F.col(col))
    out = chunked.last_known(df, keys, [F.col(order)], chunk, known, "_filled")
    filled = F.coalesce("_filled", F.col(col)) if leading == "keep" else F.col("_filled")
    return out.withColumn(col, filled).drop("_filled")


def ffill_rows(data: Column, date_col: Column, before: Column | None = None, blank: str = "trim") -> Column:
    """Forward fill of one column inside a table's row array.

    Gaps are blank cells (``blank='empty'``: only ``''``, else also white space).  Each known
    cell is repeated up to the next one, so the work is linear in the rows.  Gaps ahead
    of the first known cell take ``before``, the last value of what precedes the table;
    without one they stay as they are.
    """
    known_only = blank_to_null if blank == "trim" else (lambda c: F.nullif(c, F.lit("")))
    start = F.struct(F.lit(0).alias("i"), (F.lit(None) if before is None else before).cast("string").alias("c"))

    def bound(value: Column, body) -> Column:
        return F.get(F.transform(F.array(value), body), 0)

    def filled(at: Column) -> Column:
        placed = F.transform(data, lambda row, i: F.struct(i.alias("i"), F.get(row, at).alias("c")))
        known = F.filter(placed, lambda x: known_only(x["c"]).isNotNull())
        return bound(F.concat(F.array(start), known), lambda ks: bound(values(ks), lambda vs: rows(vs, at)))

    def values(known: Column) -> Column:
        upto = lambda k: F.coalesce(F.get(known, k + 1)["i"], F.size(data))
        return F.flatten(F.transform(known, lambda x, k: F.array_repeat(x["c"], upto(k) - x["i"])))

    def rows(values_: Column, at: Column) -> Column:
        cell = lambda c, i, k: F.when(k == at, F.coalesce(F.get(values_, i), c)).otherwise(c)
        return F.transform(data, lambda row, i: F.transform(row, lambda c, k: cell(c, i, k)))

    return bound(date_col, filled)


def last_filled(data: Column, date_col: Column) -> Column:
    """The last cell of a column that is not blank, null without one: what a table hands on to the next."""
    known = F.filter(F.transform(data, lambda row: F.get(row, date_col)), lambda c: blank_to_null(c).isNotNull())
    return F.get(F.reverse(known), 0)


def date_column(header: Column) -> Column:
    """0-based position of the first header that names a date; 0 without one."""
    named = F.transform(
        header, lambda h, i: F.when(h.contains(DATE_WORDS[0]) | h.contains(DATE_WORDS[1]), i)
    )
    return F.coalesce(F.get(F.array_compact(named), 0), F.lit(0))


def wants_date_fill(title: Column, header: Column, body: Column) -> Column:
    """Title speaks of announcements, or the date label occurs in the first data row or its names."""
    first = F.get(body, 0)
    label = lambda c: c.contains(DATE_COLUMN)
    seen = F.coalesce(F.exists(first, label), F.lit(False)) | (
        first.isNotNull() & F.coalesce(F.exists(header, label), F.lit(False))
    )
    return title.contains(NOTICE_WORD) | seen


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in the given order.

    An aggregation, not a window: copies are dropped map-side, so a key that
    fills a third of the table sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    first = F.min_by(F.struct(*rest), F.struct(*cols))
    out = df.groupBy(*keys).agg(first.alias("_first"))
    return out.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def ordinals(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], chunk: Column | None = None, name: str = "pos"
) -> DataFrame:
    """1-based position in the group.

    ``chunk`` cuts groups where a dense unique number orders them; without it the
    groups are cut by ranges of the order itself, whatever its values are.
    """
    if chunk is None:
        return ranks_by_range(df, keys, order, name)
    return chunked.rank_within(df, keys, order, chunk, name)


def repair_header(df: DataFrame, order_col: str, header_row: int = 1) -> DataFrame:
    """Row ``header_row`` (0-based by ``order_col``) names the columns; it and earlier rows go.

    Only that one row comes to the driver.  Repeated names get a numeric suffix;
    ``order_col`` is renumbered from 0.
    """
    data_cols = [c for c in df.columns if c != order_col]
    head = df.filter(F.col(order_col) == header_row).select(*data_cols).first()
    if head is None:
        return df.limit(0)
    names: list[str] = []
    for i, value in enumerate(head):
        name = str(value) if value is not None else f"_c{i}"
        copies = sum(1 for n in names if n == name or n.startswith(name + "."))
        names.append(f"{name}.{copies}" if copies else name)
    body = df.filter(F.col(order_col) > header_row)
    return body.select(
        (F.col(order_col) - F.lit(header_row + 1)).alias(order_col),
        *[F.col(c).alias(n) for c, n in zip(data_cols, names, strict=True)],
    )
