"""Income, balance and cash-flow statements."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.text import is_hk, market_symbol

# Core columns and items, statement names.
CORE_INCOME_A = (
    "REPORT_DATE", "REPORT_TYPE", "OPERATE_INCOME", "OPERATE_COST", "OPERATE_PROFIT",
    "TOTAL_PROFIT", "NETPROFIT", "PARENT_NETPROFIT", "BASIC_EPS", "TOTAL_COMPRE_INCOME",
)
CORE_ITEMS_HK = (
    "营业额", "营运收入", "销售成本", "毛利", "营业利润", "利润总额", "年内溢利", "每股盈利", "综合收益总额",
)
STATEMENTS = ("利润表", "资产负债表", "现金流量表")


def select_or_null(
    df: DataFrame, cols: Sequence[str] = CORE_INCOME_A, types: Mapping[str, T.DataType | str] | None = None
) -> DataFrame:
    """Named columns in order; absent ones as typed nulls (report date and type are strings), others dropped."""
    types = {"REPORT_DATE": "string", "REPORT_TYPE": "string"} | dict(types or {})
    return df.select(
        *[
            F.col(c) if c in df.columns else F.lit(None).cast(types.get(c, "double")).alias(c)
            for c in cols
        ]
    )


def rename_with(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; unmapped columns stay.  A projection at most."""
    return df.withColumnsRenamed(dict(mapping))


def in_list(df: DataFrame, col: str, values: Sequence[str] = CORE_ITEMS_HK) -> DataFrame:
    return df.filter(F.col(col).isin(*values))


def pivot_first(
    df: DataFrame,
    keys: Sequence[str],
    col: str,
    val: str,
    order: str | Column,
    values: Sequence[str] | None = None,
) -> DataFrame:
    """Long to wide with the first non-null value in row order.

    Null keys and null values go first, so all-null rows vanish.  With
    ``values`` the schema is fixed and no extra job runs; without, the columns
    are the names that have a value at all.  ``min_by`` combines map-side.
    """
    known = df.filter(F.col(val).isNotNull() & F.col(col).isNotNull())
    for k in keys:
        known = known.filter(F.col(k).isNotNull())
    grouped = known.groupBy(*keys).pivot(col, list(values)) if values else known.groupBy(*keys).pivot(col)
    wide = grouped.agg(F.min_by(val, order))
    if values:
        # Rows whose item lies outside the list must not leave an empty key row.
        wide = wide.filter(F.coalesce(*[F.col(f"`{v}`") for v in values]).isNotNull())
    return wide


def core_hk(df: DataFrame, order: str | Column, values: Sequence[str] = CORE_ITEMS_HK) -> DataFrame:
    """Core items wide; keyed by DATE_TYPE_CODE too where the column exists."""
    keys = ["FISCAL_YEAR"] + (["DATE_TYPE_CODE"] if "DATE_TYPE_CODE" in df.columns else [])
    return pivot_first(in_list(df, "STD_ITEM_NAME", values), keys, "STD_ITEM_NAME", "AMOUNT", order, values)


def statement_grid(codes: DataFrame, market: str | None = None) -> DataFrame:
    """Stocks by the three statements, with market and vendor symbol; a generator."""
    names = F.array(*[F.lit(s) for s in STATEMENTS])
    code = F.col("code")
    return codes.select(
        "code",
        F.explode(names).alias("statement"),
        F.when(is_hk(code, market), "hk").otherwise("cn").alias("market"),
        market_symbol(code, market).alias("symbol"),
    )


def label_items(long: DataFrame, field_map: DataFrame, item: str, key: str = "hk_item") -> DataFrame:
    """Adds zh and en labels; an item with two labels gives two rows.

    The label dimension has 33 rows by construction, so it is broadcast.
    """
    dim = field_map.filter(F.col(key).isNotNull()).select(F.col(key).alias(item), "statement", "ord", "zh", "en")
    return long.join(F.broadcast(dim), item, "left")


def nonempty(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows of those groups that hold at least one non-null value."""
    has_value = F.coalesce(*[F.col(v).cast("string") for v in values]).isNotNull()
    live = df.filter(has_value).select(*keys).distinct()
    return df.join(live, list(keys), "left_semi")


def statement_shape(df: DataFrame, n_columns: int) -> DataFrame:
    return df.groupBy("statement").agg(F.count("*").alias("rows")).withColumn("columns", F.lit(n_columns))
