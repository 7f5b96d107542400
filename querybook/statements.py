"""Statements derived from orders: code by customer, item by priority, order by key."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.functions.text import market_symbol, norm_code
from ledgerlark.operators import statements as S
from ledgerlark.session import fresh_path
from ledgerlark.sources import field_map as FM
from ledgerlark.sources.files import read_statements, write_csv, write_statements
from querybook.base import query, table

ITEMS = {"1-URGENT": "营业额", "2-HIGH": "销售成本", "3-MEDIUM": "毛利", "4-NOT SPECIFIED": "年内溢利", "5-LOW": "其他项目"}
_ITEM = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ITEMS.items()) + " END"
_CODE = """CASE WHEN o_custkey % 10 = 0 THEN printf('%05d.HK', o_custkey) WHEN o_custkey % 3 = 0 THEN printf('6%05d', o_custkey)
  ELSE printf('%06d', o_custkey) END"""

LONG_SQL = f"""
long AS (
  SELECT o_orderkey AS row_order, {_CODE} AS code, CAST(year(o_orderdate) AS VARCHAR) AS FISCAL_YEAR, o_orderstatus AS DATE_TYPE_CODE,
         {_ITEM} AS STD_ITEM_NAME, CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS AMOUNT,
         CASE o_orderkey % 3 WHEN 0 THEN '利润表' WHEN 1 THEN '资产负债表' ELSE '现金流量表' END AS statement
  FROM orders)
"""
WITH = f"WITH {LONG_SQL}"


def code_of(custkey):
    return (
        F.when(custkey % 10 == 0, F.format_string("%05d.HK", custkey))
        .when(custkey % 3 == 0, F.format_string("6%05d", custkey))
        .otherwise(F.format_string("%06d", custkey))
    )


def long_items(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    item = F.lit(None).cast("string")
    for name, label in ITEMS.items():
        item = F.when(F.col("o_orderpriority") == name, label).otherwise(item)
    return o.select(
        k.alias("row_order"), code_of(F.col("o_custkey")).alias("code"),
        F.year("o_orderdate").cast("string").alias("FISCAL_YEAR"), F.col("o_orderstatus").alias("DATE_TYPE_CODE"),
        item.alias("STD_ITEM_NAME"), F.when(k % 10 != 0, F.col("o_totalprice")).alias("AMOUNT"),
        F.when(k % 3 == 0, "利润表").when(k % 3 == 1, "资产负债表").otherwise("现金流量表").alias("statement"),
    )


def wide_a(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("EXTRA"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("REPORT_DATE"),
        F.col("o_orderstatus").alias("REPORT_TYPE"), F.col("o_totalprice").alias("OPERATE_INCOME"),
        (F.col("o_totalprice") / 2).alias("OPERATE_COST"), (F.col("o_custkey") * 1.5).alias("NETPROFIT"),
    )


_A_COLUMNS = """strftime(o_orderdate, '%Y-%m-%d') AS REPORT_DATE, o_orderstatus AS REPORT_TYPE, o_totalprice AS OPERATE_INCOME,
  o_totalprice / 2 AS OPERATE_COST, CAST(NULL AS DOUBLE) AS OPERATE_PROFIT, CAST(NULL AS DOUBLE) AS TOTAL_PROFIT,
  o_custkey * CAST(1.5 AS DOUBLE) AS NETPROFIT, CAST(NULL AS DOUBLE) AS PARENT_NETPROFIT, CAST(NULL AS DOUBLE) AS BASIC_EPS,
  CAST(NULL AS DOUBLE) AS TOTAL_COMPRE_INCOME"""


@query("core_income_a", f"SELECT {_A_COLUMNS} FROM orders")
def _core_a(spark, sf):
    return S.select_or_null(wide_a(spark, sf))


@query("rename_labels", """
SELECT o_orderkey AS EXTRA, strftime(o_orderdate, '%Y-%m-%d') AS REPORT_DATE, o_orderstatus AS REPORT_TYPE,
  o_totalprice AS "营业收入", o_totalprice / 2 AS "营业成本", o_custkey * CAST(1.5 AS DOUBLE) AS "净利润" FROM orders""")
def _rename(spark, sf):
    return S.rename_with(wide_a(spark, sf), FM.zh_labels("利润表"))


@query("in_list", WITH + "SELECT row_order, STD_ITEM_NAME FROM long WHERE STD_ITEM_NAME <> '其他项目'")
def _in_list(spark, sf):
    return S.in_list(long_items(spark, sf), "STD_ITEM_NAME").select("row_order", "STD_ITEM_NAME")


def _pivot_sql(keys: str) -> str:
    picked = ", ".join(
        f"min_by(AMOUNT, row_order) FILTER (STD_ITEM_NAME = '{i}' AND AMOUNT IS NOT NULL) AS \"{i}\"" for i in S.CORE_ITEMS_HK
    )
    return WITH + f"SELECT {keys}, {picked} FROM long WHERE STD_ITEM_NAME <> '其他项目' AND AMOUNT IS NOT NULL GROUP BY {keys}"


@query("hk_pivot", _pivot_sql("code, FISCAL_YEAR, DATE_TYPE_CODE"))
def _pivot(spark, sf):
    core = S.in_list(long_items(spark, sf), "STD_ITEM_NAME")
    return S.pivot_first(core, ["code", "FISCAL_YEAR", "DATE_TYPE_CODE"], "STD_ITEM_NAME", "AMOUNT", "row_order", S.CORE_ITEMS_HK)


@query("core_income_hk", _pivot_sql("FISCAL_YEAR, DATE_TYPE_CODE"))
def _core_hk(spark, sf):
    return S.core_hk(long_items(spark, sf), "row_order")


@query("core_income_hk_years", _pivot_sql("FISCAL_YEAR"))
def _core_hk_years(spark, sf):
    return S.core_hk(long_items(spark, sf).drop("DATE_TYPE_CODE"), "row_order")


@query("nonempty", WITH + """
SELECT row_order, code, statement FROM long WHERE (code, statement) IN (SELECT (code, statement) FROM long WHERE AMOUNT > 400000)""")
def _nonempty(spark, sf):
    rows = long_items(spark, sf).withColumn("big", F.when(F.col("AMOUNT") > 400000, F.col("AMOUNT")))
    return S.nonempty(rows, ["code", "statement"], ["big"]).select("row_order", "code", "statement")


_SYMBOL = """CASE WHEN ends_with(code, '.HK') THEN replace(code, '.HK', '') WHEN regexp_full_match(code, '[0-9]{6}')
  THEN CASE WHEN code[1] = '6' THEN 'SH' ELSE 'SZ' END || code ELSE code END"""


@query("statement_grid", WITH + f"""
SELECT code, statement, CASE WHEN ends_with(code, '.HK') THEN 'hk' ELSE 'cn' END AS market, {_SYMBOL} AS symbol
FROM (SELECT DISTINCT code FROM long), (SELECT unnest(['利润表', '资产负债表', '现金流量表']) AS statement)""")
def _grid(spark, sf):
    return S.statement_grid(long_items(spark, sf).select("code").distinct())


# The label dimension, written out so that the SQL does not depend on the library.
MAP_SQL = """field_map(statement, ord, a_field, hk_item, zh, en) AS (VALUES
  ('利润表', 1, 'OPERATE_INCOME', '营业额', '营业收入', 'Operating Revenue'),
  ('利润表', 2, 'OPERATE_COST', '销售成本', '营业成本', 'Operating Cost'),
  ('利润表', 3, 'OPERATE_PROFIT', '营业利润', '营业利润', 'Operating Profit'),
  ('利润表', 4, 'TOTAL_PROFIT', '利润总额', '利润总额', 'Total Profit'),
  ('利润表', 5, 'NETPROFIT', '年内溢利', '净利润', 'Net Profit'),
  ('利润表', 6, 'PARENT_NETPROFIT', '年内溢利', '归母净利润', 'Net Profit Attributable to Parent'),
  ('利润表', 7, 'BASIC_EPS', '每股盈利', '基本每股收益', 'Basic EPS'),
  ('利润表', 8, 'TOTAL_COMPRE_INCOME', '综合收益总额', '综合收益总额', 'Total Comprehensive Income'),
  ('利润表', 9, NULL, '毛利', '毛利', 'Gross Profit'),
  ('利润表', 10, NULL, '营运收入', '营运收入', 'Operating Revenue (Alt)'),
  ('资产负债表', 1, 'MONETARY_CAP', '货币资金', '货币资金', 'Monetary Capital'),
  ('资产负债表', 2, 'ACCT_RCV', '应收账款', '应收账款', 'Accounts Receivable'),
  ('资产负债表', 3, 'INVENTORY', '存货', '存货', 'Inventory'),
  ('资产负债表', 4, 'TOTAL_ASSETS', '资产总额', '资产总额', 'Total Assets'),
  ('资产负债表', 5, 'TOTAL_LIAB', '负债总额', '负债总额', 'Total Liabilities'),
  ('资产负债表', 6, 'TOTAL_EQUITY', '权益总额', '所有者权益合计', 'Total Equity'),
  ('资产负债表', 7, 'PARENT_EQUITY', '股东权益（不含少数股东权益）', '归属于母公司股东权益', 'Equity Attributable to Parent'),
  ('资产负债表', 8, 'MINORITY_EQUITY', '少数股东权益', '少数股东权益', 'Minority Equity'),
  ('资产负债表', 9, 'FIXED_ASSETS', '固定资产', '固定资产', 'Fixed Assets'),
  ('资产负债表', 10, 'INTANGIBLE_ASSETS', '无形资产', '无形资产', 'Intangible Assets'),
  ('资产负债表', 11, 'LONG_TERM_INVEST', '长期投资', '长期投资', 'Long-term Investment'),
  ('现金流量表', 1, 'NET_CASH_OPERATE', '经营活动产生的现金流量净额', '经营活动现金流净额', 'Net Cash from Operating Activities'),
  ('现金流量表', 2, 'NET_CASH_INVEST', '投资活动产生的现金流量净额', '投资活动现金流净额', 'Net Cash from Investing Activities'),
  ('现金流量表', 3, 'NET_CASH_FINANCE', '筹资活动产生的现金流量净额', '筹资活动现金流净额', 'Net Cash from Financing Activities'),
  ('现金流量表', 4, 'CASH_EQUI_END', '现金及现金等价物结余', '期末现金及现金等价物余额', 'Cash and Cash Equivalents at End of Period'),
  ('现金流量表', 5, 'CASH_EQUI_BEG', '现金及现金等价物年初结余', '期初现金及现金等价物余额', 'Cash and Cash Equivalents at Beginning of Period'),
  ('现金流量表', 6, 'NET_INCREASE_CASH_EQUI', '现金及现金等价物净增加额', '现金及现金等价物净增加额', 'Net Increase in Cash and Cash Equivalents'),
  ('现金流量表', 7, 'OPERATE_CASH_INFLOW', '经营活动现金流入', '经营活动现金流入', 'Operating Cash Inflow'),
  ('现金流量表', 8, 'OPERATE_CASH_OUTFLOW', '经营活动现金流出', '经营活动现金流出', 'Operating Cash Outflow'),
  ('现金流量表', 9, 'INVEST_CASH_INFLOW', '投资活动现金流入', '投资活动现金流入', 'Investing Cash Inflow'),
  ('现金流量表', 10, 'INVEST_CASH_OUTFLOW', '投资活动现金流出', '投资活动现金流出', 'Investing Cash Outflow'),
  ('现金流量表', 11, 'FINANCE_CASH_INFLOW', '筹资活动现金流入', '筹资活动现金流入', 'Financing Cash Inflow'),
  ('现金流量表', 12, 'FINANCE_CASH_OUTFLOW', '筹资活动现金流出', '筹资活动现金流出', 'Financing Cash Outflow'))"""


@query("label_join", f"WITH {LONG_SQL}, {MAP_SQL} " + """
SELECT row_order, STD_ITEM_NAME, AMOUNT, m.statement, m.ord, zh, en FROM long LEFT JOIN field_map m ON STD_ITEM_NAME = hk_item""")
def _label(spark, sf):
    long = long_items(spark, sf).select("row_order", "STD_ITEM_NAME", "AMOUNT")
    return S.label_items(long, FM.field_map(spark), "STD_ITEM_NAME")


@query("field_map", f"WITH {LONG_SQL}, {MAP_SQL} " + """
SELECT m.statement, m.ord, a_field, hk_item, zh, en, count(row_order) AS uses FROM field_map m LEFT JOIN long ON STD_ITEM_NAME = hk_item
GROUP BY ALL""")
def _field_map(spark, sf):
    """The dimension written out, read back, and counted against the items in use."""
    path = fresh_path(spark, "field_map")
    FM.field_map(spark).write.parquet(path)
    uses = long_items(spark, sf).groupBy(F.col("STD_ITEM_NAME").alias("hk_item")).agg(F.count("*").alias("uses"))
    return spark.read.parquet(path).join(uses, "hk_item", "left").fillna({"uses": 0})


@query("statement_shape", WITH + "SELECT statement, count(*) AS rows, 5 AS columns FROM long GROUP BY statement")
def _shape(spark, sf):
    return S.statement_shape(long_items(spark, sf), 5)


# Codes of the sink queries: a stock for each supplier, some of them in Hong Kong.
_SINK_CODE = "CASE WHEN l_suppkey % 10 = 0 THEN printf('%05d', l_suppkey) ELSE printf('%06d', l_suppkey) END"


def _sink_rows(spark, sf):
    n = F.col("l_suppkey")
    # Padding is much cheaper than a format, but cuts what is longer.
    padded = lambda width: F.when(n.between(0, 10**width - 1), F.lpad(n.cast("string"), width, "0")).otherwise(F.format_string(f"%0{width}d", n))
    code = F.when(n % 10 == 0, F.concat(padded(5), F.lit(".HK"))).otherwise(padded(6))
    kind = F.when(F.col("l_returnflag") == "A", "利润表").when(F.col("l_returnflag") == "R", "资产负债表").otherwise("现金流量表")
    return table(spark, sf, "lineitem").select(
        code.alias("code"), kind.alias("statement"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_order"),
        F.when(F.col("l_orderkey") % 10 != 0, F.col("l_extendedprice")).alias("AMOUNT"),
        F.year("l_shipdate").cast("string").alias("FISCAL_YEAR"),
    )


@query("statement_sink", f"""
SELECT {_SINK_CODE} AS code, CASE l_returnflag WHEN 'A' THEN '利润表' WHEN 'R' THEN '资产负债表' ELSE '现金流量表' END AS statement,
  l_orderkey * 10 + l_linenumber AS row_order, CASE WHEN l_orderkey % 10 <> 0 THEN l_extendedprice END AS AMOUNT FROM lineitem""")
def _sink(spark, sf):
    path = fresh_path(spark, "statements")
    rows = _sink_rows(spark, sf).drop("FISCAL_YEAR")
    write_statements(rows, path)
    return read_statements(spark, path, rows.schema)


@query("statement_sink_periods", f"""
SELECT {_SINK_CODE} AS code, CAST(year(l_shipdate) AS VARCHAR) AS FISCAL_YEAR, count(*) AS rows, sum(l_orderkey * 10 + l_linenumber) AS keys
FROM lineitem GROUP BY ALL""")
def _sink_periods(spark, sf):
    """All rows as one statement, a partition for each stock and year."""
    path = fresh_path(spark, "statement_periods")
    rows = _sink_rows(spark, sf).withColumn("statement", F.lit("利润表"))
    write_statements(rows, path, split=("FISCAL_YEAR",))
    back = read_statements(spark, path, rows.schema)
    return back.groupBy("code", "FISCAL_YEAR").agg(
        F.count("*").alias("rows"), F.sum("row_order").alias("keys")
    )


@query("scan_statements", WITH + "SELECT row_order, code, AMOUNT FROM long WHERE statement = '资产负债表' AND ends_with(code, '.HK')")
def _scan(spark, sf):
    """Partitioned by statement; the filter prunes to one of them."""
    path = fresh_path(spark, "landed")
    long_items(spark, sf).write.partitionBy("statement").parquet(path)
    kept = read_statements(spark, path).filter((F.col("statement") == "资产负债表") & F.col("code").endswith(".HK"))
    return kept.select("row_order", "code", "AMOUNT")


@query("market_route", WITH + f"SELECT row_order, code, {_SYMBOL} AS symbol FROM long")
def _route(spark, sf):
    return long_items(spark, sf).select("row_order", "code", market_symbol(F.col("code")).alias("symbol"))


@query("norm_code", WITH + """
SELECT row_order, CASE WHEN ends_with(code, '.HK') THEN substr(replace(code, '.HK', ''), 1, 6) ELSE substr(code, 1, 6) END AS code FROM long""")
def _norm(spark, sf):
    return long_items(spark, sf).select("row_order", norm_code(F.col("code")).alias("code"))


@query("csv_sink", """
SELECT printf('%06d', p_partkey) AS code, p_name || CASE WHEN p_partkey % 5 = 0 THEN ', "q"' ELSE '' END AS name,
  CASE WHEN p_partkey % 7 <> 0 THEN p_type END AS type, p_brand AS stock_code FROM part""")
def _csv(spark, sf):
    path = fresh_path(spark, "csv")
    k = F.col("p_partkey")
    rows = table(spark, sf, "part").select(
        F.format_string("%06d", k).alias("code"),
        F.concat("p_name", F.when(k % 5 == 0, ', "q"').otherwise("")).alias("name"),
        F.when(k % 7 != 0, F.col("p_type")).alias("type"), F.col("p_brand").alias("stock_code"),
    )
    write_csv(rows, path, by=["stock_code"])
    # Quotes are doubled in the standard way, codes stay text.
    schema = "code string, name string, type string, stock_code string"
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
