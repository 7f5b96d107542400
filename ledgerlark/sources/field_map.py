"""Label dimension of the three statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlark.schemas import FIELD_MAP

# Fixed values: (mainland field or None, Hong Kong item, Chinese label, English label).
INCOME = (
    ("OPERATE_INCOME", "营业额", "营业收入", "Operating Revenue"),
    ("OPERATE_COST", "销售成本", "营业成本", "Operating Cost"),
    ("OPERATE_PROFIT", "营业利润", "营业利润", "Operating Profit"),
    ("TOTAL_PROFIT", "利润总额", "利润总额", "Total Profit"),
    ("NETPROFIT", "年内溢利", "净利润", "Net Profit"),
    ("PARENT_NETPROFIT", "年内溢利", "归母净利润", "Net Profit Attributable to Parent"),
    ("BASIC_EPS", "每股盈利", "基本每股收益", "Basic EPS"),
    ("TOTAL_COMPRE_INCOME", "综合收益总额", "综合收益总额", "Total Comprehensive Income"),
    (None, "毛利", "毛利", "Gross Profit"),
    (None, "营运收入", "营运收入", "Operating Revenue (Alt)"),
)
BALANCE = (
    ("MONETARY_CAP", "货币资金", "货币资金", "Monetary Capital"),
    ("ACCT_RCV", "应收账款", "应收账款", "Accounts Receivable"),
    ("INVENTORY", "存货", "存货", "Inventory"),
    ("TOTAL_ASSETS", "资产总额", "资产总额", "Total Assets"),
    ("TOTAL_LIAB", "负债总额", "负债总额", "Total Liabilities"),
    ("TOTAL_EQUITY", "权益总额", "所有者权益合计", "Total Equity"),
    ("PARENT_EQUITY", "股东权益（不含少数股东权益）", "归属于母公司股东权益", "Equity Attributable to Parent"),
    ("MINORITY_EQUITY", "少数股东权益", "少数股东权益", "Minority Equity"),
    ("FIXED_ASSETS", "固定资产", "固定资产", "Fixed Assets"),
    ("INTANGIBLE_ASSETS", "无形资产", "无形资产", "Intangible Assets"),
    ("LONG_TERM_INVEST", "长期投资", "长期投资", "Long-term Investment"),
)
CASH_FLOW = (
    ("NET_CASH_OPERATE", "经营活动产生的现金流量净额", "经营活动现金流净额", "Net Cash from Operating Activities"),
    ("NET_CASH_INVEST", "投资活动产生的现金流量净额", "投资活动现金流净额", "Net Cash from Investing Activities"),
    ("NET_CASH_FINANCE", "筹资活动产生的现金流量净额", "筹资活动现金流净额", "Net Cash from Financing Activities"),
    ("CASH_EQUI_END", "现金及现金等价物结余", "期末现金及现金等价物余额", "Cash and Cash Equivalents at End of Period"),
    ("CASH_EQUI_BEG", "现金及现金等价物年初结余", "期初现金及现金等价物余额", "Cash and Cash Equivalents at Beginning of Period"),
    ("NET_INCREASE_CASH_EQUI", "现金及现金等价物净增加额", "现金及现金等价物净增加额", "Net Increase in Cash and Cash Equivalents"),
    ("OPERATE_CASH_INFLOW", "经营活动现金流入", "经营活动现金流入", "Operating Cash Inflow"),
    ("OPERATE_CASH_OUTFLOW", "经营活动现金流出", "经营活动现金流出", "Operating Cash Outflow"),
    ("INVEST_CASH_INFLOW", "投资活动现金流入", "投资活动现金流入", "Investing Cash Inflow"),
    ("INVEST_CASH_OUTFLOW", "投资活动现金流出", "投资活动现金流出", "Investing Cash Outflow"),
    ("FINANCE_CASH_INFLOW", "筹资活动现金流入", "筹资活动现金流入", "Financing Cash Inflow"),
    ("FINANCE_CASH_OUTFLOW", "筹资活动现金流出", "筹资活动现金流出", "Financing Cash Outflow"),
)

BY_STATEMENT = {"利润表": INCOME, "资产负债表": BALANCE, "现金流量表": CASH_FLOW}


def rows() -> list[tuple]:
    return [(s, i, *entry) for s, entries in BY_STATEMENT.items() for i, entry in enumerate(entries, 1)]


def field_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows(), FIELD_MAP)


def zh_labels(statement: str) -> dict[str, str]:
    """Mainland field to Chinese label."""
    return {a: zh for a, _, zh, _ in BY_STATEMENT[statement] if a}
