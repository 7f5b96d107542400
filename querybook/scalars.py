"""Scalar functions without a natural home elsewhere."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.functions import text as X
from querybook.base import query, table


@query("venue_filter", """
SELECT p_partkey, CASE WHEN length(code) = 6 THEN CASE WHEN code[1] = '6' THEN 'Shanghai' WHEN code[1] IN ('0', '3') THEN 'Shenzhen' END END AS venue
FROM (SELECT p_partkey, (p_partkey % 10) || repeat('1', 4 + p_partkey % 3) AS code FROM part)""")
def _venue(spark, sf):
    k = F.col("p_partkey")
    code = F.concat((k % 10).cast("string"), F.repeat(F.lit("1"), (k % 3 + 4).cast("int")))
    return table(spark, sf, "part").select("p_partkey", X.venue(code).alias("venue"))


@query("url_template", "SELECT p_partkey, 'http://h/list,' || p_brand || '_' || p_size || '.html' AS url FROM part")
def _url(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.page_url("http://h/list,%s_%d.html", "p_brand", "p_size").alias("url"))


_TITLE = """CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN 'a/b:c  d' WHEN 2 THEN repeat('x', 60) ELSE p_name || chr(9) || '?*"<>|' || chr(92) END"""


@query("safe_filename", f"""
SELECT p_partkey, printf('%02d_', p_partkey) || substr(regexp_replace({_TITLE}, '[<>:"/\\\\|?*]', '_', 'g'), 1, 50) || '.csv' AS aligned,
  printf('%02d_', p_partkey) || substr(regexp_replace(regexp_replace({_TITLE}, '[<>:"/\\\\|?*]', '_', 'g'), '\\s+', '_', 'g'), 1, 50) || '.csv' AS inline
FROM part""")
def _filename(spark, sf):
    k = F.col("p_partkey")
    title = (
        F.when(k % 4 == 0, F.col("p_name")).when(k % 4 == 1, "a/b:c  d").when(k % 4 == 2, "x" * 60)
        .otherwise(F.concat("p_name", F.lit('\t?*"<>|\\')))
    )
    return table(spark, sf, "part").select(
        k, X.safe_filename(k, title).alias("aligned"), X.safe_filename(k, title, squash_ws=True).alias("inline")
    )


@query("add_tool", "SELECT p_partkey, p_partkey + p_size AS total FROM part")
def _add(spark, sf):
    """The typed function as a SQL function, inlined by the optimizer."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION add_tool(x BIGINT, y BIGINT) RETURNS BIGINT RETURN x + y")
    return table(spark, sf, "part").selectExpr("p_partkey", "add_tool(p_partkey, p_size) AS total")


@query("report_kind", r"""
WITH titled AS (
  SELECT doc_id, lang, source, text || CASE doc_id % 5 WHEN 0 THEN ' 2023年年度报告' WHEN 1 THEN ' 2023年第三季度报告'
    WHEN 2 THEN ' 2023年半年度报告' WHEN 3 THEN ' 2022年报' ELSE '' END AS title FROM documents)
SELECT doc_id, CASE WHEN contains(title, '半年') THEN 'half_year' WHEN regexp_matches(title, '年度报告|年报') THEN 'annual'
    WHEN contains(title, '季') THEN 'quarterly' END AS kind,
  printf('%02d_', row_number() OVER (PARTITION BY lang, source ORDER BY doc_id)) || title || '.pdf' AS name
FROM titled""")
def _report_kind(spark, sf):
    """Kinds of whole texts with a title behind them, numbered within language and source."""
    from ledgerlark.plans.chunked import dense_chunk, rank_within

    d = F.col("doc_id")
    kind = (
        F.when(d % 5 == 0, " 2023年年度报告").when(d % 5 == 1, " 2023年第三季度报告").when(d % 5 == 2, " 2023年半年度报告")
        .when(d % 5 == 3, " 2022年报").otherwise("")
    )
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", F.concat("text", kind).alias("title"))
    numbered = rank_within(docs, ["lang", "source"], [d], dense_chunk(d), "n")
    return numbered.select(
        "doc_id", X.report_kind(F.col("title")).alias("kind"),
        F.format_string("%02d_%s.pdf", "n", "title").alias("name"),
    )
