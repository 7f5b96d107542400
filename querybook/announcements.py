"""Announcements over the derived disclosure pages, de-duplication over documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.functions.text import extract_date, has_keyword
from ledgerlark.operators import announcements as A
from ledgerlark.operators import cleaning, tables
from querybook.base import query, table
from querybook.views import ORDER_ROWS_SQL, disclosure_pages

# Entity pattern for the derived pages: orders whose number ends in 77.
ENTITY = r"(?:订单|公告|通知&)[0-9]*77(?![0-9])"

# One row per anchor of the order table: position, text, href as it stands.
FOUND_SQL = f"""
WITH {ORDER_ROWS_SQL},
-- li counts the links of a row from 0
row_links AS (
  SELECT pid, r, k, label, d, dated, s, p, 0 AS li, CASE WHEN k % 4 = 3 THEN '订单' || k ELSE label END AS title, href FROM lines WHERE href IS NOT NULL
  UNION ALL
  SELECT pid, r, k, label, d, dated, s, p, 1, '附件' || k, 'other/' || k FROM lines WHERE href IS NOT NULL AND k % 4 = 3),
sited_links AS (
  SELECT *, CASE WHEN starts_with(href, 'http') THEN href WHEN starts_with(href, '/') THEN 'https://www.sse.com.cn' || href
    ELSE 'https://www.sse.com.cn/' || href END AS url FROM row_links),
every AS (
  SELECT pid, CASE WHEN k % 4 = 0 THEN d ELSE '' END AS date, title, url, '关键词匹配' AS extraction_method, 0 AS m, r, li
  FROM sited_links WHERE regexp_matches(title, '公告|年报|季报|半年报|报告|通知|披露')
  UNION ALL
  SELECT pid, CASE WHEN k % 4 = 0 THEN d ELSE '' END, title, url, '表格解析', 1, r, li
  FROM sited_links WHERE regexp_matches(label, '公告|年报|季报|半年报|报告|通知|披露')
  UNION ALL
  SELECT pid, CASE WHEN k % 4 = 0 THEN d ELSE '' END, title, url, '600519相关', 2, r, li
  FROM sited_links WHERE li = 0 AND k % 100 = 77)
"""


def found(spark, sf):
    return disclosure_pages(spark, sf).select("pid", "html")


@query("announcements", FOUND_SQL + """
SELECT pid, date, title, url, '上交所官网' AS source, extraction_method FROM (
  SELECT *, row_number() OVER (PARTITION BY pid, title ORDER BY m, r, li) AS n FROM every) WHERE n = 1""")
def _announcements(spark, sf):
    out = A.extract_announcements(found(spark, sf), entity=ENTITY)
    return out.drop("method_rank", "method_pos")


@query("union_extractors", FOUND_SQL + """
SELECT pid, extraction_method, count(*) AS n, count(DISTINCT title) AS titles FROM every GROUP BY pid, extraction_method""")
def _union(spark, sf):
    pages = found(spark, sf)
    every = A.union_extractors(A.keyword_links(pages), A.keyword_cells(pages), A.entity_links(pages, entity=ENTITY))
    return every.groupBy("pid", "extraction_method").agg(F.count("*").alias("n"), F.countDistinct("title").alias("titles"))


@query("row_links", FOUND_SQL + """
SELECT pid, 3 AS "index", r + CASE WHEN pid % 4 = 1 THEN 1 ELSE 0 END AS row_idx, unnest([0, 1, 2, 3]) AS col_idx,
  unnest([dated, label, s, p]) AS cell_text, title, href FROM row_links
UNION ALL SELECT pid, 1, 0, 0, '首页', '首页', '/' FROM pids""")
def _row_links(spark, sf):
    cells = tables.raw_cells(tables.page_tables(found(spark, sf)), ["pid"])
    joined = A.row_links(cells, ["pid"])
    return joined.select(
        "pid", "index", "row_idx", "col_idx", "cell_text", F.col("a.text").alias("title"), F.col("a.href").alias("href")
    )


@query("project_order", FOUND_SQL + """
SELECT date, title, url, '上交所官网' AS source, extraction_method FROM every""")
def _project(spark, sf):
    pages = found(spark, sf)
    every = A.union_extractors(A.keyword_links(pages), A.keyword_cells(pages), A.entity_links(pages, entity=ENTITY))
    return A.project_announcements(every)


@query("keyword_filter", """
SELECT doc_id FROM documents WHERE contains(text, 'the') OR contains(text, 'que.') OR contains(text, '(c)') OR contains(text, 'für')""")
def _keyword_filter(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.filter(has_keyword(F.col("text"), ("the", "que.", "(c)", "für"))).select("doc_id")


@query("dedup_first", """
SELECT doc_id, text FROM (SELECT doc_id, text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents) WHERE n = 1""")
def _dedup(spark, sf):
    return cleaning.keep_first(table(spark, sf, "documents").select("doc_id", "text"), ["text"], ["doc_id"])


@query("extract_date", """
SELECT doc_id, coalesce(nullif(regexp_extract(t, '(\\d{4}-\\d{2}-\\d{2})', 1), ''), nullif(regexp_extract(t, '(\\d{4}/\\d{2}/\\d{2})', 1), ''),
  nullif(regexp_extract(t, '(\\d{4}年\\d{2}月\\d{2}日)', 1), ''), nullif(regexp_extract(t, '(\\d{2}-\\d{2})', 1), ''),
  nullif(regexp_extract(t, '(\\d{2}/\\d{2})', 1), ''), '') AS date
FROM (SELECT doc_id, text || CASE doc_id % 6 WHEN 0 THEN ' 12-31 2024/01/02' WHEN 1 THEN ' 2024年01月02日 2023/01/01' WHEN 2 THEN ' 2021-02-03'
  WHEN 3 THEN ' 03/04' WHEN 4 THEN ' 05-06' ELSE '' END AS t FROM documents)""")
def _extract_date(spark, sf):
    d = F.col("doc_id") % 6
    tail = (
        F.when(d == 0, " 12-31 2024/01/02").when(d == 1, " 2024年01月02日 2023/01/01").when(d == 2, " 2021-02-03")
        .when(d == 3, " 03/04").when(d == 4, " 05-06").otherwise("")
    )
    return table(spark, sf, "documents").select("doc_id", extract_date(F.concat("text", tail)).alias("date"))
