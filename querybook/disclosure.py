"""Disclosure pages: tables, titles, links, merging, results."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.functions import markup as M
from ledgerlark.functions.text import label_classes, resolve_url, valid_title
from ledgerlark.operators import cleaning, tables
from ledgerlark.plans import chunked, flows
from ledgerlark.session import fresh_path, landed
from querybook.base import query, table
from querybook.views import AS_OF, ORDER_ROWS_SQL, PAGE_TITLE_SQL, disclosure_pages

WITH = f"WITH {ORDER_ROWS_SQL}"

# Long cells in SQL: nav tables 1 and 2, then the order table.
ALIGNED_CELLS = """
, cells AS (
  SELECT pid, 1 AS idx, 0 AS row_idx, unnest([0, 1]) AS col_idx, unnest(['首页', '公告链接']) AS text FROM pids
  UNION ALL SELECT pid, 2, 0, unnest([0, 1]), unnest(['搜索', CAST(pid AS VARCHAR)]) FROM pids
  UNION ALL SELECT pid, 3, 0, unnest([0, 1, 2, 3, 4]), unnest(['公告时间', '公告标题', '公告链接', '状态', '级别']) FROM pids
  UNION ALL SELECT pid, 3, r, unnest([0, 1, 2, 3, 4]), unnest([dated, label, url_aligned, s, p]) FROM sited)
"""
INLINE_CELLS = """
, cells AS (
  SELECT pid, 3 AS idx, 0 AS row_idx, unnest([0, 1, 2, 3, 4]) AS col_idx, unnest(['公告时间', '公告标题', '状态', '级别', '']) AS text FROM pids
  UNION ALL SELECT pid, 3, r, unnest([0, 1, 2, 3, 4]),
    unnest(CASE WHEN url_inline IS NULL THEN [dated, label, s, p, ''] ELSE [dated, label, url_inline, s, p] END) FROM sited)
"""
TITLES = f"""
, titles AS (
  SELECT pid, stock_code, page, n, c, idx, CASE
    WHEN idx < 3 THEN CASE WHEN c IN (0, 1, 3) THEN {PAGE_TITLE_SQL} ELSE '表格_' || idx END
    ELSE coalesce({PAGE_TITLE_SQL}, CASE c WHEN 6 THEN '表格_3_tbl' || pid WHEN 7 THEN '表格_3_disclosure_wide' ELSE '表格_3' END)
    END AS aligned_title,
    coalesce({PAGE_TITLE_SQL}, CASE c WHEN 6 THEN 'tbl' || pid WHEN 7 THEN 'table' ELSE '公告时间' END) AS inline_title
  FROM pids, (SELECT unnest([1, 2, 3]) AS idx))
"""


def pages_of(spark, sf):
    return disclosure_pages(spark, sf).select("pid", "html")


@query("extract_tables_aligned", WITH + ALIGNED_CELLS + 'SELECT pid, idx AS "index", row_idx, col_idx, text FROM cells')
def _aligned(spark, sf):
    return tables.table_cells(tables.extract_tables(pages_of(spark, sf), "aligned", titles=False), ["pid"])


@query("extract_tables_inline", WITH + INLINE_CELLS + 'SELECT pid, idx AS "index", row_idx, col_idx, text FROM cells')
def _inline(spark, sf):
    return tables.table_cells(tables.extract_tables(pages_of(spark, sf), "inline", titles=False), ["pid"])


# The cells outside the data rows: two tables of one row, and the third one's header.
_OTHER_CELLS = """
  SELECT pid, 1 AS "index", 0 AS row_idx, 0 AS col_idx, '首页' AS text FROM pids
  UNION ALL SELECT pid, 2, 0, unnest([0, 1]), unnest(['搜索', CAST(pid AS VARCHAR)]) FROM pids
  UNION ALL SELECT pid, 3, 0, unnest([0, 1, 2, 3]), unnest(['公告时间', '公告标题', '状态', '级别']) FROM pids"""


@query("cell_text", WITH + _OTHER_CELLS + """ UNION ALL
SELECT pid, 3, r + CASE WHEN pid % 4 = 1 THEN 1 ELSE 0 END AS row_idx, unnest([0, 1, 2, 3]) AS col_idx,
  unnest([dated, CASE WHEN href IS NOT NULL AND k % 4 = 3 THEN '订单' || k || ' | 附件' || k ELSE label END, s, p]) AS text FROM lines""")
def _cell_text(spark, sf):
    cells = tables.raw_cells(tables.page_tables(pages_of(spark, sf)), ["pid"])
    return cells.select("pid", "index", "row_idx", "col_idx", M.cell_text({"text": F.col("text"), "links": F.col("links")}).alias("text"))


@query("cell_links", WITH + """, plain AS (""" + _OTHER_CELLS + """
  UNION ALL SELECT pid, 3, r + CASE WHEN pid % 4 = 1 THEN 1 ELSE 0 END, unnest([0, 2, 3]), unnest([dated, s, p]) FROM lines)
SELECT pid, 3 AS "index", r + CASE WHEN pid % 4 = 1 THEN 1 ELSE 0 END AS row_idx, 1 AS col_idx, label AS text,
  CASE WHEN href IS NULL THEN '' WHEN k % 4 = 3 THEN '订单' || k || '=' || url_aligned || ';附件' || k || '=other/' || k
       WHEN k % 4 = 0 THEN '订单' || k || '公告 ' || d || '=' || url_aligned ELSE label || '=' || url_aligned END AS links,
  url_inline AS first_url
FROM sited
UNION ALL SELECT *, CASE "index" WHEN 1 THEN '首页=https://www.sse.com.cn/' ELSE '' END, CASE "index" WHEN 1 THEN 'http://www.szse.cn/' END FROM plain""")
def _cell_links(spark, sf):
    cells = tables.raw_cells(tables.page_tables(pages_of(spark, sf)), ["pid"])
    shown = F.array_join(
        F.transform(tables.cell_links(F.col("links")), lambda a: F.concat(a["text"], F.lit("="), a["url"])), ";"
    )
    return cells.select(
        "pid", "index", "row_idx", "col_idx", "text", shown.alias("links"),
        tables.cell_links(F.col("links"), first_only=True).alias("first_url"),
    )


@query("table_title", WITH + TITLES + 'SELECT pid, idx AS "index", aligned_title AS title FROM titles')
def _title(spark, sf):
    found = tables.page_tables(pages_of(spark, sf), titles=True)
    return found.select("pid", "index", tables.table_title("aligned").alias("title"))


@query("table_title_inline", WITH + TITLES + 'SELECT pid, idx AS "index", inline_title AS title FROM titles WHERE idx = 3')
def _title_inline(spark, sf):
    found = tables.page_tables(pages_of(spark, sf), titles=True, skip=2)
    return found.select("pid", "index", tables.table_title("inline").alias("title"))


@query("nearest_heading", WITH + """
SELECT pid, idx AS "index", CASE WHEN idx = 3 AND c = 0 THEN '公司公告' || pid WHEN idx = 3 AND c = 1 THEN CAST(pid AS VARCHAR) END AS heading
FROM pids, (SELECT unnest([1, 2, 3]) AS idx)""")
def _nearest(spark, sf):
    return tables.nearest_headings(pages_of(spark, sf), 1)


@query("ancestor_join", WITH + """
, heads AS (
  SELECT pid, 1 AS level, CASE c WHEN 0 THEN '公司公告' || pid ELSE CAST(pid AS VARCHAR) END AS heading, 2 AS d, c FROM pids WHERE c IN (0, 1)
  UNION ALL SELECT pid, 2, '公告列表' || pid, 2, c FROM pids WHERE c = 1
  UNION ALL SELECT pid, 3, '后置标题' || pid, 1, c FROM pids WHERE c = 3)
SELECT pid, idx AS "index", depth, level, heading FROM heads, (SELECT unnest([1, 2, 3]) AS idx), (SELECT unnest([1, 2, 3]) AS depth)
WHERE depth >= CASE WHEN idx = 3 AND c = 3 THEN 1 ELSE 2 END""")
def _ancestors(spark, sf):
    return tables.ancestor_headings(pages_of(spark, sf))


@query("table_shape_report", WITH + """
SELECT pid, idx AS "index", CASE WHEN idx < 3 THEN 1 WHEN pid % 4 = 1 THEN n + 2 ELSE n + 1 END AS rows,
  CASE idx WHEN 3 THEN 4 ELSE 0 END AS headers,
  CASE idx WHEN 1 THEN '首页 [链接: 1个]' WHEN 2 THEN '搜索,' || pid ELSE
    '公告时间,公告标题,状态,级别' ||
    (SELECT string_agg('/' || dated || ',' || label || CASE WHEN href IS NULL THEN '' WHEN k % 4 = 3 THEN ' [链接: 2个]' ELSE ' [链接: 1个]' END
                       || ',' || s || ',' || p, '' ORDER BY r)
     FROM lines l WHERE l.pid = pids.pid AND l.r <= CASE WHEN pids.pid % 4 = 1 THEN 1 ELSE 2 END)
  END AS first_rows,
  CASE WHEN idx = 3 AND c = 6 THEN 'tbl' || pid ELSE '' END AS id,
  CASE WHEN idx = 3 AND c = 7 THEN 'table table-hover disclosure wide' ELSE '' END AS classes, '' AS style
FROM pids, (SELECT unnest([1, 2, 3]) AS idx)""")
def _shape(spark, sf):
    report = tables.inspect_tables(tables.page_tables(pages_of(spark, sf)), ["pid"])
    return report.select(
        "pid", "index", "rows", F.size("header_texts").alias("headers"),
        F.array_join(F.transform("first_rows", lambda r: F.array_join(r, ",")), "/").alias("first_rows"),
        "id", F.array_join("classes", " ").alias("classes"), "style",
    )


@query("table_dims", WITH + """
SELECT pid, idx AS "index", CASE WHEN idx < 3 THEN 1 ELSE n + 1 END AS rows, CASE WHEN idx < 3 THEN 2 ELSE 5 END AS columns
FROM pids, (SELECT unnest([1, 2, 3]) AS idx)""")
def _dims(spark, sf):
    cells = tables.table_cells(tables.extract_tables(pages_of(spark, sf), "aligned", titles=False), ["pid"])
    return tables.table_dims(cells, ["pid"])


@query("link_columns", WITH + """
SELECT pid, idx AS "index", CASE idx WHEN 1 THEN '0' WHEN 2 THEN '' ELSE '1' END AS link_columns FROM pids, (SELECT unnest([1, 2, 3]) AS idx)""")
def _link_columns(spark, sf):
    found = tables.link_columns(tables.page_tables(pages_of(spark, sf)), ["pid"])
    shown = F.array_join(F.transform("link_columns", lambda i: i.cast("string")), ",")
    return found.select("pid", "index", shown.alias("link_columns"))


@query("total_pages", WITH + """
SELECT pid, pid % 6 + 1 AS total_pages, least(CASE WHEN pid % 5 = 4 THEN 4 ELSE pid % 6 + 1 END, 4) AS capped FROM pids""")
def _total_pages(spark, sf):
    return pages_of(spark, sf).select(
        "pid", tables.total_pages(F.col("html")).alias("total_pages"),
        tables.total_pages_by_index(F.col("html"), 4).alias("capped"),
    )


@query("first_table", WITH + 'SELECT pid, 3 AS "index", n + 1 AS rows, 5 AS columns FROM pids')
def _first_table(spark, sf):
    found = tables.extract_tables(pages_of(spark, sf), "inline", max_tables=1, titles=False)
    return found.select("pid", "index", "rows", "columns")


@query("max_tables", WITH + 'SELECT pid, idx AS "index" FROM pids, (SELECT unnest([1, 2]) AS idx)')
def _max_tables(spark, sf):
    return tables.extract_tables(pages_of(spark, sf), "aligned", max_tables=2, titles=False).select("pid", "index")


@query("label_classes", WITH + """
SELECT pid, idx AS "index", CASE WHEN c = 7 AND idx = 3 THEN 'disclosure_wide' ELSE '' END AS label FROM pids, (SELECT unnest([1, 2, 3]) AS idx)""")
def _label_classes(spark, sf):
    found = tables.page_tables(pages_of(spark, sf))
    return found.select("pid", "index", F.array_join(label_classes(M.class_list(F.col("tag"))), "_").alias("label"))


@query("promote_header", WITH + """
, named AS (SELECT r, pid, unnest([0, 1, 2, 3, 4]) AS col_idx, unnest(['公告时间', '公告标题', '公告链接', '状态', '级别']) AS "column",
                   unnest([dated, label, url_aligned, s, p]) AS text FROM sited)
SELECT pid, 3 AS "index", CAST(r - 1 AS INTEGER) AS row_idx, col_idx, "column", text FROM named""")
def _promote(spark, sf):
    found = tables.extract_tables(pages_of(spark, sf), "aligned", titles=False)
    cells = tables.named_cells(found, ["pid"], "aligned")
    return cells.select("pid", "index", "row_idx", "col_idx", "column", "text")


@query("ragged_pad", """
SELECT o_orderkey, array_to_string(list_transform(range(CAST(greatest(o_orderkey % 4, 3) AS BIGINT)),
  lambda i: CASE WHEN i < o_orderkey % 4 THEN o_orderstatus ELSE '' END), ',') AS padded FROM orders""")
def _pad(spark, sf):
    o = table(spark, sf, "orders")
    arr = F.array_repeat(F.col("o_orderstatus"), (F.col("o_orderkey") % 4).cast("int"))
    return o.select("o_orderkey", F.array_join(tables.pad_right(arr, F.lit(3)), ",").alias("padded"))


@query("merge_pages", WITH + """
SELECT stock_code, page, row_number() OVER (PARTITION BY stock_code ORDER BY page, r) - 1 AS row_no, line FROM (
  SELECT stock_code, page, 0 AS r, '公告时间,公告标题,状态,级别,' AS line FROM pids WHERE page = 1
  UNION ALL SELECT stock_code, page, r, CASE WHEN url_inline IS NULL THEN concat_ws(',', dated, label, s, p, '')
    ELSE concat_ws(',', dated, label, url_inline, s, p) END FROM sited)""")
def _merge(spark, sf):
    pages = disclosure_pages(spark, sf).select("stock_code", "page", "html")
    return flows.disclosure_rows(pages).select("stock_code", "page", "row_no", F.array_join("row", ",").alias("line"))


_MERGED_SQL = """
, carried AS (
  SELECT *, coalesce(last_value(CASE WHEN k % 3 = 0 THEN d END IGNORE NULLS) OVER (PARTITION BY stock_code ORDER BY page, r), dated) AS filled
  FROM sited),
merged AS (
  SELECT stock_code, page, r, CASE WHEN url_inline IS NULL THEN concat_ws(',', filled, label, s, p, '')
    ELSE concat_ws(',', filled, label, url_inline, s, p) END AS line FROM carried)"""


@query("disclosure_merged", WITH + _MERGED_SQL + """
SELECT stock_code, line FROM merged
UNION ALL SELECT stock_code, '公告时间,公告标题,状态,级别,' FROM pids WHERE page = 1""")
def _disclosure_merged(spark, sf):
    """Dates filled across the pages of a stock, the files written and read back."""
    pages = disclosure_pages(spark, sf).select("stock_code", "page", "html")
    return flows.disclosure_merged(pages, fresh_path(spark, "merged"))[0]


@query("disclosure_merged_rows", WITH + _MERGED_SQL + """
SELECT stock_code, page, row_number() OVER (PARTITION BY stock_code ORDER BY page, r) - 1 AS row_no, line FROM merged""")
def _disclosure_merged_rows(spark, sf):
    pages = disclosure_pages(spark, sf).select("stock_code", "page", "html")
    found = tables.extract_tables(pages, "inline", max_tables=1, titles=False)
    merged = tables.merged_pages(landed(found, "first_tables"))
    rows = merged.select("stock_code", "page", "row_no", F.posexplode("rows").alias("i", "row"))
    return rows.select(
        "stock_code", "page", (F.col("row_no") + F.col("i")).cast("bigint").alias("row_no"), tables.csv_line(F.col("row")).alias("line")
    )


@query("disclosure_result", WITH + """
SELECT true AS success, stock_code, count(*) AS total_pages, count(*) AS successful_pages, CAST(sum(n) + 1 AS BIGINT) AS total_rows,
  'financial/' || stock_code || '/03_信息披露_多页合并.csv' AS saved_file, 'financial/' || stock_code AS base_dir,
  CAST(NULL AS VARCHAR) AS error FROM pids GROUP BY stock_code""")
def _disclosure_result(spark, sf):
    pages = disclosure_pages(spark, sf).select("stock_code", "page", "html")
    return flows.disclosure_merged(pages, fresh_path(spark, "merged"))[1]


@query("header_skip", WITH + """
SELECT stock_code, page, n + CASE WHEN page = 1 THEN 1 ELSE 0 END AS rows FROM pids""")
def _header_skip(spark, sf):
    pages = disclosure_pages(spark, sf).select("stock_code", "page", "html")
    return flows.disclosure_rows(pages).groupBy("stock_code", "page").agg(F.count("*").alias("rows"))


@query("union_stocks", WITH + TITLES + """
SELECT true AS success, stock_code, page, pid, 1 AS tables_count,
  'financial/' || stock_code || '/03_' || regexp_replace(inline_title, '\\s+', '_', 'g') || '.csv' AS files,
  'financial/' || stock_code AS base_dir, CAST(NULL AS VARCHAR) AS error FROM titles WHERE idx = 3 AND stock_code[1] IN ('0', '3') AND length(stock_code) = 6""")
def _union_stocks(spark, sf):
    pages = disclosure_pages(spark, sf)
    out = flows.run_batch(pages, pages, "Shenzhen", "inline")
    return out.withColumn("files", F.array_join("saved_files", ";")).drop("saved_files")


@query("stock_result", WITH + TITLES + """
SELECT pid % 10 <> 9 AND pid % 10 <> 8 AS success, stock_code, pid, CASE WHEN pid % 10 >= 8 THEN 0 ELSE 3 END AS tables_count,
  CASE WHEN pid % 10 >= 8 THEN '' ELSE
    string_agg('financial/' || stock_code || printf('/%02d_', idx) || substr(aligned_title, 1, 50) || '.csv', ';' ORDER BY idx) END AS files,
  CASE WHEN pid % 10 >= 8 THEN '' ELSE 'financial/' || stock_code END AS base_dir,
  CASE pid % 10 WHEN 9 THEN '获取上交所 ' || stock_code || ' 页面失败' WHEN 8 THEN '未找到任何表格' END AS error
FROM titles GROUP BY pid, stock_code""")
def _stock_result(spark, sf):
    p = F.col("pid")
    html = F.when(p % 10 == 9, F.lit(None)).when(p % 10 == 8, "<p>none</p>").otherwise(F.col("html"))
    pages = disclosure_pages(spark, sf).select("stock_code", "pid", html.alias("html"))
    out = tables.stock_results(pages, ["stock_code", "pid"])
    return out.withColumn("files", F.array_join("saved_files", ";")).drop("saved_files")


@query("multi_page_result", WITH + """
SELECT true AS success, stock_code, count(*) AS total_pages, count(*) AS successful_pages,
  CAST(sum(n) + 1 AS BIGINT) AS total_rows, 'financial/' || stock_code || '/03_信息披露_多页合并.csv' AS saved_file,
  'financial/' || stock_code AS base_dir, CAST(NULL AS VARCHAR) AS error FROM pids GROUP BY stock_code""")
def _multi_page(spark, sf):
    pages = disclosure_pages(spark, sf).select("stock_code", "page", "html")
    requested = pages.groupBy("stock_code").agg(F.count("*").alias("total_pages"))
    found = tables.extract_tables(pages, "inline", max_tables=1, titles=False)
    counts = found.select("stock_code", (F.col("rows") - F.when(F.col("page") == 1, 0).otherwise(1)).alias("n_rows"))
    return tables.multi_page_results(requested, counts)


@query("batch_status", WITH + "SELECT pid % 10 < 8 AS success, count(*) AS stocks FROM pids GROUP BY 1")
def _batch_status(spark, sf):
    return tables.batch_status(_stock_result(spark, sf))


@query("table_summary", WITH + TITLES + f"""
SELECT pid, 3 AS total_tables, '[' || string_agg('{{"index":' || idx || ',"title":"' || aligned_title || '","rows":' ||
    CASE WHEN idx < 3 THEN 1 ELSE n + 1 END || ',"columns":' || CASE WHEN idx < 3 THEN 2 ELSE 5 END ||
    ',"filename":"' || printf('%02d_', idx) || substr(aligned_title, 1, 50) || '.csv"}}', ',' ORDER BY idx) || ']' AS tables,
  '{AS_OF}' AS timestamp FROM titles GROUP BY pid""")
def _summary(spark, sf):
    return tables.summarize_tables(tables.extract_tables(pages_of(spark, sf), "aligned"), ["pid"], F.lit(AS_OF))


@query("disclosure_tables", WITH + TITLES + """
, filled AS (
  SELECT sited.*, inline_title, last_value(CASE WHEN k % 3 = 0 THEN d END IGNORE NULLS) OVER (PARTITION BY sited.pid ORDER BY r) AS carried
  FROM sited JOIN titles ON sited.pid = titles.pid AND idx = 3)
SELECT pid, r - 1 AS row_idx, coalesce(carried, '') || ',' ||
  CASE WHEN url_inline IS NULL THEN concat_ws(',', label, s, p, '') ELSE concat_ws(',', label, url_inline, s, p) END AS line FROM filled""")
def _disclosure_tables(spark, sf):
    found = flows.disclosure_tables(pages_of(spark, sf), "inline")
    rows = found.select("pid", F.posexplode("body").alias("row_idx", "row"))
    return rows.select("pid", "row_idx", F.array_join("row", ",").alias("line"))


@query("disclosure_tables_aligned", WITH + """
SELECT pid, 3 AS "index", r - 1 AS row_idx, concat_ws(',', CASE WHEN c IN (0, 1) THEN
    coalesce(last_value(CASE WHEN k % 3 = 0 THEN d END IGNORE NULLS) OVER (PARTITION BY pid ORDER BY r), '') ELSE dated END,
  label, url_aligned, s, p) AS line FROM sited JOIN pids USING (pid)""")
def _disclosure_tables_aligned(spark, sf):
    found = flows.disclosure_tables(pages_of(spark, sf), "aligned")
    rows = found.select("pid", "index", F.posexplode("body").alias("row_idx", "row"))
    return rows.select("pid", "index", "row_idx", F.array_join("row", ",").alias("line"))


@query("ffill_dates", """
SELECT event_id, user_id, last_value(CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d') END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY event_id) AS date FROM events""")
def _ffill(spark, sf):
    e = F.col("event_id")
    date = F.when(e % 3 == 0, F.date_format("ts", "yyyy-MM-dd")).when(e % 3 == 1, "").otherwise("  ")
    rows = table(spark, sf, "events").select("event_id", "user_id", date.alias("date"))
    return cleaning.ffill(rows, "date", ["user_id"], "event_id", chunked.dense_chunk(e), blank="trim")


@query("ffill_dates_empty", """
SELECT event_id, user_id, coalesce(last_value(CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d') WHEN event_id % 3 = 2 THEN ' ' END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY event_id), '') AS date FROM events""")
def _ffill_empty(spark, sf):
    e = F.col("event_id")
    date = F.when(e % 3 == 0, F.date_format("ts", "yyyy-MM-dd")).when(e % 3 == 1, "").otherwise(" ")
    rows = table(spark, sf, "events").select("event_id", "user_id", date.alias("date"))
    return cleaning.ffill(rows, "date", ["user_id"], "event_id", chunked.dense_chunk(e), blank="empty", leading="keep")


@query("header_repair", """
SELECT o_orderkey - 2 AS row_no, CAST(o_custkey AS VARCHAR) AS "客户", o_orderstatus AS "状态" FROM orders WHERE o_orderkey > 1""")
def _header_repair(spark, sf):
    k = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(
        k.alias("row_no"),
        F.when(k == 0, "报表").when(k == 1, "客户").otherwise(F.col("o_custkey").cast("string")).alias("_c0"),
        F.when(k == 0, "").when(k == 1, "状态").otherwise(F.col("o_orderstatus")).alias("_c1"),
    )
    return cleaning.repair_header(rows, "row_no", 1)


_HREF = "CASE o_orderkey % 4 WHEN 0 THEN '//h/' WHEN 1 THEN '/x/' WHEN 2 THEN './x/' ELSE 'http://h/' END || o_orderkey"


def _hrefs(spark, sf):
    k = F.col("o_orderkey")
    prefix = F.when(k % 4 == 0, "//h/").when(k % 4 == 1, "/x/").when(k % 4 == 2, "./x/").otherwise("http://h/")
    return table(spark, sf, "orders").select(k, F.concat(prefix, k.cast("string")).alias("h"))


@query("resolve_url_cell", f"""
SELECT o_orderkey, CASE WHEN starts_with(h, '//') THEN 'https:' || h WHEN starts_with(h, '/') THEN 'https://www.sse.com.cn' || h ELSE h END AS aligned,
  CASE WHEN starts_with(h, '/') THEN 'http://www.szse.cn' || h WHEN starts_with(h, './') THEN 'http://www.szse.cn' || substr(h, 2)
       WHEN starts_with(h, 'http') THEN h ELSE 'http://www.szse.cn/' || h END AS inline
FROM (SELECT o_orderkey, {_HREF} AS h FROM orders)""")
def _resolve_cell(spark, sf):
    h = F.col("h")
    return _hrefs(spark, sf).select(
        "o_orderkey",
        resolve_url(h, tables.ALIGNED_HOST, "aligned").alias("aligned"),
        resolve_url(h, tables.INLINE_HOST, "inline").alias("inline"),
    )


@query("resolve_url_announcement", f"""
SELECT o_orderkey, CASE WHEN starts_with(h, 'http') THEN h WHEN starts_with(h, '/') THEN 'https://www.sse.com.cn' || h
  ELSE 'https://www.sse.com.cn/' || h END AS url FROM (SELECT o_orderkey, {_HREF} AS h FROM orders)""")
def _resolve_announcement(spark, sf):
    return _hrefs(spark, sf).select("o_orderkey", resolve_url(F.col("h"), tables.ALIGNED_HOST, "announcement").alias("url"))


@query("valid_title", """
SELECT doc_id, 0 AS line_no, length(text) BETWEEN 1 AND 99 AND NOT regexp_full_match(text, '[0-9]+') AS ok FROM documents
UNION ALL SELECT doc_id, generate_subscripts(ls, 1), unnest([length(l) BETWEEN 1 AND 99 AND NOT regexp_full_match(l, '[0-9]+') FOR l IN ls])
FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)""")
def _valid_title(spark, sf):
    """Whole texts (line 0) and each of their lines as titles."""
    lines = F.concat(F.array("text"), F.split("text", "\n"))
    titles = table(spark, sf, "documents").select("doc_id", F.posexplode(lines).alias("line_no", "title"))
    return titles.select("doc_id", "line_no", valid_title(F.col("title")).alias("ok"))
