"""Tables out of pages: cells, titles, links, shapes, merging over pages.

``extract_tables`` gives one row per table.  Everything up to that row is
computed inside the page's row (see ``functions.markup``); operators that need
an order across pages of one stock use chunked prefixes over page-level counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions import markup as M
from ledgerlark.functions.text import label_classes, resolve_url, safe_filename
from ledgerlark.operators import cleaning
from ledgerlark.plans import chunked
from ledgerlark.plans.emit import each

# Hosts, and the header of the added link column.
ALIGNED_HOST = "https://www.sse.com.cn"
INLINE_HOST = "http://www.szse.cn"
LINK_HEADER = "公告链接"
MERGED_TITLE = "信息披露_多页合并"
MERGED_INDEX = 3
INLINE_SKIP = 2


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


# --- structure ------------------------------------------------------------------------------


def page_tables(
    pages: DataFrame,
    html: str = "html",
    titles: bool = False,
    skip: int = 0,
    outer: bool = False,
    filled: int | None = None,
    first_href: bool = False,
) -> DataFrame:
    """One row per table: page columns, ``index`` (1-based), ``tag``, ``body``, ``cells``.

    ``cells`` is ``array<array<struct<text, links>>>`` with one entry per row,
    also for rows without cells.  With ``titles`` the row also carries
    ``heading`` (a usable heading before the table), ``caption`` and
    ``around`` (a title found in enclosing elements).  The first ``skip`` tables
    of a page are left out without being read; the others keep their number.
    With ``outer`` a page without tables gives one row with null ``index``.  With
    ``filled`` only the first so many tables that have a cell leave the page; cells of the
    others are never read.  With ``first_href`` a cell has its first link at most, as
    ``struct<href>``: the texts of links are not read.
    """
    keep = [c for c in pages.columns if c != html]
    # A cheap test ahead of the structural work; pages without tables give no rows.
    df = pages if outer else pages.filter(F.col(html).rlike(r"(?i)<table[\s/>]"))
    df = df.select(*keep, M.visible(F.col(html)).alias("_visible"))
    df = df.withColumn("_pieces", M.table_pieces(F.col("_visible")))
    df = df.withColumn("_tables", M.table_array("_pieces"))
    cols = [*keep, "_tables"]
    if titles:
        df = df.withColumn("_marks", M.mark_array(F.col("_visible")))
        df = df.withColumn("_heads", F.expr(M.headings_sql("_marks")))
        title = f"transform({M.table_marks_sql('_marks')}, m -> {M.heading_title_sql('hs', 'm')})"
        df = df.withColumn("_heading", F.expr(M.let_sql("_heads", "hs", title)))
        df = df.withColumn("_caption", F.expr(f"transform(_tables, t -> {M.caption_sql('t.body')})"))
        # The stack pass over all tags runs only where a table still lacks a title.
        lacking = "exists(arrays_zip(_heading, _caption), z -> z._heading IS NULL AND z._caption IS NULL)"
        around = f"transform({M.enclosing_sql('_marks')}, en -> {M.enclosing_title_sql('hs', 'en')})"
        df = df.withColumn("_around", F.expr(f"IF({lacking}, {M.let_sql('_heads', 'hs', around)}, NULL)"))
        cols += ["_heading", "_caption", "_around"]
    if skip:
        cols.remove("_tables")
        cols.append(F.slice("_tables", skip + 1, F.greatest(F.size("_tables") - skip, F.lit(0))).alias("_tables"))
    df = df.select(*cols).withColumn("_tables", F.transform("_tables", lambda t, i: F.struct(i.alias("i"), t.alias("t"))))
    if filled is not None:
        has_cell = f"n.t.body rlike {M.quoted(M.ROW_WITH_CELL)}"
        df = df.withColumn("_tables", F.slice(F.expr(f"filter(_tables, n -> {has_cell})"), 1, filled))
    df = df.select(*[c for c in df.columns if c != "_tables"], F.inline_outer("_tables").alias("_i", "_t"))
    df = df if outer else df.filter(F.col("_i").isNotNull())
    return df.select(
        *keep,
        (F.col("_i") + skip + 1).alias("index"),
        F.col("_t.tag").alias("tag"),
        F.col("_t.body").alias("body"),
        M.cell_rows(F.col("_t.body"), first_href).alias("cells"),
        *[F.get(c, F.col("_i") + skip).alias(c[1:]) for c in ("_heading", "_caption", "_around") if titles],
    )


def table_title(mode: str) -> Column:
    """Title of a row of ``page_tables(titles=True)``; first rule that applies."""
    ident = F.coalesce(M.attribute(F.col("tag"), "id"), F.lit(""))
    classes = M.class_list(F.col("tag"))
    number = F.concat(F.lit("表格_"), F.col("index").cast("string"))
    if mode == "aligned":
        named = F.array_join(label_classes(classes), "_")
        own = (
            F.when(ident != "", F.concat(number, F.lit("_"), ident))
            .when(named != "", F.concat(number, F.lit("_"), named))
            .otherwise(number)
        )
    else:
        short = F.filter(classes, lambda c: (F.length(c) < 50) & ~c.rlike("^[0-9]+$"))
        first_row = F.get("cells", 0)
        first = F.get(first_row, 0)["text"]
        own = F.coalesce(
            F.when(F.length(ident).between(1, 49), ident),
            F.get(short, 0),
            F.when(F.length(first).between(1, 49), first),
            number,
        )
    return F.coalesce("heading", "caption", "around", own)


# --- data -----------------------------------------------------------------------------------


def link_column_array(cells: Column) -> Column:
    """0-based columns with a link in the first row that has any link."""
    linked = F.filter(cells, lambda row: F.exists(row, lambda c: F.size(c["links"]) > 0))
    flags = F.transform(F.get(linked, 0), lambda c, i: F.when(F.size(c["links"]) > 0, i))
    return F.coalesce(F.array_compact(flags), F.array().cast("array<int>"))


def aligned_data(cells: Column) -> Column:
    """Rows of strings; link columns are followed by a column with the first link's URL.

    The row at position 0 gets the literal header in that place.  Rows without
    cells are left out but keep their position.
    """

    def url(cell: Column) -> Column:
        href = F.coalesce(F.get(cell["links"], 0)["href"], F.lit(""))
        return F.when(F.size(cell["links"]) > 0, resolve_url(href, ALIGNED_HOST, "aligned")).otherwise("")

    def rows(at: Column) -> Column:
        return F.transform(
            cells,
            lambda cells_of_row, r: F.flatten(
                F.transform(
                    cells_of_row,
                    lambda c, i: F.when(
                        F.array_contains(at, i),
                        F.array(c["text"], F.when(r == 0, LINK_HEADER).otherwise(url(c))),
                    ).otherwise(F.array(M.cell_text(c))),
                )
            ),
        )

    return F.filter(_bind(link_column_array(cells), rows), lambda x: F.size(x) > 0)


def inline_link(cell: Column) -> Column:
    """First link's URL, null for a cell without an anchor."""
    href = F.coalesce(F.get(cell["links"], 0)["href"], F.lit(""))
    return F.when(F.size(cell["links"]) > 0, resolve_url(href, INLINE_HOST, "inline"))


def pad_right(arr: Column, width: Column) -> Column:
    missing = F.greatest(width - F.size(arr), F.lit(0))
    return F.concat(arr, F.array_repeat(F.lit(""), missing))


def inline_data(cells: Column) -> Column:
    """Rows of strings; a linked cell emits text and URL; rows padded to the widest."""

    def row(cells_of_row: Column) -> Column:
        return F.flatten(
            F.transform(
                cells_of_row,
                lambda c: F.when(F.size(c["links"]) > 0, F.array(c["text"], inline_link(c))).otherwise(
                    F.array(c["text"])
                ),
            )
        )

    ragged = F.filter(F.transform(cells, row), lambda x: F.size(x) > 0)

    def padded(rows: Column) -> Column:
        widest = F.array_max(F.transform(rows, F.size))
        return _bind(widest, lambda w: F.transform(rows, lambda r: pad_right(r, w)))

    return _bind(ragged, padded)


def extract_tables(
    pages: DataFrame,
    mode: str = "aligned",
    html: str = "html",
    skip: int | None = None,
    max_tables: int | None = None,
    titles: bool = True,
    outer: bool = False,
) -> DataFrame:
    """One row per non-empty table: page columns, index, title, data, rows, columns.

    ``inline`` leaves out the first two tables but keeps their numbers.
    ``columns`` is the width of the first row.  With ``outer`` a page or table
    without data gives a row with null ``index``.  ``max_tables`` ends each page after
    so many non-empty tables, inside the row: every row of ``pages`` is a page.
    """
    skip = (INLINE_SKIP if mode == "inline" else 0) if skip is None else skip
    keep = [c for c in pages.columns if c != html]
    inline = mode != "aligned"  # uses the first address of a cell, no text of a link
    tables = page_tables(pages, html, titles=titles, skip=skip, outer=outer, filled=max_tables, first_href=inline)
    data = aligned_data(F.col("cells")) if mode == "aligned" else inline_data(F.col("cells"))
    title = table_title(mode) if titles else F.lit(None).cast("string")
    # Emitted by a generator, so that the size test does not compute the data again.
    made = F.filter(
        F.array(F.struct(F.col("index"), title.alias("title"), data.alias("data"))), lambda t: F.size(t["data"]) > 0
    )
    out = tables.select(*keep, F.inline_outer(made))
    out = out if outer else out.filter(F.col("index").isNotNull())
    return out.select("*", F.size("data").alias("rows"), F.size(F.get("data", 0)).alias("columns"))


def table_cells(tables: DataFrame, keys: list[str]) -> DataFrame:
    """Long form: (keys, index, row_idx, col_idx, text)."""
    rows = tables.select(*keys, "index", F.posexplode("data").alias("row_idx", "_row"))
    return rows.select(*keys, "index", "row_idx", F.posexplode("_row").alias("col_idx", "text"))


def table_dims(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, and the width of the first row, from long cells."""
    per_row = cells.groupBy(*keys, "index", "row_idx").agg(F.count("*").alias("_w"))
    return per_row.groupBy(*keys, "index").agg(
        F.count("*").alias("rows"), F.min_by("_w", "row_idx").alias("columns")
    )


def link_columns(tables: DataFrame, keys: list[str]) -> DataFrame:
    """The set of link columns per table, from ``page_tables`` rows."""
    return tables.select(*keys, "index", link_column_array(F.col("cells")).alias("link_columns"))


def raw_cells(tables: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, index, row_idx, col_idx, text, links) from ``page_tables`` rows."""
    rows = each(tables, [*keys, "index"], "cells", "row_idx", "_row")
    cells = rows.select(*keys, "index", "row_idx", F.posexplode("_row").alias("col_idx", "_c"))
    return cells.select(
        *keys, "index", "row_idx", "col_idx", F.col("_c.text").alias("text"), F.col("_c.links").alias("links")
    )


def cell_links(links: Column, first_only: bool = False) -> Column:
    """Links with absolute URLs; the inline family keeps the first one only."""
    if first_only:
        href = F.coalesce(F.get(links, 0)["href"], F.lit(""))
        return F.when(F.size(links) > 0, resolve_url(href, INLINE_HOST, "inline"))
    return F.transform(
        links,
        lambda a: F.struct(
            a["text"].alias("text"),
            resolve_url(F.coalesce(a["href"], F.lit("")), ALIGNED_HOST, "aligned").alias("url"),
        ),
    )


def inspect_tables(tables: DataFrame, keys: list[str]) -> DataFrame:
    """Shape report of ``page_tables`` rows: row count, header texts, first rows, attributes.

    A header is every ``tr.header`` row; without one, one empty text list per
    ``th``, because a ``th`` holds no cells of its own.
    """
    header_row = f"array_contains({M.class_list_sql(M.open_tag_sql('hr'))}, 'header')"
    marked = F.call_function("filter", M.row_array(F.col("body")), F.expr(f"hr -> {header_row}"))
    marked_texts = M.mapped(marked, "x", f"transform({M.cells_sql('x')}, xc -> xc.text)")
    bare = F.transform(
        M.all_matches(F.col("body"), r"(?i)<th(?=[\s/>])"), lambda _: F.array().cast("array<string>")
    )

    def described(cell: Column) -> Column:
        n = F.size(cell["links"])
        return F.when(n > 0, F.concat(cell["text"], F.format_string(" [链接: %d个]", n))).otherwise(cell["text"])

    first_rows = F.filter(F.slice("cells", 1, 3), lambda row: F.size(row) > 0)
    return tables.select(
        *keys,
        "index",
        F.size("cells").alias("rows"),
        _bind(marked_texts, lambda m: F.when(F.size(m) > 0, m).otherwise(bare)).alias("header_texts"),
        F.transform(first_rows, lambda row: F.transform(row, described)).alias("first_rows"),
        F.coalesce(M.attribute(F.col("tag"), "id"), F.lit("")).alias("id"),
        M.class_list(F.col("tag")).alias("classes"),
        F.coalesce(M.attribute(F.col("tag"), "style"), F.lit("")).alias("style"),
    )


# --- headings -------------------------------------------------------------------------------


def nearest_headings(pages: DataFrame, level: int, html: str = "html") -> DataFrame:
    """(page columns, index, heading): last heading of one level before each table."""
    keep = [c for c in pages.columns if c != html]
    df = pages.withColumn("_marks", M.mark_array(M.visible(F.col(html))))
    nearest = f"transform({M.table_marks_sql('_marks')}, m -> {M.nearest_sql('hs', 'm', level)})"
    found = F.expr(M.let_sql(M.headings_sql("_marks"), "hs", nearest))
    return each(df, keep, found, "_i", "heading").select(
        *keep, (F.col("_i") + 1).alias("index"), "heading"
    )


def ancestor_headings(pages: DataFrame, html: str = "html") -> DataFrame:
    """(page columns, index, depth, level, heading): headings inside the three enclosing elements."""
    keep = [c for c in pages.columns if c != html]
    df = pages.withColumn("_marks", M.mark_array(M.visible(F.col(html))))
    df = df.withColumn("_heads", F.expr(M.headings_sql("_marks")))
    df = df.withColumn("_around", F.expr(M.enclosing_sql("_marks")))
    df = each(df, [*keep, "_heads"], "_around", "_i", "_up")
    df = df.select(*keep, "_heads", "_i", F.posexplode("_up").alias("_d", "_e"))
    inside = F.filter("_heads", lambda h: (h["at"] > F.col("_e.lo")) & (h["at"] < F.col("_e.hi")))
    df = df.select(*keep, (F.col("_i") + 1).alias("index"), (F.col("_d") + 1).alias("depth"), F.explode(inside).alias("h"))
    return df.select(*keep, "index", "depth", F.col("h.level").alias("level"), F.col("h.text").alias("heading"))


# --- header, names, merging -----------------------------------------------------------------


def split_header(data: Column, mode: str) -> tuple[Column, Column]:
    """(header, body) of a table's rows.

    ``inline`` always takes the first row; ``aligned`` only if it is as wide as
    the widest row and each of its cells is shorter than 50 characters, otherwise
    the header is null and columns stay positional.
    """
    first = F.get(data, 0)
    rest = F.slice(data, 2, F.greatest(F.size(data) - 1, F.lit(0)))
    if mode == "inline":
        return first, rest
    wide = F.size(first) >= F.array_max(F.transform(data, F.size))
    short = wide & F.forall(first, lambda c: F.length(c) < 50)
    return F.when(short, first), F.when(short, rest).otherwise(data)


def promote_header(tables: DataFrame, mode: str) -> DataFrame:
    header, body = split_header(F.col("data"), mode)
    return tables.withColumn("header", header).withColumn("body", body)


def named_cells(tables: DataFrame, keys: list[str], mode: str) -> DataFrame:
    """Long cells below the header, each with its column's name."""
    rows = promote_header(tables, mode).select(
        *keys, "index", "title", "header", F.posexplode("body").alias("row_idx", "_row")
    )
    cells = rows.select(*keys, "index", "title", "header", "row_idx", F.posexplode("_row").alias("col_idx", "text"))
    name = F.coalesce(F.get("header", F.col("col_idx")), F.col("col_idx").cast("string"))
    return cells.withColumn("column", name).drop("header")


def merge_pages(
    tables: DataFrame, stock: str = "stock_code", page: str = "page", pages_per_chunk: int = 4096
) -> DataFrame:
    """All rows of a stock over its pages: header once, pages in order.

    One output row per table row with ``row_no`` (0-based over the stock).  The
    offsets come from page-level row counts, not from sorting the rows.
    ``tables`` holds one table per (stock, page).
    """
    # Only page 1 keeps its first row.
    first = F.when(F.col(page) == 1, 1).otherwise(2)
    kept = F.slice("data", first, F.greatest(F.size("data") - first + 1, F.lit(0)))
    counts = tables.select(
        stock, page, (F.size("data") - F.when(F.col(page) == 1, 0).otherwise(1)).alias("_n")
    )
    upto = chunked.running_sum(
        counts, [stock], [F.col(page)], chunked.dense_chunk(F.col(page), pages_per_chunk), F.col("_n"), "_upto"
    )
    offsets = upto.select(stock, page, (F.col("_upto") - F.col("_n")).alias("_off"))
    rows = tables.select(stock, page, kept.alias("_rows")).join(offsets, [stock, page])
    return rows.select(stock, page, "_off", F.posexplode("_rows").alias("_i", "row")).select(
        stock, page, (F.col("_off") + F.col("_i")).alias("row_no"), "row"
    )


def merged_pages(
    tables: DataFrame, stock: str = "stock_code", page: str = "page", pages_per_chunk: int = 4096
) -> DataFrame:
    """The merged table of each stock, its dates filled across pages, still one row a page.

    (stock, page, row_no, header, rows): ``rows`` are the page's data rows, the first of
    them number ``row_no`` of the stock (from 0, the header not counted).  The first row
    of all pages together is the header: page 1 keeps its first row, later pages lose
    theirs, so without page 1 a data row takes that place.  Dates are filled in the first
    column named after a date, or the first of all, where the header or the first data row
    speaks of announcement times.

    A page reduces to its number of rows and its last known date; prefixes of both over
    the pages of a stock are joined back, and rows are filled inside their page.
    ``tables`` holds one table per (stock, page), read several times.
    """
    first = F.when(F.col(page) == 1, 1).otherwise(2)
    kept = F.slice("data", first, F.greatest(F.size("data") - first + 1, F.lit(0)))
    pages = tables.select(stock, page, kept.alias("_rows"))
    order, chunk = [F.col(page)], chunked.dense_chunk(F.col(page), pages_per_chunk)
    upto = chunked.running_sum(
        pages.select(stock, page, F.size("_rows").alias("_n")), [stock], order, chunk, F.col("_n"), "_upto"
    )
    offsets = upto.select(stock, page, (F.col("_upto") - F.col("_n")).cast("int").alias("_off"))
    pages = pages.join(offsets, [stock, page])
    row = lambda k: F.max(F.get("_rows", F.lit(k) - F.col("_off")))  # noqa: E731  one page holds it
    heads = pages.filter(F.col("_off") <= 1).groupBy(stock).agg(row(0).alias("header"), row(1).alias("_first"))
    heads = heads.withColumn("_fill", cleaning.wants_date_fill(F.lit(MERGED_TITLE), F.col("header"), F.array("_first")))
    heads = heads.withColumn("_at", cleaning.date_column(F.col("header"))).drop("_first")
    pages = pages.join(heads, stock)
    # The header's page hands on no date of the header.
    body = F.when((F.col("_off") == 0) & (F.size("_rows") > 0), F.expr("slice(_rows, 2, size(_rows))")).otherwise(F.col("_rows"))
    pages = pages.withColumn("_body", body)
    last = F.when(F.col("_fill"), cleaning.last_filled(F.col("_body"), F.col("_at")))
    carried = chunked.last_known(
        pages.select(stock, page, last.alias("_last")), [stock], order, chunk, F.col("_last"), "_before", own=False
    )
    pages = pages.join(carried.select(stock, page, "_before"), [stock, page])
    filled = cleaning.ffill_rows(F.col("_body"), F.col("_at"), F.col("_before"))
    return pages.select(
        stock,
        page,
        F.greatest(F.col("_off") - 1, F.lit(0)).alias("row_no"),
        "header",
        F.when(F.col("_fill"), filled).otherwise(F.col("_body")).alias("rows"),
    )


def csv_line(row: Column) -> Column:
    """One line of a CSV file: cells with a comma, a quote or a line break are quoted, quotes doubled."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    cell = lambda c: F.when(c.rlike("[,\"\r\n]"), quoted(c)).otherwise(F.coalesce(c, F.lit("")))
    return F.array_join(F.transform(row, cell), ",")


def merged_lines(merged: DataFrame, stock: str = "stock_code", page: str = "page") -> DataFrame:
    """(stock, line_no, line): the merged tables of :func:`merged_pages` as CSV lines, the header as line 0."""
    lines = F.transform("rows", csv_line)
    head = (F.col("row_no") == 0) & ((F.size("rows") > 0) | (F.col(page) == 1)) & F.col("header").isNotNull()
    body = merged.select(stock, "row_no", F.posexplode(lines).alias("_i", "line"))
    body = body.select(stock, (F.col("row_no") + F.col("_i") + 1).alias("line_no"), "line")
    # Several pages may stand at row 0 (those without rows): the header is written once.
    header = merged.filter(head).groupBy(stock).agg(F.max("header").alias("_h"))
    return header.select(stock, F.lit(0).alias("line_no"), csv_line(F.col("_h")).alias("line")).union(body)


def summarize_tables(tables: DataFrame, keys: list[str], at: Column, filenames: bool = True) -> DataFrame:
    """Per page: total_tables, timestamp, and the tables' descriptions as JSON.

    The number of tables of one page is bounded by the page's size.
    """
    name = safe_filename(F.col("index"), F.col("title"))
    fields = ["index", "title", "rows", "columns"] + ([name.alias("filename")] if filenames else [])
    listed = F.array_sort(F.collect_list(F.struct(*fields)))
    return tables.groupBy(*keys).agg(
        F.count("*").alias("total_tables"), F.to_json(listed).alias("tables")
    ).withColumn("timestamp", at)


# --- results per stock ----------------------------------------------------------------------


def page_failed(code: Column, mode: str) -> Column:
    """Message for a stock whose page could not be had; the inline mode reads Shenzhen pages."""
    return F.concat(F.lit("获取深交所 " if mode == "inline" else "获取上交所 "), code, F.lit(" 页面失败"))


def stock_results(pages: DataFrame, keys: list[str], mode: str = "aligned", html: str = "html") -> DataFrame:
    """One row per page asked for: success, tables_count, saved_files, base_dir, error.

    ``keys`` identify a page and include ``stock_code``; the files of one result
    are those of one page.  Pages are read once: the tables of a page meet again
    as small rows, after partial aggregation in the task that made them.
    """
    blank = F.coalesce(F.length(html) == 0, F.lit(True))
    asked = pages.select(*keys, blank.alias("_empty"), html)
    found = extract_tables(asked, mode, html, outer=True)
    name = safe_filename(F.col("index"), F.col("title"), mode == "inline")
    file = F.when(F.col("index").isNotNull(), F.struct("index", name.alias("f")))
    out = found.groupBy(*keys, "_empty").agg(F.count("index").alias("_n"), F.array_sort(F.collect_list(file)).alias("_files"))
    ok = F.col("_n") > 0
    base = F.concat(F.lit("financial/"), F.col("stock_code"))
    return out.select(
        ok.alias("success"),
        *keys,
        F.col("_n").alias("tables_count"),
        F.transform("_files", lambda x: F.concat(base, F.lit("/"), x["f"])).alias("saved_files"),
        F.when(ok, base).otherwise("").alias("base_dir"),
        F.when(ok, None)
        .when(F.col("_empty"), page_failed(F.col("stock_code"), mode))
        .otherwise(F.lit("未找到任何表格"))
        .alias("error"),
    )


def merged_file(code: Column) -> tuple[Column, Column]:
    """(folder, file) of a stock's merged table."""
    folder = F.concat(F.lit("financial/"), code)
    return folder, F.concat(folder, F.lit("/"), safe_filename(F.lit(MERGED_INDEX), F.lit(MERGED_TITLE), True))


def multi_page_results(requested: DataFrame, merged_counts: DataFrame) -> DataFrame:
    """Per stock: total_pages, successful_pages, total_rows, saved_file, base_dir; a failed stock has neither of these.

    ``requested`` has (stock_code, total_pages); ``merged_counts`` one row per
    page read with its row count after the header skip.
    """
    per = merged_counts.groupBy("stock_code").agg(
        F.count("*").alias("successful_pages"), F.sum("n_rows").alias("total_rows")
    )
    ok = F.coalesce(F.col("total_rows") > 0, F.lit(False))
    folder, file = merged_file(F.col("stock_code"))
    return requested.join(per, "stock_code", "left").select(
        ok.alias("success"),
        "stock_code",
        "total_pages",
        F.coalesce("successful_pages", F.lit(0)).alias("successful_pages"),
        F.coalesce("total_rows", F.lit(0)).alias("total_rows"),
        F.when(ok, file).alias("saved_file"),
        F.when(ok, folder).alias("base_dir"),
        F.when(~ok, "所有页面都没有获取到数据").alias("error"),
    )


def batch_status(results: DataFrame) -> DataFrame:
    return results.groupBy("success").agg(F.count("*").alias("stocks"))


# --- page counts ----------------------------------------------------------------------------


def total_pages(html: Column) -> Column:
    """Largest number among the links of the pagination block, else ``共N页`` of a text node, else 1."""

    def block(text: Column, name: str) -> Column:
        return M.applied(text, "pb", M.element_sql("pb", name, "div"))

    def by_links(links: Column) -> Column:
        top = F.array_max(M.mapped(links, "x", f"try_cast({M.node_text_sql('x')} as int)"))
        return F.when(F.size(links) > 0, F.greatest(F.coalesce(top, F.lit(1)), F.lit(1)))

    def counted(text: Column) -> Column:
        anchors = M.all_matches(F.coalesce(block(text, "pagination"), block(text, "page")), M.LINK)
        named = F.filter(M.applied(text, "pt", M.text_nodes_sql("pt")), lambda t: t.rlike(r"共\d+页"))
        stated = F.nullif(F.regexp_extract(F.get(named, 0), r"共(\d+)页", 1), F.lit("")).try_cast("int")
        return F.coalesce(_bind(anchors, by_links), stated, F.lit(1))

    return _bind(M.visible(html), counted)


def total_pages_by_index(html: Column, max_pages: int | None = None) -> Column:
    """Click variant: largest digit text of ``a[data-pi]`` in ``.paginator-ul``; capped."""
    text = M.visible(html)
    indexed = F.expr(f"x -> {M.attribute_sql(M.open_tag_sql('x'), 'data-pi')} IS NOT NULL")
    digits = M.let_sql(M.node_text_sql("x"), "y", "IF(y rlike '^[0-9]+$', try_cast(y as int), NULL)")

    def largest(block: Column) -> Column:
        anchors = F.call_function("filter", M.all_matches(block, M.LINK), indexed)
        top = F.greatest(F.coalesce(F.array_max(M.mapped(anchors, "x", digits)), F.lit(1)), F.lit(1))
        return F.when(block.isNotNull(), top).otherwise(F.lit(max_pages or 5))

    found = _bind(M.applied(text, "pb", M.element_sql("pb", "paginator-ul", "ul")), largest)
    return found if max_pages is None else F.least(found, F.lit(max_pages))


def cap_pages(df: DataFrame, max_pages: int, page: str = "page") -> DataFrame:
    return df.filter(F.col(page) <= max_pages)
