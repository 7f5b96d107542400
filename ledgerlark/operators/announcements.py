"""Announcements from pages: three extractors, their union, keep-first by title."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.functions import markup as M
from ledgerlark.functions.text import ANNOUNCEMENT_WORDS, extract_date, has_keyword, resolve_url
from ledgerlark.operators.pages import ENTITY
from ledgerlark.operators.tables import ALIGNED_HOST, page_tables
from ledgerlark.plans.emit import each
from ledgerlark.schemas import ANNOUNCEMENTS

# Source and method labels in extraction order.
SOURCE = "上交所官网"
METHODS = ("关键词匹配", "表格解析", "600519相关")


def _anchors(html: Column) -> Column:
    return _anchors_visible(M.visible(html))


def _anchors_visible(html: Column) -> Column:
    """``array<struct<href, text, own>>``; ``own`` are the text nodes directly in the anchor."""
    # Nested elements go out as a whole, so only the anchor's own text nodes stay.
    nested = M.quoted(rf"(?is)^{M.TAG}|<([a-z][a-z0-9]*)\b[^>]*>.*?</\1\s*>")
    own = M.text_nodes_sql(f"regexp_replace(x, {nested}, {M.quoted(M.SEPARATOR)})")
    link = (
        f"named_struct('href', {M.attribute_sql(M.open_tag_sql('x'), 'href')}, "
        f"'text', {M.node_text_sql('x')}, 'own', transform({own}, y -> {M.decode_sql('y')}))"
    )
    return M.mapped(M.all_matches(html, M.LINK), "x", link)


def keyword_links(pages: DataFrame, html: str = "html", words: tuple[str, ...] = ANNOUNCEMENT_WORDS) -> DataFrame:
    keep = [c for c in pages.columns if c != html]
    links = F.filter(_anchors(F.col(html)), lambda a: a["href"].isNotNull() & has_keyword(a["text"], words))
    rows = each(pages, keep, links, "pos", "a")
    return _shaped(rows, keep, F.col("a.text"), F.col("a.text"), F.col("a.href"), 0, ALIGNED_HOST)


def row_links(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Each cell beside every link of its own row: equi-join on page, table and row."""
    at = [*keys, "index", "row_idx"]
    links = cells.select(*at, F.col("col_idx").alias("_lc"), F.posexplode("links").alias("_li", "a"))
    return cells.select(*at, "col_idx", F.col("text").alias("cell_text")).join(links, at)


def keyword_cells(pages: DataFrame, html: str = "html", words: tuple[str, ...] = ANNOUNCEMENT_WORDS) -> DataFrame:
    """Cells with a keyword beside each link of their row; a row stays one array until then."""
    keep = [c for c in pages.columns if c != html]
    tables = page_tables(pages, html)
    rows = each(tables, [*keep, "index"], "cells", "row_idx", "_row")
    links = F.filter(F.flatten(F.transform("_row", lambda c: c["links"])), lambda a: a["href"].isNotNull())
    rows = rows.select(*keep, "index", "row_idx", links.alias("_links"), F.posexplode("_row").alias("col_idx", "_c"))
    rows = rows.filter(has_keyword(F.col("_c.text"), words))
    rows = rows.select(*keep, "index", "row_idx", "col_idx", "_c", F.posexplode("_links").alias("_li", "a"))
    pos = F.struct("index", "row_idx", "col_idx", "_li")
    return _shaped(rows.withColumn("pos", pos), keep, F.col("_c.text"), F.col("a.text"), F.col("a.href"), 1, ALIGNED_HOST)


def entity_links(pages: DataFrame, html: str = "html", entity: str = ENTITY) -> DataFrame:
    """Anchors by each text node directly inside them that names the entity."""
    keep = [c for c in pages.columns if c != html]
    rows = each(pages, keep, _anchors(F.col(html)), "_i", "a")
    hits = F.filter("a.own", lambda t: t.rlike(entity))
    rows = rows.select(*keep, "_i", "a", F.posexplode(hits).alias("_n", "_hit"))
    href = F.coalesce(F.col("a.href"), F.lit(""))
    return _shaped(rows.withColumn("pos", F.struct("_i", "_n")), keep, F.col("a.text"), F.col("a.text"), href, 2, ALIGNED_HOST)


def _shaped(rows: DataFrame, keep: list[str], dated: Column, title: Column, href: Column, method: int, host: str) -> DataFrame:
    return rows.select(
        *keep,
        extract_date(dated).alias("date"),
        title.alias("title"),
        resolve_url(href, host, "announcement").alias("url"),
        F.lit(SOURCE).alias("source"),
        F.lit(METHODS[method]).alias("extraction_method"),
        F.lit(method).alias("method_rank"),
        _order_key(method).alias("method_pos"),
    )


def _order_key(method: int) -> Column:
    """Four integers whatever the method, so that the extractors can be united."""
    zero = F.lit(0)
    if method == 0:
        parts = [F.col("pos"), zero, zero, zero]
    elif method == 1:
        parts = [F.col("pos.index"), F.col("pos.row_idx"), F.col("pos.col_idx"), F.col("pos._li")]
    else:
        parts = [F.col("pos._i"), F.col("pos._n"), zero, zero]
    return F.array(*[p.cast("int") for p in parts])


def union_extractors(*found: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, found)


def _first_titles(found: str) -> str:
    """The finds that are first of their title by method and position; null titles are equal."""
    by_title = (
        f"array_sort(transform({found}, x -> named_struct('title', x.title, 'm', x.m, 'pos', x.pos, "
        "'dated', x.dated, 'href', x.href)))"
    )
    return M.let_sql(by_title, "ft", "filter(ft, (x, i) -> i = 0 OR NOT (get(ft, i - 1).title <=> x.title))")


def extract_announcements(
    pages: DataFrame,
    html: str = "html",
    words: tuple[str, ...] = ANNOUNCEMENT_WORDS,
    entity: str = ENTITY,
) -> DataFrame:
    """Announcements of each page, first by title in (method, position) order.

    The three extractors share one reading of the page: their finds are one
    array until they leave the row.  Copies of a title lie side by side once that array
    is sorted, so only first ones leave and no page meets another.  Every row is a page.
    """
    keep = [c for c in pages.columns if c != html]
    word = M.quoted("|".join(r"\Q" + w + r"\E" for w in words))
    df = pages.select(*keep, M.visible(F.col(html)).alias("_visible"))
    df = df.withColumn("_anchors", _anchors_visible(F.col("_visible")))
    df = df.withColumn("_pieces", M.table_pieces(F.col("_visible")))
    df = df.withColumn("_tables", M.table_array("_pieces"))

    def find(rank: int, pos: str, dated: str, title: str, href: str) -> str:
        return f"named_struct('m', {rank}, 'pos', array({pos}), 'dated', {dated}, 'title', {title}, 'href', {href})"

    numbered = "transform(_anchors, (a, i) -> named_struct('a', a, 'i', i))"
    by_word = (
        f"transform(filter({numbered}, n -> n.a.href IS NOT NULL AND n.a.text rlike {word}), "
        f"n -> {find(0, 'n.i, 0, 0, 0', 'n.a.text', 'n.a.text', 'n.a.href')})"
    )
    or_blank = "coalesce(n.a.href, '')"
    hits = f"filter(n.a.own, t -> t rlike {M.quoted(entity)})"
    by_entity = (
        f"flatten(transform({numbered}, n -> transform({hits}, "
        f"(t, k) -> {find(2, 'n.i, k, 0, 0', 'n.a.text', 'n.a.text', or_blank)})))"
    )
    in_row = (
        f"flatten(transform(filter(transform(cs, (c, j) -> named_struct('c', c, 'j', j)), z -> z.c.text rlike {word}), "
        f"z -> transform(ls, (l, k) -> {find(1, 't, r, z.j, k', 'z.c.text', 'l.text', 'l.href')})))"
    )
    row_links_of = "filter(flatten(transform(cs, c -> c.links)), l -> l.href IS NOT NULL)"
    rows = f"transform({M.matches_sql('tb.body', M.ROW)}, x -> {M.cells_sql('x')})"
    by_cell = (
        f"flatten(transform(_tables, (tb, t) -> flatten(transform({rows}, "
        f"(cs, r) -> {M.let_sql(row_links_of, 'ls', in_row)}))))"
    )
    found = f"concat({by_word}, {by_cell}, {by_entity})"
    df = df.select(*keep, F.expr(f"inline_outer({_first_titles(found)})")).filter("m IS NOT NULL")
    return df.select(
        *keep,
        extract_date(F.col("dated")).alias("date"),
        "title",
        resolve_url(F.col("href"), ALIGNED_HOST, "announcement").alias("url"),
        F.lit(SOURCE).alias("source"),
        F.element_at(F.array(*[F.lit(m) for m in METHODS]), F.col("m") + 1).alias("extraction_method"),
        F.col("m").alias("method_rank"),
        F.col("pos").alias("method_pos"),
    )


def project_announcements(df: DataFrame) -> DataFrame:
    return df.select(*ANNOUNCEMENTS.fieldNames())
