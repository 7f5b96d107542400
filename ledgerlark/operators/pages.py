"""Page-level operators: tokens, links, metadata, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions import markup as M
from ledgerlark.functions.text import mention_flags
from ledgerlark.plans.emit import each

# What a page profile looks for.
EXACT_TERMS = {"contains_600519": "600519", "contains_茅台": "茅台", "contains_公告": "公告"}
FOLDED_TERMS = {"contains_company": "company", "contains_announcement": "announcement"}
ENTITY = "600519|茅台|贵州茅台"
PROFILE_LINKS = 20


def html_tokens(pages: DataFrame, html: str = "html") -> DataFrame:
    """(page columns, pos, kind, tag, token, attributes); pos starts at 0.  A generator, no shuffle.

    ``attributes`` is a map; who does not select it does not pay for it.  Scripts and styles are one token
    with their content; their own attributes are those of the opening tag.
    """
    keep = [c for c in pages.columns if c != html]
    rows = each(pages, keep, M.tokens(F.col(html)), "pos", "token")
    token = F.col("token")
    # Text, comments and closing tags have no attributes; of a script or style only the opening tag is read.
    opening = F.when(M.token_kind(token).isin("script", "style"), M.open_tag(token)).otherwise(token)
    return rows.select(
        *keep,
        "pos",
        M.token_kind(token).alias("kind"),
        M.tag_name(token).alias("tag"),
        "token",
        M.attributes(opening).alias("attributes"),
    )


def with_depth(tokens: DataFrame, page_key: str) -> DataFrame:
    """Nesting depth by running sum over one page, void elements excluded.

    One page's tokens come from one row, so the window's groups are bounded.
    """
    step = (
        F.when(F.col("kind").isin("text", "comment", "script", "style", "declaration"), 0)
        .when(F.col("tag").isin(*M.VOID_TAGS) | F.col("token").endswith("/>"), 0)
        .when(F.col("kind") == "open", 1)
        .otherwise(-1)
    )
    w = Window.partitionBy(page_key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return tokens.withColumn("depth", F.sum(step).over(w))


def extract_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """(page columns, pos, href, text) of every ``<a href>``; pos is 1-based."""
    keep = [c for c in pages.columns if c != html]
    links = F.filter(M.link_array(M.visible(F.col(html))), lambda a: a["href"].isNotNull())
    return each(pages, keep, links, "_i", "a").select(
        *keep, (F.col("_i") + 1).alias("pos"), F.col("a.href").alias("href"), F.col("a.text").alias("text")
    )


def first_links(html: Column, n: int = PROFILE_LINKS) -> Column:
    links = F.filter(M.link_array(M.visible(html)), lambda a: a["href"].isNotNull())
    return F.slice(links, 1, n)


def mention_count(html: Column, pattern: str) -> Column:
    """Text nodes that match; comments, scripts and styles count as text nodes too."""
    nodes = F.filter(M.tokens(html), lambda t: ~M.token_kind(t).isin("open", "close", "declaration"))
    tags = M.quoted(r"(?is)^<(?:script|style)\b[^>]*>|</(?:script|style)\s*>$")
    inner = M.mapped(nodes, "x", M.let_sql(f"regexp_replace(x, {tags}, '')", "y", M.decode_sql("y")))
    return F.size(F.filter(inner, lambda t: t.rlike(pattern)))


def profile_aligned(pages: DataFrame, html: str = "html", entity: str = ENTITY) -> DataFrame:
    """Counts, flags, mentions and the first 20 links; a projection, no shuffle."""
    h = F.col(html)
    keep = [c for c in pages.columns if c != html]
    flags = mention_flags(h, EXACT_TERMS, FOLDED_TERMS)
    return pages.select(
        *keep,
        M.page_title(h, stripped=False).alias("title"),
        M.meta_description(h).alias("meta_description"),
        *[M.count_tags(h, t).alias(f"{n}_count") for t, n in
          (("a", "links"), ("table", "tables"), ("form", "forms"), ("script", "scripts"), ("div", "divs"))],
        *[c.alias(n) for n, c in flags.items()],
        mention_count(h, entity).alias("mentions"),
        first_links(h).alias("all_links"),
    )


def profile_inline(pages: DataFrame, html: str = "html") -> DataFrame:
    h = F.col(html)
    keep = [c for c in pages.columns if c != html]
    return pages.select(
        *keep,
        M.count_tags(h, "table").alias("total_tables"),
        M.count_tags(h, "a").alias("total_links"),
        M.count_tags(h, "img").alias("total_images"),
        M.page_title(h, stripped=True).alias("page_title"),
        M.meta_description(h).alias("meta_description"),
        (M.count_tags(h, "form") > 0).alias("has_forms"),
        (M.count_tags(h, "script") > 0).alias("has_scripts"),
        (M.count_tags(h, "style") > 0).alias("has_styles"),
    )


def page_meta(pages: DataFrame, stripped: bool = True, html: str = "html") -> DataFrame:
    keep = [c for c in pages.columns if c != html]
    return pages.select(
        *keep,
        M.page_title(F.col(html), stripped).alias("title"),
        M.meta_description(F.col(html)).alias("meta_description"),
    )
