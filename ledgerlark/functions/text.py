"""Scalar string functions.  Digits are ASCII digits throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as white space when text is stripped.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85  "
    "           "
    "    　"
)

# Words that mark a disclosure announcement.
ANNOUNCEMENT_WORDS = ("公告", "年报", "季报", "半年报", "报告", "通知", "披露")

# Date shapes in order of preference (by shape, not by position).
DATE_SHAPES = (
    r"(\d{4}-\d{2}-\d{2})",
    r"(\d{4}/\d{2}/\d{2})",
    r"(\d{4}年\d{2}月\d{2}日)",
    r"(\d{2}-\d{2})",
    r"(\d{2}/\d{2})",
)

# Table classes that say nothing about a table's content.
GENERIC_CLASSES = ("table", "table-hover", "table-striped")


def strip(col: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(col, F.lit(WHITESPACE))


def blank_to_null(col: Column) -> Column:
    return F.nullif(strip(col), F.lit(""))


def resolve_url(col: Column, host: str, rule: str) -> Column:
    """Absolute form of a link; ``rule`` names the page family it came from."""
    rooted = F.concat(F.lit(host), col)
    below = F.concat(F.lit(host + "/"), col)
    if rule == "aligned":
        return (
            F.when(col.startswith("//"), F.concat(F.lit("https:"), col))
            .when(col.startswith("/"), rooted)
            .otherwise(col)
        )
    if rule == "inline":
        return (
            F.when(col.startswith("/"), rooted)
            .when(col.startswith("./"), F.concat(F.lit(host), F.substr(col, F.lit(2))))
            .when(col.startswith("http"), col)
            .otherwise(below)
        )
    if rule == "board":
        return (
            F.when(col.startswith("//"), F.concat(F.lit("http:"), col))
            .when(col.startswith("/"), rooted)
            .otherwise(col)
        )
    if rule == "announcement":
        return F.when(col.startswith("http"), col).when(col.startswith("/"), rooted).otherwise(below)
    raise ValueError(f"unknown link rule: {rule}")


def page_url(template: str, *cols: Column) -> Column:
    """Fill a printf-style URL template."""
    return F.format_string(template, *cols)


def extract_date(col: Column) -> Column:
    """First date *shape* that occurs anywhere in the text, else ``''``."""
    found = [F.nullif(F.regexp_extract(col, shape, 1), F.lit("")) for shape in DATE_SHAPES]
    return F.coalesce(*found, F.lit(""))


def safe_filename(index: Column, title: Column, squash_ws: bool = False) -> Column:
    """``NN_title.csv`` with unsafe characters replaced and the title cut at 50."""
    name = F.regexp_replace(title, r'[<>:"/\\|?*]', "_")
    if squash_ws:
        name = F.regexp_replace(name, r"(?U)\s+", "_")
    return F.format_string("%02d_%s.csv", index, F.substring(name, 1, 50))


def preview(title: Column, text: Column, n: int | None = 100) -> Column:
    """Title if there is one, else the text, cut to ``n`` characters."""
    short = text
    if n is not None:
        cut = F.concat(F.substring(text, 1, n), F.lit("..."))
        short = F.when(F.length(text) > n, cut).otherwise(text)
    return F.when(F.length(title) > 0, title).otherwise(short)


def valid_title(col: Column) -> Column:
    return F.coalesce(F.length(col).between(1, 99) & ~col.rlike("^[0-9]+$"), F.lit(False))


def label_classes(classes: Column, n: int = 2) -> Column:
    """The first ``n`` classes that are not generic table classes."""
    return F.slice(F.filter(classes, lambda c: ~c.isin(*GENERIC_CLASSES)), 1, n)


def has_keyword(col: Column, words: tuple[str, ...] = ANNOUNCEMENT_WORDS) -> Column:
    quoted = "|".join(r"\Q" + w + r"\E" for w in words)
    return col.rlike(quoted)


def mention_flags(text: Column, terms: dict[str, str], folded: dict[str, str]) -> dict[str, Column]:
    """Flags by name: exact substrings, and substrings of the lower-cased text."""
    flags = {name: text.contains(term) for name, term in terms.items()}
    flags |= {name: F.lower(text).contains(term) for name, term in folded.items()}
    return flags


def venue(col: Column) -> Column:
    """Exchange of a six-character code; null when it has none."""
    first = F.substring(col, 1, 1)
    return F.when(
        F.length(col) == 6,
        F.when(first == "6", "Shanghai").when(first.isin("0", "3"), "Shenzhen"),
    )


def is_hk(col: Column, market: str | None = None) -> Column:
    return F.lit(True) if market == "hk" else col.endswith(".HK")


def market_symbol(col: Column, market: str | None = None) -> Column:
    """Vendor symbol: bare HK number, or SH/SZ prefix for six-digit codes."""
    mainland = F.when(
        col.rlike("^[0-9]{6}$"),
        F.concat(F.when(col.startswith("6"), "SH").otherwise("SZ"), col),
    ).otherwise(col)
    return F.when(is_hk(col, market), F.replace(col, F.lit(".HK"), F.lit(""))).otherwise(mainland)


def norm_code(col: Column) -> Column:
    bare = F.when(col.endswith(".HK"), F.replace(col, F.lit(".HK"), F.lit(""))).otherwise(col)
    return F.substring(bare, 1, 6)


def profile_url(post_id: Column, path: Column, host: str) -> Column:
    """Host + the author's picture path.

    Surely meant to be the post's own link, but results must stay comparable
    with data produced so far, so the behaviour is kept.
    """
    has_id = F.coalesce((post_id.cast("string") != "") & (post_id.cast("string") != "0"), F.lit(False))
    return F.when(has_id, F.concat(F.lit(host), F.coalesce(path, F.lit("")))).otherwise("")


def vector_peek(col: Column, n: int = 5) -> tuple[Column, Column]:
    """First ``n`` entries and the dimension of a vector."""
    return F.slice(col, 1, n), F.size(col)


def add(x: Column, y: Column) -> Column:
    return x + y


def report_kind(col: Column) -> Column:
    """Half-year before annual: every half-year title also holds ``年度报告``."""
    return (
        F.when(col.rlike("半年"), "half_year")
        .when(col.rlike("年度报告|年报"), "annual")
        .when(col.rlike("季"), "quarterly")
    )
