"""HTML expressions that work inside one row.

A page is one row, so everything about its structure is computed from that
row's own string with regular expressions and higher-order functions.  No
token leaves the row before it has become a table, a link or a post: markup
extraction needs no shuffle and no Python worker at any scale.

The nested parts are Spark SQL text (``*_sql``, each taking and giving SQL
expressions), which the parser turns into one expression at once; the public
functions apply them to columns.  Each text names its lambda variables itself,
so texts nest freely.

Every pattern scans forward with character classes or a lazy dot.  None repeats
an alternation over page-sized text, which Java would run by recursion.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlark.functions.text import WHITESPACE

# Elements that never have content.
VOID_TAGS = (
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr",
    "image", "img", "input", "isindex", "keygen", "link", "menuitem", "meta", "nextid",
    "param", "source", "spacer", "track", "wbr",
)

TAG = r"""</?[A-Za-z][^<>"']*+(?:(?:"[^"]*+"|'[^']*+')[^<>"']*+)*+>"""
SILENT = r"<(?:!--.*?-->|!doctype[^>]*>|script\b.*?</script\s*>|style\b.*?</style\s*>)"
TOKEN = rf"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|{TAG}|<[^>]+>|[^<]+|<"
HEADING = r"<h([1-6])(?=[\s>]).*?</h\1\s*>"
# An element without tags inside: for the stack of open elements it comes and goes at once.
LEAF = r"""<(?!table[\s/>])([a-z][a-z0-9]*)(?=[\s>])[^<>"']*+(?:(?:"[^"]*+"|'[^']*+')[^<>"']*+)*+>[^<]*+</\2\s*>"""
# Each reaches to the next tag that ends it, or to the end: runs without a tag are taken at once.
LINK = r"(?is)<a(?=[\s/>])[^<]*+(?:<(?!/a\s*>|a[\s/>])[^<]*+)*+"
ROW = r"(?is)<tr(?=[\s/>])[^<]*+(?:<(?!tr[\s/>]|/tr\s*>)[^<]*+)*+"
CELL = r"(?is)<t[dh](?=[\s/>])[^<]*+(?:<(?!t[dh][\s/>]|/t[dh]\s*>)[^<]*+)*+"
# A row that holds a cell, as far as the cell's name.
ROW_WITH_CELL = r"(?is)<tr(?=[\s/>])[^<]*+(?:<(?!tr[\s/>]|/tr\s*>|t[dh][\s/>])[^<]*+)*+<t[dh][\s/>]"
TABLE_OPEN = r"(?is)^<table[\s/>]"

# A void tag takes the place of silent markup, so texts on both sides stay apart.
SEPARATOR = "<wbr>"



def quoted(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let_sql(value: str, var: str, body: str) -> str:
    """``body`` with ``var`` standing for a value that is computed once."""
    return f"get(transform(array({value}), {var} -> {body}), 0)"


def applied(col: Column, var: str, sql: str) -> Column:
    """A SQL text over one variable, applied to a column."""
    return F.get(F.call_function("transform", F.array(col), F.expr(f"{var} -> {sql}")), 0)


def mapped(arr: Column, var: str, sql: str) -> Column:
    """A SQL text over one variable, applied to each element of an array."""
    return F.call_function("transform", arr, F.expr(f"{var} -> {sql}"))


# --- texts ----------------------------------------------------------------------------------


def matches_sql(x: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract_all({x}, {quoted(pattern)}, {group})"


def _named_sql() -> str:
    """Map from the standard library's list, frequent names first; folded into a literal."""
    frequent = ["amp;", "lt;", "gt;", "quot;", "nbsp;", "copy;", "middot;"]
    names = frequent + [n for n in html5 if n.endswith(";") and n not in frequent]
    pairs = "\x01".join(f"&{n}\x02{html5[n]}" for n in names)
    return f"str_to_map({quoted(pairs)}, {quoted(chr(1))}, {quoted(chr(2))})"


_NAMED = _named_sql()


# Names that browsers also take without a semicolon, longest first.
_LEGACY = "&(?:" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))) + ")"
# What the numbers 128 to 159 stand for; five of them stay control characters.
_WINDOWS = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(128, 160))


def decode_sql(x: str, attribute: bool = False) -> str:
    """Numeric and named character references; unknown ones stay.  ``x`` is used several times.

    The semicolon may be missing.  In an attribute a name without it is taken only if
    neither a letter, a digit nor ``=`` follows, so that query strings keep their parameters.
    """
    digits = f"regexp_extract(dp, {quoted('^&#[xX]?0*([0-9A-Fa-f]+);?$')}, 1)"
    number = (
        f"CASE WHEN length(dd) > 7 THEN 1114112 WHEN dp rlike {quoted('^&#[xX]')} THEN cast(conv(dd, 16, 10) as int) "
        "ELSE cast(dd as int) END"
    )
    char = (
        f"CASE WHEN dn BETWEEN 128 AND 159 THEN substring({quoted(_WINDOWS)}, dn - 127, 1) "
        "WHEN dn = 0 OR dn BETWEEN 55296 AND 57343 OR dn > 1114111 THEN '�' "
        "WHEN dn < 9 OR dn = 11 OR dn BETWEEN 14 AND 31 OR dn = 127 OR dn BETWEEN 64976 AND 65007 "
        "OR dn % 65536 > 65533 THEN '' "
        "ELSE decode(unhex(lpad(hex(dn), 8, '0')), 'UTF-32') END"
    )
    numeric = let_sql(let_sql(digits, "dd", number), "dn", char)
    names = "named_struct('name', IF(endswith(dp, ';'), dp, concat(dp, ';')), 'rest', '')"
    if not attribute:  # a known name at the start of an unknown one
        names += ", named_struct('name', concat(dl, ';'), 'rest', substring(dp, length(dl) + 1))"
    found = f"transform(array({names}), dc -> concat(try_element_at({_NAMED}, dc.name), dc.rest))"
    named = let_sql(f"regexp_extract(dp, {quoted('^' + _LEGACY)}, 0)", "dl", f"coalesce(get(array_compact({found}), 0), dp)")
    piece = (
        f"CASE WHEN startswith(dp, '&#') AND length(dp) > 2 THEN {numeric} "
        f"WHEN startswith(dp, '&') AND length(dp) > 1 THEN {named} ELSE dp END"
    )
    legacy = _LEGACY + (r"(?![=A-Za-z0-9])" if attribute else "")
    pieces = matches_sql(x, rf"&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[A-Za-z][A-Za-z0-9]*;|{legacy}|[^&]+|&")
    return f"IF(contains({x}, '&'), array_join(transform({pieces}, dp -> {piece}), ''), {x})"


def text_nodes_sql(x: str) -> str:
    """Text between tags.  Splitting by one character avoids compiling a pattern per call."""
    return f"split(regexp_replace({x}, {quoted(f'(?is){TAG}')}, {quoted(chr(1))}), {quoted(chr(1))})"


def node_text_sql(x: str) -> str:
    """Each text node of visible markup stripped, then joined without a separator."""
    text = f"btrim({decode_sql('nt')}, {quoted(WHITESPACE)})"
    return f"array_join(transform({text_nodes_sql(x)}, nt -> {text}), '')"


def open_tag_sql(x: str) -> str:
    return f"regexp_extract({x}, {quoted(f'(?is)^{TAG}')}, 0)"


def attribute_sql(x: str, name: str) -> str:
    """Value of an attribute of an opening tag; null when it is absent."""
    shape = r"""(?is)([^\s"'<>/=]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    at = f"cast(array_position(transform({matches_sql('av', shape, 1)}, an -> lower(an)), {quoted(name)}) as int)"
    raw = let_sql(x, "av", let_sql(at, "ai", f"IF(ai > 0, get({matches_sql('av', shape, 2)}, ai - 1), NULL)"))
    bare = "regexp_replace({}, {}, '$2')".format(raw, quoted(r"""(?s)^(["'])(.*)\1$"""))
    return let_sql(bare, "ad", decode_sql("ad", attribute=True))


def attributes_sql(x: str) -> str:
    """Map of all attributes of an opening tag, names in lower case.

    An attribute without a value has the empty text; of a repeated name the first one counts.
    """
    shape = r"""(?s)([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?"""
    bare = "regexp_replace(get(ats, ai), {}, '$2')".format(quoted(r"""(?s)^(["'])(.*)\1$"""))
    value = let_sql(bare, "ad", f"IF(contains(ad, '&'), {decode_sql('ad', attribute=True)}, ad)")
    pairs = f"transform(ans, (an, ai) -> named_struct('k', an, 'v', {value}, 'first', array_position(ans, an) = ai + 1))"
    named = f"map_from_entries(transform(filter({pairs}, ap -> ap.first), ap -> struct(ap.k, ap.v)))"
    names = f"transform({matches_sql('av', shape, 1)}, an -> lower(an))"
    inner = let_sql(names, "ans", let_sql(matches_sql("av", shape, 2), "ats", named))
    return let_sql(f"regexp_replace({x}, {quoted(r'^<[^\s/>]*')}, '')", "av", inner)


def element_sql(x: str, cls: str, tag: str = "[a-z][a-z0-9]*") -> str:
    """Markup inside the first element of a class, up to its own closing tag; null without one.

    The text from the opening tag on is cut ahead of every tag of that name, and one
    pass counts the depth.  An element that is never closed reaches to the end.
    """
    value = rf"""(?:"(?:[^"]*\s)?{cls}(?:\s[^"]*)?"|'(?:[^']*\s)?{cls}(?:\s[^']*)?'|{cls}(?=[\s/>]))"""
    opening = rf"(?is)<{tag}(?=\s)[^>]*?\sclass\s*=\s*{value}[^>]*>"
    rest = f"nullif(regexp_extract({x}, {quoted(opening + '.*')}, 0), '')"
    own = f"regexp_extract(er, {quoted('^<([A-Za-z0-9]+)')}, 1)"
    cuts = f"split(er, concat({quoted('(?i)(?=</?')}, {own}, {quoted(r'[\s/>])')}))"
    depth = f"""
        aggregate(ep, named_struct('depth', 0, 'n', 0), (acc, p) -> IF(acc.n > 0 AND acc.depth = 0, acc, named_struct(
          'depth', acc.depth + CASE WHEN startswith(p, '</') THEN -1 WHEN p rlike '^<[^>]*/>' THEN 0 ELSE 1 END,
          'n', acc.n + 1)))"""
    mine = "array_join(IF(ed.depth = 0, slice(ep, 1, greatest(ed.n - 1, 0)), ep), '')"
    inner = f"regexp_replace({mine}, {quoted(f'(?is)^{TAG}')}, '')"
    return let_sql(rest, "er", let_sql(cuts, "ep", let_sql(depth, "ed", inner)))


def class_list_sql(x: str) -> str:
    """Classes in order; empty array when there are none."""
    names = "split(coalesce({}, ''), {})".format(attribute_sql(x, "class"), quoted(r"\s+"))
    return f"filter({names}, ck -> ck <> '')"


def links_sql(x: str) -> str:
    """``array<struct<href, text>>``; href is null for an anchor without one."""
    link = f"named_struct('href', {attribute_sql(open_tag_sql('la'), 'href')}, 'text', {node_text_sql('la')})"
    return f"transform({matches_sql(x, LINK)}, la -> {link})"


def first_href_sql(x: str) -> str:
    """Like :func:`links_sql`, the first link only and without its text."""
    href = attribute_sql(open_tag_sql("la"), "href")
    return f"transform(slice({matches_sql(x, LINK)}, 1, 1), la -> named_struct('href', {href}))"


def cells_sql(x: str, first_href: bool = False) -> str:
    """``array<struct<text, links>>`` of one row; the links as :func:`first_href_sql` has them on request."""
    links = first_href_sql("ce") if first_href else links_sql("ce")
    cell = f"named_struct('text', {node_text_sql('ce')}, 'links', {links})"
    return f"transform({matches_sql(x, CELL)}, ce -> {cell})"


def usable_sql(x: str) -> str:
    """The text if it can be a title, else null."""
    return let_sql(x, "ut", "IF(length(ut) BETWEEN 1 AND 99 AND NOT ut rlike '^[0-9]+$', ut, NULL)")


def headings_sql(marks: str) -> str:
    """``array<struct<at, level, text>>`` of the headings among the marks."""
    numbered = f"transform({marks}, (hm, hi) -> named_struct('at', hi, 'm', hm))"
    heads = f"filter({numbered}, hf -> hf.m rlike {quoted(f'(?is)^{HEADING}$')})"
    head = f"named_struct('at', hd.at, 'level', cast(substring(hd.m, 3, 1) as int), 'text', {node_text_sql('hd.m')})"
    return f"transform({heads}, hd -> {head})"


def table_marks_sql(marks: str) -> str:
    """Mark positions of the opening table tags."""
    numbered = f"transform({marks}, (tm, ti) -> IF(tm rlike {quoted(TABLE_OPEN)}, ti, NULL))"
    return f"array_compact({numbered})"


def nearest_sql(headings: str, before: str, level: int) -> str:
    """Text of the last heading of one level before a mark."""
    found = f"filter({headings}, nh -> nh.level = {level} AND nh.at < {before})"
    return let_sql(found, "nf", "get(nf, size(nf) - 1).text")


def heading_title_sql(headings: str, before: str) -> str:
    """First level whose nearest preceding heading is a usable title."""
    return "coalesce(" + ", ".join(usable_sql(nearest_sql(headings, before, n)) for n in range(1, 7)) + ")"


def caption_sql(body: str) -> str:
    shape = r"(?is)<caption(?=[\s/>])[^>]*>(.*?)</caption\s*>"
    text = node_text_sql(f"regexp_extract({body}, {quoted(shape)}, 1)")
    return let_sql(text, "ct", "IF(length(ct) BETWEEN 1 AND 99, ct, NULL)")


def enclosing_title_sql(headings: str, around: str) -> str:
    """First usable heading, title-like class or id of the enclosing elements, innermost first."""
    levels = [usable_sql(f"get(filter(eh, el -> el.level = {n}), 0).text") for n in range(1, 7)]
    inside = f"filter({headings}, ei -> ei.at > ee.lo AND ei.at < ee.hi)"
    heading = let_sql(inside, "eh", f"coalesce({', '.join(levels)})")
    titled = f"filter({class_list_sql('ee.head')}, ec -> contains(lower(ec), 'title') AND length(ec) < 50)"
    ident = let_sql(attribute_sql("ee.head", "id"), "ed", "IF(contains(lower(ed), 'title'), ed, NULL)")
    each = f"transform({around}, ee -> coalesce({heading}, get({titled}, 0), {ident}))"
    return f"get(array_compact({each}), 0)"


# --- column forms ---------------------------------------------------------------------------


def all_matches(col: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(col, F.lit(pattern), group)


def visible(html: Column) -> Column:
    """Markup without comments, scripts, styles and doctype."""
    return F.regexp_replace(html, f"(?is){SILENT}", SEPARATOR)


def tokens(html: Column) -> Column:
    """All tokens in document order; joined together they give the page back."""
    return all_matches(html, TOKEN)


def token_kind(token: Column) -> Column:
    return (
        F.when(token.startswith("<!--"), "comment")
        .when(token.rlike(r"(?i)^<script\b"), "script")
        .when(token.rlike(r"(?i)^<style\b"), "style")
        .when(token.startswith("</"), "close")
        .when(token.rlike(r"^<[A-Za-z]"), "open")
        .when(token.startswith("<") & (F.length(token) > 1), "declaration")
        .otherwise("text")
    )


def tag_name(token: Column) -> Column:
    return F.lower(F.regexp_extract(token, r"^</?([A-Za-z][^\s/>]*)", 1))


def open_tag(fragment: Column) -> Column:
    """The tag a fragment starts with."""
    return F.regexp_extract(fragment, f"(?is)^{TAG}", 0)


def attributes(token: Column) -> Column:
    """``map<string, string>`` of an opening tag's attributes; empty for other tokens."""
    return F.when(token.rlike(r"^<[A-Za-z]"), applied(token, "x", attributes_sql("x"))).otherwise(
        F.expr("cast(map() as map<string, string>)")
    )


def attribute(tag: Column, name: str) -> Column:
    return applied(tag, "x", attribute_sql("x", name))


def class_list(tag: Column) -> Column:
    return applied(tag, "x", class_list_sql("x"))


def decode_entities(col: Column) -> Column:
    return applied(col, "x", decode_sql("x"))


def node_text(fragment: Column) -> Column:
    return applied(fragment, "x", node_text_sql("x"))


def link_array(fragment: Column) -> Column:
    return applied(fragment, "x", links_sql("x"))


def first_inner(html: Column, tag: str) -> Column:
    """Raw content of the first element with this tag; null when there is none."""
    shape = rf"(?is)<{tag}(?=[\s/>])[^>]*>(.*?)</{tag}\s*>"
    return F.when(html.rlike(shape), F.regexp_extract(html, shape, 1))


def page_title(html: Column, stripped: bool) -> Column:
    inner = first_inner(visible(html), "title")
    text = node_text(inner) if stripped else decode_entities(inner)
    return F.coalesce(text, F.lit("无标题"))


def meta_description(html: Column) -> Column:
    metas = all_matches(visible(html), r"(?is)<meta\b[^>]*>")
    named = f"md -> {attribute_sql('md', 'name')} = 'description'"
    found = F.call_function("filter", metas, F.expr(named))
    return F.coalesce(attribute(F.get(found, 0), "content"), F.lit(""))


def count_tags(html: Column, tag: str) -> Column:
    """Opening tags outside comments, scripts and styles (those count by themselves)."""
    source = html if tag in ("script", "style") else visible(html)
    return F.regexp_count(source, F.lit(rf"(?i)<{tag}(?=[\s/>])"))


# --- tables ---------------------------------------------------------------------------------


def table_pieces(html: Column) -> Column:
    """Visible markup cut before every ``<table`` and after every ``</table>``."""
    closed = F.regexp_replace(html, r"(?i)</table\s*>", "</table>")
    return F.split(closed, r"(?i)(?=<table[\s/>])|(?<=</table>)")


def table_array(pieces: str) -> Column:
    """``array<struct<tag, body>>`` in document order from a column of pieces.

    A table owns the pieces that lie directly in it, so rows of a nested table
    belong to the nested table only.  Pages without nesting (every opening piece
    also closes) skip the fold that finds the owners.
    """
    opens = f"rlike {quoted(TABLE_OPEN)}"
    nested = f"exists({pieces}, x -> x {opens} AND NOT endswith(x, '</table>'))"
    owners = f"""
        aggregate(
          {pieces},
          named_struct('n', 0, 'open', cast(array() as array<int>), 'owner', cast(array() as array<int>)),
          (acc, x) -> CASE
            WHEN x {opens} THEN named_struct(
              'n', acc.n + 1,
              'open', IF(x LIKE '%</table>', acc.open, concat(acc.open, array(acc.n + 1))),
              'owner', concat(acc.owner, array(acc.n + 1)))
            ELSE named_struct(
              'n', acc.n,
              'open', IF(x LIKE '%</table>' AND size(acc.open) > 0,
                         slice(acc.open, 1, size(acc.open) - 1), acc.open),
              'owner', concat(acc.owner, array(IF(size(acc.open) > 0, element_at(acc.open, -1), 0))))
          END,
          acc -> acc.owner)"""
    mine = f"array_join(filter({pieces}, (x, i) -> get(ow, i) = tk), '')"
    owned = let_sql(owners, "ow", f"transform(sequence(1, array_max(ow)), tk -> {mine})")
    plain = f"filter({pieces}, x -> x {opens})"
    bodies = f"IF(exists({pieces}, x -> x {opens}), IF({nested}, {owned}, {plain}), cast(array() as array<string>))"
    return F.expr(f"transform({bodies}, tb -> named_struct('tag', {open_tag_sql('tb')}, 'body', tb))")


def row_array(body: Column) -> Column:
    """Row fragments of one table."""
    return all_matches(body, ROW)


def cell_array(row: Column) -> Column:
    return applied(row, "x", cells_sql("x"))


def cell_rows(body: Column, first_href: bool = False) -> Column:
    """The cells of every row of a table."""
    return mapped(row_array(body), "x", cells_sql("x", first_href))


def cell_text(cell: Column) -> Column:
    """Link texts joined by `` | `` when there are links, else the cell's text."""
    joined = F.array_join(F.transform(cell["links"], lambda a: a["text"]), " | ")
    return F.when(F.size(cell["links"]) > 0, joined).otherwise(cell["text"])


# --- marks: tags and whole headings, in one coordinate system -------------------------------


def mark_array(html: Column) -> Column:
    """Headings and leaf elements (whole) and all other tags of visible markup, in document order."""
    return all_matches(html, f"(?is){HEADING}|{LEAF}|{TAG}")


def enclosing_sql(marks: str) -> str:
    """Per table, its three innermost enclosing elements with their extent.

    ``array<array<struct<lo, hi, head>>>``.  One pass over the tags with a stack:
    a closing tag ends the innermost open element of its name and everything
    opened inside; a closing tag without partner is ignored.  Void, heading and leaf
    elements never enclose a table and are left out.  The document
    itself is the outermost element.
    """
    voids = ", ".join(f"'{t}'" for t in VOID_TAGS)
    name = quoted(r"^</?([A-Za-z][^\s/>]*)")
    last3 = "slice(acc.open, greatest(size(acc.open) - 2, 1), 3)"
    return f"""
        aggregate(
          filter(
            transform({marks}, (t, i) -> named_struct(
              't', t, 'i', i, 'name', lower(regexp_extract(t, {name}, 1)))),
            m -> (m.t LIKE '</%' OR NOT m.t LIKE '%</%') AND NOT m.t LIKE '%/>' AND m.name NOT IN ({voids})),
          named_struct(
            'open', array(named_struct('name', '', 'lo', -1, 'head', '', 'kept', false)),
            'extent', cast(array() as array<struct<lo:int,hi:int>>),
            'tables', cast(array() as array<array<struct<lo:int,head:string>>>)),
          (acc, m) -> CASE
            WHEN m.t LIKE '</%' THEN
              CASE WHEN exists(acc.open, e -> e.name = m.name) THEN named_struct(
                'open', slice(acc.open, 1,
                  cast(size(acc.open) - array_position(reverse(transform(acc.open, e -> e.name)), m.name) as int)),
                'extent', concat(acc.extent, transform(
                  filter(
                    slice(acc.open,
                      cast(size(acc.open) - array_position(reverse(transform(acc.open, e -> e.name)), m.name) + 1 as int),
                      size(acc.open)),
                    e -> e.kept),
                  e -> named_struct('lo', e.lo, 'hi', m.i))),
                'tables', acc.tables)
              ELSE acc END
            WHEN m.name = 'table' THEN named_struct(
              'open', concat(
                transform(acc.open, (e, k) -> IF(k >= size(acc.open) - 3,
                  named_struct('name', e.name, 'lo', e.lo, 'head', e.head, 'kept', true), e)),
                array(named_struct('name', m.name, 'lo', m.i, 'head', m.t, 'kept', false))),
              'extent', acc.extent,
              'tables', concat(acc.tables, array(
                reverse(transform({last3}, e -> named_struct('lo', e.lo, 'head', e.head))))))
            ELSE named_struct(
              'open', concat(acc.open, array(named_struct('name', m.name, 'lo', m.i, 'head', m.t, 'kept', false))),
              'extent', acc.extent,
              'tables', acc.tables)
          END,
          acc -> transform(acc.tables, around -> transform(around, e -> named_struct(
            'lo', e.lo,
            'hi', coalesce(get(filter(acc.extent, x -> x.lo = e.lo), 0).hi, 2147483647),
            'head', e.head))))"""
