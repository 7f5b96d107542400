"""Markup corner cases on literal pages."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from ledgerlark.functions import markup as M
from ledgerlark.operators import announcements, pages, posts, tables
from ledgerlark.plans import flows

NESTED = """<!DOCTYPE html><html><head><title> A&amp;B </title><meta name="description" content='d "x" &gt;'>
<script>var a="<table>";</script></head><body class="c"><h1>123</h1><!-- <table> --><div id="list-title"><div>
<table class="table a b" id=t1><tr><th>x&nbsp;</th><th>y</th></tr>
<tr><td><a href="/q?a=1&amp;b=2"> l <b>m</b></a><script>z</script> tail</td>
<td><table><tr><td>in</td></tr></table>after</td></tr></table></div></div>
<table><caption>cap</caption><tr><td>&#x4e2d;&#25991;&foo;</td></tr></table><h2>late</h2><p>unclosed<b>x</body></html>"""


def page(spark, *htmls):
    return spark.createDataFrame([(i, h) for i, h in enumerate(htmls)], "page_id int, html string")


def test_nested_tables_own_their_rows(spark):
    rows = tables.extract_tables(page(spark, NESTED), "aligned").orderBy("index").collect()
    assert [r["index"] for r in rows] == [1, 2, 3]
    # The literal header belongs to the row at position 0 only.
    assert rows[0].data == [["x", "公告链接", "y"], ["lmtail", "https://www.sse.com.cn/q?a=1&b=2", "after"]]
    assert rows[1].data == [["in"]]
    assert rows[2].data == [["中文&foo;"]]
    # h1 is all digits; the first table's container has an id; the third has a caption.
    assert [r.title for r in rows] == ["list-title", "表格_2", "cap"]


def test_titles_follow_enclosing_headings(spark):
    html = "<body><div><table><tr><td>1</td></tr></table></div><h2>late</h2></body>"
    row = tables.extract_tables(page(spark, html), "aligned").first()
    assert row.title == "late"
    far = "<body><div><div><div><div><table><tr><td>1</td></tr></table></div></div></div></div><h2>late</h2></body>"
    row = tables.extract_tables(page(spark, far), "aligned").first()
    assert row.title == "表格_1"


def test_unclosed_elements_do_not_shift_ancestors(spark):
    html = '<div class="x title-1"><p>a<b>c<table><tr><td>1</td></tr></table></div>'
    assert tables.extract_tables(page(spark, html), "aligned").first().title == "title-1"
    html = '<div class="x title-1"><p>a</p></b><i><table><tr><td>1</td></tr></table></div>'
    assert tables.extract_tables(page(spark, html), "aligned").first().title == "title-1"


def test_pages_without_tables(spark):
    df = page(spark, "<p>none</p>", None, "", "<table></table>")
    assert tables.extract_tables(df, "aligned").count() == 0
    results = tables.stock_results(df.withColumn("stock_code", F.lit("600519")), ["stock_code", "page_id"])
    got = {r.page_id: (r.success, r.tables_count, r.error) for r in results.collect()}
    missing, empty = "获取上交所 600519 页面失败", "未找到任何表格"
    assert got == {0: (False, 0, empty), 1: (False, 0, missing), 2: (False, 0, missing), 3: (False, 0, empty)}


def test_inline_pads_and_skips(spark):
    nav = "<table><tr><td>n</td></tr></table>"
    html = nav * 2 + "<table><tr><th>a</th><th>b</th></tr><tr><td><a href='./p'>l</a></td><td>x</td></tr><tr></tr></table>"
    row = tables.extract_tables(page(spark, html), "inline").first()
    assert (row["index"], row.rows, row.columns) == (3, 2, 3)
    assert row.data == [["a", "b", ""], ["l", "http://www.szse.cn/p", "x"]]


def test_total_pages(spark):
    df = page(spark, '<div class="pagination"><a>1</a><a>2</a><a>下一页</a></div>', "<p>共12页</p>", "<p></p>", '<div class="page"><a>x</a></div>')
    got = [r[0] for r in df.orderBy("page_id").select(tables.total_pages(F.col("html"))).collect()]
    assert got == [2, 12, 1, 1]


def test_profile(spark):
    html = '<html><title> t </title><body><a href="/1">贵州茅台</a><a>600519</a><!-- 茅台 --><img><script>600519</script></body></html>'
    row = pages.profile_aligned(page(spark, html)).first()
    assert (row.title, row.links_count, row.scripts_count, row.mentions) == (" t ", 2, 1, 4)
    assert [tuple(a) for a in row.all_links] == [("/1", "贵州茅台")]
    row = pages.profile_inline(page(spark, html)).first()
    assert (row.page_title, row.total_images, row.has_scripts, row.has_styles) == ("t", 1, True, False)


def test_tokens_give_the_page_back(spark):
    df = page(spark, NESTED, "a < b <c>", "<a title='x>y'>z</a>")
    back = pages.html_tokens(df).groupBy("page_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda x: x["token"]), "").alias("h")
    )
    joined = df.join(back, "page_id").filter("html <> h")
    assert joined.count() == 0


def test_announcements_order_and_dedup(spark):
    html = (
        '<a href="/1">公告 2024-01-02</a><a href="http://h">无关</a>'
        '<table><tr><td>报告 01-02</td><td><a href="x">甲</a><a href="//h/y">公告 2024-01-02</a></td></tr></table>'
        '<a href="/m">贵州茅台 <b>x</b></a><a><b>600519</b></a>'
    )
    got = announcements.extract_announcements(page(spark, html)).orderBy("method_rank", "method_pos").collect()
    host = "https://www.sse.com.cn"
    assert [(r.date, r.title, r.url, r.extraction_method) for r in got] == [
        ("2024-01-02", "公告 2024-01-02", host + "/1", "关键词匹配"),
        ("01-02", "甲", host + "/x", "表格解析"),
        ("", "贵州茅台x", host + "/m", "600519相关"),
    ]


def test_board_items(spark):
    html = (
        '<table><tbody class="listbody"><tr class="listitem"><td><div class="read">5</div></td><td></td>'
        '<td><div class="title"><a href="//h/1">t</a></div></td><td></td><td><div class="update">07-06 12:32</div></td></tr>'
        '<tr class="listitem"><td></td><td></td><td>no</td></tr><tr class="other"></tr></tbody></table>'
    )
    got = posts.extract_board_items(page(spark, html)).orderBy("pos").collect()
    assert [(r.title, r.href, r.read_count, r.reply_count, r.time) for r in got] == [
        ("t", "//h/1", "5", None, "07-06 12:32"), (None, None, None, None, None),
    ]


def test_saved_tables_fill_dates(spark):
    nav = "<table><tr><td>n</td></tr></table>"
    html = nav * 2 + (
        "<table><tr><th>编号</th><th>公告时间</th></tr><tr><td>1</td><td></td></tr><tr><td>2</td><td>d1</td></tr>"
        "<tr><td>3</td><td> </td></tr><tr><td>4</td><td>d2</td></tr></table>"
    )
    row = flows.disclosure_tables(page(spark, html), "inline").first()
    assert [r[1] for r in row.body] == ["", "d1", "d1", "d2"]


def test_entities(spark):
    df = spark.createDataFrame([("&lt;&#65;&#x42;&nbsp;&copy &bogus; &amp;amp; &#xD800;",)], "v string")
    assert df.select(M.decode_entities(F.col("v"))).first()[0] == "<AB\xa0© &bogus; &amp; \ufffd"


def test_attributes_of_tokens(spark):
    html = """<a HREF="/q?a=1&amp;b=2" title='x "y"' href=z disabled data-n = 7>t</a><br/><input checked value=a&lt;b>
<script src="s.js">if (a < b) c = "d";</script><!-- a="b" --><p class="">x="y"</p><img alt="a>b" src=i.png />"""
    got = pages.html_tokens(page(spark, html, "", None)).orderBy("page_id", "pos").collect()
    by_tag = {(r["kind"], r["tag"]): r["attributes"] for r in got if r["tag"]}
    assert by_tag["open", "a"] == {"href": "/q?a=1&b=2", "title": 'x "y"', "disabled": "", "data-n": "7"}
    assert by_tag["open", "br"] == {} and by_tag["close", "a"] == {} and by_tag["open", "p"] == {"class": ""}
    assert by_tag["open", "input"] == {"checked": "", "value": "a<b"}
    assert by_tag["script", "script"] == {"src": "s.js"}
    assert by_tag["open", "img"] == {"alt": "a>b", "src": "i.png"}
    assert all(r["attributes"] == {} for r in got if r["kind"] in ("text", "comment"))


def test_runs_between_tags_end_where_they_did(spark):
    """Rows, cells and links reach as far as the lazy patterns did; a row with a cell is found by one test."""
    old = {
        "LINK": r"(?is)<a(?=[\s/>]).*?(?=</a\s*>|<a[\s/>]|\z)",
        "ROW": r"(?is)<tr(?=[\s/>]).*?(?=<tr[\s/>]|</tr\s*>|\z)",
        "CELL": r"(?is)<t[dh](?=[\s/>]).*?(?=<t[dh][\s/>]|</t[dh]\s*>|\z)",
    }
    pieces = ["<tr>", "<TR x>", "</tr >", "<td>", "<th\n>", "</td>", "</Th>", "<a href='1'>", "</a>", "<abbr>", "<t", "<", ">", "a\n", "<tdx>", "公", "<tr", "<a/"]
    rnd = random.Random(5)
    texts = ["".join(rnd.choices(pieces, k=rnd.randrange(14))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for name, pattern in old.items():
        assert df.filter(M.all_matches(F.col("t"), getattr(M, name)) != M.all_matches(F.col("t"), pattern)).count() == 0, name
    had = F.exists(M.all_matches(F.col("t"), old["ROW"]), lambda r: r.rlike(r"(?i)<t[dh][\s/>]"))
    assert df.filter(had != F.col("t").rlike(M.ROW_WITH_CELL)).count() == 0
    silent = r"(?is)<!--.*?-->|<!doctype[^>]*>|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
    odd = ["<!--", "-->", "<!Doctype x>", "<SCRIPT>", "</script >", "<style a>", "</style>", "<scripty>", "<", "!", "x\n", ">"]
    df = spark.createDataFrame([("".join(rnd.choices(odd, k=rnd.randrange(12))),) for _ in range(3000)], "t string")
    assert df.filter(M.visible(F.col("t")) != F.regexp_replace("t", silent, "<wbr>")).count() == 0
    long = spark.range(1).select(F.concat(F.lit("<tr>"), F.repeat(F.lit("<td><a>x"), 500_000)).alias("t"))
    assert long.select(F.size(M.all_matches(F.col("t"), M.ROW)), F.size(M.all_matches(F.col("t"), M.LINK))).first()[:] == (1, 500_000)
