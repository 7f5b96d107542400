"""Operators on literal rows, and properties: idempotence, independence of partitioning, skew."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import cleaning, posts, search, sessions, statements
from ledgerlark.plans import chunked
from ledgerlark.session import fresh_path
from ledgerlark.sources import feeds, files

NOW = dt.datetime(2024, 1, 31)
OLD, NEW = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 30)


def items(spark, stale_by_page, size=5):
    rows = [
        ("s", page, i, "t", OLD if i < stale else NEW)
        for page, stale in stale_by_page.items()
        for i in range(size)
    ]
    return spark.createDataFrame(rows, "stock_code string, page int, pos int, title string, parsed_time timestamp_ntz")


@pytest.mark.parametrize(
    ("stale_by_page", "expected"),
    [
        ({1: 0, 2: 4, 3: 5, 4: 0}, {1, 2, 3}),  # 4 of 5 is not above the threshold
        ({2: 0, 4: 0}, {2}),  # empty page 1 goes on, empty page 3 ends it
        ({3: 0}, set()),  # page 2 is the first empty page after page 1
        ({1: 0, 2: 0}, {1, 2}),
    ],
)
def test_early_stop(spark, stale_by_page, expected):
    df = items(spark, stale_by_page)
    kept = posts.early_stop(df, posts.page_stats(df, NOW))
    assert {r.page for r in kept.select("page").distinct().collect()} == expected


def test_early_stop_limits_and_failures(spark):
    df = items(spark, {1: 0, 2: 0, 3: 0})
    stats = posts.page_stats(df, NOW)
    pages = lambda d: {r.page for r in d.select("page").distinct().collect()}
    assert pages(posts.early_stop(df, stats, max_pages=2)) == {1, 2}
    failed = spark.createDataFrame([("s", 2)], "stock_code string, page int")
    assert pages(posts.early_stop(df, stats, failed=failed)) == {1}


def test_recency_edge(spark):
    edge = NOW - dt.timedelta(days=7)
    df = spark.createDataFrame([(1, edge), (2, None), (3, edge - dt.timedelta(seconds=1))], "i int, parsed_time timestamp_ntz")
    ids = lambda d: sorted(r.i for r in d.collect())
    assert ids(posts.recent(df, NOW, keep_null=False)) == [1]
    assert ids(posts.recent(df, NOW, keep_null=True)) == [1, 2]


def test_feed_malformed_and_defaults(spark):
    pages = spark.createDataFrame(
        [("s", 1, '{"list":[{"title":null,"created_at":0,"user":{}}]}'), ("s", 2, '{"list":['), ("s", 3, '{"list":[{"title":"x"}]}'), ("t", 1, "{}")],
        "stock_code string, page int, json string",
    )
    assert [(r.stock_code, r.page) for r in feeds.failed_pages(pages).collect()] == [("s", 2)]
    got = posts.feed_discussions(feeds.flatten_feed(pages), NOW, failed=feeds.failed_pages(pages)).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.title, row.author, row.time, row.parsed_time, row.source, row.url, row.fav_count) == (
        "", "未知作者", "未知时间", "", "雪球", "", 0,
    )


@pytest.mark.parametrize(
    ("blank", "leading", "expected"),
    [
        ("empty", None, [None, "d1", "d1", " ", "d2"]),
        ("empty", "keep", ["", "d1", "d1", " ", "d2"]),
        ("trim", "keep", ["", "d1", "d1", "d1", "d2"]),
    ],
)
@pytest.mark.parametrize("size", [1, 2, 100])
def test_ffill(spark, blank, leading, expected, size):
    rows = [("k", i, v) for i, v in enumerate(["", "d1", "", " ", "d2"])]
    df = spark.createDataFrame(rows, "k string, i int, d string").repartition(3)
    out = cleaning.ffill(df, "d", ["k"], "i", chunked.dense_chunk(F.col("i"), size), blank, leading)
    assert [r.d for r in out.orderBy("i").collect()] == expected
    again = cleaning.ffill(out, "d", ["k"], "i", chunked.dense_chunk(F.col("i"), size), blank, leading)
    assert [r.d for r in again.orderBy("i").collect()] == expected


def test_rank_with_a_hot_key(spark):
    # One key holds most rows; chunks of 7 rows; any partitioning gives the same ranks.
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 1, F.col("id") % 50).otherwise(-1).alias("k"))
    expected = None
    for parts in (1, 7):
        ranked = chunked.rank_within(df.repartition(parts), ["k"], [F.col("id")], chunked.dense_chunk(F.col("id"), 7), "r")
        got = {(r.id, r.r) for r in ranked.select("id", "r").collect()}
        assert expected is None or got == expected
        expected = got
    seen: dict[int, int] = {}
    for i in range(3000):
        key = i % 50 if i % 3 == 1 else -1
        seen[key] = seen.get(key, 0) + 1
        assert (i, seen[key]) in expected


def test_keep_first(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, ""), (5, "")], "i int, title string").repartition(4)
    first = cleaning.keep_first(df, ["title"], ["i"])
    assert sorted(r.i for r in first.collect()) == [1, 2, 4]
    assert sorted(r.i for r in cleaning.keep_first(first, ["title"], ["i"]).collect()) == [1, 2, 4]


def test_pivot_first(spark):
    rows = [(0, 2023, "a", None), (1, 2023, "a", 2.0), (2, 2023, "a", 5.0), (3, 2023, "b", 3.0), (4, 2022, "b", None), (5, None, "a", 9.0)]
    df = spark.createDataFrame(rows, "o int, y int, item string, v double").repartition(3)
    for values in (["a", "b"], None):
        wide = statements.pivot_first(df, ["y"], "item", "v", "o", values)
        assert [tuple(r) for r in wide.collect()] == [(2023, 2.0, 3.0)]


def test_label_fan_out(spark):
    from ledgerlark.sources.field_map import field_map, rows

    assert len(rows()) == 33
    df = spark.createDataFrame([("年内溢利",), ("x",)], "item string")
    got = statements.label_items(df, field_map(spark), "item").collect()
    assert sorted((r.item, r.zh or "") for r in got) == [("x", ""), ("年内溢利", "净利润"), ("年内溢利", "归母净利润")]


def test_cache(spark):
    requests = spark.createDataFrame([("a",), ("b",), ("c",)], "message string")
    cache = spark.createDataFrame([("a", "A"), ("b", "")], "message string, content string")
    split = sessions.cache_split(requests, cache)
    assert {(r.message, r.status) for r in split.collect()} == {("a", "hit"), ("b", "miss"), ("c", "miss")}
    assert {r.message for r in sessions.to_process(split).collect()} == {"b", "c"}


def test_hybrid_is_exact_beyond_the_candidates(spark):
    # Vector and text rankings run against each other, so ranks outside the top lists matter.
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 97 + 1).cast("int")).alias("text"))
    emb = spark.range(400).select(
        F.col("id").alias("vec_id"), F.array(F.lit(1.0), ((F.col("id") * 37 % 400) / 400)).cast("array<float>").alias("embedding")
    )
    got = search.hybrid_topk(docs, emb, "w", [1.0, 0.0], 5, c=10).collect()
    vec = {r.vec_id: r.score for r in search.vector_scores(emb, [1.0, 0.0]).collect()}
    txt = {r.doc_id: r.score for r in search.bm25_scores(docs, "w").collect()}
    rank = lambda s: {d: i for i, (d, _) in enumerate(sorted(s.items(), key=lambda x: (-x[1], x[0])), 1)}
    rv, rt = rank(vec), rank(txt)
    best = sorted(((-(round(1 / (10 + rv[d]) + 1 / (10 + rt[d]), 9)), d) for d in rv))[:5]
    assert [(r.id, r.vec_rank, r.text_rank) for r in got] == [(d, rv[d], rt[d]) for _, d in best]


def test_vector_scores_odd_vectors(spark):
    emb = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0]), (5, [1.0, 1.0])], "vec_id int, embedding array<float>")
    got = search.vector_topk(emb, [1.0, 0.0], 10).collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 1.0), (5, 0.707107)]


def test_phrase_overlaps(spark):
    docs = spark.createDataFrame([(1, "go go, GO!"), (2, "gogo go")], "doc_id int, text string")
    assert [tuple(r) for r in search.phrase_match(docs, "go go").collect()] == [(1, 2)]


def test_repair_header(spark):
    df = spark.createDataFrame([(0, "junk", ""), (1, "a", "a"), (2, "x", "y")], "i int, c0 string, c1 string")
    out = cleaning.repair_header(df, "i", 1)
    assert out.columns == ["i", "a", "a.1"]
    assert [tuple(r) for r in out.collect()] == [(0, "x", "y")]


def test_codes_keep_leading_zeros(spark):
    path = fresh_path(spark, "codes")
    df = spark.createDataFrame([("000001", "利润表", 1.0)], "code string, statement string, v double")
    files.write_statements(df, path)
    assert files.read_statements(spark, path).first().code == "000001"


def test_select_or_null(spark):
    df = spark.createDataFrame([("x", 1)], "REPORT_DATE string, other int")
    assert statements.select_or_null(df).columns == list(statements.CORE_INCOME_A)


def test_log_routing(spark):
    df = spark.createDataFrame([("DEBUG",), ("INFO",), ("WARNING",), ("ERROR",), ("CRITICAL",)], "level string")
    got = {(r.level, r.sink) for r in files.route_by_level(df, "ERROR").collect()}
    assert {s for lv, s in got if lv == "WARNING"} == {"info", "debug"}
    assert {s for lv, s in got if lv == "ERROR"} == {"info", "debug", "error", "alert"}
    assert {s for lv, s in got if lv == "DEBUG"} == {"debug"}


def test_chinese_titles_are_searched_by_any_part(spark):
    title = "关于召开二〇二四年第一次临时股东大会的通知公告全文"
    docs = spark.createDataFrame([(1, title), (2, ""), (3, "of " + "x" * 41 + " the"), (4, "of the")], "doc_id int, text string")
    assert [r.doc_id for r in search.bm25_topk(docs, "股东大会", 5).collect()] == [1]
    assert [tuple(r) for r in search.phrase_match(docs, "临时股东大会").collect()] == [(1, 1)]
    assert [r.doc_id for r in search.phrase_match(docs, "of the").collect()] == [4]
    assert search.bm25_topk(docs, "?!", 5).count() == 0 and search.phrase_match(docs, " - ").count() == 0


def test_ranks_compare_exact_scores(spark):
    emb = spark.createDataFrame([(1, [1.0, 2e-4]), (2, [1.0, 1e-4]), (3, [0.0, 0.0])], "vec_id int, embedding array<double>")
    assert [r.vec_id for r in search.vector_topk(emb, [1.0, 0.0], 2).collect()] == [2, 1]


def test_null_keys_are_a_group_of_chunks(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, None), ("k", 3, None)], "k string, i int, d string")
    ranked = chunked.rank_within(df, ["k"], [F.col("i")], chunked.dense_chunk(F.col("i"), 1), "r").collect()
    assert sorted((r.i, r.r) for r in ranked) == [(1, 1), (2, 2), (3, 1)]
    filled = chunked.last_known(df, ["k"], [F.col("i")], chunked.dense_chunk(F.col("i"), 1), F.col("d"), "f").collect()
    assert sorted((r.i, r.f) for r in filled) == [(1, "a"), (2, "a"), (3, None)]


def test_records_of_unknown_level_reach_the_debug_sink(spark):
    from ledgerlark.sources.files import route_by_level

    log = spark.createDataFrame([("TRACE",), (None,), ("ERROR",)], "level string")
    got = sorted((str(r.level), r.sink) for r in route_by_level(log).collect())
    assert got == [("ERROR", s) for s in ("alert", "debug", "error", "info")] + [("None", "debug"), ("TRACE", "debug")]


def test_requested_stock_without_a_page_has_failed(spark):
    from ledgerlark.plans import flows

    codes = spark.createDataFrame([("000001",), ("000002",), ("000003",)], "stock_code string")
    table_ = "<table><tr><td>a</td><td>b</td></tr><tr><td>1</td><td>2</td></tr></table>"
    pages = spark.createDataFrame([("000001", 1, table_), ("000003", 1, "")], "stock_code string, page int, html string")
    venue = pages.select(flows.venue(F.col("stock_code"))).first()[0]
    got = {r.stock_code: r for r in flows.run_batch(codes, pages, venue, "inline").collect()}
    assert set(got) == {"000001", "000002", "000003"}
    assert got["000002"].error == got["000003"].error.replace("000003", "000002") == "获取深交所 000002 页面失败"
    assert not got["000002"].success and got["000002"].saved_files == []


def test_a_narrow_first_row_is_no_header(spark):
    from ledgerlark.operators import tables

    df = spark.createDataFrame([([["title"], ["a", "b"]],), ([["x", "y"], ["a", "b"]],)], "data array<array<string>>")
    got = tables.promote_header(df, "aligned").collect()
    assert [r.header for r in got] == [None, ["x", "y"]]
