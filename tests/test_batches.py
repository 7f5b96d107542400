"""Nearest vectors of many queries, quantiles from sketches, rotated logs, board pages with unquoted classes."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.functions import logs as G
from ledgerlark.operators import posts, search, sessions
from ledgerlark.session import fresh_path
from ledgerlark.sources import files


@pytest.mark.parametrize("tile, block", [(4096, 16_384), (3, 7)])
def test_batch_of_vectors_equals_single_queries(spark, monkeypatch, tile, block):
    monkeypatch.setattr(search, "TILE_QUERIES", tile)
    monkeypatch.setattr(search, "BLOCK_VECTORS", block)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(60)]  # many ties and zero vectors
    rows += [(60, None), (61, [1.0, None, 2.0, 0.0]), (62, [1.0, 2.0]), (63, [float("nan")] * 4), (64, []), (65, [2.0, 4.0])]
    emb = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = search.vector_topk_batch(emb, F.col("vec_id") % 6 < 2, 5).collect()
    mine = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        mine.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], round(r["score"], 5)))
    usable = {i: v for i, v in rows if v and None not in v and not any(map(math.isnan, v)) and any(v)}
    assert set(mine) == {i for i in usable if i % 6 < 2}
    for q, found in mine.items():
        cos = lambda w, v=usable[q]: np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w)
        scored = sorted((-round(float(cos(w)), 9), i) for i, w in usable.items() if len(w) == len(usable[q]))[:5]
        assert found == [(n + 1, i, round(-s, 5)) for n, (s, i) in enumerate(scored)]


def test_no_queries_and_no_vectors(spark):
    emb = spark.createDataFrame([(1, [1.0])], "vec_id bigint, embedding array<float>")
    assert search.vector_topk_batch(emb, F.col("vec_id") > 5, 3).count() == 0
    assert search.vector_topk_batch(emb.limit(0), F.col("vec_id") > 0, 3).count() == 0


def test_quantiles_are_within_the_stated_error(spark):
    rng = random.Random(2)
    rows = [(i, f"2024-01-0{1 + i % 5} 10:00:00", 200 if i % 3 else 500, round(rng.lognormvariate(0, 2), 2)) for i in range(3000)]
    log = spark.createDataFrame(rows, "i int, ts string, status int, s double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    log = log.withColumn("message", G.request_line(F.lit("u"), F.col("status"), F.col("s")))
    path = fresh_path(spark, "sketch")
    sessions.request_sketches(log).write.partitionBy("day").parquet(path)
    back = spark.read.parquet(path)
    for days in (5, 2):
        kept = back.filter(F.dayofmonth("day") <= days)
        for r in sessions.sketch_quantiles(kept, (0.01, 0.5, 0.95, 1.0)).collect():
            times = sorted(s for i, _, status, s in rows if status == r["status"] and s > 0 and 1 + i % 5 <= days)
            for q, name in ((0.01, "p1"), (0.5, "p50"), (0.95, "p95"), (1.0, "p100")):
                exact = times[math.ceil(q * len(times)) - 1]
                assert abs(r[name] - exact) <= sessions.ERROR * exact * (1 + 1e-6) + 1e-6


@pytest.mark.parametrize("max_bytes, keep, chunk", [(60, 3, 4), (60, 1000, 65_536), (10, 2, 5)])
def test_rotated_files(spark, max_bytes, keep, chunk):
    rng = random.Random(3)
    rows = [(s, i, "é" * rng.randrange(0, 12)) for s in ("a", "b", None) for i in range(rng.choice([1, 40]) if s else 20)]
    planned = files.rotated(spark.createDataFrame(rows, "sink string, seq bigint, line string"), "seq", max_bytes, keep, chunk_rows=chunk)
    got = planned.collect()
    for sink in ("a", "b", None):
        mine = sorted((r["seq"], r["file"], len(r["line"].encode()) + 1) for r in got if r["sink"] == sink)
        every = sorted(i for s, i, _ in rows if s == sink)
        assert [i for i, _, _ in mine] == every[len(every) - len(mine) :]  # the newest lines, none lost among them
        assert [f for _, f, _ in mine] == sorted(f for _, f, _ in mine)
        for f in {f for _, f, _ in mine}:
            sizes = [n for _, g, n in mine if g == f]
            assert sum(sizes) <= max_bytes or len(sizes) == 1
        newest = max(f for _, f, _ in mine)
        assert min(f for _, f, _ in mine) > newest - keep
        assert keep < 1000 or len(mine) == len(every)


def test_files_hold_their_lines_in_order(spark):
    rows = [("a", i, f"line {i}") for i in range(50)]
    path = fresh_path(spark, "rotated")
    planned = files.rotated(spark.createDataFrame(rows, "sink string, seq bigint, line string"), "seq", 100, 3)
    files.write_rotated(planned, path)
    texts = spark.read.text(path, wholetext=True).select("value", "file").orderBy("file").collect()
    assert len(texts) == 3
    lines = "".join(r["value"] for r in texts).splitlines()
    assert lines == [f"line {i}" for i in range(50 - len(lines), 50)]


@pytest.mark.parametrize("attribute", ["class=listbody", "class='listbody x'", 'class="a listbody"', "CLASS = listbody"])
def test_board_rows_with_any_quoting(spark, attribute):
    cells = "<td><div class=read>5</div></td><td><div class=reply>2</div></td><td><div class=title><a href=/n/1>t</a></div></td>"
    cells += "<td><div class=author><a>w</a></div></td><td><div class=update>01-02 03:04</div></td>"
    html = f"<table><tbody {attribute}><tr class=listitem>{cells}</tr></tbody><tbody><tr class=listitem>{cells}</tr></tbody></table>"
    df = spark.createDataFrame([(1, html), (2, "<p>none</p>"), (3, None)], "page int, html string")
    (r,) = posts.extract_board_items(df).collect()
    assert (r["page"], r["pos"], r["title"], r["href"], r["author"], r["time"]) == (1, 1, "t", "/n/1", "w", "01-02 03:04")
    assert (r["read_count"], r["reply_count"]) == ("5", "2")
