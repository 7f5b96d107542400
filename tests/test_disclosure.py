"""The merged disclosure table: header, fill across pages, files, results; fill inside a row."""

from __future__ import annotations

import csv
import io
from pathlib import Path

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlark.operators import cleaning, tables
from ledgerlark.plans import flows
from ledgerlark.session import fresh_path
from ledgerlark.sources import files

FOUND = "stock_code string, page int, data array<array<string>>"
HEAD = ["公告时间", "标题"]


def merged_by_hand(pages: dict[int, list]) -> list[list[str]]:
    """All rows of a stock in page order, later pages without their first row; dates filled below the header."""
    rows = [list(r) for p in sorted(pages) for r in (pages[p] if p == 1 else pages[p][1:])]
    if not rows:
        return []
    header, body = rows[0], rows[1:]
    label = any("公告时间" in c for c in header) and body or (body and any("公告时间" in c for c in body[0]))
    at = next((i for i, h in enumerate(header) if "时间" in h or "日期" in h), 0)
    last = None
    for row in body if label else ():
        if row[at].strip():
            last = row[at]
        elif last is not None:
            row[at] = last
    return [header, *body]


CASES = {
    "gaps on top of later pages": {1: [HEAD, ["", "a"], ["d1", "b"]], 2: [HEAD, ["", "c"], [" ", "d"], ["d2", "e"]], 3: [HEAD, ["", "f"]]},
    "pages without dates": {1: [HEAD, ["d1 ", "a"]], 2: [HEAD, ["", "b"]], 3: [HEAD], 4: [HEAD, ["\t", "c"]]},
    "page 1 failed": {2: [HEAD, ["d0", "公告时间"], ["", "a"], ["d1", "b"]], 5: [HEAD, ["", "c"]]},
    "no label": {1: [["x", "日期"], ["1", ""], ["2", "d"], ["3", ""]]},
    "label in the first data row": {1: [["x", "日期"], ["公告时间", "d"]], 2: [["x", "日期"], ["3", ""]]},
    "date column in the middle": {1: [["标题", "公告时间"], ["a", ""], ["b", "d"]], 2: [["标题", "公告时间"], ["c", ""]]},
    "header only": {1: [HEAD]},
    "header on page 1, rows from page 3": {1: [HEAD], 2: [HEAD], 3: [HEAD, ["", "a"], ["d", "b"]]},
    "only headers of later pages": {2: [HEAD], 3: [HEAD]},
    "signs of csv": {1: [HEAD, ['d,1', 'say "x"'], ["", "line\nbreak"]]},
}


@pytest.mark.parametrize("pages_per_chunk", [1, 2, 4096])
def test_merged_pages(spark, pages_per_chunk):
    rows = [(f"s{i}", p, data) for i, case in enumerate(CASES.values()) for p, data in case.items()]
    merged = tables.merged_pages(spark.createDataFrame(rows, FOUND), pages_per_chunk=pages_per_chunk)
    lines = tables.merged_lines(merged).collect()
    for i, (name, case) in enumerate(CASES.items()):
        mine = sorted((r["line_no"], r["line"]) for r in lines if r["stock_code"] == f"s{i}")
        want = merged_by_hand(case)
        assert [n for n, _ in mine] == list(range(len(want))), name
        assert [next(csv.reader(io.StringIO(line))) for _, line in mine] == want, name


def test_files_and_results(spark):
    page = lambda rows: "<table></table><table></table><table>" + "".join(
        "<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"
    pages = [("000001", 1, page([HEAD, ["d1", "a"]])), ("000001", 2, page([HEAD, ["", "b"], ["d2", "c"]])), ("000002", 1, "<p>none</p>")]
    pages += [("300003", 1, page([HEAD, ["", "x"]])), ("300003", 2, "<p></p>")]
    pages = spark.createDataFrame(pages, "stock_code string, page int, html string")
    path = fresh_path(spark, "merged")
    lines, results = flows.disclosure_merged(pages, path)
    assert sorted(map(tuple, lines.collect())) == sorted(
        [("000001", x) for x in ("公告时间,标题", "d1,a", "d1,b", "d2,c")] + [("300003", x) for x in ("公告时间,标题", ",x")]
    )
    text = spark.read.text(f"{path}/stock_code=000001", wholetext=True).first()[0]
    assert text.splitlines() == ["公告时间,标题", "d1,a", "d1,b", "d2,c"]
    got = {r["stock_code"]: r for r in results.collect()}
    assert got["000001"]["saved_file"] == "financial/000001/03_信息披露_多页合并.csv"
    assert got["000001"]["base_dir"] == "financial/000001" and got["000001"]["total_rows"] == 4
    assert (got["300003"]["successful_pages"], got["300003"]["total_pages"], got["300003"]["total_rows"]) == (1, 2, 2)
    assert not got["000002"]["success"] and got["000002"]["saved_file"] is None and got["000002"]["error"]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.lists(st.sampled_from(["", " ", "d1", "d2"]), min_size=0, max_size=3), max_size=8),
    st.sampled_from([None, "d0"]),
    st.integers(0, 2),
)
def test_fill_inside_a_row(spark, rows, before, at):
    for blank in ("trim", "empty"):
        gap = (lambda c: not c.strip()) if blank == "trim" else (lambda c: not c)
        want, last = [], before
        for row in rows:
            row = list(row)
            if at < len(row):
                if gap(row[at]):
                    row[at] = last if last is not None else row[at]
                else:
                    last = row[at]
            want.append(row)
        df = spark.createDataFrame([(rows, before)], "data array<array<string>>, b string")
        got = df.select(cleaning.ffill_rows(F.col("data"), F.lit(at), F.col("b"), blank).alias("x")).first()["x"]
        assert got == want


@pytest.mark.parametrize("mode", ["aligned", "inline"])
def test_capped_tables_are_the_first_with_cells(spark, mode):
    full = "<table><tr><td>{}</td></tr></table>"
    bare = "<table><tr></tr></table><table></table>"
    html = [
        bare + full.format(1) + bare + full.format(2) + full.format(3),
        full.format(4) + full.format(5) + full.format(6) + "<table><TR><TH >7</TABLE>" + full.format(8),
        "<table><tr><td>9<table><tr><td>in</td></tr></table></td></tr></table>",
        bare, "<p>no table</p>", "", None,
    ]
    pages = spark.createDataFrame(list(enumerate(html)), "pid int, html string")
    every = tables.extract_tables(pages, mode, titles=False)
    for n in (1, 2, 9):
        got = tables.extract_tables(pages, mode, max_tables=n, titles=False)
        by_page = {}
        for r in every.orderBy("pid", "index").collect():
            by_page.setdefault(r.pid, []).append(r)
        assert sorted(map(str, got.collect())) == sorted(str(r) for rows in by_page.values() for r in rows[:n])
    outer = tables.extract_tables(pages, mode, max_tables=1, titles=False, outer=True)
    assert {r.pid for r in outer.collect()} == set(range(len(html)))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def _by_folder(path):
    return {d.name: [f.read_bytes() for f in sorted(d.glob("part-*"))] for d in Path(path).iterdir() if d.is_dir()}


def test_line_files_are_those_of_spark(spark):
    """Names of folders, nulls, breaks and order as Spark's own writer and reader have them; no Hadoop side files."""
    stocks = ["000001", "a/b:c=%d", "é 中", "q'\"{}[]^#*?\\", "", None]
    texts = ["x,1", "", None, "two\nlines", "cr\rcr", "三", "﻿mark"]
    rows = [(s, n, texts[(n + i) % len(texts)]) for i, s in enumerate(stocks) for n in range(20)]
    lines = spark.createDataFrame(rows, "stock_code string, line_no int, line string").repartition(5)
    mine, theirs = fresh_path(spark, "mine"), fresh_path(spark, "theirs")
    files.write_lines(lines, mine)
    one = lines.repartition(1).sortWithinPartitions("stock_code", "line_no").select("stock_code", "line")
    one.write.partitionBy("stock_code").text(theirs)
    alike = lambda found: {k: sorted(b"".join(v).split(b"\n")) for k, v in found.items()}  # noqa: E731  two values share the null's folder
    assert alike(_by_folder(mine)) == alike(_by_folder(theirs))
    assert not [x for x in Path(mine).rglob("*") if x.is_file() and not x.name.startswith(("part-", "_"))]
    read = spark.read.schema("line string, stock_code string").text(theirs).select("stock_code", "line")
    for path in (mine, theirs):
        got = files.read_lines(spark, path)
        assert got.columns == ["stock_code", "line"]
        order = lambda df: sorted(map(str, df.collect()))
        assert order(got) == order(spark.read.schema("line string, stock_code string").text(path).select("stock_code", "line"))
    assert read.count() == files.read_lines(spark, mine).count()
    with pytest.raises(FileExistsError):
        files.write_lines(lines, mine)


def test_lines_of_a_large_stock_are_many_files_in_order(spark):
    rows = spark.range(100).select(F.lit("s").alias("stock_code"), F.col("id").cast("int").alias("line_no"), F.col("id").cast("string").alias("line"))
    path = fresh_path(spark, "large")
    files.write_lines(rows.repartition(7), path, lines_per_file=30)
    found = _by_folder(path)["stock_code=s"]
    assert [len(x.splitlines()) for x in found] == [30, 30, 30, 10]
    assert b"".join(found).split() == [str(i).encode() for i in range(100)]
    assert files.read_lines(spark, path).distinct().count() == 100


def test_a_task_that_runs_again_puts_the_same_file(tmp_path):
    batch = pa.RecordBatch.from_pydict({"folder": ["a", "a", "b"], "part": [0, 0, 0], "line": [b"1", b"2", b"3"]})

    def broken():
        yield batch.slice(0, 1)
        raise RuntimeError

    with pytest.raises(RuntimeError):
        list(files._write_files(broken(), str(tmp_path), "k"))
    assert not [x for x in tmp_path.rglob("*") if x.is_file()]
    for _ in range(2):
        assert [b.to_pydict() for b in files._write_files(iter([batch]), str(tmp_path), "k")] == [{"files": [2]}]
    assert _by_folder(tmp_path) == {"k=a": [b"1\n2\n"], "k=b": [b"3\n"]}
