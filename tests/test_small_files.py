"""Queries that write a file for each page or stock."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import querybook.statements
from ledgerlark.session import shared_folder
from querybook import BOOK


def test_pages_are_written_by_many_tasks(spark, tmp_path):
    pages = spark.range(40).select(F.col("id").alias("page_id"), F.concat(F.lit("<p>"), F.col("id").cast("string")).alias("html"))
    pages.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.glob("pages-*"))
    got = {r["page_id"]: r["md5"] for r in BOOK["scan_page_files"].run(spark, str(tmp_path)).collect()}
    assert got == {r["page_id"]: r["m"] for r in pages.select("page_id", F.md5("html").alias("m")).collect()}
    (written,) = set(folder.glob("pages-*")) - before
    parts = [f.name.split("-")[1] for f in written.glob("page_id=*/part-*")]
    assert len(parts) == 40 and len(set(parts)) > 4


@pytest.mark.parametrize("name", ["statement_sink", "statement_sink_periods"])
def test_statements_are_read_by_their_schema(spark, tmp_path, monkeypatch, name):
    rows = [(i, i % 11, i % 3, "ARN"[i % 3], float(i)) for i in range(1, 40)]
    items = spark.createDataFrame(rows, "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_returnflag string, l_extendedprice double")
    items.withColumn("l_shipdate", F.lit("1995-03-04").cast("timestamp")).write.parquet(f"{tmp_path}/lineitem.parquet")
    read, given = querybook.statements.read_statements, []
    monkeypatch.setattr(querybook.statements, "read_statements", lambda s, p, schema=None: given.append(schema) or read(s, p, schema))
    got = BOOK[name].run(spark, str(tmp_path)).collect()
    assert given[0] is not None
    assert {r["code"] for r in got} == {"00000", "00010"} | {f"{i:06d}" for i in range(1, 10)}
    if name == "statement_sink":
        assert len(got) == len(rows)
    else:
        assert sum(r["rows"] for r in got) == len(rows) and {r["FISCAL_YEAR"] for r in got} == {"1995"}
