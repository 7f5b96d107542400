"""Small files that tasks write and read themselves, against Spark's own writers and readers."""

from __future__ import annotations

import gzip
import os
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerlark.functions.text import norm_code
from ledgerlark.session import fresh_path
from ledgerlark.sources import files, folders
from querybook import BOOK


def _rows(df):
    return sorted(map(str, df.collect()))


def _with_files(path):
    return sorted({os.path.relpath(d, path) for d, _, names in os.walk(path) if any(n.startswith("part-") for n in names)})


def _statements(spark):
    codes = ["000001", "00700.HK", "a/b:c", "é 中", "q'\"{%", "", None]
    kinds = ["利润表", None, "x=%"]
    rows = [(codes[i % 7], kinds[i % 3], i, None if i % 4 == 0 else i * 1.5, f"t{i}" if i % 5 else None, i % 2 == 0, i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "code string, statement string, row_order bigint, AMOUNT double, t string, b boolean, period int")
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.col("row_order").cast("int"))
    at = F.lit("2020-01-01 01:02:03.000004").cast("timestamp_ntz")
    return df.withColumns({"d": day, "n": at, "c": F.col("AMOUNT").cast("decimal(12,2)"), "s": F.col("period").cast("smallint")})


def test_statement_files_are_those_of_spark(spark):
    """Folders, rows, types and their order; no Hadoop side files."""
    df = _statements(spark)
    mine, theirs = fresh_path(spark, "mine"), fresh_path(spark, "theirs")
    files.write_statements(df, mine, split=("period",))
    df.withColumn("code", norm_code(F.col("code"))).write.partitionBy("code", "statement", "period").parquet(theirs)
    assert _with_files(mine) == _with_files(theirs)
    assert {x.name.split("-")[0] for x in Path(mine).rglob("*") if x.is_file()} == {"part", "_SUCCESS"}
    for path in (mine, theirs):
        ours, read = files.read_statements(spark, path, df.schema), spark.read.schema(df.schema).parquet(path)
        assert ours.schema == read.schema
        assert _rows(ours) == _rows(read)
        assert _rows(files.read_statements(spark, path).select(*read.columns)) == _rows(read)
    keys = ["code", "statement", "period"]
    assert spark.read.parquet(mine).drop(*keys).schema == spark.read.parquet(theirs).drop(*keys).schema
    assert "Scan" not in files.read_statements(spark, mine, df.schema)._jdf.queryExecution().executedPlan().toString()


def test_filters_on_partitions_leave_out_files(spark):
    df = _statements(spark)
    path = fresh_path(spark, "pruned")
    files.write_statements(df, path)
    for file in Path(path).rglob("part-*"):
        if "code=000001" not in str(file):
            file.write_bytes(b"not parquet")
    got = files.read_statements(spark, path, df.schema).filter("code = '000001' AND statement = 'x=%'")
    assert got.count() == df.filter("code = '000001' AND statement = 'x=%'").count() > 0


def test_files_of_other_stores_and_types_are_left_to_spark(spark):
    df = spark.createDataFrame([("000001", "利润表", [1])], "code string, statement string, v array<int>")
    path = fresh_path(spark, "nested")
    files.write_statements(df, path)
    assert list(Path(path).rglob("*.crc"))
    assert files.read_statements(spark, path, df.schema).first().v == [1]
    assert folders.local_folder(spark, "viewfs://store/x") is None
    assert folders.readable_folder(spark, f"{path}/code=*") is None


def test_a_failed_writer_leaves_no_folder(spark):
    df = spark.range(5).select(F.lit("1").alias("code"), F.lit("x").alias("statement"), F.when(F.col("id") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("v"))
    path = fresh_path(spark, "failed")
    with pytest.raises(Exception, match="no"):
        files.write_statements(df, path)
    assert not os.path.exists(path)
    right = df.withColumn("v", F.lit(1))
    files.write_statements(right, path)
    with pytest.raises(FileExistsError):
        files.write_statements(right, path)


def test_large_files_are_read_by_row_groups(tmp_path):
    at = tmp_path / "code=1" / "statement=x"
    at.mkdir(parents=True)
    pq.write_table(pa.table({"v": list(range(100)), "w": ["a"] * 100}), at / "part-0.parquet", row_group_size=30)
    (at / "_hidden").write_bytes(b"x")
    (at / "empty.parquet").touch()
    top = lambda: iter([pa.RecordBatch.from_pydict({"top": ["code=1"]})])
    levels = folders._levels(str(tmp_path))
    assert levels == ("code", "statement")
    listed = lambda large: [r for b in folders._list_below(top(), str(tmp_path), levels, True, large=large) for r in b.to_pylist()]
    file = "code=1/statement=x/part-0.parquet"
    assert listed(1 << 20) == [{"file": file, "group": None, "folders": ["1", "x"]}]
    assert [r["group"] for r in listed(1)] == [0, 1, 2, 3]
    kinds = pa.schema({"V": pa.float64(), "gone": pa.string()})
    got = folders._rows_in(f"{tmp_path}/{file}", 3, kinds)
    assert got.to_pydict() == {"V": [float(i) for i in range(90, 100)], "gone": [None] * 10}
    assert folders._rows_in(f"{tmp_path}/{file}", None, kinds).num_rows == 100
    with pytest.raises(TypeError):
        folders._rows_in(f"{tmp_path}/{file}", None, pa.schema({"w": pa.int64()}))
    with pytest.raises(ValueError, match="not below"):
        list(folders._list_below(top(), str(tmp_path), ("code",), True))


def test_a_large_stock_is_one_file_a_task(spark):
    rows = spark.range(0, 150_000, 1, 3).select(F.lit("1").alias("code"), F.lit("x").alias("statement"), F.col("id").alias("v"))
    path = fresh_path(spark, "large")
    folders.write_parquet(rows, path, ["code", "statement"], "snappy")
    found = list(Path(path).rglob("part-*"))
    assert sorted(pq.read_metadata(f).num_rows for f in found) == [50_000] * 3
    got = files.read_statements(spark, path, rows.schema)
    assert got.agg(F.count("v"), F.sum("v"), F.countDistinct("v")).first()[:] == (150_000, 150_000 * 149_999 // 2, 150_000)


def test_rows_are_written_in_parts():
    batches = [pa.RecordBatch.from_pydict({"k": list("aab"), "v": [1, 2, 3]}), pa.RecordBatch.from_pydict({"k": ["b"], "v": [4]})]
    assert [(k, b.to_pydict()["v"]) for k, b in folders._runs(iter(batches))] == [("a", [1, 2]), ("b", [3]), ("b", [4])]
    parts = lambda rows: [t.num_rows for t in folders._parts(iter(batches), rows)]
    assert (parts(1), parts(4), parts(9)) == ([3, 1], [4], [4])


def test_sink_codes_are_padded_as_formatted(spark, tmp_path):
    keys = [0, 7, 10, -5, -10, 99_999, 100_010, 999_999, 1_000_000, 1_234_560, None]
    n = F.col("l_suppkey")
    old = F.when(n % 10 == 0, F.format_string("%05d.HK", n)).otherwise(F.format_string("%06d", n))
    rows = spark.createDataFrame([(k, 1, 1, "A", 1.0) for k in keys], "l_suppkey bigint, l_orderkey bigint, l_linenumber int, l_returnflag string, l_extendedprice double")
    rows.withColumn("l_shipdate", F.lit("1995-03-04").cast("timestamp")).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = [r.code for r in BOOK["statement_sink"].run(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(r[0] for r in rows.select(norm_code(old)).collect())


def test_page_files_are_those_of_spark(spark):
    """Names, bytes and addresses; pages that repeat are one file, nulls are empty texts."""
    rows = [(i % 20, None if i % 7 == 0 else "" if i % 5 == 0 else f"<p>\r\né 中 {i % 20}\n") for i in range(30)] + [(None, "x")]
    df = spark.createDataFrame(rows, "page_id bigint, html string").repartition(4, "page_id")
    mine, theirs = fresh_path(spark, "mine"), fresh_path(spark, "theirs #%")
    files.write_page_files(df, mine)
    df.write.option("lineSep", "\u0000").partitionBy("page_id").text(theirs)
    content = lambda path: {d.name: sorted(b"".join(f.read_bytes() for f in d.glob("part-*")).split(b"\0")) for d in Path(path).iterdir() if d.is_dir()}
    assert content(mine) == content(theirs)
    assert {x.name.split("-")[0] for x in Path(mine).rglob("*") if x.is_file()} == {"part", "_SUCCESS"}
    for path in (mine, theirs):
        read = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("url"), F.col("value").alias("html"))
        ours = files.read_pages(spark, path, fmt="files")
        assert ours.schema == read.schema and _rows(ours) == _rows(read)
        assert "Scan" not in ours._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(FileExistsError):
        files.write_page_files(df, mine)


def test_pages_of_one_folder(spark, tmp_path):
    """Files of the folder itself; hidden, empty and nested ones are passed over."""
    (tmp_path / "a 1.html").write_bytes("﻿<p>é</p>".encode())
    (tmp_path / "b.gz").write_bytes(gzip.compress(b"<b>"))
    (tmp_path / "empty.html").touch()
    for name in ("_c.html", ".d.html"):
        (tmp_path / name).write_bytes(b"x")
    (tmp_path / "nested").mkdir()
    (tmp_path / "nested" / "e.html").write_bytes(b"x")
    read = spark.read.text(str(tmp_path), wholetext=True).select(F.input_file_name().alias("url"), F.col("value").alias("html"))
    got = files.read_pages(spark, str(tmp_path), fmt="files")
    assert _rows(got) == _rows(read) and got.count() == 2
    one = files.read_pages(spark, str(tmp_path / "a 1.html"), fmt="files")
    assert one.count() == 1
