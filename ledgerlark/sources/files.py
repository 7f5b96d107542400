"""Readers of landed files and writers of results."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from functools import partial
from itertools import groupby
from operator import itemgetter
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.logs import LEVEL_RANK, level_rank
from ledgerlark.functions.text import norm_code
from ledgerlark.plans import chunked
from ledgerlark.session import ship_package
from ledgerlark.sources import folders
from ledgerlark.sources.folders import folder_column, folder_name, folder_value, local_folder


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed pages: a parquet table, or one UTF-8 file per page (``fmt='files'``).

    Files below a ``file:`` folder are listed and read by tasks, many in one task; others by Spark.
    """
    if fmt == "parquet":
        return spark.read.parquet(path)
    root = folders.readable_folder(spark, path)
    if root is not None:
        return folders.read_texts(spark, root).withColumnRenamed("text", "html")
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.input_file_name().alias("url"), F.col("value").alias("html"))


def write_page_files(pages: DataFrame, path: str, by: str = "page_id") -> None:
    """(by, text) as text files, one folder for each value of ``by``; a zero byte ends each text.

    Each partition is written by its task, so rows should be dealt by ``by`` to all
    cores.  Below a ``file:`` folder tasks write the files themselves, as in :func:`write_lines`.
    """
    root = local_folder(pages.sparkSession, path)
    if root is None:
        pages.write.mode("errorifexists").option("lineSep", "\u0000").partitionBy(by).text(path)
        return
    (text,) = (c for c in pages.columns if c != by)
    line = F.col(text).cast("binary").alias("line")
    dealt = pages.select(folder_column(by).alias("folder"), F.spark_partition_id().cast("bigint").alias("part"), line)
    with folders.NewFolder(pages.sparkSession, root):
        written = dealt.sortWithinPartitions("folder").mapInArrow(partial(_write_files, root=root, by=by, end=b"\0"), "files bigint")
        written.agg(F.sum("files")).collect()


def read_statements(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """Statements partitioned by code and statement; a missing partition has no rows.

    Codes are strings: pass a schema that says so, or leave it out and the code
    is read as text from the partition directories.  Without a schema all folders are
    listed once more and footers read, to merge the columns.  With one, small files below a
    ``file:`` folder are listed and read by tasks, many in one task.  Filters on partition
    columns leave out files either way.
    """
    folder = folders.readable_folder(spark, root) if schema is not None else None
    if folder is not None and (small := folders.read_parquet(spark, folder, schema)) is not None:
        return small
    if schema is None:
        data = spark.read.option("mergeSchema", "true").parquet(root).schema
        fields = [T.StructField("code", T.StringType()) if f.name == "code" else f for f in data.fields]
        schema = T.StructType(fields)
    return spark.read.schema(schema).parquet(root)


def write_csv(df: DataFrame, path: str, by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """CSV with header, partitioned by ``by``.  No byte-order mark.

    Spark writes no file for an empty partition of ``by``, so only non-empty
    results appear.
    """
    out = df.hint("rebalance", *by) if by else df
    writer = out.write.mode(mode).option("header", True).option("encoding", "UTF-8")
    # Quotes are doubled, as other CSV readers expect.
    writer = writer.option("escape", '"').option("emptyValue", "")
    (writer.partitionBy(*by) if by else writer).csv(path)


def write_lines(
    lines: DataFrame, path: str, by: str = "stock_code", order: str = "line_no", lines_per_file: int = 65_536
) -> None:
    """(by, order, line) as text files, one folder for each value of ``by``, its lines in order.

    A large value's lines are spread over several files whose names sort as their lines
    do, a small one has one file.  Below a ``file:`` folder, where Hadoop starts five
    ``chmod`` processes for each folder with its file, tasks write the files themselves, in
    files of ``lines_per_file``; any other store is written by Spark, rows dealt by ranges.
    """
    root = local_folder(lines.sparkSession, path)
    if root is None:
        out = lines.repartitionByRange(by, order).sortWithinPartitions(by, order).select(by, "line")
        out.write.mode("errorifexists").partitionBy(by).text(path)
        return
    os.makedirs(root)
    ship_package(lines.sparkSession)
    part = F.coalesce(F.floor(F.col(order) / lines_per_file), F.lit(0)).cast("bigint")
    dealt = lines.select(folder_column(by).alias("folder"), part.alias("part"), F.col(order).alias("at"), F.col("line").cast("binary").alias("line"))
    sorted_lines = dealt.repartition("folder", "part").sortWithinPartitions("folder", "part", "at").drop("at")
    sorted_lines.mapInArrow(partial(_write_files, root=root, by=by), "files bigint").agg(F.sum("files")).collect()
    Path(root, "_SUCCESS").touch()


def _write_files(batches: Iterator[pa.RecordBatch], root: str, by: str, end: bytes = b"\n") -> Iterator[pa.RecordBatch]:
    """Writes (folder, part, line) rows, sorted by folder and part, and gives the number of files.

    A file has its name when it is whole; a task that runs again puts the same file in its place.
    """
    own, count = f".{uuid.uuid4().hex}", 0
    key = out = None

    def finish() -> None:
        out.close()
        os.replace(out.name, os.path.join(os.path.dirname(out.name), f"part-{key[1]:08d}.txt"))

    try:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for now, run in groupby(rows, key=itemgetter(0, 1)):
                if now != key:
                    if out is not None:
                        finish()
                    os.makedirs(folder := os.path.join(root, folder_name(by, now[0])), exist_ok=True)
                    key, out, count = now, open(os.path.join(folder, own), "wb"), count + 1
                out.write(b"".join((line or b"") + end for _, _, line in run))
        if out is not None:
            finish()
    finally:
        if out is not None and not out.closed:  # of a task that failed
            out.close()
            os.remove(out.name)
    yield pa.RecordBatch.from_pydict({"files": [count]})


def read_lines(spark: SparkSession, path: str, by: str = "stock_code") -> DataFrame:
    """(by, line) of the files of :func:`write_lines`.

    Below a ``file:`` folder tasks list the folders and read the files, many in one task:
    Spark's own listing starts a task for each folder, up to 10,000, and its file scans one
    for 32 small files.
    """
    root = local_folder(spark, path)
    if root is None:
        schema = T.StructType([T.StructField("line", T.StringType()), T.StructField(by, T.StringType())])
        return spark.read.schema(schema).format("text").load(path).select(by, "line")
    ship_package(spark)
    with os.scandir(root) as found:
        names = [(x.name,) for x in found if x.name.startswith(f"{by}=")]
    tasks = 4 * spark.sparkContext.defaultParallelism
    folders = spark.createDataFrame(spark.sparkContext.parallelize(names, tasks), "folder string", verifySchema=False)
    # Files are dealt anew, so that the files of a large value are read by many tasks.
    listed = folders.mapInArrow(partial(_list_files, root=root), "folder string, file string").repartition(tasks)
    rows = listed.mapInArrow(partial(_read_files, root=root), "value string, line binary")
    return rows.select(F.col("value").alias(by), F.col("line").cast("string").alias("line"))


def _list_files(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        folders = batch.column(0).to_pylist()
        found = [(f, x) for f in folders for x in os.listdir(os.path.join(root, f)) if x[0] not in "._"]
        yield pa.RecordBatch.from_pydict({"folder": pa.array([f for f, _ in found], pa.string()), "file": pa.array([x for _, x in found], pa.string())})


def _read_files(batches: Iterator[pa.RecordBatch], root: str, rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    values: list[str | None] = []
    lines: list[bytes] = []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"value": pa.array(values, pa.string()), "line": pa.array(lines, pa.binary())})

    for batch in batches:
        for folder, file in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            value = folder_value(folder)
            found = Path(root, folder, file).read_bytes().removeprefix(b"\xef\xbb\xbf").splitlines()
            values += [value] * len(found)
            lines += found
            if len(lines) >= rows:
                yield made()
                values, lines = [], []
    yield made()


def write_json(df: DataFrame, path: str, by: Sequence[str] = ("stock_code",)) -> None:
    writer = (df.hint("rebalance", *by) if by else df).write.mode("errorifexists")
    (writer.partitionBy(*by) if by else writer).json(path)


def write_statements(df: DataFrame, root: str, split: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Partitions ``code=.../statement=...`` and, on request, one per period.

    The code is normalised to six characters.  Rows are rebalanced by partition
    column ahead of the writers: few files per partition, and a stock that is
    too large for one task is split over several.  Parquet below a ``file:`` folder is
    written by the tasks themselves, anything else by Spark.
    """
    by = ["code", "statement", *split]
    out = df.withColumn("code", norm_code(F.col("code"))).hint("rebalance", *by)
    folder = local_folder(df.sparkSession, root)
    codec = df.sparkSession.conf.get("spark.sql.parquet.compression.codec").lower()
    if folder is not None and fmt == "parquet" and codec in folders.CODECS and folders.plain(out.schema, by):
        folders.write_parquet(out, folder, by, codec)
        return
    out.write.mode("errorifexists").format(fmt).option("header", True).partitionBy(*by).save(root)


# Lowest level of each sink; the alert sink's is a parameter.
SINK_FLOOR = {"info": "INFO", "error": "ERROR", "debug": "DEBUG"}


def route_by_level(log: DataFrame, console_level: str = "WARNING") -> DataFrame:
    """One row per record and sink that takes it; a record of unknown or no level goes to the debug sink."""
    floors = SINK_FLOOR | {"alert": console_level}
    sinks = F.array(
        *[
            F.struct(F.lit(name).alias("sink"), F.lit(LEVEL_RANK[floor]).alias("floor"))
            for name, floor in floors.items()
        ]
    )
    taken = F.filter(sinks, lambda s: F.coalesce(level_rank(F.col("level")) >= s["floor"], s["sink"] == "debug"))
    return log.select("*", F.explode(taken).alias("_s")).select(*log.columns, F.col("_s.sink").alias("sink"))


def rotated(
    lines: DataFrame, order: str, max_bytes: int, keep: int, by: str = "sink", line: str = "line", chunk_rows: int = 65_536
) -> DataFrame:
    """Log lines of each ``by`` with the number ``file`` of the file they go to; files beyond the newest ``keep`` are gone.

    Files are planned, not filled one after the other: a line goes by the bytes of all
    lines before it (line breaks counted), a running sum over chunks of ``order``, a
    unique number.  Files start at multiples of ``max_bytes`` less the longest line, so
    none exceeds ``max_bytes`` but one that holds a single longer line.
    """
    size = (F.octet_length(F.coalesce(line, F.lit(""))) + 1).cast("bigint")
    placed = chunked.running_sum(
        lines.withColumn("_size", size), [by], [F.col(order)], chunked.dense_chunk(F.col(order), chunk_rows), F.col("_size"), "_upto"
    )
    width = F.greatest(F.lit(max_bytes) - F.max("_size") + 1, F.lit(1))
    widths = lines.withColumn("_size", size).groupBy(F.col(by).alias("_by")).agg(
        width.alias("_width"), F.sum("_size").alias("_all"), F.max_by("_size", order).alias("_last")
    )
    placed = placed.join(widths, F.col(by).eqNullSafe(F.col("_by")))
    number = lambda start: F.floor(start / F.col("_width")).cast("bigint")
    newest = number(F.col("_all") - F.col("_last"))
    placed = placed.withColumn("file", number(F.col("_upto") - F.col("_size"))).filter(newest - F.col("file") < keep)
    return placed.drop("_size", "_upto", "_width", "_all", "_last", "_by")


def write_rotated(planned: DataFrame, path: str, by: str = "sink", order: str = "seq") -> None:
    """One folder for each file of :func:`rotated`, its lines in order."""
    dealt = planned.repartition(by, "file").sortWithinPartitions(by, "file", order)
    dealt.select(by, "file", "line").write.mode("errorifexists").partitionBy(by, "file").text(path)


def write_logs(routed: DataFrame, path: str, max_records: int = 1_000_000, mode: str = "append") -> None:
    """One partition per sink; files roll over by record count.  Also writes batches of a stream."""
    routed.write.mode(mode).option("maxRecordsPerFile", max_records).partitionBy("sink").parquet(path)
