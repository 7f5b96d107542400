"""Many small files in partition folders below a ``file:`` folder, listed, written and read by tasks.

Hadoop's local file system starts ``chmod`` processes for each folder and file it makes.  Spark's
listing keeps all files on the driver and starts up to 10,000 tasks, its scans take 32 small
files to a task.  Here a task takes as many files as its share of the rows or names holds.
"""

from __future__ import annotations

import os
import re
import shutil
import uuid
from collections.abc import Iterator, Sequence
from functools import partial
from itertools import accumulate, chain, groupby, islice
from operator import itemgetter
from pathlib import Path
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ledgerlark.plans import emit
from ledgerlark.session import ship_package

# What Spark calls the folder of a null, the characters it writes as %XX in the name
# of a folder, and those of an address.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile("[\\x01-\\x1f\"#%'*/:=?\\\\\\x7f{\\[\\]^]")
_QUOTED = re.compile('[\\x00-\\x20"#%<>?\\[\\\\\\]^`{|}\\x7f]')

# Columns that tasks write and read as Spark does, compressions of parquet, and of texts.
_PLAIN = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
    T.BinaryType, T.DateType, T.TimestampNTZType,
)
CODECS = {"none": "none", "uncompressed": "none", "snappy": "snappy", "gzip": "gzip", "zstd": "zstd"}
_TEXT_CODECS = {".gz": "gzip", ".bz2": "bz2", ".zst": "zstd", ".deflate": None, ".lz4": None, ".snappy": None}


def local_folder(spark: SparkSession, path: str) -> str | None:
    """The folder a ``file:`` path names; null for another store."""
    at = urlsplit(path)
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if at.scheme == "file" or not at.scheme and default.startswith("file:"):
        return path if not at.scheme else path.removeprefix("file://").removeprefix("file:")
    return None


def readable_folder(spark: SparkSession, path: str) -> str | None:
    """The ``file:`` folder that tasks can list; null for a pattern, a single file and another store."""
    root = None if re.search(r"[*?\[\]{}\\]", path) else local_folder(spark, path)
    return os.path.abspath(root) if root is not None and os.path.isdir(root) else None


def folder_column(by: str) -> Column:
    """The value that names a row's folder, as a string that is never null."""
    return F.coalesce(F.nullif(F.col(f"`{by}`").cast("string"), F.lit("")), F.lit(NULL_FOLDER))


def folder_name(column: str, value: str) -> str:
    return "=".join(_ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", x) for x in (column, value))


def folder_value(name: str) -> str | None:
    value = name.split("=", 1)[1]
    return None if value == NULL_FOLDER else re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), value)


class NewFolder:
    """A folder that was not there, for tasks to fill: marked when all is done, gone if that fails."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def __enter__(self) -> None:
        ship_package(self.spark)
        os.makedirs(self.root)

    def __exit__(self, kind: type | None, *_: object) -> None:
        if kind is None:
            Path(self.root, "_SUCCESS").touch()
        else:
            shutil.rmtree(self.root, ignore_errors=True)


# --- parquet ----------------------------------------------------------------------------------


def plain(schema: T.StructType, by: Sequence[str]) -> bool:
    """Whether tasks can write and read the columns: those of the folders, others besides, each of a plain type."""
    kinds = {f.name: f.dataType for f in schema.fields}
    return (
        len({n.lower() for n in kinds}) == len(schema.fields) > len(set(by)) == len(by)
        and all(b in kinds for b in by)
        and all(isinstance(k, _PLAIN) or k == T.StringType() for k in kinds.values())
    )


def write_parquet(df: DataFrame, root: str, by: Sequence[str], codec: str) -> None:
    """Parquet files in nested folders as Spark's writer names them; each partition of the table is written by its task."""
    data = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields if f.name not in by])
    # A zero byte cannot be in the name of a folder.
    folder = F.concat_ws("\u0000", *map(folder_column, by)).alias("_folder")
    rows = df.select(folder, *(F.col(f"`{n}`") for n in data.names)).sortWithinPartitions("_folder")
    write = partial(_write_parquet, root=root, by=tuple(by), footer=data.json(), codec=codec)
    with NewFolder(df.sparkSession, root):
        rows.mapInArrow(write, "files bigint").agg(F.sum("files")).collect()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Neighbouring rows with one value in the first column, and that value."""
    for batch in batches:
        if batch.num_rows:
            values, rest, start = pc.run_end_encode(batch.column(0)), batch.select(batch.schema.names[1:]), 0
            for value, end in zip(values.values.to_pylist(), values.run_ends.to_pylist(), strict=True):
                yield value, rest.slice(start, end - start)
                start = end


def _parts(batches: Iterator[pa.RecordBatch], rows: int, size: int = 64 << 20) -> Iterator[pa.Table]:
    """The batches in tables, each closed when it has so many rows or bytes."""
    part, count, held = [], 0, 0
    for batch in batches:
        part.append(batch)
        count, held = count + batch.num_rows, held + batch.nbytes
        if count >= rows or held >= size:
            yield pa.Table.from_batches(part)
            part, count, held = [], 0, 0
    if part:
        yield pa.Table.from_batches(part)


def _write_parquet(
    batches: Iterator[pa.RecordBatch], root: str, by: Sequence[str], footer: str, codec: str, rows_per_group: int = 65_536
) -> Iterator[pa.RecordBatch]:
    """Writes (folder, data) rows, sorted by folder, and gives the number of files.

    A task writes one file in each of its folders, named by the task when it is whole, so one
    that runs again puts the same files in their places.
    """
    task, own, count, schema = TaskContext.get().partitionId(), f".{uuid.uuid4().hex}", 0, None
    for folder, runs in groupby(_runs(batches), key=itemgetter(0)):
        names = [folder_name(b, value) for b, value in zip(by, folder.split("\0"), strict=True)]
        os.makedirs(at := os.path.join(root, *names), exist_ok=True)
        parts = _parts((rows for _, rows in runs), rows_per_group)
        part = next(parts)
        if schema is None:  # columns may be null, and Spark's note on their types is in the footer, as in its own files
            schema = pa.schema([f.with_nullable(True) for f in part.schema], {"org.apache.spark.sql.parquet.row.metadata": footer})
        # Few rows have few values in common.
        alike, packed = part.num_rows >= 4_096, CODECS[codec]
        try:
            with pa.OSFile(new := os.path.join(at, own), "wb") as file:
                with pq.ParquetWriter(file, schema, compression=packed, use_dictionary=alike, store_schema=False) as writer:
                    for rows in chain([part], parts):
                        writer.write_table(pa.table(rows.columns, schema=schema), row_group_size=rows.num_rows)
        except BaseException:
            Path(new).unlink(missing_ok=True)
            raise
        os.replace(new, os.path.join(at, f"part-{task:05d}.{codec}.parquet"))
        count += 1
    yield pa.RecordBatch.from_pydict({"files": [count]})


def read_parquet(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame | None:
    """The rows of partitioned parquet files, data columns first; null if the folder or the types are not for tasks.

    A file's rows leave the task as one array, so that filters on partition columns
    are applied to the names of files before these are read.
    """
    levels = _levels(root)
    if not levels or not plain(schema, levels):
        return None
    data = [f for f in schema.fields if f.name not in levels]
    listed = _listed(spark, root, levels, row_groups=True)
    keys = [F.col("folders")[i].cast(schema[b].dataType).alias(b) for i, b in enumerate(levels)]
    rows = listed.select(_rows_of(root, data)("file", "group").alias("_rows"), *keys)
    rows = emit.each(rows, levels, "_rows", "_at", "_row")
    return rows.select("_row.*", *levels)


def _rows_of(root: str, data: Sequence[T.StructField], rows: int = 65_536, size: int = 32 << 20):  # noqa: ANN202
    kinds = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in data])
    made = T.ArrayType(T.StructType([T.StructField(f.name, f.dataType) for f in data]))

    def read(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for files, groups in batches:
            tables, count, held = [], 0, 0
            for file, group in zip(files.to_pylist(), groups.to_pylist(), strict=True):
                tables.append(table := _rows_in(os.path.join(root, file), group, kinds))
                count, held = count + table.num_rows, held + table.nbytes
                if count >= rows or held >= size:
                    yield _lists(tables)
                    tables, count, held = [], 0, 0
            if tables:
                yield _lists(tables)

    read.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(read, made)


def _rows_in(path: str, group: int | None, kinds: pa.Schema) -> pa.Table:
    """The columns of a file by name: those it has not are null, and numbers may become wider."""
    with open(path, "rb") as raw:
        file = pq.ParquetFile(pa.BufferReader(raw.read()) if group is None else raw)
        has = {n.lower(): n for n in file.schema_arrow.names} | {n: n for n in file.schema_arrow.names}
        found = [has.get(f.name) or has.get(f.name.lower()) for f in kinds]
        wanted = [n for n in found if n is not None]
        table = file.read(wanted, use_threads=False) if group is None else file.read_row_group(group, wanted, use_threads=False)
        count = file.metadata.num_rows if group is None else file.metadata.row_group(group).num_rows
    columns = []
    for kind, name in zip(kinds, found, strict=True):
        column = pa.nulls(count, kind.type) if name is None else table.column(name)
        if column.type != kind.type:
            if not (pa.types.is_integer(column.type) or pa.types.is_floating(column.type)) or not _numeric(kind.type):
                raise TypeError(f"{path}: column {name} is {column.type}, not {kind.type}")
            column = column.cast(kind.type)
        columns.append(column)
    return pa.table(columns, schema=kinds)


def _numeric(kind: pa.DataType) -> bool:
    return pa.types.is_integer(kind) or pa.types.is_floating(kind)


def _lists(tables: Sequence[pa.Table]) -> pa.Array:
    """One list of rows for each table."""
    offsets = pa.array([0, *accumulate(map(len, tables))], pa.int32())
    every = pa.concat_tables(tables).combine_chunks()
    columns = [c.chunk(0) if c.num_chunks else pa.nulls(0, c.type) for c in every.columns]
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, fields=list(every.schema)))


# --- texts ------------------------------------------------------------------------------------


def read_texts(spark: SparkSession, root: str) -> DataFrame:
    """(url, text) of each file, whole, its address as Spark's readers give it."""
    listed = _listed(spark, root, _levels(root)).select("file")
    texts = listed.mapInArrow(partial(_read_texts, root=root), "url string, text binary")
    return texts.select(F.coalesce("url", F.lit("")).alias("url"), F.col("text").cast("string").alias("text"))


def _read_texts(batches: Iterator[pa.RecordBatch], root: str, size: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"url": pa.array(urls, pa.string()), "text": pa.array(texts, pa.binary())})

    urls, texts, held = [], [], 0
    for batch in batches:
        for file in batch.column(0).to_pylist():
            path, codec = os.path.join(root, file), os.path.splitext(file)[1]
            with open(path, "rb") as raw:
                text = raw.read()
            if codec in _TEXT_CODECS:
                if _TEXT_CODECS[codec] is None:
                    raise ValueError(f"{path}: texts of this compression are not read")
                text = pa.input_stream(pa.BufferReader(text), compression=_TEXT_CODECS[codec]).read()
            urls.append("file://" + _QUOTED.sub(lambda m: f"%{ord(m[0]):02X}", path))
            texts.append(text)
            held += len(text)
            if held >= size:
                yield made()
                urls, texts, held = [], [], 0
    yield made()


# --- names ------------------------------------------------------------------------------------


def _shown(name: str) -> bool:
    """Readers pass over hidden files and folders."""
    return not (name[0] == "." or name[0] == "_" and "=" not in name or name.endswith("._COPYING_"))


def _entries(root: str, folders: bool) -> Iterator[str]:
    """Names of the partition folders in a folder, or of the files."""
    with os.scandir(root) as found:
        for x in found:
            if _shown(x.name) and (x.is_dir() and "=" in x.name if folders else not x.is_dir()):
                yield x.name


def _files_below(root: str, names: tuple[str, ...]) -> Iterator[tuple[tuple[str, ...], str, int]]:
    """(folders between, name, size) of the files with content."""
    with os.scandir(os.path.join(root, *names)) as found:
        for x in found:
            if _shown(x.name):
                if x.is_dir():
                    yield from _files_below(root, (*names, x.name))
                elif size := x.stat().st_size:
                    yield names, x.name, size


def _levels(root: str) -> tuple[str, ...]:
    """The partition columns, by the folders above the first file found; none if files are in the folder itself only."""
    for top in _entries(root, folders=True):
        for names, _, _ in _files_below(root, (top,)):
            return tuple(n.split("=", 1)[0] for n in names)
    return ()


def _listed(spark: SparkSession, root: str, levels: Sequence[str], row_groups: bool = False) -> DataFrame:
    """(file, group, folders) of the files in partition folders, or in the folder itself if it has none.

    One task reads the names in the folder and others list below them; files are dealt anew, so
    that those of a large partition are read by many tasks.  With ``row_groups`` a large parquet
    file has a row for each of its row groups; else the group is null.
    """
    ship_package(spark)
    tasks = 4 * spark.sparkContext.defaultParallelism
    tops = spark.range(0, 1, 1, 1).mapInArrow(partial(_list_top, root=root, folders=bool(levels)), "top string")
    below = partial(_list_below, root=root, levels=tuple(levels), row_groups=row_groups)
    files = tops.repartition(tasks, "top").mapInArrow(below, "file string, `group` int, folders array<string>")
    return files.repartition(tasks, "file", "group")


def _list_top(batches: Iterator[pa.RecordBatch], root: str, folders: bool, rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _ in range(batch.num_rows):
            names = _entries(root, folders)
            while some := list(islice(names, rows)):
                yield pa.RecordBatch.from_pydict({"top": pa.array(some, pa.string())})


def _list_below(
    batches: Iterator[pa.RecordBatch], root: str, levels: Sequence[str], row_groups: bool, rows: int = 10_000, large: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    def found(top: str) -> Iterator[tuple[tuple[str, ...], str, int]]:
        if levels:
            return _files_below(root, (top,))
        size = os.stat(os.path.join(root, top)).st_size
        return iter([((), top, size)] if size else [])

    def listed() -> Iterator[tuple[str, int | None, list[str | None]]]:
        for batch in batches:
            for top in batch.column(0).to_pylist():
                for names, name, size in found(top):
                    file = "/".join((*names, name))
                    if [n.split("=", 1)[0] if "=" in n else None for n in names] != list(levels):
                        raise ValueError(f"{root}/{file} is not below a folder for each of {', '.join(levels)}")
                    many = row_groups and size >= large
                    groups = range(pq.read_metadata(os.path.join(root, file)).num_row_groups) if many else [None]
                    values = [folder_value(n) for n in names]
                    yield from ((file, group, values) for group in groups)

    every = listed()
    while some := list(islice(every, rows)):
        kinds = (pa.string(), pa.int32(), pa.list_(pa.string()))
        columns = [pa.array(x, kind) for x, kind in zip(zip(*some, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=["file", "group", "folders"])
