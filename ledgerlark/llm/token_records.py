"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

A file is a sequence of frames::

    length of the payload      8 bytes, little-endian
    masked checksum of length  4 bytes
    payload                    doc_id (8 bytes), number of ids (4 bytes), ids (2 or 4 bytes each)
    masked checksum of payload 4 bytes

Checksums are CRC-32, masked by a rotation of 15 bits and a constant, so that data
that hold checksums themselves do not check by accident.  Ids take two bytes if the
vocabulary has at most 65,536 entries.  Documents are range-partitioned and sorted
by doc_id (then by text), one file for each partition, so the files in the order of
their numbers hold all documents in ascending order.  Each task writes under a name
of its own attempt, and only files named in the committed index are read: a task
that is run again, or twice, leaves nothing but an unread file.

The index, a table written by Spark, has one row a record: file, place in the file,
tokens before it.  Any subset can be read in any order; a reader groups its rows by
file and seeks.  Files are written and read through ``pyarrow.fs`` at the shared
folder's address.

A null or empty text is the end id alone.  Null ids come first.  An empty table
gives no file and an empty index.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from posixpath import join

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.texts import as_bytes, blocks
from ledgerlark.session import fresh_path, landed

END_ID = 1
CACHE_WORDS = 500_000
_MASK = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_SELF = struct.Struct("<qI")
_NO_DOC = -(2**63)

INDEX = (
    "file_no int, file string, place bigint, doc_id bigint, offset bigint, length bigint, n_tokens bigint, "
    "tokens_before bigint"
)


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def unframe(data: bytes) -> bytes:
    """The payload of one whole frame; raises ValueError if a checksum is wrong."""
    length, check = _HEAD.unpack_from(data)
    payload = data[_HEAD.size : -4]
    if masked(data[:8]) != check or length != len(payload):
        raise ValueError("length of a record is damaged")
    if masked(payload) != struct.unpack("<I", data[-4:])[0]:
        raise ValueError("payload of a record is damaged")
    return payload


def record(doc: int | None, n: int, ids: bytes) -> bytes:
    return frame(_SELF.pack(_NO_DOC if doc is None else doc, n) + ids)


def ids_of(framed: bytes, kind: np.dtype) -> np.ndarray:
    payload = unframe(framed)
    values = np.frombuffer(payload, kind, offset=_SELF.size)
    if len(values) != _SELF.unpack_from(payload)[1]:
        raise ValueError("a record has another number of ids than it says")
    return values


class Encoder:
    """Encodes texts with a tokenizer that drops white space, chunk by chunk between spaces.

    No token spans ASCII white space, so a text's ids are those of its chunks.  A
    chunk of Latin letters, with signs behind them or not, is two runs to the
    tokenizer: the lower-cased letters go to its model itself, spelt in the byte
    alphabet of byte-level vocabularies.  All other chunks take the tokenizer's
    whole way.  A bounded number of chunks is kept.
    """

    # Latin letters that normalisation leaves as they are (U+0130 lower-cases to two signs).
    _PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([.,:;?!%&*#$|]*)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        n = self.whole.get_vocab_size()
        self.kind = np.dtype("<u2" if n <= 1 << 16 else "<u4")
        self.as_bytes = [i.to_bytes(self.kind.itemsize, "little") for i in range(n)]
        self.chunks: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {"": b""}
        self.end = self.as_bytes[END_ID]
        # Printable bytes stand for themselves, the others for the code points from 256 on.
        other = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
        self.alphabet = {b: 256 + i for i, b in enumerate(other)}

    def _join(self, ids: list[int]) -> bytes:
        return b"".join([self.as_bytes[i] for i in ids])

    def _word(self, word: str) -> bytes:
        spelt = word if word.isascii() else word.encode().decode("latin-1").translate(self.alphabet)
        ids = self.words[word] = self._join([t.id for t in self.model.tokenize(spelt)])
        return ids

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8", "replace")
        if plain := self._PLAIN.fullmatch(text):
            word, signs = plain.groups()
            word = word.lower()
            ids = self.words.get(word) or self._word(word)
            if signs not in self.signs:
                self.signs[signs] = self._join(self.whole.encode(signs, add_special_tokens=False).ids)
            return ids + self.signs[signs]
        return self._join(self.whole.encode(text, add_special_tokens=False).ids)

    def encode(self, text: bytes) -> bytes:
        """The ids of a text, end id included, as bytes."""
        if len(self.chunks) > CACHE_WORDS:
            self.chunks.clear()
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        if len(self.signs) > CACHE_WORDS:
            self.signs = {"": b""}
        parts, known = text.split(), self.chunks
        for chunk in parts:
            if chunk not in known:
                known[chunk] = self._chunk(chunk)
        parts = list(map(known.__getitem__, parts))
        parts.append(self.end)
        return b"".join(parts)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _write(folder: str, tokenizer: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        store, root = fs.FileSystem.from_uri(folder)
        name = f"part-{number:06d}-{uuid.uuid4().hex}.rec"
        encode = encoder(tokenizer)
        out, offset, place, tokens = None, 0, 0, 0
        for batch in batches:
            if out is None:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(join(root, name), buffer_size=1 << 20)
            texts, ids = as_bytes(batch.column(1)), batch.column(0).to_pylist()
            rows = []
            for doc, text in zip(ids, texts, strict=True):
                payload = encode.encode(text)
                n = len(payload) // encode.kind.itemsize
                framed = record(doc, n, payload)
                out.write(framed)
                rows.append((number, name, place, doc, offset, len(framed), n, tokens))
                offset, place, tokens = offset + len(framed), place + 1, tokens + n
            kinds = (pa.int32(), pa.string(), *[pa.int64()] * 6)
            names = [c.split()[0] for c in INDEX.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names
            )
        if out is not None:
            out.close()

    return write


def write_records(docs: DataFrame, tokenizer: str, folder: str | None = None) -> tuple[str, DataFrame]:
    """Writes the records of ``docs`` (doc_id, text) and returns their folder and their index."""
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "records")
    folder = folder if "://" in folder else folder.replace("file:", "")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.select("doc_id", "text").repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")
    index = landed(dealt.mapInArrow(_write(folder, tokenizer), INDEX), "record_index")
    return folder, index


def _read(folder: str, width: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        kind = np.dtype(f"<u{width}")
        name, source = None, None
        for batch in batches:
            files, offsets, lengths = (
                batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("file", "offset", "length")
            )
            for first, last in blocks(lengths, 4 << 20):
                ids = []
                k = first
                while k < last:
                    # Neighbouring records are read at once.
                    end = k + 1
                    while end < last and files[end] == files[k] and offsets[end] == offsets[end - 1] + lengths[end - 1]:
                        end += 1
                    if files[k] != name:
                        if source is not None:
                            source.close()
                        name, source = files[k], store.open_input_file(join(root, files[k]))
                    data = source.read_at(offsets[end - 1] + lengths[end - 1] - offsets[k], offsets[k])
                    for i in range(k, end):
                        at = offsets[i] - offsets[k]
                        ids.append(ids_of(data[at : at + lengths[i]], kind).astype("<u4").tobytes())
                    k = end
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(ids, pa.binary())], names=[*part.schema.names, "ids"]
                )
        if source is not None:
            source.close()

    return read


def read_records(folder: str, index: DataFrame, width: int = 2) -> DataFrame:
    """The rows of the index, or of any part of it, with ids: unsigned 32-bit little-endian numbers as bytes.

    ``width`` is the number of bytes that an id takes in the files.  Rows are read
    as they come; order them by file and place for whole files, or deal them out
    by a hash for a shuffled read.
    """
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in index.schema.fields)
    return index.mapInArrow(_read(folder, width), f"{names}, ids binary")


def with_starts(index: DataFrame) -> DataFrame:
    """The index with start, the number of ids of all documents before each one."""
    files = index.groupBy("file_no").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    files = files.select("file_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return index.join(files, "file_no").withColumn("start", F.col("base") + F.col("tokens_before")).drop("base")
