"""Fill-in-middle transformation with a piece table.

A document is never cut up and glued.  Its bytes stay one immutable text buffer, the
three sentinels are a second one, and what is worked with are descriptors
(buffer, start, length) over the two:

1. Cutting splits a descriptor at a byte place.  The places are ends of lines
   (``[^\\n]*\\n|[^\\n]+``, from left to right); two draws of 0..n choose them.
2. An arrangement permutes the three pieces and puts a sentinel before each:
   ``psm`` is prefix, suffix, middle; ``spm`` is suffix, prefix, middle.
3. Output is written by walking the descriptors; hashes stream them without it.
4. Restoring takes output and form only: the sentinels are looked up in the output,
   their places cut it into descriptors, the inverse permutation puts those in order.

Draws depend on the seed and doc_id alone: the first four groups of eight hex digits
of sha256 of ``<seed>:<doc_id>``.  A text that contains a sentinel, or that draws the
rest of ``rate``, stays ``plain``; so does an empty text.  A text without sentinels
has none that reaches over the border of two pieces either, since a sentinel's first
sign is found nowhere else in it, so each one is found at one place of the output.

Everything happens in the row: no shuffle, one pass, the memory of a few texts.  A
null text is empty.  A row without doc_id draws from ``<seed>:`` alone.  Repeated rows
give equal rows.  Columns of the input that bear the name of a result are replaced.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlark.llm.texts import as_bytes, batches_of

SEED = 7
RATE = 100  # of a hundred texts, so many are rearranged
SPM_RATE = 50  # and of those, so many with the suffix first
SENTINELS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}

TEXT, MARKS = 0, 1  # the buffers
Piece = tuple[int, int, int]

_MARKS = b"".join(SENTINELS.values())
_MARK_AT = {name: (MARKS, _MARKS.index(mark), len(mark)) for name, mark in SENTINELS.items()}
_PIECE = pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())])
_RESULT = (
    T.StructType()
    .add("n", T.LongType())
    .add("form", T.StringType())
    .add("prefix_chars", T.LongType())
    .add("middle_chars", T.LongType())
    .add(
        "pieces",
        T.ArrayType(T.StructType().add("buffer", T.IntegerType()).add("start", T.LongType()).add("length", T.LongType())),
    )
    .add("output", T.StringType())
)


def draws(seed: int, doc_id: int | None) -> tuple[int, ...]:
    hexes = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(hexes[8 * i : 8 * i + 8], 16) for i in range(4))


def cut(pieces: list[Piece], place: int, at: int) -> list[Piece]:
    """The descriptor at ``place`` in two, ``at`` bytes behind its start."""
    buffer, start, length = pieces[place]
    return [*pieces[:place], (buffer, start, at), (buffer, start + at, length - at), *pieces[place + 1 :]]


def line_ends(text: bytes) -> np.ndarray:
    """Where each line ends, its line feed included."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return ends if not text or text.endswith(b"\n") else np.append(ends, len(text))


def arrange(parts: dict[str, Piece], form: str) -> list[Piece]:
    return [d for name in ORDERS[form] for d in (_MARK_AT[name], parts[name])]


def restore(output: bytes, form: str) -> list[Piece]:
    """Descriptors over ``output`` that spell the text it was made from."""
    pieces = [(TEXT, 0, len(output))]
    if form == "plain":
        return pieces
    parts = {}
    for i, name in enumerate(ORDERS[form]):
        mark = SENTINELS[name]
        at = output.index(mark, pieces[-1][1]) - pieces[-1][1]
        if i:
            pieces = cut(pieces, len(pieces) - 1, at)
            parts[ORDERS[form][i - 1]] = pieces[-2]
        pieces = cut(pieces, len(pieces) - 1, len(mark) if i else at + len(mark))
    parts[ORDERS[form][-1]] = pieces[-1]
    return [parts[name] for name in ("prefix", "middle", "suffix")]


def spelled(pieces: list[Piece], text: bytes) -> bytes:
    return b"".join((text, _MARKS)[b][s : s + n] for b, s, n in pieces)


def streamed_hash(pieces: list[Piece], text: bytes) -> str:
    """SHA-256 of what the descriptors spell, fed piece by piece from the buffers."""
    buffers, digest = (memoryview(text), memoryview(_MARKS)), hashlib.sha256()
    for buffer, start, length in pieces:
        digest.update(buffers[buffer][start : start + length])
    return digest.hexdigest()


def characters(text: bytes, piece: Piece) -> int:
    span = np.frombuffer(text, np.uint8, piece[2], piece[1]) if piece[2] else np.zeros(0, np.uint8)
    return int(np.count_nonzero((span & 0xC0) != 0x80))


def transform(text: bytes, doc_id: int | None, seed: int, rate: int, spm_rate: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, pieces) of one text."""
    ends, whole = line_ends(text), [(TEXT, 0, len(text))]
    n = len(ends)
    h = draws(seed, doc_id)
    if not text or h[2] % 100 >= rate or any(mark in text for mark in SENTINELS.values()):
        return n, "plain", None, None, whole
    first, second = (int(ends[k - 1]) if k else 0 for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    prefix, middle, suffix = cut(cut(whole, 0, first), 1, second - first)
    form = "spm" if h[3] % 100 < spm_rate else "psm"
    pieces = arrange({"prefix": prefix, "middle": middle, "suffix": suffix}, form)
    return n, form, characters(text, prefix), characters(text, middle), pieces


def _transform(seed: int, rate: int, spm_rate: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in batches_of(batch):
                ids = part.column(part.schema.get_field_index("doc_id")).to_pylist()
                rows = [transform(t, d, seed, rate, spm_rate) for t, d in zip(texts, ids, strict=True)]
                output = [spelled(r[4], t) for r, t in zip(rows, texts, strict=True)]
                column = lambda i, kind: pa.array([r[i] for r in rows], kind)  # noqa: B023, E731
                described = [[dict(zip(("buffer", "start", "length"), p, strict=True)) for p in r[4]] for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(part.schema.get_field_index(n)) for n in names),
                        column(0, pa.int64()),
                        column(1, pa.string()),
                        column(2, pa.int64()),
                        column(3, pa.int64()),
                        pa.array(described, pa.list_(_PIECE)),
                        pa.array(output, pa.binary()).view(pa.string()),
                    ],
                    names=[*names, *_RESULT.names],
                )

    return run


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, ...) with n, form, prefix_chars, middle_chars, pieces and output."""
    docs = docs.drop(*_RESULT.names)
    return docs.mapInArrow(
        _transform(seed, rate, spm_rate, docs.columns), T.StructType([*docs.schema.fields, *_RESULT.fields])
    )


def _restored(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, outputs in batches_of(batch, "output"):
                forms = part.column(part.schema.get_field_index("form")).to_pylist()
                texts = [spelled(restore(o, f), o) for o, f in zip(outputs, forms, strict=True)]
                columns = [part.column(part.schema.get_field_index(n)) for n in names]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(texts, pa.binary()).view(pa.string())], names=[*names, "restored"]
                )

    return run


def restored(transformed: DataFrame) -> DataFrame:
    """All columns with ``restored``, the text rebuilt from ``output`` and ``form``; nothing else is read."""
    rows = transformed.drop("restored")
    schema = T.StructType([*rows.schema.fields, T.StructField("restored", T.StringType())])
    return rows.mapInArrow(_restored(rows.columns), schema)


DIGEST = (
    "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
    "output_sha256 string, restored_sha256 string"
)


def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of output, streamed over text and pieces, and of the text rebuilt from output and form."""
    for batch in batches:
        get = lambda n, b=batch: b.column(b.schema.get_field_index(n))
        texts, outputs = as_bytes(get("text")), as_bytes(get("output"))
        pieces = [[(p["buffer"], p["start"], p["length"]) for p in ps] for ps in get("pieces").to_pylist()]
        made = [streamed_hash(p, t) for p, t in zip(pieces, texts, strict=True)]
        back = [streamed_hash(restore(o, f), o) for o, f in zip(outputs, get("form").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*map(get, ("doc_id", "n", "form", "prefix_chars", "middle_chars")), pa.array(made), pa.array(back)],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
        )
