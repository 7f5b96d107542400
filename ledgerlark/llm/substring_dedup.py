"""Exact substring de-duplication with run-length indexes.

Every byte that is covered by a ``LENGTH``-byte string which also starts earlier (in
a smaller doc_id, or earlier in the same document) is removed.  Texts are UTF-8
bytes, matches never cross documents, and strings are judged on the input.

1. Anchors.  Of the 32-byte grams of each 100-byte window the one with the smallest
   hash (the leftmost of equal ones) is the window's anchor.  It depends on the
   window's bytes alone, so equal windows have equal anchors.  Consecutive windows
   with one anchor make a stretch of 100 to 168 bytes; each task sends a stretch's
   anchor hash, content hash and place, about one row for 35 bytes and no text.
   Stretches that repeat inside a block of text are settled there, and so a passage
   of a third of all documents is one row from each block.
2. Rows meet by anchor, sorted.  A stretch whose content came earlier is covered as a
   whole.  An anchor with one content only is settled.  For anchors with several
   contents (edges of passages, edits) the first stretch of each content is fetched.
3. Run-length index.  The fetched stretches of some anchors form one text with a
   separator of its own behind each.  Its Burrows-Wheeler transform is cut into runs,
   and the places at the run ends are sampled with the lengths of their matches; in
   repetitive text there are few of them.  Matching statistics stream from the
   samples: between two sampled places the match before a suffix moves on with it
   and gets shorter by one.  Places with a match of 100 bytes or more are linked to
   it, links are followed to the first of their class, and windows that are not the
   earliest of their class are marked.
4. Marked spans return to their documents, which are read once more.

A null text is empty.  Null ids come first.  Rows of one doc_id with different texts are
documents in the order of their texts' hashes (64 bits, by which they are told apart);
rows with the same id and text are one document, and each of them gets its result, so
no passage is lost from all of its rows.  Documents of less than 100 bytes are kept whole.  An empty table gives an empty result.  A text of
any length is worked through in parts of ``PART`` bytes that overlap by 99.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.texts import as_bytes, batches_of, blocks, mix, span_hashes
from ledgerlark.session import landed

LENGTH = 100
GRAM = 32
PART = 1 << 19
INDEX_BYTES = 1 << 19
_NO_DOC = -(2**63)
_PLACE_BITS = 24
_ROWS = "anchor bigint, content bigint, doc bigint, row bigint, begin bigint, length int"
_SPANS = "doc bigint, row bigint, begin bigint, length bigint"


def _grams(buffer: np.ndarray, width: int) -> np.ndarray:
    at = np.arange(max(0, len(buffer) - width + 1))
    return span_hashes(buffer, at, at + width)


def stretches(buffer: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(anchor hash, content hash, begin, end) of the stretches of texts that lie one behind another in a buffer.

    ``ends``: where each text ends.
    """
    none = np.zeros(0, np.int64)
    n = len(buffer) - length + 1
    if n <= 0:
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    hashes = _grams(buffer, gram)
    width = length - gram + 1
    # The place breaks ties: the leftmost of equal grams.
    low = np.uint64((1 << _PLACE_BITS) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: n], least[width - span : width - span + n])
    place = (least[:n] & low).astype(np.int64)
    # Windows inside one text.
    at = np.arange(n)
    of = np.searchsorted(ends, at, side="right")
    inside = at + length <= ends[np.minimum(of, len(ends) - 1)]
    at, place, of = at[inside], place[inside], of[inside]
    if not len(at):
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    begin, end = at[first], at[np.append(first[1:], len(at)) - 1] + length
    content = mix(span_hashes(buffer, begin, end) + np.uint64(1) * (place[first] - begin).astype(np.uint64))
    return hashes[place[first]], content, begin, end


def _parts(texts: list[bytes], docs: list[tuple], length: int) -> Iterator[list[tuple[tuple, int, bytes]]]:
    """Blocks of (document, offset, bytes), each document once; long texts in overlapping parts."""
    pieces = []
    for doc, text in dict(zip(docs, texts, strict=True)).items():
        for offset in range(0, max(1, len(text) - length + 1), PART):
            pieces.append((doc, offset, text[offset : offset + PART + length - 1]))
    for first, last in blocks([len(p[2]) for p in pieces], PART):
        yield pieces[first:last]


def _anchors(length: int):
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = list(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True))
            for part in _parts(as_bytes(batch.column(1)), docs, length):
                buffer = np.frombuffer(b"".join(p[2] for p in part), np.uint8)
                ends = np.cumsum([len(p[2]) for p in part])
                anchor, content, begin, end = stretches(buffer, ends, length)
                of = np.searchsorted(ends, begin, side="right")
                doc, row = (np.array([p[0][k] for p in part], np.int64)[of] for k in (0, 1))
                starts = ends - np.array([len(p[2]) for p in part]) - np.array([p[1] for p in part])
                size, begin = end - begin, begin - starts[of]
                # Repeats inside this block are settled: length below zero, dealt out by place.
                order = np.lexsort((begin, row, doc, content, anchor))
                anchor, content, doc, row, begin, size = (x[order] for x in (anchor, content, doc, row, begin, size))
                again = np.zeros(len(anchor), bool)
                again[1:] = (anchor[1:] == anchor[:-1]) & (content[1:] == content[:-1])
                anchor = np.where(again, mix(doc.astype(np.uint64) ^ mix(row.astype(np.uint64) ^ mix(begin.astype(np.uint64)))), anchor)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor.view(np.int64)),
                        pa.array(content.view(np.int64)),
                        pa.array(doc),
                        pa.array(row),
                        pa.array(begin),
                        pa.array(np.where(again, -size, size).astype(np.int32)),
                    ],
                    names=["anchor", "content", "doc", "row", "begin", "length"],
                )

    return anchors


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (anchor, content, doc, row, begin): stretches that are covered (length < 0), and those to fetch.

    A document that came in several rows has several rows of each stretch; one is left.
    State from one batch to the next: the last row and its keys, and the first row of its
    anchor as long as it is not known whether it must be fetched.
    """
    last = (None, None)
    place = None
    held = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if len(columns[0]):
            same = np.logical_and.reduce([c[1:] == c[:-1] for c in columns[:5]])
            now = tuple(int(c[-1]) for c in columns[:5])
            same = np.append(place == tuple(int(c[0]) for c in columns[:5]), same)
            columns, place = [c[~same] for c in columns], now
        settled = columns[5] < 0
        keep = [c[~settled] for c in columns]
        out = [[c[settled] for c in columns]]
        anchor, content = keep[0], keep[1]
        n = len(anchor)
        if n:
            new_anchor, new_content = np.ones(n, bool), np.ones(n, bool)
            new_anchor[1:] = anchor[1:] != anchor[:-1]
            new_content[1:] = new_anchor[1:] | (content[1:] != content[:-1])
            if last[0] == anchor[0]:
                new_anchor[0] = False
                new_content[0] = last[1] != content[0]
            covered = ~new_content
            fetch = new_content & ~new_anchor
            group = np.cumsum(new_anchor)  # 0: the anchor that the last batch ended with
            mixed = np.zeros(group[-1] + 1, bool)
            mixed[group[fetch]] = True
            if held is not None and mixed[0] and not new_anchor[0]:
                out.append(held)
                held = None
            firsts = np.flatnonzero(new_anchor)
            fetch[firsts[mixed[group[firsts]]]] = True
            rows = [c[covered].copy() for c in keep]
            rows[5] = -rows[5]
            out += [rows, [c[fetch] for c in keep]]
            if len(firsts):
                k = firsts[-1]
                held = None if mixed[group[k]] else [c[k : k + 1] for c in keep]
            last = (anchor[-1], content[-1])
        merged = [np.concatenate([o[i] for o in out]) for i in range(6)]
        yield pa.RecordBatch.from_arrays([pa.array(m) for m in merged], names=batch.schema.names)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in batches_of(batch):
            wanted = part.column(3)
            of = np.repeat(np.arange(len(texts)), wanted.value_lengths().to_numpy(zero_copy_only=False)).tolist()
            anchor, begin, length = (wanted.flatten().field(i) for i in range(3))
            cut = zip(of, begin.to_pylist(), length.to_pylist(), strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    anchor,
                    part.column(1).take(pa.array(of, pa.int64())),
                    part.column(2).take(pa.array(of, pa.int64())),
                    begin,
                    pa.array([texts[i][b : b + n] for i, b, n in cut], pa.binary()),
                ],
                names=["anchor", "doc", "row", "begin", "bytes"],
            )


# --- the run-length index ------------------------------------------------------------------


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling; the last symbol must be unlike all others."""
    _, rank = np.unique(symbols, return_inverse=True)
    n, span = len(symbols), 1
    while True:
        second = np.zeros(n, np.int64)
        second[: n - span] = rank[span:] + 1
        key = rank.astype(np.int64) * (n + 1) + second
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.zeros(n, np.int64)
        new[1:] = np.cumsum(key[1:] != key[:-1])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        span *= 2


class RunIndex:
    """Samples of the Burrows-Wheeler runs of a text: where a run's first suffix starts, the suffix before it in
    order, and for how many symbols the two agree."""

    def __init__(self, symbols: np.ndarray):
        order = suffix_array(symbols)
        transform = symbols[order - 1]  # the first symbol's predecessor is the last separator
        heads = np.ones(len(order), bool)
        heads[1:] = transform[1:] != transform[:-1]
        self.runs = int(heads.sum())
        heads = np.flatnonzero(heads)
        place, before = order[heads], order[heads - 1]
        agree = self._agreement(symbols, place, before)
        agree[0] = 0 if heads[0] == 0 else agree[0]  # the first suffix of all has none before it
        by = np.argsort(place)
        self.place, self.before, self.agree = place[by], before[by], agree[by]

    @staticmethod
    def _agreement(symbols: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of suffixes; separators are all different, so they end each one."""
        out = np.zeros(len(a), np.int64)
        active = np.flatnonzero(a != b)
        n = len(symbols)
        while len(active):
            x, y = a[active] + out[active], b[active] + out[active]
            same = (x < n) & (y < n)
            same[same] = symbols[x[same]] == symbols[y[same]]
            active = active[same]
            out[active] += 1
        return out

    def matches(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of text places: length of the match with the suffix before, and its place."""
        k = np.searchsorted(self.place, at, side="right") - 1
        moved = at - self.place[k]
        return self.agree[k] - moved, self.before[k] + moved


def repeated_windows(parts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For stretches in ascending order: places in each one where a window begins that began before."""
    sizes = np.array([len(p) for p in parts])
    n = int(sizes.sum()) + len(parts)
    symbols = np.zeros(n, np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    own = np.ones(n, bool)
    own[begins + sizes] = False
    symbols[own] = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64) + len(parts)
    symbols[~own] = np.arange(len(parts))
    index = RunIndex(symbols)
    owner = np.repeat(np.arange(len(parts)), np.maximum(0, sizes - length + 1))
    at = np.arange(len(owner)) - np.repeat(
        np.cumsum(np.maximum(0, sizes - length + 1)) - np.maximum(0, sizes - length + 1), np.maximum(0, sizes - length + 1)
    )
    at = at + begins[owner]
    agree, before = index.matches(at)
    # Follow the links to the first suffix of each class of equal windows.
    root = np.arange(n)
    linked = agree >= length
    root[at[linked]] = before[linked]
    while True:
        further = root[root]
        if np.array_equal(further, root):
            break
        root = further
    earliest = np.full(n, n)
    np.minimum.at(earliest, root[at], at)
    again = earliest[root[at]] < at
    cut = np.searchsorted(owner[again], np.arange(len(parts) + 1))
    places = (at - begins[owner])[again]
    return [places[a:b] for a, b in zip(cut, cut[1:], strict=False)]


def _index_groups(length: int):
    """Rows sorted by (anchor, doc, row, begin): whole anchors are gathered into indexes of about INDEX_BYTES."""

    def run(rows: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
        spans = []
        order = sorted(range(len(rows)), key=lambda i: rows[i][1:4])
        for i, places in zip(order, repeated_windows([rows[i][4] for i in order], length), strict=True):
            if len(places):
                cut = np.flatnonzero(np.diff(places) > length)
                for a, b in zip(np.append(0, cut + 1), np.append(cut, len(places) - 1), strict=True):
                    spans.append((*rows[i][1:3], rows[i][3] + int(places[a]), int(places[b] - places[a]) + length))
        return pa.RecordBatch.from_arrays(
            [pa.array([s[k] for s in spans], pa.int64()) for k in range(4)], names=["doc", "row", "begin", "length"]
        )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, int, int, bytes]] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= INDEX_BYTES and row[0] != rows[-1][0]:
                    yield run(rows)
                    rows, size = [], 0
                if rows and row[:4] == rows[-1][:4]:  # of a document that came in several rows
                    continue
                rows.append(row)
                size += len(row[4])
        if rows:
            yield run(rows)

    return index


# --- back to the documents -------------------------------------------------------------------


def _cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their marked spans: what is left, and the maximal removed runs."""
    for batch, texts in (p for b in batches for p in batches_of(b)):
        names = batch.schema.names
        spans = batch.column(names.index("_spans")).to_pylist()
        kept, runs = [], []
        for text, marked in zip(texts, spans, strict=True):
            removed: list[list[int]] = []
            for begin, end in sorted((s["begin"], min(len(text), s["begin"] + s["length"])) for s in marked or ()):
                if removed and begin <= removed[-1][1]:
                    removed[-1][1] = max(removed[-1][1], end)
                elif begin < end:
                    removed.append([begin, end])
            at, left = 0, []
            for begin, end in removed:
                left.append(text[at:begin])
                at = end
            left.append(text[at:])
            kept.append(b"".join(left))
            runs.append(removed)
        columns = [batch.column(names.index(n)) for n in names if n != "_spans"]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(kept, pa.binary()), pa.array(runs, pa.list_(pa.list_(pa.int64())))],
            names=[*(n for n in names if n != "_spans"), "kept_bytes", "removed"],
        )


def dedup_substrings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, ...) with kept_bytes and removed, the list of removed [begin, end)."""
    docs = docs.drop("kept_bytes", "removed", "_spans", "_doc", "_row", "_marked", "_marked_row")
    named = [F.coalesce("doc_id", F.lit(_NO_DOC)).alias("_doc"), F.xxhash64("text").alias("_row")]
    rows = docs.select(named[0], "text", named[1]).mapInArrow(_anchors(length), _ROWS)
    met = rows.repartition("anchor").sortWithinPartitions("anchor", "content", "doc", "row", "begin")
    settled = landed(met.mapInArrow(_settle, _ROWS), "stretches")
    covered = settled.filter("length < 0").select("doc", "row", "begin", (-F.col("length")).cast("bigint").alias("length"))

    keyed = docs.select("text", *named)
    of_doc = (F.col("_doc") == F.col("doc")) & (F.col("_row") == F.col("row"))
    wanted = settled.filter("length > 0").groupBy("doc", "row").agg(
        F.collect_list(F.struct("anchor", "begin", "length")).alias("w")
    )
    fetched = keyed.join(wanted, of_doc).select("text", "doc", "row", "w")
    fetched = fetched.mapInArrow(_fetch, "anchor bigint, doc bigint, row bigint, begin bigint, bytes binary")
    fetched = fetched.repartition("anchor").sortWithinPartitions("anchor", "doc", "row", "begin")
    spans = covered.union(fetched.mapInArrow(_index_groups(length), _SPANS))

    marked = spans.groupBy(F.col("doc").alias("_marked"), F.col("row").alias("_marked_row"))
    marked = marked.agg(F.collect_list(F.struct("begin", "length")).alias("_spans"))
    mine = (F.col("_doc") == F.col("_marked")) & (F.col("_row") == F.col("_marked_row"))
    joined = docs.select("*", *named).join(marked, mine, "left").drop("_doc", "_row", "_marked", "_marked_row")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return joined.mapInArrow(_cover, f"{kept}, kept_bytes binary, removed array<array<bigint>>")


def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of what :func:`dedup_substrings` returns."""
    for batch in batches:
        get = lambda n, b=batch: b.column(b.schema.get_field_index(n))
        kept, size = as_bytes(get("kept_bytes")), [len(t) for t in as_bytes(get("text"))]
        yield pa.RecordBatch.from_arrays(
            [
                get("doc_id"),
                pa.array(size, pa.int64()),
                pa.array([n - len(k) for n, k in zip(size, kept, strict=True)], pa.int64()),
                pa.array([len(r) for r in get("removed").to_pylist()], pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )
