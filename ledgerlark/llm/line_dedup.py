"""Line de-duplication with a sharded minimal perfect hash.

Lines that many documents hold are boilerplate.  A line's key is the line
without surrounding ASCII space and with A-Z lower-cased; keys of at least
``min_chars`` code points in at least ``min_docs`` documents lose all their
lines except those of the largest ``doc_id`` that holds the key.

1. Every task reduces its lines to one row for each distinct 128-bit key hash
   (number of documents, largest doc_id); a grouped sum with map-side combine
   merges them.  Only 40 bytes a distinct line and task are shuffled, no text,
   and a line that a third of all documents hold is one row from each task.
2. Keys below ``min_docs`` cannot lose lines and leave.  The others are dealt
   into shards by hash; a shard gets a minimal perfect hash (hash and displace:
   one displacement for each small bucket of keys) that numbers its keys without
   gaps, and two arrays in that order: fingerprints (8 bytes) and the counts
   with the document that keeps the line.  Shards are written as rows.
3. Documents probe the arrays.  If all shards together stay below
   ``broadcast_limit`` (their written size is summed first), each task probes
   them in memory and no text is shuffled.  Beyond that, compact probes of each
   document meet their shard in a co-grouped task.  A shard is copied as often as
   its probes fill groups of ``group_bytes``, and rows are dealt to the copies, so
   that neither a hot line nor a shard becomes one task at any size.  Only the hits return to the documents.  A row
   is named by its doc_id and a digest of its text, for rows may share an id or have
   none; rows equal in both lose the same lines and are probed once.

Every row is a document.  Rows without doc_id count too; one of them keeps a
line only if no row with an id holds it (then all of them keep it).  Rows that
share the largest doc_id all keep the line.  A null or empty text is one empty
line.  An empty table gives an empty result.  Other columns pass through
``dedup_lines``; those that bear the name of a result column are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm.texts import LOWER, SPACES, as_bytes, mix
from ledgerlark.session import landed

MIN_CHARS = 40
MIN_DOCS = 5
SHARD_KEYS = 1 << 17
BROADCAST_LIMIT = 64 << 20
GROUP_BYTES = 32 << 20  # of probes that meet a shard in one task
_BUCKET = 4  # keys of a displacement bucket, on average
_NO_DOC = -(2**63)

_SHARD = T.StructType(
    [
        T.StructField("shard", T.LongType()),
        T.StructField("n_keys", T.LongType()),
        T.StructField("displacements", T.BinaryType()),
        T.StructField("fingerprints", T.BinaryType()),
        T.StructField("n_docs", T.BinaryType()),
        T.StructField("keeper", T.BinaryType()),
    ]
)


def line_keys(text: bytes, min_chars: int = MIN_CHARS) -> Iterator[tuple[int, int]]:
    """(position, 128-bit key hash) of the lines that are long enough."""
    for i, line in enumerate(text.translate(LOWER).split(b"\n")):
        key = line.strip(SPACES)
        if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars):
            yield i, xxhash.xxh3_128_intdigest(key)


def _halves(hashes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(h.to_bytes(16, "little") for h in hashes), np.uint64).reshape(-1, 2)
    return raw[:, 0].copy(), raw[:, 1].copy()


def _partial_counts(min_chars: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[int, list[int]] = {}
            for doc, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                doc = _NO_DOC if doc is None else doc
                for key in {k for _, k in line_keys(text, min_chars)}:
                    if (found := seen.get(key)) is None:
                        seen[key] = [1, doc]
                    else:
                        found[0] += 1
                        found[1] = max(found[1], doc)
            if seen:
                low, high = _halves(list(seen))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(low.view(np.int64)),
                        pa.array(high.view(np.int64)),
                        pa.array([n for n, _ in seen.values()], pa.int64()),
                        pa.array([last for _, last in seen.values()], pa.int64()),
                    ],
                    names=["low", "high", "n", "last"],
                )

    return count


def repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(low, high, n, last): the keys that enough documents hold."""
    partial = docs.select("doc_id", "text").mapInArrow(
        _partial_counts(min_chars), "low bigint, high bigint, n bigint, last bigint"
    )
    return partial.groupBy("low", "high").agg(F.sum("n").alias("n"), F.max("last").alias("last")).filter(
        F.col("n") >= min_docs
    )


# --- the minimal perfect hash of a shard -------------------------------------------------


def _slot(low: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    return (mix(low + displacement.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)).astype(np.int64)


def _bucket_of(low: np.ndarray, n: int) -> np.ndarray:
    return (mix(low ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(max(1, n // _BUCKET))).astype(np.int64)


def build_mph(low: np.ndarray) -> np.ndarray:
    """Displacements that send distinct 64-bit keys to 0..n-1 without a gap or a clash.

    Buckets are placed from the largest down.  All buckets of one size try the
    same displacement together; those whose slots are free and apart from each
    other's are placed, the rest goes on to the next displacement.
    """
    n = len(low)
    buckets = _bucket_of(low, n)
    n_buckets = max(1, n // _BUCKET)
    order = np.argsort(buckets, kind="stable")
    sizes = np.bincount(buckets, minlength=n_buckets)
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    taken = np.zeros(n, bool)
    out = np.zeros(n_buckets, np.uint32)
    for size in range(int(sizes.max(initial=0)), 0, -1):
        waiting = np.flatnonzero(sizes == size)
        keys = low[order[begins[waiting][:, None] + np.arange(size)]]
        displacement = 0
        while len(waiting):
            slots = np.sort(_slot(keys, np.array([displacement]), n), axis=1)
            good = ~taken[slots].any(axis=1) & (np.diff(slots, axis=1) > 0).all(axis=1)
            candidates = np.flatnonzero(good)
            if len(candidates):  # two buckets may want one slot: the first one gets it
                flat = slots[candidates].ravel()
                _, first = np.unique(flat, return_index=True)
                won = np.zeros(len(flat), bool)
                won[first] = True
                candidates = candidates[won.reshape(-1, size).all(axis=1)]
                taken[slots[candidates].ravel()] = True
                out[waiting[candidates]] = displacement
                rest = np.ones(len(waiting), bool)
                rest[candidates] = False
                waiting, keys = waiting[rest], keys[rest]
            displacement += 1
    return out


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    low = rows["low"].to_numpy().view(np.uint64)
    fingerprint = rows["high"].to_numpy()
    n = len(low)
    displacements = build_mph(low)
    slots = _slot(low, displacements[_bucket_of(low, n)], n)
    arrays = {}
    for name, values, kind in (
        ("fingerprints", fingerprint, np.int64),
        ("n_docs", rows["n"].to_numpy(), np.int64),
        ("keeper", rows["last"].to_numpy(), np.int64),
    ):
        placed = np.zeros(n, kind)
        placed[slots] = values
        arrays[name] = [placed.tobytes()]
    return pd.DataFrame(
        {"shard": [rows["shard"].iloc[0]], "n_keys": [n], "displacements": [displacements.tobytes()], **arrays}
    )


def build_index(repeated: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """The shards, written to the shared folder, and their number.

    Two keys with the same low half (one in 2**64 pairs) would have no perfect
    hash; the one with the larger high half is left out, so its lines stay.
    """
    keys = landed(
        repeated.groupBy("low").agg(F.min_by(F.struct("high", "n", "last"), "high").alias("v")).select("low", "v.*"),
        "line_keys",
    )
    n_shards = max(1, -(-keys.count() // shard_keys))
    dealt = keys.withColumn("shard", F.pmod(F.col("high"), F.lit(n_shards)))
    return landed(dealt.groupBy("shard").applyInPandas(_build_shard, _SHARD), "line_index"), n_shards


class Shard:
    """Arrays of one shard; ``keepers`` answers for many keys at once."""

    def __init__(self, n_keys, displacements, fingerprints, n_docs, keeper):
        self.n = n_keys
        self.displacements = np.frombuffer(displacements, np.uint32)
        self.fingerprints = np.frombuffer(fingerprints, np.int64)
        self.n_docs = np.frombuffer(n_docs, np.int64)
        self.keeper = np.frombuffer(keeper, np.int64)

    def probe(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is in the shard, and the document that keeps its line."""
        slots = _slot(low, self.displacements[_bucket_of(low, self.n)], self.n)
        return self.fingerprints[slots] == high.view(np.int64), self.keeper[slots]


def _hits(shards: dict[int, Shard], n_shards: int, keys: list[int], docs: np.ndarray) -> np.ndarray:
    """Which of the lines (key, document) are dropped."""
    low, high = _halves(keys)
    drop = np.zeros(len(keys), bool)
    of = high.view(np.int64) % n_shards
    for s in np.unique(of):
        if (shard := shards.get(int(s))) is not None:
            at = np.flatnonzero(of == s)
            found, keeper = shard.probe(low[at], high[at])
            drop[at] = found & (keeper != docs[at])
    return drop


_KEPT = [("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_text", pa.string())]


def _kept(text: bytes, dropped: set[int] | None) -> tuple[int, int, str]:
    lines = text.split(b"\n")
    if not dropped:
        return len(lines), 0, text.decode("utf-8", "replace")
    return len(lines), len(dropped), b"\n".join(x for i, x in enumerate(lines) if i not in dropped).decode("utf-8", "replace")


def _with_kept(batch: pa.RecordBatch, rows: list[tuple[int, int, str]], drop: tuple[str, ...] = ()) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n not in drop]
    columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
    for i, (name, kind) in enumerate(_KEPT):
        names.append(name)
        columns.append(pa.array([r[i] for r in rows], kind))
    return pa.RecordBatch.from_arrays(columns, names=names)


def _probe_in_task(index, n_shards: int, min_chars: int):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = {s: Shard(*arrays) for s, arrays in index.value.items()}
        for batch in batches:
            texts = as_bytes(batch.column(batch.schema.get_field_index("text")))
            ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            keys, of, at = [], [], []
            for row, text in enumerate(texts):
                for i, key in line_keys(text, min_chars):
                    keys.append(key)
                    of.append(row)
                    at.append(i)
            dropped: dict[int, set[int]] = {}
            if keys:
                docs = np.array([_NO_DOC if ids[r] is None else ids[r] for r in of], np.int64)
                for k in np.flatnonzero(_hits(shards, n_shards, keys, docs)):
                    dropped.setdefault(of[k], set()).add(at[k])
            yield _with_kept(batch, [_kept(t, dropped.get(r)) for r, t in enumerate(texts)])

    return probe


def _line_probes(n_shards: int, min_chars: int):
    """One row for each document and shard: positions and key hashes of its lines."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = batch.column(0).to_pylist(), as_bytes(batch.column(1)), batch.column(2).to_pylist()
            for doc, text, name in zip(*columns, strict=True):
                by_shard: dict[int, list[tuple[int, int]]] = {}
                for i, key in line_keys(text, min_chars):
                    high = int.from_bytes((key >> 64).to_bytes(8, "little"), "little", signed=True)
                    by_shard.setdefault(high % n_shards, []).append((i, key))
                for shard, lines in by_shard.items():
                    low, high = _halves([k for _, k in lines])
                    at = np.array([i for i, _ in lines], np.int64)
                    rows.append((shard, doc, name, at.tobytes(), low.tobytes(), high.tobytes()))
            names = ["shard", "doc_id", "row", "at", "low", "high"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names
            )

    return cut


def _probe_shard(probes: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
    found = []
    if len(shard) and len(probes):
        row = shard.iloc[0]
        index = Shard(*(row[f.name] for f in _SHARD.fields[1:]))
        for p in probes.itertuples():
            low, high = np.frombuffer(p.low, np.uint64), np.frombuffer(p.high, np.uint64)
            inside, keeper = index.probe(low, high)
            doc = _NO_DOC if pd.isna(p.doc_id) else int(p.doc_id)
            lines = np.frombuffer(p.at, np.int64)[inside & (keeper != doc)]
            if len(lines):
                found.append((p.row, lines.tolist()))
    return pd.DataFrame(found, columns=["row", "lines"])


def _drop_listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = as_bytes(batch.column(batch.schema.get_field_index("text")))
        listed = batch.column(batch.schema.get_field_index("_lines")).to_pylist()
        rows = [_kept(t, {i for part in (x or []) for i in part}) for t, x in zip(texts, listed, strict=True)]
        yield _with_kept(batch, rows, ("_lines",))


def dedup_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    broadcast_limit: int = BROADCAST_LIMIT,
    shard_keys: int = SHARD_KEYS,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, ...) with n_lines, n_dropped and kept_text."""
    spark = docs.sparkSession
    docs = docs.drop(*(n for n, _ in _KEPT), "_lines", "_row")
    index, n_shards = build_index(repeated_lines(docs, min_docs, min_chars), shard_keys)
    added = [
        T.StructField("n_lines", T.LongType()),
        T.StructField("n_dropped", T.LongType()),
        T.StructField("kept_text", T.StringType()),
    ]
    schema = T.StructType(docs.schema.fields + added)
    arrays = [f.name for f in _SHARD.fields[2:]]
    size = index.select(F.sum(sum((F.octet_length(c) for c in arrays), F.lit(0))).alias("b")).first()["b"] or 0
    if size <= broadcast_limit:
        held = {r["shard"]: (r["n_keys"], *(bytes(r[c]) for c in arrays)) for r in index.toLocalIterator()}
        return docs.mapInArrow(_probe_in_task(spark.sparkContext.broadcast(held), n_shards, min_chars), schema)
    name = F.concat_ws(":", F.md5(F.coalesce("text", F.lit(""))), "doc_id")
    named = docs.withColumn("_row", name)
    probes = (
        named.select("doc_id", "text", "_row")
        .mapInArrow(
            _line_probes(n_shards, min_chars),
            "shard bigint, doc_id bigint, row string, at binary, low binary, high binary",
        )
        .dropDuplicates(["shard", "row"])
    )
    probes = landed(probes, "line_probes")
    # A shard is copied as often as its probes fill groups; one with a hot line gets more copies.
    held_bytes = F.sum(F.octet_length("at") + F.octet_length("low") + F.octet_length("high") + F.length("row"))
    copies = probes.groupBy("shard").agg(F.ceil(held_bytes / F.lit(group_bytes)).cast("bigint").alias("copies"))
    probes = probes.join(copies, "shard").withColumn("salt", F.pmod(F.xxhash64("row"), "copies")).drop("copies")
    salted = index.join(copies, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
    salted = salted.drop("copies")
    hits = (
        probes.groupBy("shard", "salt")
        .cogroup(salted.groupBy("shard", "salt"))
        .applyInPandas(lambda p, s: _probe_shard(p, s), "row string, lines array<bigint>")
    )
    lines = hits.groupBy(F.col("row").alias("_row")).agg(F.collect_list("lines").alias("_lines"))
    joined = named.join(lines, "_row", "left").select(*(named[f"`{n}`"] for n in docs.columns), "_lines")
    return joined.mapInArrow(_drop_listed, schema)


def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_lines, n_dropped, kept_sha256) of what :func:`dedup_lines` returns."""
    for batch in batches:
        get = lambda n, b=batch: b.column(b.schema.get_field_index(n))
        shas = [hashlib.sha256(t).hexdigest() for t in as_bytes(get("kept_text"))]
        yield pa.RecordBatch.from_arrays(
            [get("doc_id"), get("n_lines"), get("n_dropped"), pa.array(shas, pa.string())],
            names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )
