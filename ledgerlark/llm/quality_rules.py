"""Quality rules: a hashed n-gram log-likelihood ratio behind a few base measures.

Two multinomials over hashed 1- and 2-grams are counted: one over the trusted
documents (``labels.quality = 1``), one over the whole raw corpus.  A document's
score is the mean of ``log p_trusted(g) - log p_raw(g)`` over its n-grams, so
length does not matter; it is kept if the score reaches a fixed threshold.  No
random draw takes part: equal texts get equal verdicts.

N-grams are taken over runs (letters and digits, or other signs), so that marks
strewn over a text show whatever word they stand at.  ``2**bits`` buckets bound
the model by a parameter; each task sends its counts in slices of 1,024 buckets,
slices are summed by task-sized streams, and only the finished table of
``2**bits`` 4-byte numbers (1 MB) reaches the driver and the tasks.

A null or empty text has no words: its base measures fail and it is not kept.
Labels that are null, of unknown documents, or repeated count as the document's
being trusted if any of its labels is 1.  With no trusted document at all every
ratio is 0.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm.texts import RUN, SPACES, WORD, batches_of, mix, owners, per_text, windows, word_hashes

BITS = 18
SLICE_BITS = 10
PRIOR = 20.0
THRESHOLD = -0.2
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
SYMBOLS = b"#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SLICE = "slice int, raw binary, trusted binary"


def features(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all 1- and 2-grams, and the position of each one's text."""
    hashes, places = word_hashes(texts, RUN)
    pairs, pair_owner = windows(hashes, places, 2)
    shift = np.uint64(64 - bits)
    grams = np.concatenate([mix(hashes) >> shift, pairs >> shift]).astype(np.int64)
    return grams, np.concatenate([owners(places), pair_owner])


def _count(bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, trusted = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for batch in batches:
            for part, texts in batches_of(batch):
                grams, owner = features(texts, bits)
                raw += np.bincount(grams, minlength=1 << bits)
                marked = part.column(part.schema.get_field_index("trusted")).to_numpy(zero_copy_only=False).astype(bool)
                trusted += np.bincount(grams[marked[owner]], minlength=1 << bits)
        width = 1 << SLICE_BITS
        used = [i for i in range(1 << (bits - SLICE_BITS)) if raw[i * width : (i + 1) * width].any()]
        cut = lambda a: pa.array([a[i * width : (i + 1) * width].tobytes() for i in used], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), cut(raw), cut(trusted)], names=["slice", "raw", "trusted"]
        )

    return count


def _sum_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums sorted slices as they stream by; a task holds the sums of its own slices only."""
    totals: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for i, *parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            arrays = [np.frombuffer(p, np.int64) for p in parts]
            totals[i] = [a + b for a, b in zip(totals[i], arrays, strict=True)] if i in totals else arrays
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(list(totals), pa.int32()),
            *(pa.array([v[k].tobytes() for v in totals.values()], pa.binary()) for k in (0, 1)),
        ],
        names=["slice", "raw", "trusted"],
    )


def marked_trusted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, trusted)"""
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_id")).distinct()
    # Merged at every size: whether the labels would fit a broadcast is not known.
    joined = docs.select("doc_id", "text").join(good.hint("merge"), F.col("doc_id") == F.col("_id"), "left")
    return joined.select("text", F.col("_id").isNotNull().alias("trusted"))


def train(marked: DataFrame, bits: int = BITS, prior: float = PRIOR) -> np.ndarray:
    """log p_trusted - log p_raw of each bucket, shrunk to 0 where there is little to count.

    ``marked`` has the columns text and trusted (boolean).
    """
    slices = marked.mapInArrow(_count(bits), _SLICE).repartition(1 << (bits - SLICE_BITS), "slice")
    raw, trusted = np.zeros(1 << bits), np.zeros(1 << bits)
    width = 1 << SLICE_BITS
    for row in slices.mapInArrow(_sum_slices, _SLICE).collect():  # 2**bits numbers, whatever the input
        at = slice(row["slice"] * width, (row["slice"] + 1) * width)
        raw[at], trusted[at] = np.frombuffer(row["raw"], np.int64), np.frombuffer(row["trusted"], np.int64)
    share = trusted.sum() / max(1.0, raw.sum())
    if share == 0:
        return np.zeros(1 << bits, np.float32)
    return np.log((trusted + prior * share) / ((raw + prior) * share)).astype(np.float32)


def _repeats(hashes: np.ndarray, places: np.ndarray, width: int = 5) -> np.ndarray:
    """Words of each text that lie in a window of ``width`` words found twice or more in the text."""
    n_texts, n = len(places) - 1, len(hashes)
    joined, owner = windows(hashes, places, width)
    covered = np.zeros(n + 1, np.int64)
    if len(joined):
        key = joined ^ mix(owner.astype(np.uint64) + np.uint64(1))
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        # place of a window's first word: windows of a text are in order, each text lacks the last width - 1
        starts = np.flatnonzero(owners(places)[: n - width + 1] == owners(places)[width - 1 :])
        again = starts[counts[inverse] > 1]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + width, -1)
    inside = np.cumsum(covered[:-1]) > 0
    return per_text(owners(places)[inside], n_texts)


def measures(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The base measures of each text."""
    hashes, places = word_hashes(texts, WORD)
    out = {name: np.zeros(len(texts), np.int64) for name in MEASURES}
    out["n_words"] = np.diff(places)
    out["n_repeat_words"] = _repeats(hashes, places).astype(np.int64)
    for i, text in enumerate(texts):
        # A code point is a byte that does not continue another one.
        words = text.translate(None, SPACES)
        out["word_chars"][i] = len(words.translate(None, _CONTINUING))
        out["n_symbols"][i] = len(words) - len(words.translate(None, SYMBOLS))
        lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
        out["n_dup_lines"][i] = len(lines) - len(set(lines))
    return out


_CONTINUING = bytes(range(0x80, 0xC0))


def _score(ratios, bits: int, threshold: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ratios.value
        for batch in batches:
            for part, texts in batches_of(batch):
                n = len(texts)
                grams, owner = features(texts, bits)
                total = per_text(owner, n, table[grams].astype(np.float64))
                mean = total / np.maximum(1, per_text(owner, n))
                base = measures(texts)
                failed = (base["n_words"] < MIN_WORDS) | (
                    100 * base["n_repeat_words"] > MAX_REPEATED_PERCENT * base["n_words"]
                )
                kept = ~failed & (mean >= threshold)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        *(pa.array(base[m].astype(np.int64)) for m in MEASURES),
                        pa.array(mean),
                        pa.array(failed),
                        pa.array(kept),
                    ],
                    names=[*part.schema.names, *MEASURES, "llr", "base_failed", "kept"],
                )

    return score


ADDED = T.StructType(
    [T.StructField(m, T.LongType()) for m in MEASURES]
    + [T.StructField("llr", T.DoubleType()), T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]
)


def judge(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` with the base measures, llr, base_failed and kept."""
    bits = int(len(ratios)).bit_length() - 1
    docs = docs.drop(*ADDED.fieldNames())
    held = docs.sparkSession.sparkContext.broadcast(ratios)
    return docs.mapInArrow(_score(held, bits, threshold), T.StructType(docs.schema.fields + ADDED.fields))
