"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal updates.

Features are 1- and 2-grams of runs (letters and digits, or other signs) hashed
into ``2**bits`` buckets with weights log(1 + count), scaled to length one; pairs
of equal runs share one bucket of their own, since repetition counts whatever is
repeated.  The model is fitted on at most ``sample`` labelled rows, those with the
smallest hash of doc_id, in one task that follows the regularised leader row by
row; every document is then scored by one sparse dot product.  Labels are learnt
only from rows with crc32(doc_id as text) mod 5 <> 0.

Shuffles: features of the sample only.  The sample's ids are broadcast (bounded
by ``sample``), as are the weights (``2**bits`` 4-byte numbers).

A null or empty text has the bias alone and so the score of an average text of
no content.  Null labels and ids are not learnt from; of a doc_id with several
labels the smallest counts.  Without any label all scores are 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm.texts import RUN, batches_of, mix, owners, per_text, windows, word_hashes

BITS = 18
SAMPLE = 12_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1
THRESHOLD = 0.3
FOLDS = 5


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """Rows that no label is learnt from; a row without an id is one."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(True))


def vectors(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (bucket, position of the text, value); bucket 0 is the bias."""
    hashes, places = word_hashes(texts, RUN)
    pairs, pair_owner = windows(hashes, places, 2)
    if len(pairs):
        of = owners(places)
        same = (hashes[1:] == hashes[:-1])[of[1:] == of[:-1]]
        pairs[same] = mix(np.array([2], np.uint64))[0]
    shift = np.uint64(64 - bits)
    bucket = np.concatenate([mix(hashes) >> shift, pairs >> shift]).astype(np.int64)
    owner = np.concatenate([owners(places), pair_owner])
    key, counts = np.unique((owner << bits) | np.maximum(bucket, 1), return_counts=True)
    value = np.log1p(counts)
    owner = key >> bits
    value = value / np.sqrt(per_text(owner, len(texts), value**2))[owner]
    n = len(texts)
    return (
        np.concatenate([np.zeros(n, np.int64), key & ((1 << bits) - 1)]),
        np.concatenate([np.arange(n), owner]),
        np.concatenate([np.ones(n), value]),
    )


def _feature_rows(bits: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in batches_of(batch):
                bucket, owner, value = vectors(texts, bits)
                order = np.argsort(owner, kind="stable")
                cuts = np.searchsorted(owner[order], np.arange(len(texts) + 1))
                bucket, value = bucket[order].astype(np.int32), value[order].astype(np.float32)
                spans = list(zip(cuts, cuts[1:], strict=False))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(part.schema.get_field_index("turn")),
                        part.column(part.schema.get_field_index("label")),
                        pa.array([bucket[a:b].tobytes() for a, b in spans], pa.binary()),
                        pa.array([value[a:b].tobytes() for a, b in spans], pa.binary()),
                    ],
                    names=["turn", "label", "bucket", "value"],
                )

    return rows


class Ftrl:
    """FTRL-proximal logistic regression with per-coordinate rates."""

    def __init__(self, size: int, alpha: float, beta: float, l1: float, l2: float):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * self.l1 - z
        return np.where(np.abs(z) <= self.l1, 0.0, shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = 1.0 / (1.0 + np.exp(-np.clip(value @ w, -35, 35)))
        g = (p - label) * value
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def _fit(bits: int, epochs: int):
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Ftrl(1 << bits, ALPHA, BETA, L1, L2)
        rows = []
        for batch in batches:
            for label, bucket, value in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                rows.append((np.frombuffer(bucket, np.int32), np.frombuffer(value, np.float32).astype(float), label))
        for _ in range(epochs):
            for row in rows:
                model.learn(*row)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.weights().astype(np.float32).tobytes()], pa.binary())], names=["w"]
        )

    return fit


def train(docs: DataFrame, labels: DataFrame, label: str, bits: int = BITS, sample: int = SAMPLE) -> np.ndarray:
    """Weights of the buckets, fitted on at most ``sample`` labelled rows outside the held-out fold."""
    chosen = (
        labels.filter(F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"))
        .withColumn("turn", F.xxhash64("doc_id"))
        .orderBy("turn", "doc_id")
        .limit(sample)
    )
    rows = (
        docs.select(F.col("doc_id").alias("_id"), "text")
        .join(F.broadcast(chosen), F.col("_id") == F.col("doc_id"))
        .select("turn", "label", "text")
        .mapInArrow(_feature_rows(bits), "turn bigint, label int, bucket binary, value binary")
    )
    one = rows.repartition(1).sortWithinPartitions("turn", "bucket")
    fitted = one.mapInArrow(_fit(bits, EPOCHS), "w binary").collect()
    return np.frombuffer(fitted[0]["w"], np.float32) if fitted else np.zeros(1 << bits, np.float32)


def _score(weights, bits: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in batches:
            for part, texts in batches_of(batch):
                bucket, owner, value = vectors(texts, bits)
                dot = per_text(owner, len(texts), value * w[bucket])
                out = 1.0 / (1.0 + np.exp(-np.clip(dot, -35, 35)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out)], names=[*part.schema.names, "score"])

    return score


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """All columns of ``docs`` and score, the probability of label 1."""
    docs = docs.drop("score")
    bits = int(len(weights)).bit_length() - 1
    held = docs.sparkSession.sparkContext.broadcast(weights)
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(_score(held, bits), schema)
