"""Toxicity by two Kneser-Ney models, one of toxic and one of ordinary labelled texts.

The models are over word stems (the first ``STEM`` letters of each run of letters and
digits, A-Z lower-cased; in scripts without blanks each sign by itself), so inflected
and compound insults are known by how they begin.  A stem is a 40-bit hash.  A class's
probability of a stem is the Kneser-Ney continuation probability:
in how many contexts (stems before it) has the class seen it?  Counts are lowered by
an absolute discount of a few contexts, and what the discounts take away goes to the
shared continuation counts of both classes together.  So a rare expression gets
nearly the same probability from both models and moves nothing.

A text's raw score compares the two log-likelihoods word by word, divided by the
number of words.  The classes also differ in their mixture of languages and topics,
which shifts most words a little; so differences are taken from their mean over the
counted contexts of both classes, one zero point for all texts, and those within a
dead zone about it, above or below, count as none.  Stronger evidence counts for
either class, however large a part of a text its words are.  Of a few widths of the
zone, that one is taken whose logistic curve has the least loss on a fold that took
no part in the counts; the curve maps raw scores to 0..1.

Counts come from every labelled row of the counting folds: each task sends its
distinct (stem, context, class) keys, dealt by stem and a few bits of the context so
that a frequent stem is spread over several groups; their numbers of distinct
contexts add up.  All stems that were counted score, however many they are: the
``table_rows`` most frequent (8 MB) go to the tasks.  If there are more, tasks send
the words they do not know under a digest of the text, a join with the other stems
gives what each text's score must be corrected by, and texts meet their correction
by the digest.  Both ways give the same scores.

Labels are learnt only from rows with crc32(doc_id as text) mod 5 <> 0: counts
from remainders 1 to 3, zone and curve from at most ``curve_rows`` rows of remainder 4.

A null or empty text has raw score 0.  Null labels and ids are not learnt from; a
doc_id with several labels is toxic if one of them says so.  If a class has no
text, or the curve no rows of a class, scores still are defined: the curve is held
by a weak prior.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.llm.quality_classifier import FOLDS, held_out
from ledgerlark.llm.texts import LOWER, RUN, batches_of, mix, owners, per_text, span_hashes, word_hashes
from ledgerlark.session import landed

STEM = 5
GROUPS = 64
SUBS = 8
TABLE_ROWS = 1 << 19
DISCOUNT = 4.0
DEAD_ZONE = 2.0  # where no labelled row can tell
ZONES = (0.0, 1.0, 2.0, 3.0)
CURVE_ROWS = 20_000
THRESHOLD = 0.5
_FLUSH = 1 << 21

_SENT = "piece int, keys binary"
_CLASSES = np.where(RUN == 1, 1, 0).astype(np.uint8)
_CONTEXT_BITS = np.uint64(23)


def stems(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Stems of all words, and the places where each text's words begin."""
    return word_hashes([t.translate(LOWER) for t in texts], _CLASSES, _stem_hashes, apart=True)


def _stem_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """40-bit hashes of the first letters of each span."""
    letters = np.append(np.flatnonzero(buffer & 0xC0 != 0x80), np.full(STEM, len(buffer)))
    cut = letters[np.searchsorted(letters, starts) + STEM]
    return span_hashes(buffer, starts, np.minimum(ends, cut)) >> np.uint64(24)


def _keys(texts: list[bytes], toxic: np.ndarray) -> np.ndarray:
    """Distinct (stem, context, class): 40 bits, 23 bits of a hash, one bit."""
    stem, places = stems(texts)
    context = np.zeros(len(stem), np.uint64)
    context[1:] = mix(stem[:-1]) >> (np.uint64(64) - _CONTEXT_BITS)
    context[places[:-1][np.diff(places) > 0]] = 0
    of_class = toxic.astype(np.uint64)[owners(places)]
    return np.unique(stem << (_CONTEXT_BITS + np.uint64(1)) | context << np.uint64(1) | of_class)


def _sent(keys: np.ndarray) -> pa.RecordBatch:
    """One row for each group of keys."""
    by_stem = mix(keys >> (_CONTEXT_BITS + np.uint64(1))) % np.uint64(GROUPS)
    group = (by_stem * np.uint64(SUBS) + (keys >> np.uint64(1)) % np.uint64(SUBS)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    group, keys = group[order], keys[order]
    cut = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(group[cut[:-1]].astype(np.int32)),
            pa.array([keys[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary()),
        ],
        names=["piece", "keys"],
    )


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each task's distinct keys; it holds at most a few million of them at a time."""
    held: list[np.ndarray] = []
    for batch in batches:
        for part, texts in batches_of(batch):
            toxic = part.column(part.schema.get_field_index("toxic")).to_numpy(zero_copy_only=False)
            held.append(_keys(texts, toxic))
            if sum(map(len, held)) > _FLUSH:
                held = [np.unique(np.concatenate(held))]
                if len(held[0]) > _FLUSH // 2:
                    yield _sent(held.pop())
    if held:
        yield _sent(np.unique(np.concatenate(held)))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(stem, contexts in ordinary, in toxic, in either); rows arrive sorted by group, one group is in memory."""

    def close(parts: list[np.ndarray]) -> pa.RecordBatch:
        keys = np.unique(np.concatenate(parts))
        stem, of = np.unique(keys >> (_CONTEXT_BITS + np.uint64(1)), return_inverse=True)
        toxic = (keys & np.uint64(1)).astype(bool)
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] >> np.uint64(1) != keys[:-1] >> np.uint64(1)
        counts = [np.bincount(of[m], minlength=len(stem)) for m in (~toxic, toxic, first)]
        return pa.RecordBatch.from_arrays(
            [pa.array(stem.astype(np.int64)), *(pa.array(c.astype(np.int64)) for c in counts)],
            names=["stem", "n0", "n1", "n"],
        )

    now, parts = None, []
    for batch in batches:
        for group, keys in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if group != now and parts:
                yield close(parts)
                parts = []
            now = group
            parts.append(np.frombuffer(keys, np.uint64))
            if sum(map(len, parts)) > 2 * _FLUSH:
                parts = [np.unique(np.concatenate(parts))]
    if parts:
        yield close(parts)


class Models:
    """log P_toxic - log P_ordinary of the stems."""

    def __init__(self, stem: np.ndarray, value: np.ndarray, unknown: float, zero: float = 0.0):
        order = np.argsort(stem)
        self.stems, self.values = stem[order], value[order].astype(np.float64)
        self.unknown, self.zero = unknown, zero

    def find(self, stem: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Differences, and which stems have one of their own."""
        if not len(self.stems):
            return np.full(len(stem), self.unknown), np.zeros(len(stem), bool)
        at = np.minimum(np.searchsorted(self.stems, stem), len(self.stems) - 1)
        known = self.stems[at] == stem
        return np.where(known, self.values[at], self.unknown), known

    def difference(self, stem: np.ndarray) -> np.ndarray:
        return self.find(stem)[0]


def _beyond(value: np.ndarray, zone: float) -> np.ndarray:
    return np.sign(value) * np.maximum(0, np.abs(value) - zone)


def _sums(models: Models, texts: list[bytes], zone: float) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the differences beyond the dead zone about the zero point, and number of words, of each text."""
    stem, places = stems(texts)
    unique, of = np.unique(stem, return_inverse=True)
    beyond = _beyond(models.difference(unique) - models.zero, zone)[of]
    return per_text(owners(places), len(texts), beyond), np.diff(places)


def raw_scores(models: Models, texts: list[bytes], zone: float = DEAD_ZONE) -> np.ndarray:
    """Mean over a text's words of the differences beyond the dead zone about the zero point, with their signs."""
    total, n = _sums(models, texts, zone)
    return total / np.maximum(1, n)


def labelled(labels: DataFrame) -> DataFrame:
    """(id, toxic, fold) of the rows that may be learnt from."""
    return (
        labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("fold", F.crc32(F.col("id").cast("string")) % FOLDS)
    )


def _models(docs: DataFrame, known: DataFrame, table_rows: int) -> tuple[Models, DataFrame | None]:
    """Models of the most frequent stems, and (stem, value) of all others, if there are any."""
    counted = known.filter(F.col("fold") < FOLDS - 1)
    sent = (
        docs.select("doc_id", "text")
        .join(counted.hint("merge"), F.col("doc_id") == F.col("id"))
        .select("toxic", "text")
        .mapInArrow(_distinct, _SENT)
    )
    contexts = sent.repartition("piece").sortWithinPartitions("piece").mapInArrow(
        _contexts, "stem bigint, n0 bigint, n1 bigint, n bigint"
    )
    stem = landed(contexts.groupBy("stem").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "n"))), "stems")
    less = lambda c: F.greatest(F.col(c) - DISCOUNT, F.lit(0.0))
    total = stem.agg(
        *(F.coalesce(F.sum(x), F.lit(0.0)).cast("double") for x in ("n0", "n1", "n", less("n0"), less("n1"))),
        F.count("*"),
    ).first()
    # Of each class: 1 / contexts, and what the discounts leave to the shared counts.
    share = [1.0 / max(1.0, total[c]) for c in (0, 1)]
    rest = [1 - total[3 + c] * share[c] for c in (0, 1)]
    log = [F.log(less(f"n{c}") * share[c] + F.col("n") * (rest[c] / max(1.0, total[2]))) for c in (0, 1)]
    zero = stem.agg(F.sum(F.col("n") * (log[1] - log[0])) / F.sum("n")).first()[0] or 0.0
    valued = stem.select("stem", "n", (log[1] - log[0]).alias("value"))
    others = None
    if total[5] <= table_rows:
        table = valued.toArrow()
    else:
        table = valued.orderBy(F.desc("n"), "stem").limit(table_rows).toArrow()
        n, last = table["n"][-1].as_py(), table["stem"][-1].as_py()
        behind = (F.col("n") < n) | ((F.col("n") == n) & (F.col("stem") > last))
        others = valued.filter(behind).select("stem", "value")
    found = [table.column(c).to_numpy() for c in ("stem", "value")]
    return Models(found[0].astype(np.uint64), found[1], float(np.log(rest[1] / rest[0])), float(zero)), others


def count_models(docs: DataFrame, known: DataFrame) -> Models:
    """Models from every labelled row of the counting folds, all stems in one; ``known`` as from :func:`labelled`."""
    return _models(docs, known, 1 << 62)[0]


_SUMS = T.StructType(
    [T.StructField("sum", T.DoubleType()), T.StructField("words", T.LongType()), T.StructField("key", T.BinaryType())]
)


def _digests(texts: list[bytes]) -> list[bytes]:
    return [hashlib.sha256(t).digest() for t in texts]


def _summed(held, zone: float, keyed: bool):
    """Rows with ``score``: sum, words and, if corrections follow, a digest of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in batches_of(batch):
                total, n = _sums(held.value, texts, zone)
                keys = pa.array(_digests(texts) if keyed else [None] * len(texts), pa.binary())
                sums = pa.StructArray.from_arrays([pa.array(total), pa.array(n), keys], ["sum", "words", "key"])
                yield pa.RecordBatch.from_arrays([*part.columns, sums], names=[*part.schema.names, "score"])

    return run


def _unknown_words(held):
    """(key, stem, n) of the stems of each text that the task's table does not have, and one row without stem a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in batches_of(batch):
                stem, places = stems(texts)
                other = ~held.value.find(stem)[1]
                of, stem = owners(places)[other], stem[other]
                order = np.lexsort((stem, of))
                of, stem = of[order], stem[order]
                first = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(stem, prepend=np.uint64(0)) != 0))
                n = np.diff(np.append(first, len(of)))
                keys = pa.array(_digests(texts), pa.binary())
                rows = np.concatenate([of[first], np.arange(len(texts))])
                found = pa.array(np.append(stem[first].astype(np.int64), np.full(len(texts), -1)))
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(rows)), found, pa.array(np.append(n, np.ones(len(texts), np.int64)))],
                    names=["key", "stem", "n"],
                )

    return run


def _with_raw(docs: DataFrame, held, others: DataFrame | None, zone: float) -> DataFrame:
    """All columns of ``docs`` and the raw score as ``score``."""
    docs = docs.drop("score")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", _SUMS)])
    summed = docs.mapInArrow(_summed(held, zone, others is not None), schema)
    total = F.col("score.sum")
    if others is not None:
        models = held.value
        value = F.col("value") - models.zero
        beyond = F.signum(value) * F.greatest(F.lit(0.0), F.abs(value) - zone)
        unknown = float(_beyond(np.float64(models.unknown - models.zero), zone))
        words = landed(docs.select("text").mapInArrow(_unknown_words(held), "key binary, stem bigint, n bigint"), "unknown")
        # Equal texts send the same words: their sum is divided by the number of copies.
        copies = words.filter("stem < 0").groupBy("key").agg(F.count("*").alias("copies"))
        more = words.join(others, "stem").groupBy("key").agg(F.sum(F.col("n") * (beyond - unknown)).alias("more"))
        mended = more.join(copies, "key").select(F.struct("key", (F.col("more") / F.col("copies")).alias("more")).alias("_mended"))
        summed = summed.join(mended, F.col("score.key") == F.col("_mended.key"), "left")
        total = total + F.coalesce(F.col("_mended.more"), F.lit(0.0))
    raw = total / F.greatest(F.lit(1), F.col("score.words"))
    return summed.select(*(F.col(f"`{c}`") for c in docs.columns), raw.alias("score"))


def fit_curve(raw: np.ndarray, label: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton's method, with a weak prior on the standardised slope."""
    if not len(raw):
        return 1.0, -2.0
    centre, scale = float(raw.mean()), float(raw.std()) or 1.0
    x = np.stack([(raw - centre) / scale, np.ones(len(raw))], axis=1)
    w, prior = np.zeros(2), np.array([1e-3, 1e-3])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(prior), x.T @ (p - label) + prior * w)
        w -= np.clip(step, -4, 4)
    return float(w[0] / scale), float(w[1] - w[0] * centre / scale)


def fit_zone(by_zone: dict[float, tuple[np.ndarray, np.ndarray]]) -> tuple[float, tuple[float, float]]:
    """The dead zone with the least loss on raw scores and labels, and its curve; of equal ones the narrowest."""
    label = next(iter(by_zone.values()))[1] if by_zone else np.zeros(0)
    if len(np.unique(label)) < 2:
        return DEAD_ZONE, fit_curve(*by_zone.get(DEAD_ZONE, (np.zeros(0), np.zeros(0))))
    best = None
    for zone, (raw, label) in sorted(by_zone.items()):
        curve = fit_curve(raw, label)
        x = np.clip(curve[0] * raw + curve[1], -35, 35)
        loss = float(np.mean(np.logaddexp(0, np.where(label > 0, -x, x))))
        if best is None or loss < best[0] - 1e-9:
            best = loss, zone, curve
    return best[1:]


def score(docs: DataFrame, labels: DataFrame, curve_rows: int = CURVE_ROWS, table_rows: int = TABLE_ROWS) -> DataFrame:
    """All columns of ``docs`` and score, 0 to 1."""
    known = labelled(labels)
    models, others = _models(docs, known, table_rows)
    held = docs.sparkSession.sparkContext.broadcast(models)
    chosen = known.filter(F.col("fold") == FOLDS - 1).orderBy(F.xxhash64("id"), "id").limit(curve_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    sample = landed(sample.select("toxic", "text"), "curve_rows")
    raws = [_with_raw(sample, held, others, z).select("score", "toxic", F.lit(z).alias("zone")) for z in ZONES]
    rows = reduce(DataFrame.union, raws).toArrow().to_pandas()
    zone, curve = fit_zone({z: (g["score"].to_numpy(), g["toxic"].to_numpy(float)) for z, g in rows.groupby("zone")})
    x = F.least(F.lit(35.0), F.greatest(F.lit(-35.0), F.col("score") * curve[0] + curve[1]))
    return _with_raw(docs, held, others, zone).withColumn("score", 1 / (1 + F.exp(-x)))
