"""Substring dedup where ids repeat or are missing: no passage may vanish from all of its rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import substring_dedup
from ledgerlark.session import ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def kept_by_hand(documents: list[bytes], length: int = 100) -> list[bytes]:
    """Documents in order: bytes covered by a string that started earlier go."""
    seen: set[bytes] = set()
    out = []
    for text in documents:
        gone = [False] * len(text)
        for i in range(len(text) - length + 1):
            window = text[i : i + length]
            if window in seen:
                gone[i : i + length] = [True] * length
            seen.add(window)
        out.append(bytes(b for b, g in zip(text, gone, strict=True) if not g))
    return out


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def test_repeated_and_missing_ids(spark):
    shared = words(1, 60)
    rows = [(5, shared), (5, shared), (5, shared), (7, words(2, 30) + shared), (7, shared + words(3, 30)), (9, shared)]
    rows += [(None, words(4, 50)), (None, words(4, 50)), (None, words(4, 50) + words(5, 20)), (3, words(4, 50)), (11, None), (11, "")]
    rows += [(20, words(6, 40) + words(6, 40)), (20, words(6, 40) + words(6, 40)), (None, "short"), (None, "short"), (21, "short")]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id bigint, text string, doc int, row int, begin int").repartition(5)
    hashed = df.select("doc_id", "text", F.xxhash64("text").alias("h"), *[F.col(c) for c in ("doc", "row", "begin")])
    got = substring_dedup.dedup_substrings(hashed).collect()
    documents = sorted({(r["doc_id"] is not None, r["doc_id"] or 0, r["h"], r["text"] or "") for r in got})
    want = dict(zip([(d[:2], d[3]) for d in documents], kept_by_hand([d[3].encode() for d in documents]), strict=True))
    assert len(got) == len(rows) and all((r["doc"], r["row"], r["begin"]) == (1, 2, 3) for r in got)
    for r in got:
        key = ((r["doc_id"] is not None, r["doc_id"] or 0), r["text"] or "")
        assert bytes(r["kept_bytes"]) == want[key], key[0]
    everything = b" ".join(bytes(r["kept_bytes"]) for r in got)
    assert all((t or "").encode() in everything for _, t in rows[:3] + rows[6:8] + rows[14:])


def test_many_rows_of_one_document(spark):
    base = words(8, 80)
    rows = [(1, base)] * 300 + [(k, words(k, 10) + base) for k in range(2, 30)]
    got = substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)).collect()
    assert sum(bytes(r["kept_bytes"]) == base.encode() for r in got) == 300
    assert all(base.encode() not in bytes(r["kept_bytes"]) for r in got if r["doc_id"] > 1)
