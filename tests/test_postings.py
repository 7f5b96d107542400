"""The stored index against searches over the texts: terms, places, phrases with gaps, segments, what a query reads."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from ledgerlark.operators import postings as P
from ledgerlark.operators import search as K
from ledgerlark.session import fresh_path

WORDS = "a b c d the of Zed éa x1".split()


def texts():
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.choice([0, 1, 5, 40])))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "the " * 1000 + "of"), (63, "平安银行 a b 银行"), (64, "a-b,c\nd! สวัสดี"), (65, "éa ÉA")]
    return rows


@pytest.fixture(scope="module")
def index(spark):
    docs = spark.createDataFrame(texts(), "doc_id bigint, text string").repartition(4)
    path = fresh_path(spark, "index")
    P.add_segment(docs, path, 0)
    return docs, path


def by_hand(text: str, phrase: list[str], slop: int) -> int:
    ts = K.phrase_terms(text or "")
    found = 0
    for p, t in enumerate(ts):
        if t != phrase[0]:
            continue
        at = p
        for word in phrase[1:]:
            at = next((q for q in range(at + 1, len(ts)) if ts[q] == word), None)
            if at is None:
                break
        found += at is not None and at - p - (len(phrase) - 1) <= slop
    return found


def test_terms_on_both_sides_agree(spark):
    rows = [(t or "",) for _, t in texts()] + [("naïve café ภาษาไทย x́̂ ́b ΑΒΓ ß İ",)]
    for text, found in spark.createDataFrame(rows, "t string").select("t", K.terms(F.col("t"))).collect():
        if "İ" not in text:  # lower-cased to two signs, in either order of marks
            assert found == K.phrase_terms(text)
    assert K.phrase_terms("cafés, ภา") == ["cafés", "ภ", "า"]


def test_postings_hold_places(spark, index):
    docs, path = index
    stored = {(r["doc_id"], r["term"]): (r["tf"], r["dl"], r["p"]) for r in spark.read.parquet(f"{path}/postings").withColumn("p", P.decoded(F.col("blocks"))).collect()}
    want = {}
    for doc_id, text in texts():
        ts = K.phrase_terms(text or "")
        for t in set(ts):
            places = [i for i, x in enumerate(ts) if x == t]
            want[doc_id, t] = (len(places), len(ts), places)
    assert stored == want
    assert spark.read.parquet(f"{path}/stored").count() == len(texts())


@pytest.mark.parametrize("query", ["the of", "zed the the", "银行 a", "สวัสดี", "nowhere", "", "the nowhere"])
def test_ranking_equals_search_over_texts(spark, index, query):
    docs, path = index
    got = [tuple(r) for r in P.bm25_indexed(spark, path, query, 7).collect()]
    assert got == [tuple(r) for r in K.bm25_topk(docs, query, 7).collect()]


@pytest.mark.parametrize("phrase", ["the of", "a b a", "the the", "银行", "平安银行", "of", "c nowhere", "", "b c d", "สวัส"])
@pytest.mark.parametrize("slop", [0, 1, 3])
def test_phrases(spark, index, phrase, slop):
    docs, path = index
    got = {r["doc_id"]: r["places"] for r in P.phrase_indexed(spark, path, phrase, slop).collect()}
    words = K.phrase_terms(phrase)
    want = {i: by_hand(t, words, slop) for i, t in texts()} if words else {}
    assert got == {i: n for i, n in want.items() if n}
    if slop == 0:
        assert got == {r["doc_id"]: r["places"] for r in K.phrase_match(docs, phrase).collect()}


def test_segments_are_added_and_merged(spark, index):
    docs, _ = index
    path, target = fresh_path(spark, "index"), fresh_path(spark, "index")
    P.load_segment(docs.filter("doc_id < 30"), path, 0)
    P.load_segment(docs.filter("doc_id < 50"), path, 1)
    P.load_segment(docs, path, 2)
    kept = {}
    for bound in (30, 50, 100):
        new = {}
        for i, t in texts():
            if i < bound and t not in kept:
                new.setdefault(t, i)
        kept |= new
    assert {r["doc_id"] for r in spark.read.parquet(f"{path}/stored").collect()} == set(kept.values())
    P.merge_segments(spark, path, target)
    one = docs.filter(F.col("doc_id").isin(list(kept.values())))
    for where in (path, target):
        assert P.bm25_indexed(spark, where, "the a", 9).collect() == K.bm25_topk(one, "the a", 9).collect()


def test_a_query_reads_its_buckets_only(spark, index, capsys):
    _, path = index
    P.postings_of(spark, path, ["the", "of"]).explain("formatted")
    plan = capsys.readouterr().out
    buckets = sorted({P.bucket_of(w) for w in ("the", "of")})
    assert regex.search(r"PartitionFilters: \[.*bucket#\d+ (?:IN|INSET)? ?.*" + str(buckets[0]), plan)
    assert "PushedFilters: [In(term" in plan and "text" not in regex.findall("ReadSchema: (.*)", plan)[0]
    assert len({r["bucket"] for r in P.postings_of(spark, path, ["the", "of"]).select("bucket").collect()}) == len(buckets)


@pytest.mark.parametrize("at_once", [1, 7, 1_000_000])
def test_rows_are_grouped_a_few_at_a_time(monkeypatch, at_once):
    """Keys that repeat or are null, rows without terms, runs over several blocks."""
    monkeypatch.setattr(P, "SORTED", at_once)
    rows = [(1, ["b", "a", "b"]), (1, ["a"]), (None, []), (None, ["a", "c"] * 100), (2, []), (3, ["x"] * 64)]
    rows = pa.RecordBatch.from_pydict({"doc_id": pa.array([k for k, _ in rows], pa.int64()), "ts": [t for _, t in rows]})
    # A slice, as its lists begin within the values.
    got = [tuple(r.values()) for batch in P.grouped_terms(iter([rows.slice(0, 3), rows.slice(3)])) for r in batch.to_pylist()]
    found = [(t, k, tf, dl, [b["first"] + g for b in blocks for g in b["gaps"]], [len(b["gaps"]) for b in blocks]) for t, k, tf, dl, blocks in got]
    want = [("a", 1, 1, 3, [1], [1]), ("b", 1, 2, 3, [0, 2], [2]), ("a", 1, 1, 1, [0], [1]), ("x", 3, 64, 64, list(range(64)), [64])]
    want += [("a", None, 100, 200, list(range(0, 200, 2)), [64, 36]), ("c", None, 100, 200, list(range(1, 200, 2)), [64, 36])]
    assert sorted(map(str, found)) == sorted(map(str, want))


def test_signs_and_runs_at_the_ends_of_the_fast_ranges(spark):
    text = "az09 ßöøÿ à÷b×c ÀÖ 年a报 9日 _x-y々 ก1 ｱア ٣ a\u0301 \x7f\x80z"
    want = regex.findall(r"(?V1)[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]|[[\p{L}\p{N}\p{M}]&&[^\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]]+", text.lower())
    assert K.phrase_terms(text) == want
    assert spark.createDataFrame([(text,)], "t string").select(K.terms(F.col("t"))).first()[0] == want
