"""A stored full-text index: postings with positions, searched without reading texts.

The index is a folder of segments.  A segment has two tables:

* ``postings/segment=s/bucket=b``: one row for each term of each document, with the
  term's frequency, the document's length (the norm of its field) and the places of the
  term.  Places are cut into blocks and kept as distances from the block's first one.
  Buckets are the terms' checksums; within a file rows are sorted by term, so a query
  reads the folders of its few buckets and skips row groups without its terms;
* ``stored/segment=s``: one row for each document with its length and the hash of its
  content, from which the corpus statistics come and by which later loads are told
  what is there already.

Terms of a document are grouped inside the task that reads it; the only shuffle of a load deals
finished postings to buckets, a bucket with a very common term being split.  Segments
are added without touching the others and can be merged into one.

A null text has no terms and no length, but counts as a document.  Documents need a unique key.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce
from operator import add as plus

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.operators.search import phrase_terms, query_terms, terms
from ledgerlark.operators.sessions import load_docs
from ledgerlark.session import ship_package

BUCKETS = 64
BLOCK = 64  # places
SORTED = 1_000_000  # terms


def bucket_of(term: str, buckets: int = BUCKETS) -> int:
    return zlib.crc32(term.encode()) % buckets


def grouped_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, doc_id, tf, dl, blocks) for each term of each row (doc_id, ts), whose terms ``ts`` are in order.

    Places ascend from 0, in blocks of ``BLOCK`` as distances from the first of the block.
    Rows are told by their position, so keys may repeat or be null.  A few rows at a time
    are sorted by (row, term) as numbers: the work is that of one stable sort, and memory
    is bound by ``SORTED`` terms or one longer row.
    """
    for batch in batches:
        upto = np.cumsum(pc.list_value_length(batch.column("ts")).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = upto[start - 1] if start else 0
            end = max(int(np.searchsorted(upto, before + SORTED, side="right")), start + 1)
            if upto[end - 1] > before:
                yield _runs(batch.slice(start, end - start))
            start = end


def _runs(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The rows of :func:`grouped_terms` for a small batch with at least one term."""
    lists = batch.column("ts")
    coded = lists.flatten().dictionary_encode()
    words, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    length = pc.list_value_length(lists).to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(lists)), length)
    place = np.arange(len(code)) - np.repeat(np.cumsum(length) - length, length)
    key = row * len(words) + code
    order = np.argsort(key, kind="stable")
    key, place = key[order], place[order]
    run = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    tf = np.diff(np.append(run, len(key)))
    within = np.arange(len(key)) - np.repeat(run, tf)
    block = np.flatnonzero(within % BLOCK == 0)
    ends = np.append(block, len(key))
    gaps = place - np.repeat(place[block], np.diff(ends))
    gaps = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(gaps, pa.int32()))
    blocks = pa.StructArray.from_arrays([pa.array(place[block], pa.int32()), gaps], ["first", "gaps"])
    of_run = np.append(0, np.cumsum(-(-tf // BLOCK)))
    held = row[order][run]
    columns = {
        "term": words.take(pa.array(code[order][run])),
        "doc_id": batch.column("doc_id").take(pa.array(held)),
        "tf": pa.array(tf, pa.int32()),
        "dl": pa.array(length[held], pa.int32()),
        "blocks": pa.ListArray.from_arrays(pa.array(of_run, pa.int32()), blocks),
    }
    return pa.RecordBatch.from_pydict(columns)


def decoded(blocks: Column) -> Column:
    return F.flatten(F.transform(blocks, lambda b: F.transform(b["gaps"], lambda g: b["first"] + g)))


def _shifted(places: str, by: int) -> Column:
    return F.transform(places, lambda p: p - by)


def add_segment(docs: DataFrame, path: str, segment: int, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> None:
    """Index ``docs`` as a new segment of the index at ``path``."""
    ship_package(docs.sparkSession)
    ts = terms(F.coalesce(F.col(text), F.lit("")))
    length = F.when(F.col(text).isNotNull(), F.size(ts)).alias("dl")
    content = F.sha2(text, 256).alias("content_hash")
    docs.select(F.col(key).alias("doc_id"), content, length).write.parquet(f"{path}/stored/segment={segment}")
    found = docs.select(F.col(key).alias("doc_id"), ts.alias("ts"))
    key_type = found.schema["doc_id"].dataType.simpleString()
    rows = found.mapInArrow(
        grouped_terms, f"term string, doc_id {key_type}, tf int, dl int, blocks array<struct<first: int, gaps: array<int>>>"
    )
    bucket = F.pmod(F.crc32("term"), F.lit(buckets)).cast("int").alias("bucket")
    rows = rows.select(bucket, "term", "doc_id", "tf", "dl", "blocks")
    _write_postings(rows, f"{path}/postings/segment={segment}")


def _write_postings(rows: DataFrame, path: str) -> None:
    dealt = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", "doc_id")
    dealt.write.partitionBy("bucket").parquet(path)


def load_segment(new: DataFrame, path: str, segment: int, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> None:
    """Add those documents of ``new`` whose content is in no segment yet, each content once (lowest key)."""
    spark = new.sparkSession
    stored = spark.read.parquet(f"{path}/stored").select("content_hash") if segment else None
    firsts = load_docs(new, stored, recreate=stored is None, key=key, text=text, hashed=True)
    add_segment(new.join(firsts.select(key), key, "left_semi"), path, segment, key, text, buckets)


def merge_segments(spark: SparkSession, path: str, target: str) -> None:
    """All segments of ``path`` as the only segment of ``target``; no text is read."""
    spark.read.parquet(f"{path}/stored").drop("segment").write.parquet(f"{target}/stored/segment=0")
    _write_postings(spark.read.parquet(f"{path}/postings").drop("segment"), f"{target}/postings/segment=0")


def postings_of(spark: SparkSession, path: str, words: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Postings of a few terms: only their buckets are listed, only their row groups read."""
    wanted = sorted({bucket_of(w, buckets) for w in words})
    rows = spark.read.parquet(f"{path}/postings")
    return rows.filter(F.col("bucket").isin(wanted) & F.col("term").isin(words))


def bm25_indexed(
    spark: SparkSession, path: str, query: str, k: int, k1: float = 1.2, b: float = 0.75, buckets: int = BUCKETS
) -> DataFrame:
    """(doc_id, score): the best ``k`` documents, as ``search.bm25_topk`` finds them over the texts."""
    words = query_terms(query)
    stored = spark.read.parquet(f"{path}/stored")
    if not words:
        return stored.select("doc_id", F.lit(0.0).alias("score")).limit(0)
    rows = postings_of(spark, path, words, buckets)
    tf = [F.coalesce(F.max(F.when(F.col("term") == w, F.col("tf"))), F.lit(0)).alias(f"tf{i}") for i, w in enumerate(words)]
    counted = rows.groupBy("doc_id").agg(F.max("dl").alias("dl"), *tf)
    df = rows.agg(F.struct(*[F.count_if(F.col("term") == w).alias(f"df{i}") for i, w in enumerate(words)])).scalar()
    size = stored.agg(F.struct(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))).scalar()
    scored = counted.withColumn("d", df).withColumn("s", size)

    def part(i: int) -> Column:
        f, n = F.col(f"tf{i}").cast("double"), F.col(f"d.df{i}")
        idf = F.log(1 + (F.col("s.n") - n + 0.5) / (n + 0.5))
        return idf * f * (k1 + 1) / (f + k1 * ((1 - b) + b * F.col("dl") / F.col("s.avgdl")))

    scored = scored.select("doc_id", reduce(plus, [part(i) for i in range(len(words))]).alias("score"))
    best = scored.orderBy(F.desc("score"), "doc_id").limit(k)
    return best.withColumn("score", F.round("score", 6))


def phrase_indexed(spark: SparkSession, path: str, phrase: str, slop: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, places): where the phrase's terms follow each other in order with at most ``slop`` other words among them.

    A place is a position of the first term.  Lists of places meet document by document,
    beginning with the rarest term, so those of a very common term are only fetched for
    documents that hold all rarer ones.  Shifted by their offset in the phrase, places
    that belong together are equal, and one intersection for each term and gap finds them.
    """
    words = phrase_terms(phrase)
    if not words:
        return spark.read.parquet(f"{path}/stored").select("doc_id", F.lit(0).alias("places")).limit(0)
    distinct = list(dict.fromkeys(words))
    rows = postings_of(spark, path, distinct, buckets)
    held = {r["term"]: r["count"] for r in rows.groupBy("term").count().collect()}  # a row for each word of the phrase
    if len(held) < len(distinct):
        return rows.select("doc_id", F.lit(0).alias("places")).limit(0)
    name = {w: f"p{i}" for i, w in enumerate(distinct)}
    found = None
    for word in sorted(distinct, key=lambda w: (held[w], w)):
        mine = postings_of(spark, path, [word], buckets).select("doc_id", F.col("blocks").alias(name[word]))
        found = mine if found is None else found.join(mine, "doc_id")
    lists = found.select("doc_id", *[decoded(F.col(c)).alias(c) for c in name.values()])

    # starts[x]: first places of chains of the terms so far that hold x other words.
    starts = {0: F.col(name[words[0]])}
    for offset, word in enumerate(words[1:], 1):
        further = {}
        for gap in range(slop + 1):
            reached = [starts[g] for g in starts if g <= gap]
            if reached:
                further[gap] = F.array_intersect(reduce(F.array_union, reached), _shifted(name[word], offset + gap))
        starts = further
    places = F.size(reduce(F.array_union, starts.values()))
    return lists.select("doc_id", F.explode(F.array(places)).alias("places")).filter("places > 0")
