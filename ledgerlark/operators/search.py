"""Keyword, vector, hybrid and phrase search.

Query terms are few and known, so documents are scored inside their own row:
no posting list is exploded and no document text is shuffled.  Corpus
statistics are one row of aggregates; the final order is a top-k per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add as plus

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.plans.emit import once
from ledgerlark.session import landed

# Scripts written without blanks: each sign is a term, so clauses can be searched by any part of them.
SIGNS = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")


def _term_pattern(prefix: str) -> str:
    """A run of letters, digits and the marks that combine with them, or a sign.

    Finding a character's script is slow, so it is left out for lower-case Latin letters and
    digits, which are no signs, and for other ASCII, which is neither.
    """
    signs = "".join(rf"\p{{{prefix}{s}}}" for s in SIGNS)
    run = rf"[[a-z0-9ß-öø-ÿ][[\p{{L}}\p{{N}}\p{{M}}]&&[^{signs}]]]+"
    return rf"{run}|[[^\x00-\x7F]&&[{signs}]]"


def terms(text: Column) -> Column:
    """Lower-cased alphanumeric runs, and single signs of scripts without blanks, in order; one pass over the text."""
    return F.regexp_extract_all(F.lower(text), F.lit(_term_pattern("Is")), F.lit(0))


def query_terms(query: str) -> list[str]:
    """Distinct terms of a query in order of appearance."""
    return list(dict.fromkeys(phrase_terms(query)))


def phrase_terms(phrase: str) -> list[str]:
    return regex.findall("(?V1)" + _term_pattern(""), phrase.lower())


def _counted(docs: DataFrame, words: Sequence[str], key: str, text: str) -> DataFrame:
    """(key, dl, tf0..): document length and frequency of each query term.

    The term list lives inside its row only; each text is split once.
    """
    scanned = F.get(
        F.transform(
            F.array(terms(F.col(text))),
            lambda ts: F.struct(F.size(ts).alias("dl"), F.filter(ts, lambda t: t.isin(*words)).alias("hits")),
        ),
        0,
    )
    freqs = [_frequency(word).alias(f"tf{i}") for i, word in enumerate(words)]
    return once(docs, [key], scanned, "_s").select(key, F.col("_s.dl").alias("dl"), *freqs)


def _frequency(word: str) -> Column:
    return F.size(F.filter("_s.hits", lambda t: t == word))


def bm25_scores(
    docs: DataFrame, query: str, k1: float = 1.2, b: float = 0.75, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, score) of documents that hold at least one query term; a query without terms has none."""
    words = query_terms(query)
    if not words:
        return docs.select(key, F.lit(0.0).alias("score")).limit(0)
    # Counts are a few numbers a document; statistics and scores both read them, the texts are read once.
    tf = landed(_counted(docs, words, key, text), "term_counts")
    # One row: number of documents, mean length, document frequency per term.
    stats = tf.agg(
        F.struct(
            F.count("*").alias("n"),
            F.avg("dl").alias("avgdl"),
            *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(words))],
        )
    ).scalar()
    matched = tf.filter(reduce(lambda x, y: x | y, [F.col(f"tf{i}") > 0 for i in range(len(words))]))
    scored = matched.withColumn("s", stats)

    def part(i: int) -> Column:
        f = F.col(f"tf{i}").cast("double")
        df = F.col(f"s.df{i}")
        idf = F.log(1 + (F.col("s.n") - df + 0.5) / (df + 0.5))
        norm = f + k1 * ((1 - b) + b * F.col("dl") / F.col("s.avgdl"))
        return idf * f * (k1 + 1) / norm

    return scored.select(key, reduce(plus, [part(i) for i in range(len(words))]).alias("score"))


def bm25_topk(docs: DataFrame, query: str, k: int, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """Best ``k`` documents, ranked by the exact score, which is shown with 6 digits."""
    best = bm25_scores(docs, query, k1, b).orderBy(F.desc("score"), "doc_id").limit(k)
    return best.withColumn("score", F.round("score", 6))


def keyword_topk(docs: DataFrame, keywords: str, region: str, k: int = 5) -> DataFrame:
    """Best ``k`` documents of one language by BM25 over that language."""
    return bm25_topk(docs.filter(F.col("lang") == region), keywords, k)


def query_vector(emb: DataFrame, vec_id: int) -> list[float]:
    """One stored vector, as a query for :func:`vector_topk`."""
    return [float(x) for x in emb.filter(F.col("vec_id") == vec_id).select("embedding").first()[0]]


def cosine(query: Sequence[float]) -> object:
    """Arrow function: cosine of a vector column with one query, in double precision.

    A batch whose vectors all have the query's length is one matrix product;
    null vectors and other lengths give null, zero vectors too.
    """
    q = np.asarray(query, dtype=np.float64)
    q_norm = float(np.sqrt(q @ q))

    @F.arrow_udf("double")
    def score(vectors: pa.Array) -> pa.Array:
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        fits = np.nan_to_num(lengths.astype(np.float64), nan=-1) == len(q)
        out = np.full(len(vectors), np.nan)
        if fits.any():
            usable = vectors.filter(pa.array(fits)).flatten()
            m = np.asarray(usable.to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, len(q))
            norms = np.sqrt(np.einsum("ij,ij->i", m, m)) * q_norm
            with np.errstate(divide="ignore", invalid="ignore"):
                out[fits] = (m @ q) / norms
        return pa.array(out, mask=~np.isfinite(out))

    return score


def vector_scores(emb: DataFrame, query: Sequence[float], key: str = "vec_id") -> DataFrame:
    """Null for vectors that have no cosine with the query."""
    return emb.select(key, cosine(query)(F.col("embedding")).alias("score"))


def vector_topk(emb: DataFrame, query: Sequence[float], k: int) -> DataFrame:
    """Exact nearest vectors by cosine, which is shown with 6 digits; each task keeps ``k`` rows.

    Nulls sort last and go after the limit: a filter ahead of it would score
    every vector a second time.
    """
    best = vector_scores(emb, query).orderBy(F.desc_nulls_last("score"), "vec_id").limit(k)
    return best.filter("score IS NOT NULL").withColumn("score", F.round("score", 6))


TILE_QUERIES = 4096
BLOCK_VECTORS = 16_384
_SCORED = "query_id bigint, vec_id bigint, score double"


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors (n, d) of one length, ascending by id."""
    ids, vectors = table.column("vec_id").to_numpy(), table.column("v").combine_chunks()
    values = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(ids), -1)
    order = np.argsort(ids, kind="stable")
    return ids[order], values[order]


def _best_of_block(k: int):
    """The best ``k`` rows of a block for each query of a tile, by matrix products of a few queries at a time."""

    def best(block: pa.Table, tile: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[], [], []]
        if block.num_rows and tile.num_rows:
            (ids, rows), (queries, wanted) = _matrix(block), _matrix(tile)
            norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
            for a in range(0, len(queries), 256):
                some = wanted[a : a + 256]
                lengths = np.sqrt(np.einsum("ij,ij->i", some, some))
                with np.errstate(divide="ignore", invalid="ignore"):
                    scores = (some @ rows.T) / norms / lengths[:, None]
                scores[~np.isfinite(scores)] = -np.inf
                n = min(k, len(ids))
                least = -np.partition(-scores, n - 1, axis=1)[:, n - 1 : n]
                i, j = np.nonzero((scores >= least) & np.isfinite(scores))
                order = np.lexsort((ids[j], -scores[i, j], i))
                i, j = i[order], j[order]
                rank = np.arange(len(i)) - np.searchsorted(i, i)
                i, j = i[rank < k], j[rank < k]
                for column, values in zip(found, (queries[a + i], ids[j], scores[i, j]), strict=True):
                    column.append(values)
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        columns = [pa.array(np.concatenate(c) if c else [], f.type) for c, f in zip(found, schema, strict=True)]
        return pa.Table.from_arrays(columns, schema=schema)

    return best


def vector_topk_batch(emb: DataFrame, wanted: Column, k: int) -> DataFrame:
    """(query_id, vec_id, rank, score): exact nearest vectors of every row for which ``wanted`` holds.

    Queries go into tiles and rows into blocks of bounded size, dealt by a hash; every
    tile meets every block in a task of its own, which returns at most ``k`` rows a query.
    Those are merged by a window with a limit, cut down before its shuffle.  Only vectors
    of one length meet; null vectors and components, zero vectors and other lengths of
    the pair give no row.  Ties go to the smaller id.  Ids must be unique.
    """
    usable = F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x))
    rows = emb.filter(usable & F.col("vec_id").isNotNull() & (F.size("embedding") > 0))
    rows = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("v"), F.size("embedding").alias("d"), wanted.alias("w"))
    size = rows.agg(F.count("*").alias("n"), F.count_if("w").alias("q")).first()
    n_blocks, n_tiles = max(1, -(-size["n"] // BLOCK_VECTORS)), max(1, -(-size["q"] // TILE_QUERIES))

    def dealt(n: int, seed: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    blocks = rows.select("vec_id", "v", "d", dealt(n_blocks, 1).alias("block"), every(n_tiles).alias("tile"))
    tiles = rows.filter("w").select("vec_id", "v", "d", dealt(n_tiles, 2).alias("tile"), every(n_blocks).alias("block"))
    at = ["tile", "block", "d"]
    best = blocks.groupBy(*at).cogroup(tiles.groupBy(*at)).applyInArrow(_best_of_block(k), _SCORED)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "vec_id", "rank", F.round("score", 6).alias("score"))


def _fusion_depth(k: int, c: int) -> int:
    """Depth at which no document outside both top lists can reach the fused top ``k``.

    The k-th document of either list scores at least 1/(c+k).  One outside both
    lists scores at most 2/(c+depth+1), which is less from 2(c+k)-c on.
    """
    return 2 * (c + k) - c


def _exact_ranks(scores: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """(id, rank) of a few wanted documents among all scores.

    ``wanted`` is bounded by the fusion depth.  Its scores become one sorted
    array; each scored document finds how many of them it precedes, counts per
    place are aggregated, and their running total gives the ranks.  No global
    sort, no window over the corpus.
    """
    sorted_wanted = wanted.join(scores, "id").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("id").alias("id")))).alias("w")
    )
    placed = scores.withColumn("w", sorted_wanted.scalar())
    me = F.struct((-F.col("score")).alias("s"), F.col("id").alias("id"))
    placed = placed.select(F.size(F.filter("w", lambda x: x < me)).alias("place"))
    counts = placed.groupBy("place").agg(F.count("*").alias("n"))
    # place p: documents behind exactly p wanted ones; rank of the j-th wanted = documents at places <= j-1.
    totals = counts.agg(F.collect_list(F.struct("place", "n")).alias("c"))
    out = sorted_wanted.select(F.posexplode("w").alias("j", "x")).withColumn("c", totals.scalar())
    rank = F.aggregate(
        F.filter("c", lambda e: e["place"] <= F.col("j")), F.lit(0).cast("bigint"), lambda acc, e: acc + e["n"]
    )
    return out.select(F.col("x.id").alias("id"), rank.alias(name))


def hybrid_topk(
    docs: DataFrame, emb: DataFrame, text: str, vec: Sequence[float], k: int, c: int = 60
) -> DataFrame:
    """Reciprocal-rank fusion of the full vector and keyword rankings, exact.

    Only documents in the top of either ranking can win (see ``_fusion_depth``);
    their ranks in the other ranking are counted exactly over the whole corpus.
    """
    # Scores are two numbers a document and read three times: they land once.
    by_vec = landed(vector_scores(emb, vec).select(F.col("vec_id").alias("id"), "score"), "vector_scores")
    by_vec = by_vec.filter("score IS NOT NULL")
    by_text = landed(bm25_scores(docs, text).select(F.col("doc_id").alias("id"), "score"), "text_scores")
    depth = _fusion_depth(k, c)
    best = [s.orderBy(F.desc("score"), "id").limit(depth).select("id") for s in (by_vec, by_text)]
    wanted = best[0].union(best[1]).distinct()
    vec_rank = _exact_ranks(by_vec, wanted, "vec_rank")
    text_rank = _exact_ranks(by_text, wanted, "text_rank")
    fused = vec_rank.join(text_rank, "id", "full")
    part = lambda r: F.coalesce(F.lit(1.0) / (F.lit(c) + F.col(r)), F.lit(0.0))
    return (
        fused.withColumn("score", F.round(part("vec_rank") + part("text_rank"), 9))
        .select("id", "vec_rank", "text_rank", "score")
        .orderBy(F.desc("score"), "id")
        .limit(k)
    )


def phrase_match(docs: DataFrame, phrase: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents that hold the phrase's terms next to each other; counts the places.  No terms, no documents."""
    words = phrase_terms(phrase)
    if not words:
        return docs.select(key, F.lit(0).alias("places")).limit(0)
    joined = F.concat(F.lit(" "), F.array_join(terms(F.col(text)), " "), F.lit(" "))
    # Look-ahead, so that overlapping places count.
    places = F.regexp_count(joined, F.lit(r" (?=\Q" + " ".join(words) + r"\E )"))
    return once(docs, [key], places, "places").filter("places > 0")
