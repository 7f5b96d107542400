"""Search, sessions, cache, memory, incremental loading."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlark.functions.text import vector_peek
from ledgerlark.operators import postings as P
from ledgerlark.operators import search as K
from ledgerlark.operators import sessions as H
from ledgerlark.session import fresh_path
from querybook.base import query, table

QUERY = "the letion éreen nteres"
PHRASE = "of the"
BREAK = "[^\\p{L}\\p{N}\\p{M}]+"
SIGNS = "([\\p{Han}\\p{Hiragana}\\p{Katakana}\\p{Thai}\\p{Lao}\\p{Khmer}\\p{Myanmar}])"


def _toks(text: str) -> str:
    apart = f"regexp_replace(lower({text}), '{SIGNS}', ' \\1 ', 'g')"
    return f"list_filter(regexp_split_to_array({apart}, '{BREAK}'), lambda x: x <> '')"


def bm25_sql(docs: str, words: list[str]) -> str:
    tf = ", ".join(f"len(list_filter(t, lambda x: x = '{w}')) AS tf{i}" for i, w in enumerate(words))
    df = ", ".join(f"count(*) FILTER (tf{i} > 0) AS df{i}" for i in range(len(words)))
    parts = " + ".join(
        f"ln(1 + (n - df{i} + CAST(0.5 AS DOUBLE)) / (df{i} + CAST(0.5 AS DOUBLE))) * tf{i} * CAST(2.2 AS DOUBLE)"
        f" / (tf{i} + CAST(1.2 AS DOUBLE) * (CAST(0.25 AS DOUBLE) + CAST(0.75 AS DOUBLE) * dl / avgdl))"
        for i in range(len(words))
    )
    some = " OR ".join(f"tf{i} > 0" for i in range(len(words)))
    return f"""
toks AS (SELECT doc_id, {_toks('text')} AS t FROM {docs}),
tf AS (SELECT doc_id, len(t) AS dl, {tf} FROM toks),
st AS (SELECT count(*) AS n, avg(dl) AS avgdl, {df} FROM tf),
bm AS (SELECT doc_id, {parts} AS score FROM tf, st WHERE {some})"""


COS_SQL = """
q AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 0),
cs AS (SELECT vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), v) AS score FROM embeddings, q)"""


@query("bm25_topk", f"""
WITH {bm25_sql('documents', ['the', 'letion', 'éreen', 'nteres'])}
SELECT doc_id, round(score, 6) AS score FROM (SELECT * FROM bm ORDER BY score DESC, doc_id LIMIT 10)""")
def _bm25(spark, sf):
    return K.bm25_topk(table(spark, sf, "documents"), QUERY, 10)


@query("keyword_topk", f"""
WITH region AS (SELECT * FROM documents WHERE lang = 'fr'), {bm25_sql('region', ['que', 'éreen', 'letion'])}
SELECT doc_id, round(score, 6) AS score FROM (SELECT * FROM bm ORDER BY score DESC, doc_id LIMIT 5)""")
def _keyword(spark, sf):
    return K.keyword_topk(table(spark, sf, "documents"), "que éreen letion", "fr")


# Titles in Chinese: kind of event, then a number.
NAMES = {"view": "平安银行发布年度报告", "click": "关于召开股东大会的通知", "purchase": "银行业季度业绩公告", "error": "年度报告更正公告"}
_TITLES = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in NAMES.items()) + " ELSE '其他' END || (event_id % 23)"


def _titles(spark, sf):
    kind = F.lit("其他")
    for name, title in NAMES.items():
        kind = F.when(F.col("event_type") == name, title).otherwise(kind)
    number = (F.col("event_id") % 23).cast("string")
    return table(spark, sf, "events").select(F.col("event_id").alias("doc_id"), F.concat(kind, number).alias("text"))


@query("bm25_chinese", f"""
WITH titles AS (SELECT event_id AS doc_id, {_TITLES} AS text FROM events), {bm25_sql('titles', ['银', '行', '年', '报'])}
SELECT doc_id, round(score, 6) AS score FROM (SELECT * FROM bm ORDER BY score DESC, doc_id LIMIT 10)""")
def _bm25_chinese(spark, sf):
    return K.bm25_topk(_titles(spark, sf), "银行年报", 10)


@query("phrase_chinese", f"SELECT event_id AS doc_id, 1 AS places FROM events WHERE contains({_TITLES}, '年度报告')")
def _phrase_chinese(spark, sf):
    return K.phrase_match(_titles(spark, sf), "年度报告")


@query("vector_topk", f"""
WITH {COS_SQL} SELECT vec_id, round(score, 6) AS score FROM (SELECT * FROM cs ORDER BY score DESC, vec_id LIMIT 10)""")
def _vector(spark, sf):
    emb = table(spark, sf, "embeddings")
    return K.vector_topk(emb, K.query_vector(emb, 0), 10)


@query("vector_topk_batch", """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, r.vec_id, list_cosine_similarity(q.v, r.v) AS score FROM v q JOIN v r ON q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM ranked WHERE rank <= 10""")
def _vector_batch(spark, sf):
    return K.vector_topk_batch(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, 10)


@query("hybrid_topk", f"""
WITH {COS_SQL}, {bm25_sql('documents', ['the', 'letion', 'éreen', 'nteres'])},
v AS (SELECT vec_id AS id, row_number() OVER (ORDER BY score DESC, vec_id) AS vec_rank FROM cs),
t AS (SELECT doc_id AS id, row_number() OVER (ORDER BY score DESC, doc_id) AS text_rank FROM bm)
SELECT id, vec_rank, text_rank, round(coalesce(CAST(1 AS DOUBLE) / (60 + vec_rank), 0) + coalesce(CAST(1 AS DOUBLE) / (60 + text_rank), 0), 9) AS score
FROM v FULL JOIN t USING (id) ORDER BY score DESC, id LIMIT 10""")
def _hybrid(spark, sf):
    emb = table(spark, sf, "embeddings")
    return K.hybrid_topk(table(spark, sf, "documents"), emb, QUERY, K.query_vector(emb, 0), 10)


@query("phrase_match", f"""
WITH toks AS (SELECT doc_id, {_toks('text')} AS t FROM documents),
hits AS (SELECT doc_id, len(list_filter(range(1, len(t)), lambda i: t[i] = 'of' AND t[i + 1] = 'the')) AS places FROM toks)
SELECT doc_id, places FROM hits WHERE places > 0""")
def _phrase(spark, sf):
    return K.phrase_match(table(spark, sf, "documents"), PHRASE)


def _index(spark, sf):
    path = fresh_path(spark, "postings")
    P.add_segment(table(spark, sf, "documents"), path, 0)
    return path


@query("bm25_indexed", f"""
WITH {bm25_sql('documents', ['the', 'letion', 'éreen', 'nteres'])}
SELECT doc_id, round(score, 6) AS score FROM (SELECT * FROM bm ORDER BY score DESC, doc_id LIMIT 10)""")
def _bm25_indexed(spark, sf):
    """The texts are read once, to build the index; the query reads the buckets of its terms."""
    return P.bm25_indexed(spark, _index(spark, sf), QUERY, 10)


_LOADED_SQL = """
loads AS (SELECT doc_id, text, CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS segment FROM documents),
loaded AS (SELECT min(doc_id) AS doc_id, text FROM loads WHERE segment = 0 GROUP BY text
  UNION ALL SELECT min(doc_id), text FROM loads WHERE segment = 1 AND text NOT IN (SELECT text FROM loads WHERE segment = 0) GROUP BY text)"""


@query("bm25_segments", f"""
WITH {_LOADED_SQL}, {bm25_sql('loaded', ['the', 'letion', 'éreen', 'nteres'])}
SELECT doc_id, round(score, 6) AS score FROM (SELECT * FROM bm ORDER BY score DESC, doc_id LIMIT 10)""")
def _bm25_segments(spark, sf):
    """Two loads of new contents, merged into one segment."""
    path, merged = fresh_path(spark, "postings"), fresh_path(spark, "merged_postings")
    docs = table(spark, sf, "documents")
    P.load_segment(docs.filter("doc_id % 3 <> 0"), path, 0)
    P.load_segment(docs.filter("doc_id % 3 = 0"), path, 1)
    P.merge_segments(spark, path, merged)
    return P.bm25_indexed(spark, merged, QUERY, 10)


@query("phrase_indexed", f"""
WITH toks AS (SELECT doc_id, {_toks('text')} AS t FROM documents),
hits AS (SELECT doc_id, len(list_filter(range(1, len(t)), lambda i: t[i] = 'of' AND t[i + 1] = 'the')) AS places FROM toks)
SELECT doc_id, places FROM hits WHERE places > 0""")
def _phrase_indexed(spark, sf):
    return P.phrase_indexed(spark, _index(spark, sf), PHRASE)


@query("phrase_indexed_slop", f"""
WITH toks AS (SELECT doc_id, {_toks('text')} AS t FROM documents),
hits AS (SELECT doc_id, len(list_filter(range(1, len(t) + 1), lambda i: t[i] = 'of' AND list_contains(t[i + 1:i + 3], 'the'))) AS places FROM toks)
SELECT doc_id, places FROM hits WHERE places > 0""")
def _phrase_indexed_slop(spark, sf):
    return P.phrase_indexed(spark, _index(spark, sf), PHRASE, slop=2)


@query("vector_peek", """
SELECT vec_id, array_to_string(list_transform(embedding[1:5], lambda x: CAST(round(CAST(x AS DOUBLE) * 1000) AS BIGINT)), ',') AS head, len(embedding) AS dim FROM embeddings""")
def _peek(spark, sf):
    head, dim = vector_peek(F.col("embedding"))
    shown = F.transform(head, lambda x: F.round(x.cast("double") * 1000).cast("bigint").cast("string"))
    return table(spark, sf, "embeddings").select("vec_id", F.array_join(shown, ",").alias("head"), dim.alias("dim"))


@query("last_n_runs", """
WITH runs AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM conversations)
SELECT conv_id, turn, role, text FROM (SELECT *, dense_rank() OVER (PARTITION BY conv_id ORDER BY run DESC) AS back FROM runs) WHERE back <= 3""")
def _runs(spark, sf):
    return H.last_n_runs(table(spark, sf, "conversations"), 3)


def _ops(spark, sf):
    ev = table(spark, sf, "events")
    e = F.col("event_id")
    op = F.when((F.col("event_type") == "error") & (e % 8 == 1), "clear").when(F.col("event_type") == "view", "delete").otherwise("add")
    return ev.select(
        F.col("user_id").cast("string").alias("user_id"), (e % 9).alias("memory_id"), op.alias("op"),
        F.concat(F.lit("likes "), (e % 23).cast("string")).alias("text"), e.alias("seq"),
    )


@query("memory_state", """
WITH ops AS (SELECT CAST(user_id AS VARCHAR) AS user_id, event_id % 9 AS memory_id,
    CASE WHEN event_type = 'error' AND event_id % 8 = 1 THEN 'clear' WHEN event_type = 'view' THEN 'delete' ELSE 'add' END AS op,
    'likes ' || (event_id % 23) AS text, event_id AS seq FROM events),
live AS (SELECT *, coalesce(max(CASE WHEN op = 'clear' THEN seq END) OVER (PARTITION BY user_id), -1) AS cleared FROM ops)
SELECT user_id, memory_id, text, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, memory_id ORDER BY seq DESC) AS n FROM live WHERE op <> 'clear' AND seq > cleared)
WHERE n = 1 AND op = 'add'""")
def _memory(spark, sf):
    return H.memory_state(_ops(spark, sf))


_CACHE_SQL = """
cache AS (SELECT text AS message, CASE WHEN min(doc_id) % 6 = 0 THEN '' ELSE 'answer ' || min(doc_id) END AS content
          FROM documents WHERE doc_id % 2 = 0 GROUP BY text),
split AS (SELECT d.doc_id, d.text AS message, nullif(content, '') AS content, CASE WHEN nullif(content, '') IS NULL THEN 'miss' ELSE 'hit' END AS status
          FROM documents d LEFT JOIN cache ON d.text = message WHERE d.doc_id % 2 = 1)"""


def _cache(spark, sf):
    docs = table(spark, sf, "documents")
    first = docs.filter("doc_id % 2 = 0").groupBy(F.col("text").alias("message")).agg(F.min("doc_id").alias("d"))
    answer = F.when(F.col("d") % 6 == 0, "").otherwise(F.concat(F.lit("answer "), F.col("d").cast("string")))
    return first.select("message", answer.alias("content"))


def _split(spark, sf):
    requests = table(spark, sf, "documents").filter("doc_id % 2 = 1").select("doc_id", F.col("text").alias("message"))
    return H.cache_split(requests, _cache(spark, sf))


@query("cache_split", f"WITH {_CACHE_SQL} SELECT doc_id, status, content FROM split")
def _cache_split(spark, sf):
    return _split(spark, sf).select("doc_id", "status", "content")


@query("cache_append", f"""
WITH {_CACHE_SQL}, answers AS (SELECT DISTINCT message, 'new' AS content FROM split WHERE status = 'miss')
SELECT message, content FROM cache WHERE message NOT IN (SELECT message FROM answers) UNION ALL SELECT message, content FROM answers""")
def _cache_append(spark, sf):
    answers = H.to_process(_split(spark, sf)).withColumn("content", F.lit("new"))
    return H.append_cache(_cache(spark, sf), answers)


@query("incremental_load", """
SELECT min(doc_id) AS doc_id, sha256(text) AS content_hash FROM documents WHERE doc_id % 3 = 0
  AND text NOT IN (SELECT text FROM documents WHERE doc_id % 3 <> 0) GROUP BY text""")
def _load(spark, sf):
    docs = table(spark, sf, "documents")
    return H.load_docs(docs.filter("doc_id % 3 = 0"), docs.filter("doc_id % 3 <> 0"))


@query("incremental_load_recreate", "SELECT min(doc_id) AS doc_id, sha256(text) AS content_hash FROM documents GROUP BY text")
def _recreate(spark, sf):
    docs = table(spark, sf, "documents")
    return H.load_docs(docs, docs, recreate=True)
