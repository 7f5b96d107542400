"""The operators as queries over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import (
    decontaminate,
    embedding_dedup,
    fill_in_middle,
    hard_negatives,
    line_dedup,
    near_dedup,
    pieces,
    quality_classifier,
    quality_rules,
    sharding,
    substring_dedup,
    token_records,
    toxicity,
)
from ledgerlark.session import ship_package

WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return run(spark, sf_dir)

        QUERIES[name] = shipped
        if sql is not None:
            SQL[name] = sql
        return run

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_TRIM = r"regexp_replace(regexp_replace(l, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_LINE_SQL = f"""
WITH split AS (
  SELECT doc_id, unnest(ls) AS l, unnest(range(len(ls))) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
keyed AS (SELECT doc_id, l, i, {_LOWER.format(_TRIM)} AS k FROM split),
repeated AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (keeper <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (keeper IS NULL OR keeper = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN repeated USING (k) GROUP BY doc_id
"""


@query("op1_line_dedup", _LINE_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.mapInArrow(line_dedup.digest, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string")


@query("op2_quality_rules")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ratios = quality_rules.train(quality_rules.marked_trusted(docs, _table(spark, sf_dir, "labels")))
    return quality_rules.judge(docs, ratios).drop("text")


@query("op3_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(_table(spark, sf_dir, "documents"))


@query("op4_sharding")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(_table(spark, sf_dir, "documents")).drop("source")


@query("op5_quality_classifier")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = quality_classifier.train(docs, _table(spark, sf_dir, "labels"), "quality")
    scored = quality_classifier.score(docs, weights)
    return scored.select(
        "doc_id",
        quality_classifier.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op6_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, _table(spark, sf_dir, "labels")).select(
        "doc_id",
        quality_classifier.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op9_token_records")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, index = token_records.write_records(_table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER))
    index = token_records.with_starts(index).repartition("file_no").sortWithinPartitions("file_no", "place")
    ids = token_records.read_records(folder, index)
    return ids.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


@query("op10_sentencepiece")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path(PIECE_TOKENIZER)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = pieces.encode(docs, path, decoded=True)
    return decoded.select(
        "doc_id",
        F.size("pieces").cast("bigint").alias("n_pieces"),
        F.hash("pieces").alias("pieces_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


_SUBSTRING_SQL = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, i, substr(x, 2 * i + 1, 200) AS s
      FROM (SELECT doc_id, x, unnest(range(len(x) // 2 - 99)) AS i FROM h)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM w) WHERE r > 1),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (
           SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM (
             SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END AS fresh
             FROM again)) GROUP BY doc_id, g),
gaps AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM runs
         UNION ALL SELECT doc_id, max(b), NULL FROM runs GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(x, 2 * a + 1, CASE WHEN b IS NULL THEN len(x) ELSE 2 * (b - a) END), '' ORDER BY a) AS k
         FROM gaps JOIN h USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, sum(b - a) AS n, count(*) AS c FROM runs GROUP BY doc_id)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       coalesce(c, 0) AS n_spans, sha256(unhex(coalesce(k, x))) AS kept_sha256
FROM h LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query("op7_substring_dedup", _SUBSTRING_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.dedup_substrings(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.mapInArrow(
        substring_dedup.digest, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )


_FIM_SQL = r"""
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS x FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS ls,
             CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
             CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM h),
c AS (SELECT *, CAST(len(ls) AS BIGINT) AS n, least(h1 % (len(ls) + 1), h2 % (len(ls) + 1)) AS a,
             greatest(h1 % (len(ls) + 1), h2 % (len(ls) + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(ls[1:a], '') AS pre, array_to_string(ls[a + 1:b], '') AS mid,
             array_to_string(ls[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


@query("op11_fill_in_middle", _FIM_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.mapInArrow(fill_in_middle.digest, fill_in_middle.DIGEST)


_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER w <= 10
"""


@query("op12_hard_negatives", _NEGATIVES_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query("op13_embedding_dedup")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", kept.alias("kept"))
