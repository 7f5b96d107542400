"""The registered queries of the training-data operators: their SQL, columns and rows; the pipeline's stages."""

from __future__ import annotations

import collections

import pytest
from compare import difference

from conftest import SMALL
from ledgerlark.llm.book import QUERIES, SQL

COLUMNS = {
    "op1_line_dedup": "doc_id n_lines n_dropped kept_sha256",
    "op2_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op3_near_dedup": "doc_id class_id class_size",
    "op4_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op5_quality_classifier": "doc_id held_out score predicted",
    "op7_substring_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op8_toxicity": "doc_id held_out score predicted",
    "op9_token_records": "doc_id start n_tokens ids_crc32",
    "op10_sentencepiece": "doc_id n_pieces round_trip",
    "op11_fill_in_middle": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck_small, name):
    assert difference(spark, QUERIES[name], SQL[name], duck_small, SMALL) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_has_a_row_for_each_document(spark, name):
    got = QUERIES[name](spark, SMALL)
    assert set(COLUMNS[name].split()) <= set(got.columns)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert sorted(r[0] for r in got.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())


def test_one_row_for_each_vector(spark):
    got = QUERIES["op13_embedding_dedup"](spark, SMALL).collect()
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    assert sorted(r["vec_id"] for r in got) == sorted(r[0] for r in vectors.select("vec_id").collect())
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) and r["n_links"] >= 0 for r in got)


def test_records_start_where_the_ones_before_end(spark):
    rows = sorted((r["doc_id"], r["start"], r["n_tokens"]) for r in QUERIES["op9_token_records"](spark, SMALL).collect())
    total = 0
    for _, start, n in rows:
        assert start == total
        total += n


def test_contaminated_documents_hold_an_item(spark, duck_small):
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op6_decontamination"](spark, SMALL).collect()}
    exact = duck_small.execute("SELECT doc_id, item_id FROM documents, benchmark WHERE contains(documents.text, benchmark.text)")
    assert set(exact.fetchall()) <= got


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL).cache()
        assert docs.columns == columns, name
        now = docs.count()
        assert 0 < now <= before, name
        before = now
    last = corpus_pipeline.run(spark, SMALL).collect()
    assert collections.Counter(r["doc_id"] for r in last) == collections.Counter(r["doc_id"] for r in docs.collect())
    assert all(r["n_pieces"] == len(r["pieces"]) for r in last)


def test_pipeline_takes_documents_without_id_and_empty_tables(spark, tmp_path):
    import corpus_pipeline

    source = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    odd = source.limit(20).selectExpr("CAST(NULL AS BIGINT) AS doc_id", *source.columns[1:])
    source.limit(50).union(odd).write.parquet(f"{tmp_path}/documents.parquet")
    assert any(r["doc_id"] is None for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    source.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
