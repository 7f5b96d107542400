"""Corpus pipeline: from raw documents to token ids, in five stages.

Each stage reads what the one before has kept, as a written table.  All but the last
return the columns of ``documents``.

1. quality rules: documents that the rules reject go;
2. line dedup: lines of many documents go, texts (and n_chars) change;
3. near dedup: of each class of near-duplicates the smallest doc_id stays;
4. decontamination: documents that hold a benchmark item go;
5. pieces: texts become the ids of SentencePiece pieces.

Documents without doc_id are judged by the rules and the lines; no class and no
finding can name them, so stages 3 and 4 keep them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import decontaminate, line_dedup, near_dedup, pieces, quality_rules
from ledgerlark.llm.book import PIECE_TOKENIZER, tokenizer_path
from ledgerlark.session import landed, ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ratios = quality_rules.train(quality_rules.marked_trusted(docs, labels))
    return quality_rules.judge(docs, ratios).filter("kept").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    kept = line_dedup.dedup_lines(docs).withColumn("text", F.col("kept_text"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    copies = near_dedup.near_classes(docs).filter("doc_id <> class_id").select("doc_id")
    return docs.join(copies, "doc_id", "left_anti").select(docs.columns)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = landed(decontaminate.contaminated(docs, items).select("doc_id").distinct(), "contaminated")
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    encoded = pieces.encode(docs.select("doc_id", "source", "text"), tokenizer_path(PIECE_TOKENIZER))
    return encoded.select("doc_id", "source", F.size("pieces").cast("bigint").alias("n_pieces"), "pieces")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near),
    ("decontamination", clean),
    ("sentencepiece", encode),
]

# Hashed models, minimum hashes and Viterbi searches have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
