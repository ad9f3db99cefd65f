"""The training-data pipeline: stages over documents, each written as Parquet and read again as the next one's input.

1. language ID learns from the labelled rows and drops documents without a language (null or no letters);
2. near-dedup keeps, of each class of exact and near copies, the row of the least doc_id;
3. decontamination drops documents contaminated by the benchmark;
4. the secret scan replaces secrets in texts by a mark, and renews n_chars; no document goes;
5. SentencePiece encoding gives each document's piece ids, and says whether decoding gives the text back.

Defined cases: documents whose text is null, empty or without letters go in stage 1; a null doc_id stays
null, and counts as greater than all others where stage 2 keeps one; repeated rows are copies, of which
stage 2 keeps one; very long texts go through every stage whole; ties are those of the operators; other
columns, whatever their names, stay to the end (where one is named like a new column of stage 5, that one
gets underscores); an empty table gives an empty table of the same columns, and an empty benchmark
contaminates nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strandseek.llm import decontam, language, near_dup, pieces, secret_scan
from strandseek.llm._text import shared_folder
from strandseek.llm.queries import table, tokenizer
from strandseek.llm.warc import opened


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_known(docs, language.learn(docs))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs, size="n_chars")


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.with_pieces(docs, tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("language_id", language_stage),
    ("minhash_near_dedup", near_dup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("sentencepiece", pieces_stage),
]
#: Learned profiles, near-duplicate classes and pieces aren't SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents. What a stage has written goes once the next one's result is there."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(now := f"{folder}/{k}-{name}")
        docs = spark.read.parquet(now)
        if before:
            files, path = opened(before)
            files.delete_dir(path)
        before = now
    return docs
