"""The queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strandseek.llm import collocations, compression, decontam, language, near_dup, pieces, quality, resampling, secret_scan, substring, suffixes, warc
from strandseek.llm._text import Shelf, shared_folder
from strandseek.llm.tokens import token_counts


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(table(spark, sf_dir, "documents")).drop("kept")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup(table(spark, sf_dir, "documents")).drop("kept")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_archives(table(spark, sf_dir, "pages"), f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}")
    try:
        return Shelf(spark, "warc-read").put(warc.read_archives(spark, files, payloads=False))  # so the archives may go
    finally:
        warc.remove_archives(files)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trips(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_classes(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.learn(docs))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return compression.score(docs, compression.learn(docs, table(spark, sf_dir, "labels")))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_substring_dedup, op3_decontaminate, op4_suffix_dedup, op5_warc, op6_secret_scan, op7_sentencepiece, op8_near_dup, op9_quality_rules, op10_language_id, op11_collocations, op12_quality_classifier, op13_resample)}
SQL: dict[str, str] = {"op5_warc": warc.WARC_SQL, "op2_substring_dedup": substring.DEDUP_SQL, "op3_decontaminate": decontam.DECONTAMINATE_SQL, "op9_quality_rules": quality.quality_sql(), "op11_collocations": collocations.COLLOCATIONS_SQL, "op13_resample": resampling.RESAMPLE_SQL}
