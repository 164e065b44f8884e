"""Queries over the corpus tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lotwise.llm import bpe, classifier, jaccard, langid, lexical, license_scan, lm_score, mixing, quality, resample, shards, topk, toxicity
from lotwise.llm.text import documents, table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.digest(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(documents(spark, sf_dir), tokenizer_path())


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.digest(table(spark, sf_dir, "embeddings"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(documents(spark, sf_dir))


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.digest(documents(spark, sf_dir))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.resolve(documents(spark, sf_dir))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(documents(spark, sf_dir))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.score(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_score": op1_lm_score,
    "op2_bpe": op2_bpe,
    "op3_toxicity": op3_toxicity,
    "op4_quality_rules": op4_quality_rules,
    "op5_language_id": op5_language_id,
    "op6_exact_topk": op6_exact_topk,
    "op7_license_scan": op7_license_scan,
    "op8_shards": op8_shards,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_mixing": op10_mixing,
    "op11_quality": op11_quality,
    "op12_lexical_search": op12_lexical_search,
    "op13_resample": op13_resample,
}

ORACLES: dict[str, str] = {
    "op6_exact_topk": topk.SQL,
    "op9_ngram_jaccard": jaccard.SQL,
    "op12_lexical_search": lexical.SQL,
    "op13_resample": resample.SQL,
}
