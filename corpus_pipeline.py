"""From raw documents to token ids: the stages of the training-data pipeline.

Every stage takes whole tables: empty ones give empty ones, texts of any length are read whole, repeated rows are rows of their own
unless a stage says otherwise, and further columns pass unread, whatever their names. All but the last return the columns of their
input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import bpe, jaccard, langid, mixing, quality
from lotwise.llm.registry import tokenizer_path
from lotwise.llm.text import small_batches, table
from lotwise.session import discard, place, stored

#: A document is rejected when its text has no letter, or when the classifier is sure of another language than the one stated.
SURE = 0.9


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a recognised language; one stated language may only be contradicted with a probability of SURE.

    Null and empty texts, and those without a letter, go; a null language is never contradicted; without a learned language all stay.
    """
    small_batches(spark)
    model = langid.train_fold(docs)
    p = langid.predict(model, spark, F.col("text"))
    rows = docs.select("lang", p.alias("p"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"))
    wrong = F.col("lang").isNotNull() & (F.col("p.lang_pred") != F.col("lang")) & (F.col("p.score") >= SURE)
    blank = F.lit(bool(model.langs)) & (F.col("p.lang_pred") == "und")
    return rows.filter(~blank & ~wrong).select("document.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that pass the base rules and the certified cutoffs of their language.

    Null and empty texts have too few words and go; null languages are a stratum; without labels no cutoff is certified.
    """
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of copies, five words and 0.8: the one with the smallest id.

    Null and empty texts are linked with nothing and stay; so do rows with a null id; of repeated rows of an id one stays.
    """
    return jaccard.keep_one(docs, n=5, percent=80)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a row for each pass over a document.

    Null and empty texts have no words and are never taken; null sources are one source; n_chars follows the text.
    """
    return mixing.taken_texts(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids (little-endian uint32) of their whole texts, and n_tokens; columns of these names are replaced.

    Null and empty texts have no ids.
    """
    done = bpe.encode(docs, tokenizer_path())
    return done.withColumn("n_tokens", (F.length("ids") / 4).cast("long"))


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("ngram_jaccard", ngram_jaccard),
    ("mixing_sources", mixing_sources),
    ("bpe_encoding", bpe_encoding),
]

#: Several stages learn models, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written and read again, and goes once the next one is there."""
    where = place(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{where}/{k}-{name}"
        docs = stored(stage(spark, docs, sf_dir), path)
        if before:
            discard(spark, before)
        before = path
    return docs
