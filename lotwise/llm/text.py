"""What the text operators share: word patterns, splits by id, Arrow batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the corpus contracts: a run without space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows per Arrow batch. Texts reach megabytes, so a batch has to hold few rows.
BATCH_ROWS = 256


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bounds what a Python worker holds at once, however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def words(text: Column) -> Column:
    """array<string> of the words of a text; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def fold_ascii(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's decimal text modulo parts: the contracts' held-out rule."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts
