"""Slowly changing history, run-over-run changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_hash(*parts: Column) -> Column:
    """sha256 over cleaned lower-case texts joined by |; nulls are empty."""
    return F.sha2(F.concat_ws("|", *[F.lower(F.trim(F.coalesce(p.cast("string"), F.lit("")))) for p in parts]).cast("binary"), 256)


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the order, as an aggregate (no window)."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__r")).select(*key, "__r.*")


def merged(latest: DataFrame, batch: DataFrame, date: str, key: str = "uid", close_missing: bool = False) -> DataFrame:
    """latest after a batch, with `changed`: whether the batch has given the key or its content anew."""
    content = [c for c in batch.columns if c != key]
    day = F.lit(date)
    a, b = latest.alias("a"), batch.alias("b")
    both = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full")
    gone, new = F.col(f"b.{key}").isNull(), F.col(f"a.{key}").isNull()
    same = F.col("a.hash") == F.col("b.hash")
    return both.select(
        F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key),
        *[F.when(gone | same, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in content],
        F.when(new, day).otherwise(F.col("a.first_seen")).alias("first_seen"),
        F.when(gone, F.col("a.last_seen")).otherwise(day).alias("last_seen"),
        F.when(gone | same, F.col("a.valid_from")).otherwise(day).alias("valid_from"),
        (~gone if close_missing else F.lit(True)).alias("is_current"),
        (new | ~(gone | F.coalesce(same, F.lit(True)))).alias("changed"),
    )


def upsert(latest: DataFrame, history: DataFrame, batch: DataFrame, date: str, key: str = "uid", close_missing: bool = False) -> tuple[DataFrame, DataFrame]:
    """(latest, history) after a batch (key, content columns, hash).

    latest has first_seen, last_seen and valid_from besides; history has valid_from, valid_to, is_current. A new key gets
    a row in both. An equal hash moves last_seen only. Another hash replaces the content, keeps first_seen, closes the open
    history row and opens one. Keys that the batch lacks stay as they are, unless close_missing.
    """
    content = [c for c in batch.columns if c != key]
    day = F.lit(date)
    a, b = latest.alias("a"), batch.alias("b")
    changed = b.join(a, F.col(f"a.{key}") == F.col(f"b.{key}"), "left").filter(F.col(f"a.{key}").isNull() | (F.col("a.hash") != F.col("b.hash"))).select("b.*")
    opened = changed.select(key, *content, day.alias("valid_from"), F.lit(None).cast("string").alias("valid_to"), F.lit(True).alias("is_current"))
    touched = changed.select(F.col(key).alias("__k")).withColumn("__c", F.lit(True))
    if close_missing:
        touched = touched.unionByName(latest.join(batch, key, "left_anti").select(F.col(key).alias("__k")).withColumn("__c", F.lit(True)))
    kept = history.join(touched, history[key] == F.col("__k"), "left")
    closes = F.col("is_current") & F.coalesce("__c", F.lit(False))
    closed = kept.select(key, *content, "valid_from", F.when(closes, day).otherwise(F.col("valid_to")).alias("valid_to"), (F.col("is_current") & ~closes).alias("is_current"))
    return merged(latest, batch, date, key, close_missing).drop("changed"), closed.unionByName(opened)


def new_and_gone(now: DataFrame, before: DataFrame, key: str, by: str) -> DataFrame:
    """by, change (new or gone), rows: ids only one of two runs has."""
    count = lambda x, y, name: x.join(y, key, "left_anti").groupBy(by).agg(F.count_distinct(key).alias("rows")).withColumn("change", F.lit(name))
    return count(now, before, "new").unionByName(count(before, now, "gone"))


def run_history(now: DataFrame, before: DataFrame, key: str, date: str, any_previous: bool = True) -> DataFrame:
    """Price change, photo change and status change of every listing against the previous run.

    photo_changed also holds for a new listing with photos, if there is a previous run and any_previous is set.
    """
    old = before.select(F.col(key).alias("__k"), F.col("price").alias("__price"), F.col("status").alias("__status"), F.array_sort("photos").alias("__photos"))
    both = now.join(old, F.col(key) == F.col("__k"), "left")
    known = F.col("__k").isNotNull()
    none = F.array().cast("array<string>")
    photo = F.coalesce(F.array_sort("photos"), none) != F.coalesce("__photos", none)
    return both.select(
        key, F.lit(date).alias("run_date"), "price", "status",
        (F.col("price") - F.col("__price")).alias("price_delta"),
        (photo if any_previous else known & photo).alias("photo_changed"),
        F.coalesce(F.col("status") != F.col("__status"), F.lit(False)).alias("status_changed"),
    )
