"""A cache of answers by key as a table: each merge writes the buckets of its keys only. JSON object files are imported and exported."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.sources import tables
from lotwise.sources.history_table import HistoryTable, steps


class Cache:
    """key -> value (text). Values that a later merge gives replace earlier ones; what a key had before stays in the table's history."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16) -> None:
        self.spark, self.path = spark, path
        self.table = HistoryTable(spark, path, "key", buckets)

    def rows(self) -> DataFrame:
        """key, value as they are now."""
        now = self.table.latest()
        return self.spark.createDataFrame([], "key string, value string") if now is None else now.select("key", "value")

    def merge(self, new: DataFrame) -> dict[str, int]:
        """Adds key, value rows; nulls are left out, of several values of a key the largest counts. Returns what has changed."""
        new = new.filter(F.col("key").isNotNull() & F.col("value").isNotNull()).groupBy("key").agg(F.max(F.col("value").cast("string")).alias("value"))
        name = f"{len(steps(self.spark, self.path)):09d}"
        return self.table.apply(name, new.withColumn("hash", F.sha2(F.col("value").cast("binary"), 256)), name)

    def import_json(self, path: str) -> dict[str, int]:
        """Merges a JSON object file; a missing or broken one is empty."""
        return self.merge(tables.json_cache(self.spark, path))

    def fill(self, wanted: DataFrame, fetch: Callable, most: int | None = None) -> DataFrame:
        """rows() after the keys of `wanted` (key, and what fetch needs) that the cache lacks have been fetched and merged.

        fetch maps an iterator of pandas frames with the columns of `wanted` to frames (key, value); it sees each key once,
        the first `most` keys by key where that is set.
        """
        lacks = wanted.filter(F.col("key").isNotNull()).dropDuplicates(["key"]).join(self.rows().select("key"), "key", "left_anti").select(*wanted.columns)
        if most is not None:
            lacks = lacks.orderBy("key").limit(most)  # the cap on outside calls is the feature
        self.merge(lacks.mapInPandas(fetch, "key string, value string"))
        return self.rows()
