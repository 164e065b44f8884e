"""The history upsert as a stream of daily batches, and first and last sightings with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.operators import history
from lotwise.operators.counters import Counters
from lotwise.sources.history_table import BUCKETS, MARK, HistoryTable, steps

__all__ = ["MARK", "current", "sightings", "steps", "upsert_batches"]


def current(spark: SparkSession, base: str, name: str) -> DataFrame:
    """`latest` or `history` after the last finished step."""
    return getattr(HistoryTable(spark, base, ""), name)()


def upsert_batches(stream: DataFrame, base: str, checkpoint: str, content: list[str], key: str = "uid", day: str = "day", buckets: int = BUCKETS):
    """Every micro-batch updates the history table under base, a step for each of its days in order; replaying a batch changes nothing.

    Each step keeps its counts: rows_in (of the day), rows (distinct keys), upserts and history rows. Returns the started query.
    """

    def apply(batch: DataFrame, number: int) -> None:
        table = HistoryTable(batch.sparkSession, base, key, buckets)
        hashed = batch.withColumn("hash", history.content_hash(*[F.col(c) for c in content]))
        for k, r in enumerate(batch.select(day).distinct().orderBy(day).collect()):  # the days of one batch
            counters = Counters()
            rows = counters.of(hashed.filter(F.col(day).eqNullSafe(r[0])), rows_in=None).select(key, *content, "hash")
            table.apply(f"{number:012d}-{k:04d}", counters.of(history.keep_first(rows, [key], ["hash"]), rows=None), r[0], counters)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sightings(events: DataFrame, key: str, ts: str, late: str = "1 day", every: str = "1 day") -> DataFrame:
    """key, window, first_seen, last_seen, events in tumbling windows; rows later than `late` are left out."""
    return events.withWatermark(ts, late).groupBy(key, F.window(ts, every)).agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), F.count("*").alias("events"))
