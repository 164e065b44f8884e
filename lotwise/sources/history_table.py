"""Latest rows and history of a table of keys, in hash buckets of the key, written step by step.

A step's folder holds what the step changed: `latest/bucket=<b>` has the latest rows of each bucket that the step's keys fall
into, `history` the rows that it closed, `buckets` names the step whose folder has each bucket's latest rows from now on, and
`counters` what it has counted. The step counts from the moment its mark is there: a crash in between leaves the step before in
place, and a replay writes the same again. Open history rows aren't written: they are the latest rows.

So a step writes the buckets that it touches and the rows that it closes, however long the history is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.operators import history
from lotwise.operators.counters import Counters
from lotwise.sources import tables

MARK = "_DONE"
KEPT = 2  # steps whose latest rows stay, for readers of the one before
BUCKETS = 64  # of a new table; an old one keeps its own


def steps(spark: SparkSession, base: str) -> list[str]:
    """Folders of the finished steps, oldest first."""
    return sorted(p.rsplit("/", 1)[0] for p in tables.matches(spark, f"{base}/step=*/{MARK}"))


class HistoryTable:
    def __init__(self, spark: SparkSession, base: str, key: str, buckets: int = BUCKETS) -> None:
        self.spark, self.base, self.key, self.buckets = spark, base, key, buckets

    def held(self, step: str) -> tuple[dict[int, str], int]:
        """(bucket -> folder with its latest rows, number of buckets) after a step. A row a bucket."""
        rows = self.spark.read.parquet(f"{step}/buckets").collect()
        return {r.bucket: f"{self.base}/{r.step}/latest/bucket={r.bucket}" for r in rows if r.bucket >= 0}, next(r.of for r in rows)

    def latest(self, only: list[int] | None = None) -> DataFrame | None:
        """Latest rows after the last step, of some buckets or of all; None before the first step."""
        done = steps(self.spark, self.base)
        if not done:
            return None
        where, _ = self.held(done[-1])
        schema = self.spark.read.parquet(f"{done[-1]}/schema").schema
        paths = [p for b, p in sorted(where.items()) if only is None or b in only]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def history(self) -> DataFrame | None:
        """Closed and open rows: valid_from, valid_to and is_current besides key and content."""
        done = steps(self.spark, self.base)
        if not done:
            return None
        opened = self.latest().drop("first_seen", "last_seen", "is_current").withColumns({"valid_to": F.lit(None).cast("string"), "is_current": F.lit(True)})
        closed = self.spark.read.schema(opened.schema).parquet(*[f"{step}/history" for step in done])
        return closed.unionByName(opened)

    def counters(self) -> DataFrame:
        """step and its counts, a row a step."""
        at = F.regexp_extract(F.input_file_name(), r"/step=([^/]+)/", 1).alias("step")
        return self.spark.read.parquet(*[f"{s}/counters" for s in steps(self.spark, self.base)]).select(at, "*")

    def apply(self, name: str, rows: DataFrame, day: str, counters: Counters | None = None) -> dict[str, int]:
        """Brings rows (key, content, hash; one for each key) of a day into the table as the step of that name, and returns the step's counts.

        A finished step isn't done again. counters: counts that stand in the plan of the rows, kept with the step's own:
        upserts (new or changed keys), new_history_rows (rows opened) and closed_history_rows.
        """
        spark, key, where = self.spark, self.key, f"{self.base}/step={name}"
        done = steps(spark, self.base)
        if any(p.endswith(f"/step={name}") for p in done):
            return spark.read.parquet(f"{where}/counters").first().asDict()
        before, of = self.held(done[-1]) if done else ({}, self.buckets)
        bucket = F.pmod(F.xxhash64(key), F.lit(of)).cast("int")
        counters = counters or Counters()
        # written first: the rows are read three times, and counted once
        tables.write_table(rows.withColumn("bucket", bucket), f"{where}/rows")
        rows = spark.read.parquet(f"{where}/rows")
        touched = {r.bucket for r in rows.select("bucket").distinct().collect()}  # buckets at most
        rows = rows.drop("bucket")
        none = F.lit(None).cast("string")
        empty = rows.limit(0).withColumns({"first_seen": none, "last_seen": none, "valid_from": none, "is_current": F.lit(True)})
        known = self.latest(sorted(touched)) if done else None
        known = spark.createDataFrame([], empty.schema) if known is None else known
        merged = counters.of(history.merged(known, rows, day, key), upserts=F.col("changed"), new_history_rows=F.col("changed"))
        merged.drop("changed").withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{where}/latest")
        new = rows.select(F.col(key).alias("__key"), F.col("hash").alias("__hash"))
        closed = known.join(new, F.col(key) == F.col("__key")).filter(F.col("hash") != F.col("__hash")).drop("__key", "__hash", "first_seen", "last_seen", "is_current")
        closed = counters.of(closed.withColumns({"valid_to": F.lit(day), "is_current": F.lit(False)}), closed_history_rows=None)
        tables.write_table(closed, f"{where}/history")
        tables.write_table(spark.createDataFrame([], known.schema), f"{where}/schema")
        own = {b: p.split("/")[-3] for b, p in before.items()} | {b: f"step={name}" for b in touched}
        tables.write_table(spark.createDataFrame([(-1, "", of), *[(b, s, of) for b, s in sorted(own.items())]], "bucket int, step string, of int").coalesce(1), f"{where}/buckets")
        counts = counters.read()
        tables.write_table(spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts)).coalesce(1), f"{where}/counters")
        tables.put_mark(spark, f"{where}/{MARK}")
        tables.remove(spark, f"{where}/rows")
        self.clean(done)
        return counts

    def clean(self, done: list[str]) -> None:
        """Deletes latest rows that only steps before the last KEPT refer to."""
        if len(done) < KEPT:
            return
        old, _ = self.held(done[-KEPT])
        now, _ = self.held(done[-KEPT + 1])
        for b, path in old.items():
            if now.get(b) != path:
                tables.remove(self.spark, path)
