"""Order statistics and neighbours within groups, exact, however many rows a group has.

Rows are dealt to tasks by ranges of (group, value), so a large group lies in many tasks, one behind the other. What a task can't
know, it learns from a table with a row for each group and range: how many rows of the group lie before, or which one is next to
its first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotwise.session import cut, kept


def placed(df: DataFrame, by: list[str], value: str, step=cut) -> DataFrame:
    """df with `part`: rows lie in ranges of (by, value), and stay there."""
    return step(df.repartitionByRange(*by, value).withColumn("part", F.spark_partition_id()))


def same(a: str, b: str, names: list[str]) -> Column:
    return reduce(lambda x, c: x & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")), names, F.lit(True))


def medians(counts: DataFrame, by: list[str], value: str = "value", many: str = "n") -> DataFrame:
    """by, median: of placed() values that occur `many` times each; groups without a value are left out."""
    known = counts.filter(F.col(value).isNotNull())
    sums = known.groupBy(*by, "part").agg(F.sum(many).alias("rows"))
    every = W.partitionBy(*by)
    before = sums.withColumns({"before": F.sum("rows").over(every.orderBy("part")) - F.col("rows"), "all": F.sum("rows").over(every)}).drop("rows")
    x = known.withColumn("upto", F.sum(many).over(W.partitionBy(*by, "part").orderBy(value))).alias("x")
    both = x.join(before.alias("y"), same("x", "y", [*by, "part"])).select(*[F.col(f"x.{c}").alias(c) for c in by], F.col(value).alias("v"), (F.col("before") + F.col("upto") - F.col(many)).alias("lo"), (F.col("before") + F.col("upto")).alias("hi"), "all")
    at = lambda rank: F.max(F.when((F.col("lo") <= rank) & (rank < F.col("hi")), F.col("v")))
    low, high = F.floor((F.col("all") - 1) / 2), F.floor(F.col("all") / 2)
    return both.filter((F.col("lo") <= high) & (low < F.col("hi"))).groupBy(*by).agg(((at(low) + at(high)) / 2).alias("median"))


def neighbours(df: DataFrame, by: list[str], value: str, keep: str) -> DataFrame:
    """by, s, t, a, b: each row of a group (value t, `keep` b) with the one before it in the order of its value (s, a). Values are distinct within a group."""
    rows = placed(df.select(*by, value, keep), by, value, lambda d: kept(d, "ranges"))
    order = W.partitionBy(*by, "part").orderBy(value)
    inner = rows.select(*by, F.lag(value).over(order).alias("s"), F.col(value).alias("t"), F.lag(keep).over(order).alias("a"), F.col(keep).alias("b")).filter(F.col("s").isNotNull())
    pair = F.struct(F.col(value).alias("v"), F.col(keep).alias("k"))
    ends = rows.groupBy(*by, "part").agg(F.min_by(pair, value).alias("first"), F.max_by(pair, value).alias("last"))
    ends = ends.withColumn("prior", F.lag("last").over(W.partitionBy(*by).orderBy("part"))).filter(F.col("prior").isNotNull())
    return inner.unionByName(ends.select(*by, F.col("prior.v").alias("s"), F.col("first.v").alias("t"), F.col("prior.k").alias("a"), F.col("first.k").alias("b")))
