"""Steps that are written down leave no shuffle files behind."""

import time

from pyspark.sql import functions as F

from lotwise.operators.components import components
from lotwise.session import cut, discard, place, stored


def shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {name for name in (f.rsplit("/", 1)[-1] for f in files.split("\n")) if name.startswith("shuffle_")}


def left(spark, before):
    for _ in range(50):  # files are deleted in the background
        if not shuffles(spark) - before:
            return set()
        time.sleep(0.1)
    return shuffles(spark) - before


def counted(spark):
    return spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()


def test_a_checkpoint_leaves_no_shuffle_files(spark):
    before, df = shuffles(spark), counted(spark)
    kept = cut(df)
    assert left(spark, before) == set()
    assert sorted(kept.collect()) == sorted(df.collect())


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before, df, where = shuffles(spark), counted(spark), place(spark, "tidy")
    kept = stored(df, where)
    assert left(spark, before) == set()
    assert kept.count() == 7
    discard(spark, where)


def test_components_leave_no_shuffle_files(spark):
    before = shuffles(spark)
    labels = components(spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long"))
    assert left(spark, before) == set()
    assert {(r.node, r.label) for r in labels.collect()} == {(i, 0) for i in range(41)}
