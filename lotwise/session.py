"""Session settings shared by queries, benches and tests."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and benches; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lotwise")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LOTWISE_DRIVER_MEMORY", "8g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; one of our own only where none is set and one machine does all the work."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext._jsc.sc()
    if context.getCheckpointDir().isEmpty():
        if not where and not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(where or tempfile.mkdtemp(prefix="lotwise-checkpoints-"))
    return where or context.getCheckpointDir().get()


#: Spark's own setting: shuffle files go when the execution that made them ends.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Executions within leave no shuffle files: their results are written down, so nothing reads these again.

    Spark takes the setting when a DataFrame is made, so frames made before keep their files.
    """
    before = spark.conf.get(TIDY, "false")
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        spark.conf.set(TIDY, before)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: results that an executor loss can't take away."""
    shared_dir(df.sparkSession)
    with tidy(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a frame made here: one made before is not tidied


def empty(df: DataFrame) -> bool:
    """Whether df has no rows; leaves no shuffle files."""
    with tidy(df.sparkSession):
        return df.isEmpty()


def place(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, where: str) -> DataFrame:
    """df as a table at that path: compressed, read by column, and gone after discard()."""
    with tidy(df.sparkSession):
        df.write.parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)


def kept(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, read by column and well compressed; it goes when the session's JVM ends, or by release()."""
    spark = df.sparkSession
    where = place(spark, name)
    with tidy(spark):
        df.select("*").write.option("compression", "zstd").parquet(where)  # a frame made here: one made before is not tidied
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    out = spark.read.schema(df.schema).parquet(where)
    out.kept_at = where
    return out


def release(*tables: DataFrame) -> None:
    """Deletes what kept() has written, once nothing reads it any more."""
    for t in tables:
        discard(t.sparkSession, t.kept_at)


def discard(spark: SparkSession, where: str) -> None:
    """Deletes what stored() has written, once nothing reads it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
