"""Reading and writing of the engine's tables; paths are Spark paths, never opened by Python."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.functions.text import one_line
from lotwise.schema import RAW_LISTING, conform, missing_to_null


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def first_existing(spark: SparkSession, paths: list[str]) -> str | None:
    return next((p for p in paths if exists(spark, p)), None)


def raw_csv(spark: SparkSession, paths: list[str] | str, schema: T.StructType = RAW_LISTING) -> DataFrame:
    """Listings as text, missing tokens as null, with the file (source_path) and the record's place in it (position).

    Records may span lines; quotes are doubled.
    """
    names = schema.fieldNames()
    read = spark.read.csv(paths, schema=schema, header=True, multiLine=True, quote='"', escape='"', enforceSchema=False)
    df = missing_to_null(read).withColumns({"source_path": F.input_file_name(), "position": F.monotonically_increasing_id()})
    return df.select(*names, "source_path", "position")


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern (with *, ?, [..] or {..}) or a plain path stands for."""
    p = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return [s.getPath().toString() for s in found] if found else []


def union_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files of several layouts, by column name; all columns text; paths and patterns, distinct and sorted.

    Files with one header are one scan. Absent files, and those whose header can't be read, are left out with a warning; of a file that
    breaks off later, what comes before is kept.
    """
    layouts: dict[tuple[str, ...], list[str]] = {}
    for p in sorted({m for pattern in paths for m in matches(spark, pattern)}):
        try:
            layouts.setdefault(tuple(spark.read.csv(p, header=True, multiLine=True, escape='"', inferSchema=False).columns), []).append(p)
        except Exception as why:  # noqa: BLE001  whatever a reader finds wrong with the file
            warnings.warn(f"{p} is left out: {why}", stacklevel=2)
    out = None
    for names, files in layouts.items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        df = missing_to_null(spark.read.option("ignoreCorruptFiles", "true").csv(files, schema=schema, header=True, multiLine=True, escape='"'))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"none of {paths}")
    return out


def read(spark: SparkSession, path: str) -> DataFrame:
    """csv or parquet, by extension."""
    if path.endswith((".csv", ".csv.gz")):
        return union_csv(spark, [path])
    return spark.read.parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return conform(spark.read.parquet(path), schema) if exists(spark, path) else spark.createDataFrame([], schema)


def csv_records(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """source_path, records: true records of each file."""
    return raw_csv(spark, paths, T.StructType([T.StructField("c0", T.StringType())])).groupBy("source_path").agg(F.count("*").alias("records"))


def json_cache(spark: SparkSession, path: str, value: str = "string") -> DataFrame:
    """key, value rows of a JSON object file; a missing or broken file is empty."""
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    parsed = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>", {"mode": "PERMISSIVE"}).alias("m"))
    return parsed.select(F.explode("m").alias("key", "value")).withColumn("value", F.col("value").try_cast(value))


def runs(spark: SparkSession, base: str) -> DataFrame:
    """run_date, previous: the runs under base (folders run=...), each with the one before it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in (fs.listStatus(p) if fs.exists(p) else [])) if fs.exists(p) else []
    dates = [n.removeprefix("run=") for n in names if n.startswith("run=")]
    return spark.createDataFrame([(d, dates[i - 1] if i else None) for i, d in enumerate(dates)], "run_date string, previous string")


def resolve_run(spark: SparkSession, base: str, date: str | None = None) -> str | None:
    """Folder of a run: the date's, else `latest`, else the last."""
    last = runs(spark, base).agg(F.max("run_date")).first()[0]
    wanted = [f"run={date}"] if date else []
    return first_existing(spark, [f"{base}/{name}" for name in (*wanted, "latest", *([f"run={last}"] if last else []))])


# --- sinks


def write_table(df: DataFrame, path: str, schema: T.StructType | None = None, dictionary: bool = True) -> None:
    out = conform(df, schema) if schema is not None else df
    out.write.mode("overwrite").option("compression", "snappy").option("parquet.enable.dictionary", str(dictionary).lower()).parquet(path)


def replace_partition(df: DataFrame, path: str, by: str = "run_date") -> None:
    """Replaces the partitions that df has; others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def put_mark(spark: SparkSession, path: str) -> None:
    """An empty file: made at once or not at all."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True).close()


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def recovered(spark: SparkSession, path: str) -> None:
    """Finishes what an interrupted swap() left: the old table goes back where no new one came."""
    p = spark._jvm.org.apache.hadoop.fs.Path
    fs = p(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(p(f"{path}.old")):
        if fs.exists(p(path)):
            fs.delete(p(f"{path}.old"), True)
        else:
            fs.rename(p(f"{path}.old"), p(path))


def swap(df: DataFrame, path: str) -> None:
    """Replaces a table that df may be reading: writes beside it, then renames the old one away and the new one in.

    One of the two is there at any moment; recovered() puts the old one back after a crash between the renames.
    """
    spark = df.sparkSession
    recovered(spark, path)
    df.write.mode("overwrite").parquet(f"{path}.new")
    p = spark._jvm.org.apache.hadoop.fs.Path
    fs = p(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(p(path)) and not fs.rename(p(path), p(f"{path}.old")):
        raise OSError(f"can't rename {path}")
    if not fs.rename(p(f"{path}.new"), p(path)):
        raise OSError(f"can't rename {path}.new")
    fs.delete(p(f"{path}.old"), True)


def publish(df: DataFrame, base: str, date: str, name: str) -> None:
    """A table of a run, and its copy under latest."""
    where = f"{base}/run={date}/{name}"
    write_table(df, where)
    swap(df.sparkSession.read.parquet(where), f"{base}/latest/{name}")


def raw_copy(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("compression", "gzip").csv(path)


def raw_listings(df: DataFrame, path: str) -> None:
    """Raw listings as CSV files with the fixed columns in their order: every cell on one line but the description's, nulls empty."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) if c == "description" else one_line(F.col(c).cast("string")) for c in RAW_LISTING.fieldNames() if c in df.columns]
    names = [c for c in RAW_LISTING.fieldNames() if c in df.columns]
    whole = df.select(*[c.alias(n) for n, c in zip(names, cells, strict=True)])
    whole = whole.select(*[F.col(c) if c in names else F.lit("").alias(c) for c in RAW_LISTING.fieldNames()])
    whole.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def csv_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def json_text(c: Column) -> Column:
    return F.to_json(c, {"ignoreNullFields": "false"})
