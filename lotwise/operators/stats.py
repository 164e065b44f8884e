"""Market statistics: groups with counts, means, exact medians, modes and boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.operators import ranges


def tallied(df: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """by, name, value, n: how often each value of each column occurs, nulls too; placed in ranges, for exact medians."""
    pairs = ", ".join(f"'{v}', CAST(`{v}` AS double)" for v in values)
    long = df.select(*by, F.expr(f"stack({len(values)}, {pairs}) AS (name, value)"))
    return ranges.placed(long.groupBy(*by, "name", "value").agg(F.count("*").alias("n")), [*by, "name"], "value")


def market(df: DataFrame, by: list[str], price: str = "price", psm: str = "psm", size: str = "size") -> DataFrame:
    """Count, mean and exact median of price and price per square, mean size; rows with a null key are left out, blank keys are `unknown`.

    One pass over df: everything follows from the counts of the values.
    """
    for k in by:
        df = df.filter(F.col(k).isNotNull()).withColumn(k, F.when(F.trim(k) == "", "unknown").otherwise(F.col(k)))
    df = df.select(*by, F.col(price).alias("price"), F.col(psm).alias("psm"), F.col(size).alias("size"), F.lit(0).alias("__all"))
    keys = by or ["__all"]
    counts = tallied(df, keys, ["price", "psm", "size"])
    of = lambda c: F.sum(F.when((F.col("name") == c) & F.col("value").isNotNull(), F.col("value") * F.col("n"))) / F.sum(F.when((F.col("name") == c) & F.col("value").isNotNull(), F.col("n")))
    middle = ranges.medians(counts.filter("name <> 'size'"), [*keys, "name"]).groupBy(*keys).agg(*[F.max(F.when(F.col("name") == c, F.col("median"))).alias(f"median_{c}") for c in ("price", "psm")])
    base = counts.groupBy(*keys).agg(F.sum(F.when(F.col("name") == "price", F.col("n"))).alias("listings"), *[of(c).alias(f"avg_{c}") for c in ("price", "psm", "size")])
    out = base.join(middle, keys, "left").select(*by, "listings", "avg_price", "median_price", "avg_psm", "median_psm", "avg_size")
    if by:
        return out
    none = F.lit(None).cast("double")  # an empty table has a row too
    return out.unionByName(df.limit(1).agg(F.count("*").alias("listings")).filter("listings = 0").withColumns({c: none for c in out.columns if c != "listings"}))


def price_summary(df: DataFrame, by: str, price: str = "price") -> DataFrame:
    """Mean, exact median, extremes and count of prices; groups without a price are left out; cheapest mean first."""
    counts = tallied(df.filter(F.col(price).isNotNull()).select(by, F.col(price).alias("price")), [by], ["price"])
    out = counts.groupBy(by).agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean_price"), F.min("value").alias("min_price"), F.max("value").alias("max_price"), F.sum("n").alias("listings"))
    middle = ranges.medians(counts, [by]).select(F.col(by).alias("__by"), F.col("median").alias("median_price"))
    out = out.join(middle, F.col(by).eqNullSafe(F.col("__by")), "left")
    return out.select(by, "mean_price", "median_price", "min_price", "max_price", "listings").orderBy("mean_price", by)


def mean_by_label(df: DataFrame, label: str, price: str = "price") -> DataFrame:
    """Mean price and count of each label, null means last."""
    return df.groupBy(label).agg(F.avg(price).alias("mean_price"), F.count("*").alias("listings")).orderBy(F.asc_nulls_last("mean_price"), label)


def room_type(rooms: Column) -> Column:
    return F.when(rooms.isNull(), "Unknown").otherwise(F.concat(F.greatest(F.lit(1), F.rint(rooms).cast("int")).cast("string"), F.lit("-izbový")))


def place_cluster(lat: Column, lng: Column, city: Column, street: Column) -> Column:
    """Rounded coordinates, else city and street, else the city."""
    at = F.format_string("geo:%.3f|%.3f", lat, lng)
    text = F.when(F.trim(F.coalesce(street, F.lit(""))) != "", F.concat_ws("|", F.concat(F.lit("text:"), F.lower(city)), F.lower(F.trim(street))))
    return F.coalesce(F.when(lat.isNotNull() & lng.isNotNull(), at), text, F.concat(F.lit("city:"), F.lower(city)))


def mode_of(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Most frequent value of each group, the smallest on ties."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("__n"))
    return counts.groupBy(*by).agg(F.min_by(value, F.struct(-F.col("__n"), F.col(value))).alias(value))


def place_clusters(df: DataFrame, key: str, city: str, price: str = "price", least: int = 3) -> DataFrame:
    """Groups of at least `least` listings: mean price, mode of the city, mean coordinates."""
    sums = df.groupBy(key).agg(F.count("*").alias("listings"), F.avg(price).alias("mean_price"), F.avg("lat").alias("lat"), F.avg("lng").alias("lng")).filter(F.col("listings") >= least)
    return sums.join(mode_of(df, [key], city), key, "left")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("unknown")).alias("value")).agg(F.count("*").alias("rows")).orderBy("value")


def ordered_totals(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Counts by key; keys of the list come first, in its order."""
    at = F.nullif(F.array_position(F.array(*[F.lit(x) for x in order]), F.col(key)), F.lit(0).cast("long"))
    return df.groupBy(key).agg(F.count("*").alias("rows")).withColumn("position", F.coalesce(at, F.lit(len(order) + 1).cast("long"))).orderBy("position", key)


def ratio(a: Column, b: Column) -> Column:
    return a / F.greatest(b, F.lit(1))


def missing_profile(df: DataFrame, name: str, fields: list[str]) -> DataFrame:
    """Rows, blanks and percent blank of every field; an absent column is blank everywhere."""
    blank = {f: F.count_if(F.trim(F.coalesce(F.col(f).cast("string"), F.lit(""))) == "") if f in df.columns else F.count("*") for f in fields}
    one = df.agg(F.count("*").alias("rows"), *[b.alias(f"m_{f}") for f, b in blank.items()])
    pairs = ", ".join(f"'{f}', `m_{f}`" for f in fields)
    long = one.select(F.lit(name).alias("table_name"), "rows", F.expr(f"stack({len(fields)}, {pairs}) AS (field, missing)"))
    return long.withColumn("percent", 100.0 * F.col("missing") / F.greatest(F.col("rows"), F.lit(1)))


def size_histogram(df: DataFrame, key: str) -> DataFrame:
    """How many groups have how many rows."""
    return df.groupBy(key).agg(F.count("*").alias("cluster_size")).groupBy("cluster_size").agg(F.count("*").alias("clusters"))


def boxes(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Bounding box, midpoint and count for every key of the dimension, also where nothing lies."""
    facts = df.filter(F.col("lat").isNotNull() & F.col("lng").isNotNull()).groupBy(key).agg(
        F.count("*").alias("n"), F.min("lat").alias("south"), F.max("lat").alias("north"), F.min("lng").alias("west"), F.max("lng").alias("east")
    )
    out = dimension.select(key).distinct().join(facts, key, "left")
    return out.withColumns({"n": F.coalesce("n", F.lit(0)), "mid_lat": (F.col("south") + F.col("north")) / 2, "mid_lng": (F.col("west") + F.col("east")) / 2})
