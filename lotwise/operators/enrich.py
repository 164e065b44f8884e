"""Lookups against caches and other tables, and pluggable fetching of what they lack."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotwise.functions import geo, text


def cached(df: DataFrame, cache: DataFrame, text_col: str, value: str) -> DataFrame:
    """df with the cache's value for the sha1 of the trimmed text; cache: key, value."""
    return df.withColumn("cache_key", text.cache_key(F.col(text_col))).join(cache.select(F.col("key").alias("cache_key"), F.col("value").alias(value)), "cache_key", "left")


def fill_coordinates(df: DataFrame, cache: DataFrame, most_new: int | None = None, fetch: Callable | None = None) -> DataFrame:
    """Rows with lat or lng missing get them from the cache (key, lat, lng), else from `fetch`.

    Adds geo_source: own, failed (nothing to look up), cache, new, or pending. `fetch` maps an iterator of pandas frames (key, query)
    to frames (key, lat, lng); it sees each key once, the first `most_new` keys by key where that is set.
    """
    street, town = F.col("street"), F.col("town")
    own = F.col("lat").isNotNull() & F.col("lng").isNotNull()
    keyed = df.withColumns({"geo_key": F.when(~own, geo.place_key(street, town)), "geo_query": F.when(~own, geo.place_query(street, town))})
    known = cache.select(F.col("key").alias("geo_key"), F.col("lat").alias("__lat"), F.col("lng").alias("__lng"), F.lit("cache").alias("__from"))
    if fetch is not None:
        want = keyed.filter(F.col("geo_query").isNotNull()).groupBy("geo_key").agg(F.min("geo_query").alias("query")).join(known, "geo_key", "left_anti")
        if most_new is not None:
            want = want.orderBy("geo_key").limit(most_new)  # the cap on outside calls is the feature
        got = want.select(F.col("geo_key").alias("key"), "query").mapInPandas(fetch, "key string, lat double, lng double")
        known = known.unionByName(got.select(F.col("key").alias("geo_key"), F.col("lat").alias("__lat"), F.col("lng").alias("__lng"), F.lit("new").alias("__from")))
    out = keyed.join(known, "geo_key", "left")
    source = F.when(own, "own").when(F.col("geo_query").isNull(), "failed").otherwise(F.coalesce("__from", F.lit("pending")))
    return out.withColumns({"lat": F.when(own, F.col("lat")).otherwise(F.col("__lat")), "lng": F.when(own, F.col("lng")).otherwise(F.col("__lng")), "geo_source": source}).drop("__lat", "__lng", "__from", "geo_query")


def coordinate_counts() -> dict[str, Column | None]:
    """What Counters count of fill_coordinates(): all rows, those with coordinates, and where missing ones came from."""
    found = F.col("lat").isNotNull() & F.col("lng").isNotNull()
    of = lambda *names: F.col("geo_source").isin(*names)
    return {"total": None, "with_coords": found, "missing_coords": ~found, "cache_hits": of("cache"), "geocoded_now": of("new"), "failures": of("failed", "pending")}


def cache_counts(value: str) -> dict[str, Column | None]:
    """What Counters count of cached(): rows found in the cache and rows that still have to be made."""
    return {"cache_hits": F.col(value).isNotNull(), "cache_misses": F.col(value).isNull()}


def pick_description(sources: DataFrame, descriptions: DataFrame, priority: list[str], key: str = "cluster_id") -> DataFrame:
    """key, description, portal: the first non-blank text by portal priority, then first_seen, then listing key.

    sources: key, portal, listing_key, first_seen; descriptions: portal, listing_key, description.
    """
    rank = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(p) for p in priority]), F.col("portal")), F.lit(0).cast("long")), F.lit(len(priority) + 1).cast("long"))
    usable = descriptions.filter(F.trim(F.coalesce("description", F.lit(""))) != "")
    both = sources.join(usable, ["portal", "listing_key"]).withColumn("r", F.struct(rank.alias("rank"), "first_seen", "listing_key", "description"))
    return both.groupBy(key).agg(F.min(F.struct("r", "portal")).alias("m")).select(key, F.col("m.r.description").alias("description"), F.col("m.portal").alias("portal"))


def missing_reasons(gold: DataFrame, sources: DataFrame, descriptions: DataFrame, key: str = "cluster_id") -> DataFrame:
    """key, reasons: why a golden record has no description, one reason a source; records that have one are left out.

    sources: key, portal, listing_key; descriptions: portal, listing_key, description.
    """
    known = descriptions.groupBy("portal", "listing_key").agg(F.max(F.trim(F.coalesce("description", F.lit(""))) != "").alias("told"))
    portals = descriptions.select("portal").distinct().withColumn("read", F.lit(True))
    each = sources.join(known, ["portal", "listing_key"], "left").join(portals, "portal", "left")
    # The texts of the reasons.
    why = F.when(~F.col("told"), "empty description in CSV").when(F.col("read").isNull(), "missing portal CSV").when(F.col("told").isNull(), "missing property_id")
    each = each.select(key, "told", F.concat_ws(" ", F.concat_ws(":", "portal", F.coalesce("listing_key", F.lit(""))), why).alias("reason"))
    found = each.groupBy(key).agg(F.coalesce(F.max("told"), F.lit(False)).alias("told"), F.array_sort(F.collect_list("reason")).alias("reasons"))
    out = gold.select(key).join(found, key, "left").filter(~F.coalesce("told", F.lit(False)))
    return out.select(key, F.coalesce("reasons", F.array(F.lit("no sources linked to listing"))).alias("reasons"))


def first_of(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """The first n rows in the order, for a log, with `more`: how many follow."""
    rows = df.agg(F.count("*").alias("__all"))
    return df.orderBy(*order).limit(n).crossJoin(F.broadcast(rows)).withColumn("more", F.greatest(F.col("__all") - n, F.lit(0).cast("long"))).drop("__all")  # one row is broadcast


def to_ask(df: DataFrame, cache: DataFrame, text_col: str) -> DataFrame:
    """cache_key, text: the distinct texts that the cache lacks."""
    want = df.select(text.cache_key(F.col(text_col)).alias("cache_key"), F.trim(text_col).alias("text")).filter(F.col("text") != "").dropDuplicates(["cache_key"])
    return want.join(cache.select(F.col("key").alias("cache_key")), "cache_key", "left_anti")


def backfilled(df: DataFrame, cache: DataFrame, text_col: str, fields: list[str], overwrite: bool = False, price: str = "price", size: str = "floor_area", psm: str = "price_area") -> DataFrame:
    """df with fields that it lacks taken from the cached answer on its description, then the price per square from the other two.

    cache: key, value (a JSON object of the fields). Fields stay texts.
    """
    schema = ", ".join(f"`{f}` string" for f in fields)
    answers = cache.select(F.col("key").alias("cache_key"), F.from_json(text.strip_fences(F.col("value")), schema).alias("a")).select("cache_key", *[F.col(f"a.`{f}`").alias(f) for f in fields])
    out = fill_missing(df.withColumn("cache_key", text.cache_key(F.col(text_col))), answers, "cache_key", fields, overwrite).drop("cache_key")
    number = lambda c: F.replace(F.col(c).cast("string"), F.lit(","), F.lit(".")).try_cast("double")
    derived = F.rint(F.try_divide(number(price), F.when(number(size) > 0, number(size)))).cast("long").cast("string")
    lacks = F.trim(F.coalesce(F.col(psm).cast("string"), F.lit(""))).isin("", "nan", "none", "null")
    return out.withColumn(psm, F.when(lacks, derived).otherwise(F.col(psm).cast("string")))


def first_hit(df: DataFrame, photos: DataFrame, keys: list[tuple[str, str]], value: str) -> DataFrame:
    """df with `value` from the first of several keys that hits. keys: (column of df, column of photos); the smallest value wins on repeats."""
    found = []
    for i, (own, other) in enumerate(keys):
        side = photos.filter(F.col(other).isNotNull()).groupBy(F.col(other).alias(f"__k{i}")).agg(F.min(value).alias(f"__v{i}"))
        df = df.join(side, F.col(own) == F.col(f"__k{i}"), "left")
        found.append(F.col(f"__v{i}"))
    return df.withColumn(value, F.coalesce(*found)).drop(*[f"__{c}{i}" for i in range(len(keys)) for c in "kv"])


def resolve_tokens(df: DataFrame, urls: DataFrame, id_col: str, tokens: str) -> DataFrame:
    """id, urls: the urls of a row's tokens in their order; urls: token, url."""
    each = df.select(id_col, F.posexplode(tokens).alias("at", "token")).join(urls, "token")
    lists = each.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "url"))), lambda x: x["url"]).alias("urls"))
    return df.select(id_col).join(lists, id_col, "left").withColumn("urls", F.coalesce("urls", F.array().cast("array<string>")))


def fetch_texts(df: DataFrame, ask: Callable[[list[str]], list[str | None]], text_col: str, value: str, batch: int = 10) -> DataFrame:
    """cache_key, value for every distinct text, asked for in batches; answers that are missing are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), batch):
                part = b.iloc[lo : lo + batch]
                out = pd.DataFrame({"cache_key": part["cache_key"].to_numpy(), value: ask(list(part["t"]))})
                yield out[out[value].notna()]

    want = df.select(text.cache_key(F.col(text_col)).alias("cache_key"), F.trim(text_col).alias("t")).filter(F.col("t") != "").dropDuplicates(["cache_key"])
    return want.mapInPandas(run, f"cache_key string, {value} string")


def fill_missing(df: DataFrame, found: DataFrame, key: str, fields: list[str], overwrite: bool = False) -> DataFrame:
    """Fields of df from found where df has none (nan, none, null and blank count as none), or everywhere."""
    side = found.select(F.col(key), *[F.col(f).alias(f"__{f}") for f in fields])
    out = df.join(side, key, "left")
    for f in fields:
        lacks = F.col(f).isNull() | F.lower(F.trim(F.col(f).cast("string"))).isin("", "nan", "none", "null")
        old, new = F.col(f), F.col(f"__{f}")
        out = out.withColumn(f, F.coalesce(new, old) if overwrite else F.when(lacks, new).otherwise(old))
    return out.drop(*[f"__{f}" for f in fields])


def portal_priority(sources: DataFrame, order: str) -> DataFrame:
    """portal, rank: by first appearance in the given order column."""
    first = sources.groupBy("portal").agg(F.min(order).alias("__first"))
    return first.withColumn("rank", F.row_number().over(W.orderBy("__first", "portal"))).drop("__first")  # one row a portal
