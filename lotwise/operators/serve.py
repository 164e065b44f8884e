"""The listings that an interface shows: derived figures, filters, limits, JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.numbers import js_round
from lotwise.functions.text import dash_slug, slug

# Shares of the price, and grades by capitalisation rate.
RENT_SHARE, COST_SHARE, ROI_FACTOR = 0.004, 0.0009, 1.6
GRADES = ((6.0, "A", 8.5), (4.0, "B", 6.5))
RENT_WORDS = ("prenajom", "prenájom", "rent", "lease")


def investment(df: DataFrame, price: str = "price") -> DataFrame:
    """rent, expenses, cashflow, cap_rate, roi, grade, grade_score from the price."""
    p = F.col(price)
    df = df.withColumns({"rent": js_round(p * RENT_SHARE), "expenses": js_round(p * COST_SHARE)})
    df = df.withColumn("cashflow", F.col("rent") - F.col("expenses"))
    df = df.withColumn("cap_rate", js_round(F.try_divide((F.col("rent") - F.col("expenses")) * 12 * 100.0, p) * 10) / 10)
    df = df.withColumn("roi", js_round(F.col("cap_rate") * ROI_FACTOR * 10) / 10)
    grade, score = F.lit("C"), F.lit(4.5)
    for least, name, value in reversed(GRADES):
        grade, score = F.when(F.col("cap_rate") >= least, name).otherwise(grade), F.when(F.col("cap_rate") >= least, value).otherwise(score)
    return df.withColumns({"grade": F.when(p.isNotNull(), grade), "grade_score": F.when(p.isNotNull(), score)})


def imputed(df: DataFrame, price: str = "price", psm: str = "psm", size: str = "size") -> DataFrame:
    """Each of price, price per square and size from the other two."""
    p, q, s = F.col(price), F.col(psm), F.col(size)
    return df.withColumns({price: F.coalesce(p, js_round(q * s).cast("double")), psm: F.coalesce(q, js_round(F.try_divide(p, s)).cast("double")), size: F.coalesce(s, js_round(F.try_divide(p, q)).cast("double"))})


def presented(df: DataFrame) -> DataFrame:
    """type, type_label, region_slug, portal_id, picture of listings with rooms, region, url, row_id."""
    kind = F.when(F.coalesce("rooms", F.lit(0)) >= 4, "house").otherwise("apartment")
    codes = F.aggregate(F.split(F.coalesce("row_id", F.lit("")), ""), F.lit(0), lambda a, c: a + F.when(c == "", 0).otherwise(F.ascii(c)))
    return df.withColumns(
        {
            "type": kind,
            "type_label": F.when(kind == "house", "House").otherwise("Apartment"),
            "region_slug": dash_slug(F.col("region")),
            "portal_id": F.nullif(F.regexp_extract("url", r"/detail/([A-Za-z0-9]+)", 1), F.lit("")),
            "picture": codes % 7,
        }
    )


def listings(df: DataFrame, city: str | None = None, region: str | None = None, q: str | None = None, limit: int | None = None, order: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """Equal city and region (any case), a text in title, town or summary; then the limit, in a fixed order."""
    if city and city.lower() not in ("all", "*"):
        df = df.filter(F.lower(F.coalesce("town", F.lit(""))) == city.lower())
    if region:
        df = df.filter(F.lower(F.coalesce("region", F.lit(""))) == region.lower())
    if q:
        have = [F.coalesce(F.col(c), F.lit("")) for c in ("title", "street", "town", "summary") if c in df.columns]
        df = df.filter(F.contains(F.lower(F.concat_ws(" ", *have)), F.lit(q.lower())))
    return df if limit is None else df.orderBy(*order).limit(limit)


def narrowed(df: DataFrame, kind: str | None = None, region: str | None = None, price_min: float = 0, price_max: float = 0, cap_min: float = 0, roi_min: float = 0) -> DataFrame:
    """Filters of the list view; a bound of 0 is off; a missing price counts as 0."""
    price = F.coalesce("price", F.lit(0))
    tests = [
        (kind, lambda: F.col("type") == kind), (region, lambda: F.col("region_slug") == region), (price_min, lambda: price >= price_min),
        (price_max, lambda: price <= price_max), (cap_min, lambda: F.coalesce("cap_rate", F.lit(0)) >= cap_min), (roi_min, lambda: F.coalesce("roi", F.lit(0)) >= roi_min),
    ]
    for bound, test in tests:
        if bound:
            df = df.filter(test())
    return df


def not_rentals(df: DataFrame, *columns: str) -> DataFrame:
    """Without rows whose texts hold a rent word."""
    whole = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns]))
    return df.filter(~F.rlike(whole, F.lit("|".join(RENT_WORDS))))


def as_json(df: DataFrame) -> Column:
    """A row as JSON; nulls keep their keys."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"})


def documents_by(df: DataFrame, key: str) -> DataFrame:
    """key, rows, digest: how many JSON documents each key has, and a sum over them that takes no order; write_json writes them."""
    whole = F.conv(F.substring(F.md5(as_json(df).cast("binary")), 1, 12), 16, 10).cast("decimal(38,0)")
    return df.select(key, whole.alias("h")).groupBy(key).agg(F.count("*").alias("rows"), F.sum("h").cast("string").alias("digest"))


def write_json(df: DataFrame, path: str, by: str) -> None:
    """One folder of JSON lines for each key: no group is gathered in one task."""
    df.write.mode("overwrite").partitionBy(by).json(path)


def snapshot_meta(df: DataFrame, returned: DataFrame, path: str) -> DataFrame:
    """total_rows, returned_rows, path."""
    return df.agg(F.count("*").alias("total_rows")).crossJoin(returned.agg(F.count("*").alias("returned_rows"))).withColumn("path", F.lit(path))  # one row each


def with_slug(df: DataFrame, city: str = "city") -> DataFrame:
    """df with city_slug, without rows whose city has none."""
    return df.withColumn("city_slug", slug(F.col(city))).filter(F.col("city_slug") != "")


def daily_stats(overall: DataFrame, cities: DataFrame, date: str, site: str, currency: str = "EUR") -> DataFrame:
    """json: the market statistics of a site's day, with one entry a city in order of names. Both frames as stats.market() makes them."""
    figures = ("avg_price", "median_price", "avg_psm", "median_psm")
    rows = cities.agg(F.array_sort(F.collect_list(F.struct(F.col("city"), F.col("listings").alias("count"), *figures, F.col("avg_size").alias("avg_floor_area_m2")))).alias("cities"))  # one row a city
    whole = overall.crossJoin(rows)  # one row each
    body = F.struct(F.lit(date).alias("date"), F.lit(site).alias("site"), F.lit(currency).alias("currency"), F.col("listings").alias("total_listings"), *figures, "cities")
    return whole.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))


def write_snapshot(df: DataFrame, returned: DataFrame, path: str, source: str) -> None:
    """data (JSON lines) and meta (total_rows, returned_rows, path) of a snapshot, in two folders."""
    returned.write.mode("overwrite").json(f"{path}/data")
    snapshot_meta(df, returned, source).write.mode("overwrite").json(f"{path}/meta")


def plain_summary(c: Column) -> Column:
    """The quoted summary of an answer, else the answer without its prompt, field name and outer quotes; null and empty stay null."""
    own = F.trim(F.regexp_extract(c, r'(?i)summary_short_sk:\s*"([^"]+)"', 1))
    bare = F.regexp_replace(F.regexp_replace(c, r"(?is)INPUT DESCRIPTION:.*?OUTPUT:\s*", ""), r"(?i)summary_short_sk:\s*", "")
    return F.when(F.rlike(c, F.lit(r'(?i)summary_short_sk:\s*"[^"]+"')), own).otherwise(F.trim(F.btrim(F.nullif(bare, F.lit("")), F.lit('"'))))


def path_for(path: str, transaction: str | None) -> str:
    """`a/name.csv` as `a/name_rent.csv` for the transaction `rent`; paths that have it, and no transaction, stay."""
    word = (transaction or "").strip().lower()
    folder, slash, name = path.rpartition("/")
    stem, dot, kind = name.rpartition(".") if "." in name[1:] else (name, "", "")
    return path if not word or stem.endswith(f"_{word}") else f"{folder}{slash}{stem}_{word}{dot}{kind}"
