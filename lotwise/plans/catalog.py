"""Registered queries over the driver's tables, with their DuckDB SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.functions import geo, numbers, similarity, text
from lotwise.operators import edges, enrich, extract, history, records, resolve, serve, stats, survivors
from lotwise.operators.counters import Counters
from lotwise.plans import pipelines
from lotwise.plans.proxy import listings, oracle
from lotwise.schema import conform, struct
from lotwise.session import kept, place
from lotwise.sources.history_table import HistoryTable

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

DAY_1, DAY_2 = "2025-11-01", "2025-11-02"


#: Means of cents never fall on this boundary, so both engines round them alike.
OFFSET = 0.3141592653


def snapped(c, digits: int = 4):
    return F.floor(F.col(c) * 10.0**digits + OFFSET) / 10.0**digits


def snapped_sql(sql: str) -> str:
    """round(x, digits) in SQL as the same rounding."""
    while "round(" in sql and (found := next(two_part_rounds(sql), None)):
        start, comma, end = found
        inner, digits = sql[start + 6 : comma], int(sql[comma + 1 : end])
        sql = f"{sql[:start]}(floor(({inner}) * 1e{digits} + {OFFSET}) / 1e{digits}){sql[end + 1 :]}"
    return sql


def two_part_rounds(sql: str):
    for m in re.finditer(r"(?<![a-z_])round\(", sql):
        depth, comma = 1, None
        for at in range(m.end(), len(sql)):
            depth += {"(": 1, ")": -1}.get(sql[at], 0)
            if sql[at] == "," and depth == 1:
                comma = at
            if depth == 0:
                if comma is not None:
                    yield m.start(), comma, at
                break


def query(sql: str | None = None, recursive: bool = False, proxy: bool = True):
    """Registers a query under its function's name, with SQL over the tables or over `listings`."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = snapped_sql(oracle(sql, recursive) if proxy else sql)
        return f

    return put


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles to a few decimals: sums depend on the order of rows."""
    return df.select(*[snapped(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def priced(spark, sf) -> DataFrame:
    return listings(spark, sf).withColumn("psm", numbers.per_square(F.col("price"), F.col("size")))


# --- market statistics


@query("""
SELECT town, count(*) AS listings, round(avg(price), 4) AS avg_price, round(median(price), 4) AS median_price, round(avg(price / size), 4) AS avg_psm,
  round(median(price / size), 4) AS median_psm, round(avg(size), 4) AS avg_size
FROM listings GROUP BY town""")
def market_stats_by_city(spark, sf):
    return rounded(stats.market(priced(spark, sf), ["town"]))


@query("""
SELECT count(*) AS listings, round(avg(price), 4) AS avg_price, round(median(price), 4) AS median_price, round(avg(price / size), 4) AS avg_psm,
  round(median(price / size), 4) AS median_psm, round(avg(size), 4) AS avg_size FROM listings""")
def market_stats_overall(spark, sf):
    return rounded(stats.market(priced(spark, sf), []))


@query("""
SELECT town, round(avg(price), 4) AS mean_price, round(median(price), 4) AS median_price, min(price) AS min_price, max(price) AS max_price, count(price) AS listings
FROM listings WHERE transaction = 'prenajom' AND price IS NOT NULL GROUP BY town""")
def rental_by_city(spark, sf):
    return rounded(stats.price_summary(listings(spark, sf).filter("transaction = 'prenajom'"), "town"))


@query("""
SELECT CASE WHEN rooms IS NULL THEN 'Unknown' ELSE CAST(rooms AS VARCHAR) || '-izbový' END AS label, round(avg(price), 4) AS mean_price, count(*) AS listings
FROM listings GROUP BY 1""")
def rental_by_rooms(spark, sf):
    return rounded(stats.mean_by_label(listings(spark, sf).withColumn("label", stats.room_type(F.col("rooms"))), "label"))


@query(""", k AS (
  SELECT *, CAST(l_cell AS VARCHAR) AS key FROM (SELECT *, CAST(floor(lat * 1000) AS BIGINT) * 100000 + CAST(floor(lng * 1000) AS BIGINT) AS l_cell FROM listings)
), m AS (
  SELECT key, town FROM (SELECT key, town, row_number() OVER (PARTITION BY key ORDER BY count(*) DESC, town) AS r FROM k GROUP BY key, town) WHERE r = 1
)
SELECT key, count(*) AS listings, round(avg(price), 4) AS mean_price, round(avg(lat), 4) AS lat, round(avg(lng), 4) AS lng, any_value(m.town) AS town
FROM k JOIN m USING (key) GROUP BY key HAVING count(*) >= 3""")
def rental_clusters(spark, sf):
    keyed = listings(spark, sf).withColumn("key", (geo.cell(F.col("lat")) * 100000 + geo.cell(F.col("lng"))).cast("string"))
    return rounded(stats.place_clusters(keyed, "key", "town"))


@query(""", k AS (
  SELECT *, CASE WHEN p IS NOT NULL AND CAST(quantity AS BIGINT) % 3 <> 0 THEN 'geo:' || printf('%.3f', lat) || '|' || printf('%.3f', lng) WHEN street IS NOT NULL THEN 'text:' || lower(town) || '|' || lower(trim(street)) ELSE 'city:' || lower(town) END AS key,
    CASE WHEN CAST(quantity AS BIGINT) % 3 <> 0 THEN lat END AS own_lat FROM (SELECT *, 1 AS p FROM listings)
), m AS (
  SELECT key, town FROM (SELECT key, town, row_number() OVER (PARTITION BY key ORDER BY count(*) DESC, town) AS r FROM k GROUP BY key, town) WHERE r = 1
)
SELECT key, count(*) AS listings, round(avg(price), 4) AS mean_price, round(avg(own_lat), 4) AS lat, round(avg(lng), 4) AS lng, any_value(m.town) AS town
FROM k JOIN m USING (key) GROUP BY key HAVING count(*) >= 3""")
def rental_places(spark, sf):
    """Clusters by rounded coordinates, else by city and street, else by city."""
    d = listings(spark, sf).withColumn("lat", F.when(F.col("quantity").cast("long") % 3 != 0, F.col("lat")))
    return rounded(stats.place_clusters(d.withColumn("key", stats.place_cluster(F.col("lat"), F.col("lng"), F.col("town"), F.col("street"))), "key", "town"))


@query("SELECT event_type AS value, count(*) AS rows FROM events GROUP BY 1", proxy=False)
def value_counts(spark, sf):
    return stats.value_counts(table(spark, sf, "events"), "event_type")


@query("SELECT town, transaction, count(*) AS rows FROM listings GROUP BY 1, 2")
def town_transaction_counts(spark, sf):
    return listings(spark, sf).groupBy("town", "transaction").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "town")


@query("""
SELECT transaction, count(*) AS rows, CAST(CASE transaction WHEN 'predaj' THEN 1 WHEN 'prenajom' THEN 2 ELSE 3 END AS BIGINT) AS position FROM listings GROUP BY 1""")
def transaction_totals(spark, sf):
    return stats.ordered_totals(listings(spark, sf), "transaction", ["predaj", "prenajom"])


@query("""
SELECT round(count(price) / greatest(count(*), 1), 6) AS priced_share, round(count(DISTINCT listing_key) / greatest(count(*), 1), 6) AS key_share,
  round(count(*) / greatest(count(DISTINCT listing_key), 1), 6) AS rows_a_key FROM listings""")
def funnel_ratios(spark, sf):
    one = listings(spark, sf).agg(F.count("*").alias("n"), F.count("price").alias("p"), F.count_distinct("listing_key").alias("k"))
    r = lambda a, b, name: stats.ratio(F.col(a), F.col(b)).alias(name)
    return rounded(one.select(r("p", "n", "priced_share"), r("k", "n", "key_share"), r("n", "k", "rows_a_key")), 6)


@query("SELECT cluster_size, count(*) AS clusters FROM (SELECT count(*) AS cluster_size FROM listings GROUP BY listing_key) GROUP BY 1")
def cluster_size_histogram(spark, sf):
    return stats.size_histogram(listings(spark, sf), "listing_key")


@query("""
, f AS (SELECT n_name AS town, l.lat, l.lng FROM nation LEFT JOIN listings l ON l.town = n_name AND l.price IS NOT NULL AND l.transaction = 'prenajom')
SELECT town, count(lat) AS n, round(min(lat), 4) AS south, round(max(lat), 4) AS north, round(min(lng), 4) AS west, round(max(lng), 4) AS east,
  round((min(lat) + max(lat)) / 2, 4) AS mid_lat, round((min(lng) + max(lng)) / 2, 4) AS mid_lng FROM f GROUP BY town""")
def city_boxes(spark, sf):
    towns = table(spark, sf, "nation").select(F.col("n_name").alias("town"))
    return rounded(stats.boxes(listings(spark, sf).filter("price IS NOT NULL AND transaction = 'prenajom'"), towns, "town"))


FIELDS = ("street", "size", "price", "rooms", "floor", "cert", "status", "agent")


@query(
    " UNION ALL ".join(f"SELECT 'listings' AS table_name, count(*) AS rows, '{f}' AS field, {'count(*)' if f == 'agent' else f'count(*) FILTER (WHERE {f} IS NULL)'} AS missing, round(100.0 * {'count(*)' if f == 'agent' else f'count(*) FILTER (WHERE {f} IS NULL)'} / greatest(count(*), 1), 4) AS percent FROM listings" for f in FIELDS)
)
def missing_profile(spark, sf):
    return rounded(stats.missing_profile(listings(spark, sf), "listings", list(FIELDS)))


# --- cleaning


@query("""
, t AS (SELECT row_id, ' ' || CAST(CAST(quantity AS BIGINT) AS VARCHAR) || chr(160) || '500,5' AS a, CASE CAST(quantity AS BIGINT) % 3 WHEN 0 THEN 'abc' WHEN 1 THEN '68 m2' ELSE '1.2.3' END AS b,
  CAST(CAST(quantity AS BIGINT) AS VARCHAR) || '.5' AS c, CASE WHEN CAST(quantity AS BIGINT) % 4 = 0 THEN '0' ELSE CAST(CAST(quantity AS BIGINT) AS VARCHAR) || ' 000' END AS d FROM listings)
SELECT row_id, TRY_CAST(replace(replace(replace(a, ' ', ''), chr(160), ''), ',', '.') AS DOUBLE) AS a_float, TRY_CAST(regexp_replace(replace(b, ',', '.'), '[^0-9.]', '', 'g') AS DOUBLE) AS b_decimal,
  CAST(round_even(CAST(c AS DOUBLE), 0) AS BIGINT) AS c_int, nullif(TRY_CAST(regexp_replace(d, '[^0-9]', '', 'g') AS BIGINT), 0) AS d_digits FROM t""")
def numbers_parsed(spark, sf):
    q = F.col("quantity").cast("long")
    t = listings(spark, sf).select(
        "row_id",
        F.concat(F.lit(" "), q.cast("string"), F.lit(" 500,5")).alias("a"),
        F.when(q % 3 == 0, "abc").when(q % 3 == 1, "68 m2").otherwise("1.2.3").alias("b"),
        F.concat(q.cast("string"), F.lit(".5")).alias("c"),
        F.when(q % 4 == 0, "0").otherwise(F.concat(q.cast("string"), F.lit(" 000"))).alias("d"),
    )
    return t.select("row_id", numbers.to_float(F.col("a")).alias("a_float"), numbers.decimal(F.col("b")).alias("b_decimal"), numbers.to_int(F.col("c")).alias("c_int"), numbers.digits(F.col("d")).alias("d_digits"))


@query("""
, s AS (
  SELECT listing_key AS listing_uid, portal AS site, transaction, town AS city, region, CAST(rooms AS BIGINT) AS rooms, CASE WHEN size > 0 THEN size END AS floor_area_m2, CASE WHEN price > 0 THEN price END AS price_eur,
    round(price / size, 4) AS price_psm_eur, 'EUR' AS currency, row_number() OVER (PARTITION BY listing_key ORDER BY row_id) AS r FROM listings
)
SELECT listing_uid, site, transaction, city, region, rooms, floor_area_m2, price_eur, price_psm_eur, currency,
  sha256(lower(trim(coalesce(site, ''))) || '|' || lower(trim(coalesce(city, ''))) || '|' || coalesce(CAST(rooms AS VARCHAR), '') || '|' || lower(transaction)) AS hash FROM s WHERE r = 1""")
def silver_clean(spark, sf):
    d = listings(spark, sf).select(
        F.col("listing_key").alias("listing_uid"), F.col("portal").alias("site"), "transaction", F.col("town").alias("city"), "region", F.col("rooms").cast("long").alias("rooms"),
        numbers.positive(F.col("size")).alias("floor_area_m2"), numbers.positive(F.col("price")).alias("price_eur"), F.lit("EUR").alias("currency"), "row_id",
    )
    d = d.withColumn("price_psm_eur", numbers.per_square(F.col("price_eur"), F.col("floor_area_m2"))).withColumn("price_psm_eur", snapped("price_psm_eur"))
    d = d.withColumn("hash", history.content_hash(F.col("site"), F.col("city"), F.col("rooms"), F.col("transaction")))
    return history.keep_first(d, ["listing_uid"], ["row_id"]).drop("row_id")


@query("""
SELECT row_id, sha256(lower(concat_ws('|', coalesce(transaction, ''), coalesce(url, ''), coalesce(street, ''), coalesce(town, ''), coalesce(region, ''), coalesce(CAST(rooms AS VARCHAR), ''), coalesce(printf('%.6f', size), ''), coalesce(status, ''),
  coalesce(CAST(year_built AS VARCHAR), ''), coalesce(CAST(floor AS VARCHAR), ''), coalesce(cert, ''), coalesce(printf('%.6f', price), '')))) AS hash FROM listings""")
def content_hashes(spark, sf):
    """The hash over all twelve columns, many of them null."""
    d = listings(spark, sf)
    named = dict(zip(pipelines.HASHED, ("transaction", "url", "street", "town", "region", "rooms", "size", "status", "year_built", "floor", "cert", "price"), strict=True))
    d = d.select("row_id", *[F.col(c).alias(f"h_{name}") for name, c in named.items()])
    return d.select("row_id", history.content_hash(*[pipelines.printed(f"h_{c}", c in ("floor_area_m2", "price_eur")) for c in pipelines.HASHED]).alias("hash"))


@query("""
, t AS (SELECT *, CASE WHEN rooms IS NULL THEN 'okres ' || replace(replace(town, '_', ' '), '0', '') ELSE 'OKRES ' || replace(replace(town, '_', '-x'), '1', 'i') || ', ' || lower(region) || '  KRAJ' END AS area FROM listings),
d AS (SELECT *, trim(regexp_replace(regexp_extract(regexp_replace(area, '\\s+', ' ', 'g'), '(?i)okres\\s+([\\p{L}\\s-]+)', 1), '\\s+', ' ', 'g')) AS di, trim(regexp_extract(regexp_replace(area, '\\s+', ' ', 'g'), '(?i)([\\p{L}\\s-]+)\\s+kraj', 1)) AS re FROM t)
SELECT row_id, nullif(array_to_string(list_transform(regexp_extract_all(lower(di), '\\p{L}+|[^\\p{L}]+'), lambda w: upper(w[1]) || w[2:]), ''), '') AS district,
  nullif(array_to_string(list_transform(regexp_extract_all(lower(re), '\\p{L}+|[^\\p{L}]+'), lambda w: upper(w[1]) || w[2:]), ''), '') AS region,
  nullif(trim(regexp_replace(regexp_replace('Ulica  ' || street, '\\s+', ' ', 'g'), '(?i)^Ulica\\s+', '')), '') AS street, CASE WHEN street IS NULL THEN lower(town) ELSE lower(street || ', ' || town) END AS address_norm FROM d""")
def address_parts(spark, sf):
    town, region = F.col("town"), F.lower("region")
    plain = F.concat(F.lit("okres "), F.replace(F.replace(town, F.lit("_"), F.lit(" ")), F.lit("0"), F.lit("")))
    full = F.concat(F.lit("OKRES "), F.replace(F.replace(town, F.lit("_"), F.lit("-x")), F.lit("1"), F.lit("i")), F.lit(", "), region, F.lit("  KRAJ"))
    area = F.when(F.col("rooms").isNull(), plain).otherwise(full)
    return listings(spark, sf).select(
        "row_id",
        text.district(area).alias("district"),
        text.region(area).alias("region"),
        text.street(F.concat(F.lit("Ulica  "), F.col("street"))).alias("street"),
        text.join_address(text.fold(F.col("street")), text.fold(F.col("town"))).alias("address_norm"),
    )


@query("""
, t AS (SELECT row_id, CASE WHEN floor IS NULL THEN 'prízemie' WHEN floors_total IS NULL THEN CAST(floor AS VARCHAR) ELSE CAST(floor AS VARCHAR) || '/' || CAST(floors_total AS VARCHAR) || ' + výťah' END AS f,
  CASE CAST(quantity AS BIGINT) % 4 WHEN 0 THEN 'nie je' WHEN 1 THEN 'x' WHEN 2 THEN '' ELSE cert END AS e, 'Krásny ' || coalesce(CAST(rooms AS VARCHAR), '2,5') || '-izbový byt' AS title FROM listings)
SELECT row_id, TRY_CAST(nullif(regexp_extract(f, '(\\d+)', 1), '') AS INTEGER) AS floor, TRY_CAST(nullif(regexp_extract(f, '\\d+\\s*/\\s*(\\d+)', 1), '') AS INTEGER) AS total, CASE WHEN contains(f, 'výťah') THEN true END AS elevator,
  CASE WHEN coalesce(e, '') = '' OR contains(lower(e), 'nie') THEN 'none' WHEN upper(substring(e, 1, 1)) BETWEEN 'A' AND 'G' THEN upper(substring(e, 1, 1)) ELSE 'unknown' END AS energy,
  CAST(regexp_extract(title, '(\\d)[-\\s]?izb', 1) AS INTEGER) AS title_rooms FROM t""")
def floor_and_energy(spark, sf):
    q = F.col("quantity").cast("long")
    f = F.when(F.col("floor").isNull(), "prízemie").when(F.col("floors_total").isNull(), F.col("floor").cast("string")).otherwise(F.concat(F.col("floor").cast("string"), F.lit("/"), F.col("floors_total").cast("string"), F.lit(" + výťah")))
    e = F.when(q % 4 == 0, "nie je").when(q % 4 == 1, "x").when(q % 4 == 2, "").otherwise(F.col("cert"))
    title = F.concat(F.lit("Krásny "), F.coalesce(F.col("rooms").cast("string"), F.lit("2,5")), F.lit("-izbový byt"))
    d = listings(spark, sf).select("row_id", numbers.floor_parts(f).alias("p"), text.energy_class(e).alias("energy"), numbers.rooms_of_title(title).alias("title_rooms"))
    return d.select("row_id", "p.floor", "p.total", "p.elevator", "energy", "title_rooms")


@query("""
SELECT doc_id, trim(regexp_replace(lower(trim(regexp_replace(coalesce(text, ''), '[\\s\\x{A0}]+', ' ', 'g'))), '[^\\p{L}\\p{N}_\\p{M}]+', '_', 'g'), '_') AS slug, length(strip_accents(replace(lower(text), 'ß', 's'))) AS folded_length,
  md5(strip_accents(replace(lower(text), 'ß', 's'))) AS folded FROM documents""", proxy=False)
def ascii_fold_slug(spark, sf):
    t = F.col("text")
    return table(spark, sf, "documents").select("doc_id", text.slug(t).alias("slug"), F.length(text.fold(t)).cast("long").alias("folded_length"), F.md5(text.fold(t).cast("binary")).alias("folded"))


@query("""
, u AS (SELECT row_id, ['https://h.example/foto/abc=/' || photo || '_fss?st=1', 'https://h.example/x/Ž' || photo || '-2.jpg', 'https://h.example/y/a=' || photo || '_fss2.jpg;v=1#t'] AS urls FROM listings)
SELECT row_id, list_aggregate(list_sort(list_distinct(list_filter(list_transform(urls, lambda x: nullif(regexp_replace(replace(string_split(list_last(string_split(string_split(string_split(x, '#')[1], '?')[1], '/')), ';')[1], '_fss', ''), '[^A-Za-z0-9]', '', 'g'), '')), lambda x: x IS NOT NULL))), 'string_agg', ',') AS tokens FROM u""")
def photo_tokens(spark, sf):
    p = F.col("photo")
    urls = (F.concat(F.lit("https://h.example/foto/abc=/"), p, F.lit("_fss?st=1")), F.concat(F.lit("https://h.example/x/Ž"), p, F.lit("-2.jpg")), F.concat(F.lit("https://h.example/y/a="), p, F.lit("_fss2.jpg;v=1#t")))
    return listings(spark, sf).select("row_id", F.array_join(text.photo_tokens(*urls), ",").alias("tokens"))


# --- sets, order


@query("SELECT event_type, user_id FROM events GROUP BY 1, 2", proxy=False)
def distinct_on_columns(spark, sf):
    return table(spark, sf, "events").dropDuplicates(["event_type", "user_id"]).select("event_type", "user_id")


@query("""
SELECT id, 'returned' AS side FROM (SELECT l_partkey AS id FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45 EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 45)
UNION ALL SELECT id, 'accepted' FROM (SELECT l_partkey AS id FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 45 EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)""", proxy=False)
def set_difference(spark, sf):
    sold = table(spark, sf, "lineitem").filter("l_quantity > 45")
    r, a = (sold.filter(F.col("l_returnflag") == f).select(F.col("l_partkey").alias("id")) for f in "RA")
    return r.subtract(a).withColumn("side", F.lit("returned")).unionByName(a.subtract(r).withColumn("side", F.lit("accepted")))


@query("SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS VARCHAR) AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer", proxy=False)
def union_by_name(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return s.unionByName(c, allowMissingColumns=True)


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100", proxy=False)
def top_orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS listing_id, CAST(o_totalprice AS BIGINT) AS price, CAST(NULL AS VARCHAR) AS run_date FROM orders WHERE false UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CAST(trunc(o_totalprice) AS BIGINT), NULL FROM orders", proxy=False)
def conformed(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("listing_id"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("extra"))
    return conform(o, struct("listing_id string, price long, run_date string"))


# --- history: two snapshots of the orders, the second with other prices and another set of keys

SNAPSHOTS = """
WITH d1 AS (SELECT CAST(o_orderkey AS VARCHAR) AS uid, o_orderstatus AS status, CAST(round(o_totalprice) AS BIGINT) AS price, o_orderpriority AS priority FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
d2 AS (SELECT CAST(o_orderkey AS VARCHAR) AS uid, o_orderstatus AS status, CAST(round(o_totalprice) AS BIGINT) + CASE WHEN o_custkey % 4 = 0 THEN 100 ELSE 0 END AS price, o_orderpriority AS priority FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'),
h1 AS (SELECT *, sha256(lower(trim(status)) || '|' || CAST(price AS VARCHAR)) AS hash FROM d1), h2 AS (SELECT *, sha256(lower(trim(status)) || '|' || CAST(price AS VARCHAR)) AS hash FROM d2)
"""


def snapshots(spark, sf) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf, "orders")
    make = lambda d, extra: d.select(F.col("o_orderkey").cast("string").alias("uid"), F.col("o_orderstatus").alias("status"), (F.round("o_totalprice").cast("long") + extra).alias("price"), F.col("o_orderpriority").alias("priority")).withColumn("hash", history.content_hash(F.col("status"), F.col("price")))
    first = make(o.filter("o_orderdate < TIMESTAMP '1999-01-01'"), F.lit(0).cast("long"))
    return first, make(o.filter("o_orderdate >= TIMESTAMP '1996-01-01'"), F.when(F.col("o_custkey") % 4 == 0, F.lit(100)).otherwise(F.lit(0)).cast("long"))


def two_days(spark, sf) -> tuple[DataFrame, DataFrame]:
    first, second = snapshots(spark, sf)
    day = F.lit(DAY_1)
    latest = first.withColumns({"first_seen": day, "last_seen": day, "valid_from": day})
    past = first.withColumns({"valid_from": day, "valid_to": F.lit(None).cast("string"), "is_current": F.lit(True)})
    return history.upsert(latest, past, second, DAY_2)


@query(SNAPSHOTS + f"""
SELECT coalesce(a.uid, b.uid) AS uid, CASE WHEN b.uid IS NULL THEN a.status ELSE b.status END AS status, CASE WHEN b.uid IS NULL THEN a.price ELSE b.price END AS price,
  CASE WHEN b.uid IS NULL OR a.hash = b.hash THEN a.priority ELSE b.priority END AS priority, CASE WHEN b.uid IS NULL THEN a.hash ELSE b.hash END AS hash,
  CASE WHEN a.uid IS NULL THEN '{DAY_2}' ELSE '{DAY_1}' END AS first_seen, CASE WHEN b.uid IS NULL THEN '{DAY_1}' ELSE '{DAY_2}' END AS last_seen,
  CASE WHEN b.uid IS NULL OR a.hash = b.hash THEN '{DAY_1}' ELSE '{DAY_2}' END AS valid_from, true AS is_current FROM h1 a FULL JOIN h2 b ON a.uid = b.uid""", proxy=False)
def scd2_latest(spark, sf):
    return two_days(spark, sf)[0]


@query(SNAPSHOTS + f"""
SELECT a.uid, a.status, a.price, a.priority, a.hash, '{DAY_1}' AS valid_from, CASE WHEN b.uid IS NOT NULL AND a.hash <> b.hash THEN '{DAY_2}' END AS valid_to, NOT (b.uid IS NOT NULL AND a.hash <> b.hash) AS is_current
FROM h1 a LEFT JOIN h2 b ON a.uid = b.uid
UNION ALL SELECT b.uid, b.status, b.price, b.priority, b.hash, '{DAY_2}', NULL, true FROM h2 b LEFT JOIN h1 a ON a.uid = b.uid WHERE a.uid IS NULL OR a.hash <> b.hash""", proxy=False)
def scd2_history(spark, sf):
    return two_days(spark, sf)[1]


def two_steps(spark, sf) -> HistoryTable:
    """The two snapshots brought into a history table step by step, in the shared folder."""
    orders = HistoryTable(spark, place(spark, "history"), "uid", buckets=16)
    for day, rows in zip((DAY_1, DAY_2), snapshots(spark, sf), strict=True):
        counters = Counters()
        orders.apply(day, counters.of(rows, rows_in=None), day, counters)
    return orders


@query(ORACLES["scd2_history"], proxy=False)
def history_by_steps(spark, sf):
    """The history out of the bucketed table: rows closed by each step, and the latest rows."""
    return two_steps(spark, sf).history()


@query(ORACLES["scd2_latest"], proxy=False)
def latest_by_steps(spark, sf):
    return two_steps(spark, sf).latest()


@query(SNAPSHOTS + f""", c AS (SELECT count(*) AS n FROM h2 JOIN h1 USING (uid) WHERE h1.hash <> h2.hash)
SELECT '{DAY_1}' AS step, count(*) AS rows_in, count(*) AS upserts, count(*) AS new_history_rows, CAST(0 AS BIGINT) AS closed_history_rows FROM h1
UNION ALL SELECT '{DAY_2}', count(*), count(*) FILTER (WHERE uid NOT IN (SELECT uid FROM h1)) + (SELECT n FROM c), count(*) FILTER (WHERE uid NOT IN (SELECT uid FROM h1)) + (SELECT n FROM c), (SELECT n FROM c) FROM h2""", proxy=False)
def run_counters(spark, sf):
    """Counts of both steps, taken by the plans that wrote them."""
    return two_steps(spark, sf).counters()


@query(SNAPSHOTS + """
SELECT priority, 'new' AS change, count(DISTINCT uid) AS rows FROM d2 WHERE uid NOT IN (SELECT uid FROM d1) GROUP BY 1
UNION ALL SELECT priority, 'gone', count(DISTINCT uid) FROM d1 WHERE uid NOT IN (SELECT uid FROM d2) GROUP BY 1""", proxy=False)
def run_new_and_gone(spark, sf):
    first, second = snapshots(spark, sf)
    return history.new_and_gone(second, first, "uid", "priority")


@query(SNAPSHOTS + f"""
SELECT b.uid, '{DAY_2}' AS run_date, b.price, b.status, b.price - a.price AS price_delta, (b.priority <> coalesce(a.priority, '')) AS photo_changed, coalesce(b.status <> a.status, false) AS status_changed
FROM d2 b LEFT JOIN d1 a ON a.uid = b.uid""", proxy=False)
def run_history(spark, sf):
    first, second = (d.withColumn("photos", F.array("priority")) for d in snapshots(spark, sf))
    return history.run_history(second, first, "uid", DAY_2)


@query(f"""
, p AS (SELECT portal, listing_key, min(first_seen) AS first FROM listings WHERE updated_at < '1999-01-01' GROUP BY 1, 2)
SELECT l.row_id, coalesce(p.first, '{DAY_2}') AS first_seen, '{DAY_2}' AS last_seen FROM listings l LEFT JOIN p ON p.portal = l.portal AND p.listing_key = l.listing_key""")
def first_seen_carried(spark, sf):
    d = listings(spark, sf)
    return resolve.with_previous(d.drop("first_seen"), d.filter("updated_at < '1999-01-01'"), F.lit(DAY_2)).select("row_id", "first_seen", "last_seen")


# --- entity resolution


def rows(spark, sf) -> DataFrame:
    """What the match rules take."""
    d = listings(spark, sf)
    return d.withColumns({"photos": F.array("photo"), "address": text.join_address(text.fold(F.col("street")), text.fold(F.col("town")))})


def all_rows(spark, sf) -> DataFrame:
    """What all six rules take; the order tables have no projects."""
    return rows(spark, sf).withColumns({"address_ascii": F.col("address"), "project": F.lit(None).cast("string")})


CLOSE = "(a.size > 0 AND b.size > 0 AND abs(a.size - b.size) <= {} * greatest(a.size, b.size))"
BAND = f"{CLOSE.format(0.03)} AND abs(round_even(a.size, 0) - round_even(b.size, 0)) <= 2"
ROWS = ", r AS (SELECT *, CASE WHEN street IS NULL THEN lower(town) ELSE lower(street || ', ' || town) END AS address FROM listings)"
HAVERSINE = "2 * 6371000.0 * asin(sqrt(least(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a.lng) / 2), 2), 1.0)))"
PAIRS = {
    "P1": "SELECT a.row_id AS a, b.row_id AS b FROM r a JOIN r b ON a.photo = b.photo AND a.row_id < b.row_id",
    "A1": f"SELECT a.row_id AS a, b.row_id AS b FROM r a JOIN r b ON a.address = b.address AND a.town = b.town AND a.row_id < b.row_id AND {BAND}",
    "I1": "SELECT a.row_id AS a, b.row_id AS b FROM r a JOIN r b ON a.listing_key = b.listing_key AND a.row_id < b.row_id JOIN (SELECT listing_key FROM r GROUP BY 1 HAVING min(portal) < max(portal)) k ON k.listing_key = a.listing_key",
    "G1": f"SELECT a.row_id AS a, b.row_id AS b FROM r a JOIN r b ON a.town = b.town AND abs(a.lat - b.lat) < 0.002 AND abs(a.lng - b.lng) < 0.002 AND a.row_id < b.row_id AND {CLOSE.format(0.03)} AND {HAVERSINE} <= 60.0",
}


def closure(edges_sql: str) -> str:
    """Tables of the WITH clause that name every row's component by its smallest row."""
    return f"""{ROWS}, e AS MATERIALIZED ({edges_sql}), g AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT a AS node, a AS other FROM g UNION SELECT reach.node, g.b FROM reach JOIN g ON g.a = reach.other),
label AS (SELECT r.row_id, least(r.row_id, coalesce(min(reach.other), r.row_id)) AS cluster_id FROM r LEFT JOIN reach ON reach.node = r.row_id GROUP BY r.row_id)"""


def labelled_by(spark, sf, names: tuple[str, ...], keep: tuple[str, ...] = ()) -> DataFrame:
    """row_id, what the rules read, what is to be kept, and cluster_id."""
    read = dict.fromkeys(["row_id", *keep, *[c for n in names for c in resolve.RULES[n]]])
    return resolve.labelled_by(rows(spark, sf).select(*read), names)


def register_rule(rule: str, name: str) -> None:
    def run(spark, sf):
        return labelled_by(spark, sf, (rule,)).select("row_id", "cluster_id")

    run.__name__ = name
    query(closure(PAIRS[rule]) + " SELECT row_id, cluster_id FROM label", recursive=True)(run)


for _rule, _name in (("P1", "match_photo"), ("A1", "match_address_size"), ("I1", "match_key_across_portals"), ("G1", "match_place")):
    register_rule(_rule, _name)

THREE = " UNION ".join(PAIRS[r] for r in ("P1", "A1", "I1"))


@query(closure(THREE) + " SELECT row_id, cluster_id FROM label", recursive=True)
def components_of_rules(spark, sf):
    return labelled_by(spark, sf, ("P1", "A1", "I1")).select("row_id", "cluster_id")


SCORED = f"""
  SELECT a.row_id AS a, b.row_id AS b, CASE WHEN a.listing_key = b.listing_key THEN 8 ELSE 0 END + CASE WHEN a.address = b.address THEN 4 ELSE 0 END
    + CASE WHEN {CLOSE.format(0.02)} THEN 3 WHEN {CLOSE.format(0.03)} THEN 2 ELSE 0 END + CASE WHEN a.photo = b.photo THEN 4 ELSE 0 END
    + CASE WHEN a.price > 0 AND b.price > 0 AND abs(a.price - b.price) <= 0.05 * greatest(a.price, b.price) THEN 1 ELSE 0 END AS score
  FROM (SELECT DISTINCT x.row_id AS i, y.row_id AS j FROM r x JOIN r y ON x.row_id < y.row_id AND x.listing_key = y.listing_key
    UNION SELECT x.row_id, y.row_id FROM r x JOIN r y ON x.row_id < y.row_id AND x.photo = y.photo
    UNION SELECT x.row_id, y.row_id FROM r x JOIN r y ON x.row_id < y.row_id AND x.address = y.address AND x.size IS NOT NULL AND y.size IS NOT NULL)
  JOIN r a ON a.row_id = i JOIN r b ON b.row_id = j"""


@query(f"{ROWS}, p AS ({SCORED}) SELECT a, b, score FROM p WHERE score >= 7")
def scored_pairs(spark, sf):
    return edges.scored_pairs(rows(spark, sf))


@query(closure(f"SELECT a, b FROM ({SCORED}) WHERE score >= 7") + " SELECT row_id, cluster_id FROM label", recursive=True)
def scored_clusters(spark, sf):
    """Components of the scored pairs, from edges without the pairs."""
    d = rows(spark, sf).select("row_id", "listing_key", "address", "size", "price", "photos")
    return resolve.labelled(d, lambda n: [edges.scored_edges(n, resolve.NUMBER)]).select("row_id", "cluster_id")


def merge_counts(spark, sf):
    """Components that each of the six rules takes away; tested against counting by hand."""
    return resolve.merge_counts(all_rows(spark, sf))


def fuzzy_matches(spark, sf):
    """Rule on similar addresses: its similarity has no SQL form."""
    d = resolve.numbered(rows(spark, sf).select("row_id", "address", "town", "size"))
    found = resolve.linked(d, [edges.fuzzy_edges(d, "address", id_col=resolve.NUMBER)])
    return d.join(found, resolve.NUMBER).select(F.col("row_id").alias("node"), F.col("cluster_id").alias("label"))


QUERIES |= {"merge_counts": merge_counts, "fuzzy_matches": fuzzy_matches}

NEWEST = "updated_at DESC, portal_rank, row_id"
BEST = "portal_rank, updated_at DESC, row_id"
FIRST = lambda c, order: f"(list({c} ORDER BY {order}) FILTER (WHERE {c} IS NOT NULL))[1]"


SOURCE = ("portal", "listing_key", "url", "updated_at")
#: What golden records read.
RECORD = (*SOURCE, "portal_rank", "town", "street", "size", "price", "rooms", "floor", "floors_total", "elevator", "cert", "year_built", "lat", "lng", "status", "photos", "address")


def labelled_by_all(spark, sf, keep: tuple[str, ...] = ()) -> DataFrame:
    read = dict.fromkeys(["row_id", *keep, *[c for columns in resolve.RULES.values() for c in columns]])
    return resolve.labelled_by(all_rows(spark, sf).select(*read))


def components_of_all_rules(spark, sf):
    """Six rules; similar addresses have no SQL form."""
    return labelled_by_all(spark, sf).select("row_id", "cluster_id")


def golden_records_of_all_rules(spark, sf):
    return printed(resolve.golden(kept(labelled_by_all(spark, sf, RECORD), "labelled")))


def conflict_report_of_all_rules(spark, sf):
    return resolve.conflict_report(resolve.golden(kept(labelled_by_all(spark, sf, RECORD), "labelled")))


def golden_sources_of_all_rules(spark, sf):
    return labelled_by_all(spark, sf, SOURCE).select("cluster_id", "portal", "listing_key", "url", "updated_at")


QUERIES |= {f.__name__: f for f in (components_of_all_rules, golden_records_of_all_rules, conflict_report_of_all_rules, golden_sources_of_all_rules)}


def golden_rows(spark, sf) -> DataFrame:
    return resolve.golden(kept(labelled_by(spark, sf, ("P1", "A1", "I1"), RECORD), "labelled"))


GOLD = f"""{closure(THREE)}, c AS (SELECT r.*, label.cluster_id FROM r JOIN label USING (row_id)),
rm AS (SELECT cluster_id, CASE WHEN count(*) FILTER (WHERE n = top) = 1 THEN max(rooms) FILTER (WHERE n = top) END AS v FROM (SELECT *, max(n) OVER (PARTITION BY cluster_id) AS top FROM (SELECT cluster_id, rooms, count(*) AS n FROM c WHERE rooms IS NOT NULL GROUP BY 1, 2)) GROUP BY 1),
tm AS (SELECT cluster_id, town AS v FROM (SELECT cluster_id, town, row_number() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC, min(lpad(CAST(portal_rank AS VARCHAR), 4, '0') || row_id)) AS o FROM c WHERE town IS NOT NULL GROUP BY 1, 2) WHERE o = 1),
g0 AS (
  SELECT cluster_id, count(*) AS cluster_size, {FIRST('portal', NEWEST)} AS primary_portal, {FIRST('url', NEWEST)} AS primary_url, {FIRST('updated_at', NEWEST)} AS updated_at, {FIRST('street', NEWEST)} AS street, {FIRST('address', NEWEST)} AS address, {FIRST('rooms', BEST)} AS r1, {FIRST('town', NEWEST)} AS t0,
    CASE WHEN coalesce(max(size) - min(size) > 0.05 * max(size), false) THEN {FIRST('size', BEST)} ELSE median(size) END AS size, coalesce(max(size) - min(size) > 0.05 * max(size), false) AS size_flag,
    {FIRST('price', NEWEST)} AS price, min(price) AS plo, max(price) AS phi,
    (list({{'f': floor, 't': floors_total}} ORDER BY {NEWEST}) FILTER (WHERE floor IS NOT NULL AND floors_total IS NOT NULL))[1] AS pair, {FIRST('floor', BEST)} AS f1, {FIRST('floors_total', BEST)} AS t1,
    bool_or(elevator) AS elevator, {FIRST('cert', BEST)} AS cert, {FIRST('year_built', BEST)} AS year_built, avg(lat) AS lat, avg(lng) AS lng, {FIRST('status', NEWEST)} AS status, coalesce(min(status) <> max(status), false) AS status_flag,
    coalesce(min(rooms) <> max(rooms), false) AS rooms_flag, list_aggregate(list_sort(list(DISTINCT photo)), 'string_agg', ',') AS photos
  FROM c GROUP BY cluster_id),
gold AS (
  SELECT g0.*, coalesce(tm.v, t0) AS town, coalesce(rm.v, r1) AS rooms, CASE WHEN pair IS NULL THEN f1 ELSE pair.f END AS floor, CASE WHEN pair IS NULL THEN t1 ELSE pair.t END AS floors_total,
    coalesce(price <> 0 AND (abs(plo - price) > 0.05 * greatest(abs(price), 1.0) OR abs(phi - price) > 0.05 * greatest(abs(price), 1.0)), false) AS price_flag FROM g0 LEFT JOIN tm USING (cluster_id) LEFT JOIN rm USING (cluster_id)),
flagged AS (SELECT *, array_to_string(list_filter([CASE WHEN price_flag THEN 'price_disagree' END, CASE WHEN rooms_flag THEN 'rooms_disagree' END, CASE WHEN size_flag THEN 'size_gt_5pct' END, CASE WHEN status_flag THEN 'status_disagree' END], lambda x: x IS NOT NULL), ',') AS flags FROM gold)"""


@query(GOLD + """
SELECT cluster_id, cluster_size, primary_portal, primary_url, updated_at, street, town, round(size, 4) AS size, price, rooms, floor, floors_total, elevator, cert, year_built, round(lat, 6) AS lat, round(lng, 6) AS lng,
  status, photos, round(price / nullif(size, 0.0), 4) AS price_psm, flags, address,
  sha1(lower(trim(coalesce(address, '')) || '|' || coalesce(printf('%.1f', round_even(size * 10, 0) / 10), '') || '|' || coalesce(CAST(floor AS VARCHAR), '') || '|' || coalesce(CAST(floors_total AS VARCHAR), '') || '|' || coalesce(CAST(year_built AS VARCHAR), '') || '||' || coalesce(cert, ''))) AS listing_id
FROM flagged""", recursive=True)
def golden_records(spark, sf):
    return printed(golden_rows(spark, sf))


def printed(gold: DataFrame) -> DataFrame:
    g = gold.withColumns({"photos": F.array_join("photos", ","), "flags": F.array_join("flags", ","), "listing_id": resolve.record_id()})
    g = g.withColumns({"size": snapped("size"), "lat": snapped("lat", 6), "lng": snapped("lng", 6), "price_psm": snapped("price_psm")})
    return g.drop("address_ascii", "project", "unit_no", "year_top", "transaction", "district", "region", "provenance")


@query(GOLD + " SELECT cluster_id, flags AS conflict_fields, cluster_size AS source_count FROM flagged WHERE flags <> ''", recursive=True)
def conflict_report(spark, sf):
    return resolve.conflict_report(golden_rows(spark, sf))


@query(closure(THREE) + " SELECT cluster_id, portal, listing_key, url, updated_at FROM r JOIN label USING (row_id)", recursive=True)
def golden_sources(spark, sf):
    return labelled_by(spark, sf, ("P1", "A1", "I1"), SOURCE).select("cluster_id", "portal", "listing_key", "url", "updated_at")


ORDER_2 = "portal_rank, row_id"


@query(f"""
, c AS (SELECT *, photo AS cluster_id FROM listings),
n AS (SELECT cluster_id, rooms, count(*) AS n, min(row_id) AS seen FROM c WHERE rooms IS NOT NULL GROUP BY 1, 2), rm AS (SELECT cluster_id, (list(rooms ORDER BY n DESC, seen))[1] AS v, count(*) FILTER (WHERE n = top) AS lead, count(*) AS kinds FROM (SELECT *, max(n) OVER (PARTITION BY cluster_id) AS top FROM n) GROUP BY 1),
t AS (SELECT cluster_id, status, count(*) AS n, min(row_id) AS seen FROM c WHERE status IS NOT NULL GROUP BY 1, 2), sm AS (SELECT cluster_id, (list(status ORDER BY n DESC, seen))[1] AS v, count(*) AS kinds FROM t GROUP BY 1),
g AS (
  SELECT cluster_id, count(*) AS cluster_size, median(size) AS size, min(size) AS lo, max(size) AS hi, (list({{'p': price}} ORDER BY updated_at DESC, row_id))[1].p AS price, min(price) AS plo, max(price) AS phi,
    {FIRST('rooms', ORDER_2)} AS r1, {FIRST('floor', ORDER_2)} AS floor, {FIRST('floors_total', ORDER_2)} AS floors_total, {FIRST('street', ORDER_2)} AS street, {FIRST('town', ORDER_2)} AS town, {FIRST('year_built', ORDER_2)} AS year_built,
    (list({{'c': cert}} ORDER BY {ORDER_2}))[1].c AS cert, (list({{'c': region}} ORDER BY {ORDER_2}))[1].c AS region, (list({{'c': transaction}} ORDER BY {ORDER_2}))[1].c AS transaction, CASE WHEN bool_or(coalesce(elevator, false)) THEN true END AS elevator, avg(lat) AS lat, avg(lng) AS lng FROM c GROUP BY 1)
SELECT cluster_id, cluster_size, street, town, region, CASE WHEN rm.lead > 1 THEN coalesce(r1, rm.v) ELSE rm.v END AS rooms, round(size, 4) AS size, price, round(price / nullif(size, 0), 4) AS price_psm, floor, floors_total, elevator, coalesce(sm.v, 'unknown') AS building_status, year_built, coalesce(cert, 'unknown') AS cert,
  '{{"size_m2":' || CAST(coalesce(abs(lo - size) > 0.05 * size OR abs(hi - size) > 0.05 * size, false) AS VARCHAR) || ',"price":' || CAST(coalesce(abs(plo - price) > 0.05 * price OR abs(phi - price) > 0.05 * price, false) AS VARCHAR) || ',"room_number":' || CAST(coalesce(rm.kinds > 1, false) AS VARCHAR) || ',"building_status":' || CAST(coalesce(sm.kinds > 1, false) AS VARCHAR) || '}}' AS conflict_flags,
  transaction, round(lat, 6) AS lat, round(lng, 6) AS lng,
  sha1(concat_ws('|', coalesce(strip_accents(lower(street)), ''), strip_accents(lower(town)), coalesce(printf('%.1f', round_even(size * 10, 0) / 10), '0.0'), coalesce(CAST(nullif(floor, 0) AS VARCHAR), ''), coalesce(CAST(nullif(floors_total, 0) AS VARCHAR), ''), coalesce(CAST(year_built AS VARCHAR), ''), coalesce(cert, 'unknown'))) AS listing_id
FROM g LEFT JOIN rm USING (cluster_id) LEFT JOIN sm USING (cluster_id)""")
def golden_by_majority(spark, sf):
    """The other survivorship, over the clusters of equal photos."""
    read = dict.fromkeys([*RECORD, "row_id", "photo", "region", "transaction"])
    g = survivors.golden(kept(rows(spark, sf).select(*read).drop("listing_key", "address").withColumnRenamed("photo", "cluster_id"), "rows"))
    g = g.withColumns({"size": snapped("size"), "lat": snapped("lat", 6), "lng": snapped("lng", 6), "price_psm": snapped("price_psm")})
    return g.drop("district", "year_top", "photos", "__price_from")


@query("""
SELECT s.cluster_id, s.reasons, s.more FROM (SELECT town AS cluster_id, count(*) FILTER (WHERE street IS NULL) AS reasons, greatest(count(*) OVER () - 10, 0) AS more, row_number() OVER (ORDER BY count(*) FILTER (WHERE street IS NULL) DESC, town) AS r FROM listings GROUP BY town) s WHERE r <= 10""")
def missing_report(spark, sf):
    """Where most listings lack a street: ten lines for the log, and how many more there are."""
    d = listings(spark, sf).groupBy(F.col("town").alias("cluster_id")).agg(F.count_if(F.col("street").isNull()).alias("reasons"))
    return enrich.first_of(d.withColumn("r", -F.col("reasons")), ["r", "cluster_id"]).drop("r")


@query("""
WITH a AS (SELECT doc_id, regexp_replace(substring(coalesce(text, ''), 1, 40), '[^A-Za-z ]', '', 'g') AS t FROM documents), e AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS id, trim(t) AS summary FROM a WHERE doc_id % 5 <> 4 UNION ALL SELECT doc_id, 'x' || CAST(doc_id AS VARCHAR), 'second' FROM a WHERE doc_id % 5 <> 4)
SELECT doc_id, id, summary FROM e WHERE summary <> ''""", proxy=False)
def batch_answers(spark, sf):
    """Batch answers of four forms (object with items, bare array, fenced, broken) taken apart into ids and texts."""
    n, t = F.col("doc_id").cast("string"), F.regexp_replace(F.substring(F.coalesce("text", F.lit("")), 1, 40), "[^A-Za-z ]", "")
    one = F.concat(F.lit('{"id":'), n, F.lit(',"summary_short_sk":" '), t, F.lit(' "}'))
    array = F.concat(F.lit("["), one, F.lit(',"text",{"listing_id":"x'), n, F.lit('","summary":"\\"second\\""},{"id":""}]'))
    items = F.concat(F.lit('{"items":'), array, F.lit("}"))
    k = F.col("doc_id") % 5
    body = F.when(k == 0, items).when(k == 1, array).when(k == 2, F.concat(F.lit("```json\n"), items, F.lit("\n```"))).when(k == 3, F.concat(F.lit("```\n"), array, F.lit("```"))).otherwise(F.concat(F.lit("{"), array))
    return table(spark, sf, "documents").select("doc_id", F.explode(text.answers(body)).alias("id", "summary")).filter("summary <> ''")


# --- enrichment and serving


@query("""
, s AS (SELECT l_suppkey % 3 AS p, d.doc_id, d.text FROM (SELECT DISTINCT l_suppkey FROM lineitem) JOIN documents d ON d.doc_id = l_suppkey WHERE trim(coalesce(text, '')) <> '')
SELECT lang AS cluster_id, (list(text ORDER BY CASE source WHEN 'src1' THEN 1 WHEN 'src0' THEN 2 ELSE 3 END, first_seen, listing_key, text))[1] AS description, (list(source ORDER BY CASE source WHEN 'src1' THEN 1 WHEN 'src0' THEN 2 ELSE 3 END, first_seen, listing_key, text))[1] AS portal
FROM (SELECT lang, source, lpad(CAST(doc_id AS VARCHAR), 12, '0') AS listing_key, lpad(CAST(n_chars AS VARCHAR), 12, '0') AS first_seen, text FROM documents WHERE trim(coalesce(text, '')) <> '') GROUP BY lang""")
def description_pick(spark, sf):
    d = table(spark, sf, "documents")
    key = F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("listing_key")
    sources = d.select(F.col("lang").alias("cluster_id"), F.col("source").alias("portal"), key, F.lpad(F.col("n_chars").cast("string"), 12, "0").alias("first_seen"))
    return enrich.pick_description(sources, d.select(F.col("source").alias("portal"), key, F.col("text").alias("description")), ["src1", "src0"])


@query("SELECT d.doc_id, sha1(trim(d.text)) AS cache_key, q.quality FROM documents d LEFT JOIN (SELECT DISTINCT sha1(trim(text)) AS k, max(quality) AS quality FROM documents JOIN labels USING (doc_id) GROUP BY 1) q ON q.k = sha1(trim(d.text))", proxy=False)
def cache_lookup(spark, sf):
    d = table(spark, sf, "documents")
    cache = d.join(table(spark, sf, "labels"), "doc_id").groupBy(text.cache_key(F.col("text")).alias("key")).agg(F.max("quality").alias("value"))
    return enrich.cached(d.select("doc_id", "text"), cache, "text", "quality").select("doc_id", "cache_key", "quality")


@query("""
, m AS (SELECT row_id, town, street, CASE WHEN CAST(quantity AS BIGINT) % 2 = 0 THEN lat END AS lat, lng, lower(trim(coalesce(street, ''))) || '|' || lower(trim(town)) || '|slovakia' AS key FROM listings),
cache AS (SELECT key, avg(lat) AS lat, avg(lng) AS lng FROM m WHERE lat IS NOT NULL GROUP BY key)
SELECT row_id, round(CASE WHEN m.lat IS NOT NULL THEN m.lat ELSE cache.lat END, 6) AS lat, round(CASE WHEN m.lat IS NOT NULL THEN m.lng ELSE cache.lng END, 6) AS lng,
  CASE WHEN m.lat IS NOT NULL THEN 'own' WHEN cache.key IS NOT NULL THEN 'cache' ELSE 'pending' END AS geo_source FROM m LEFT JOIN cache ON cache.key = m.key""")
def geocode_fill(spark, sf):
    d = listings(spark, sf).withColumn("lat", F.when(F.col("quantity").cast("long") % 2 == 0, F.col("lat"))).select("row_id", "town", "street", "lat", "lng")
    cache = d.filter("lat IS NOT NULL").groupBy(geo.place_key(F.col("street"), F.col("town")).alias("key")).agg(F.avg("lat").alias("lat"), F.avg("lng").alias("lng"))
    return rounded(enrich.fill_coordinates(d, cache).select("row_id", "lat", "lng", "geo_source"), 6)


@query("""
SELECT l.row_id, coalesce(a.u, b.u) AS photo_url FROM listings l
LEFT JOIN (SELECT listing_key AS k, min('https://img/' || photo) AS u FROM listings WHERE portal = 'portal_a' GROUP BY 1) a ON a.k = l.listing_key
LEFT JOIN (SELECT url AS k, min('https://img/' || photo) AS u FROM listings WHERE portal <> 'portal_a' GROUP BY 1) b ON b.k = l.url""")
def photo_lookup(spark, sf):
    d = listings(spark, sf)
    own = F.col("portal") == "portal_a"
    photos = d.select(F.when(own, F.col("listing_key")).alias("by_key"), F.when(~own, F.col("url")).alias("by_url"), F.concat(F.lit("https://img/"), F.col("photo")).alias("photo_url"))
    return enrich.first_hit(d.select("row_id", "listing_key", "url"), photos, [("listing_key", "by_key"), ("url", "by_url")], "photo_url").select("row_id", "photo_url")


@query("""
, t AS (SELECT photo AS token, 'https://img/' || photo || '.jpg' AS url FROM listings WHERE size IS NOT NULL GROUP BY photo), n AS (SELECT listing_key, list_sort(list(DISTINCT photo)) AS photos FROM listings GROUP BY 1),
e AS (SELECT listing_key, unnest(photos) AS token, generate_subscripts(photos, 1) AS at FROM n)
SELECT n.listing_key, coalesce(string_agg(t.url, ',' ORDER BY e.at), '') AS urls FROM n LEFT JOIN e USING (listing_key) LEFT JOIN t USING (token) GROUP BY 1""")
def photo_urls_of_tokens(spark, sf):
    d = listings(spark, sf)
    urls = d.filter("size IS NOT NULL").select(F.col("photo").alias("token")).distinct().withColumn("url", F.concat(F.lit("https://img/"), F.col("token"), F.lit(".jpg")))
    lists = d.groupBy("listing_key").agg(F.array_sort(F.collect_set("photo")).alias("photos"))
    return enrich.resolve_tokens(lists, urls, "listing_key", "photos").select("listing_key", F.array_join("urls", ",").alias("urls"))


METRICS = """
, m AS (SELECT *, floor(price * 0.004 + 0.5) AS rent, floor(price * 0.0009 + 0.5) AS expenses FROM listings),
k AS (SELECT *, floor((rent - expenses) * 12 * 100.0 / price * 10 + 0.5) / 10 AS cap_rate, CASE WHEN coalesce(rooms, 0) >= 4 THEN 'house' ELSE 'apartment' END AS type FROM m)
"""


def presented(spark, sf) -> DataFrame:
    return serve.presented(serve.investment(listings(spark, sf)))


@query(METRICS + """
SELECT row_id, CAST(rent AS BIGINT) AS rent, CAST(expenses AS BIGINT) AS expenses, CAST(rent - expenses AS BIGINT) AS cashflow, round(cap_rate, 4) AS cap_rate, CASE WHEN price IS NULL THEN NULL WHEN cap_rate >= 6 THEN 'A' WHEN cap_rate >= 4 THEN 'B' ELSE 'C' END AS grade,
  type, lower(replace(replace(region, ' ', '-'), '_', '-')) AS region_slug, regexp_extract(url, '/detail/([A-Za-z0-9]+)', 1) AS portal_id FROM k
WHERE lower(town) = 'nation_3' AND contains(lower(concat_ws(' ', coalesce(street, ''), town)), 'ring')""")
def serve_listings(spark, sf):
    d = serve.listings(presented(spark, sf), city="NATION_3", q="Ring")
    return d.select("row_id", "rent", "expenses", "cashflow", snapped("cap_rate").alias("cap_rate"), "grade", "type", "region_slug", "portal_id")


@query(METRICS + "SELECT row_id, type, price FROM k WHERE type = 'house' AND coalesce(price, 0) >= 20000 AND coalesce(price, 0) <= 60000 AND cap_rate >= 3.7 AND transaction <> 'prenajom'")
def list_view_filter(spark, sf):
    d = serve.narrowed(presented(spark, sf), kind="house", price_min=20_000, price_max=60_000, cap_min=3.7)
    return serve.not_rentals(d, "transaction").select("row_id", "type", "price")


@query("SELECT row_id, town, price FROM listings WHERE lower(town) = 'nation_7' ORDER BY row_id LIMIT 500")
def serve_limit(spark, sf):
    return serve.listings(listings(spark, sf), city="nation_7", limit=500).select("row_id", "town", "price")


@query("""SELECT town, count(*) AS rows, CAST(sum(CAST('0x' || substring(md5('{"listing_key":"' || listing_key || '","row_id":"' || row_id || '","town":"' || town || '"}'), 1, 12) AS BIGINT)) AS VARCHAR) AS digest FROM listings GROUP BY 1""")
def city_documents(spark, sf):
    return serve.documents_by(listings(spark, sf).select("row_id", "town", "listing_key"), "town")


@query("""
, c AS (SELECT town AS city, count(*) AS n, floor(avg(size) * 1e4 + 0.3141592653) / 1e4 AS s FROM listings WHERE transaction = 'prenajom' GROUP BY 1)
SELECT '2025-11-02' AS date, 'portal' AS site, (SELECT count(*) FROM listings WHERE transaction = 'prenajom') AS total_listings, (SELECT string_agg(city || ':' || CAST(n AS VARCHAR) || ':' || printf('%.4f', s), ';' ORDER BY city) FROM c) AS cities""")
def daily_statistics(spark, sf):
    """The daily JSON document, read back."""
    d = listings(spark, sf).filter("transaction = 'prenajom'").select(F.col("town").alias("city"), "price", "size", F.try_divide("price", "size").alias("psm"))
    cities = stats.market(d, ["city"]).withColumn("avg_size", snapped("avg_size"))
    body = serve.daily_stats(stats.market(d, []), cities, "2025-11-02", "portal")
    back = body.select(F.from_json("json", "date string, site string, total_listings long, cities array<struct<city string, count long, avg_floor_area_m2 double>>").alias("j")).select("j.*")
    each = F.transform("cities", lambda c: F.concat_ws(":", c["city"], c["count"].cast("string"), F.format_string("%.4f", c["avg_floor_area_m2"])))
    return back.select("date", "site", "total_listings", F.array_join(each, ";").alias("cities"))


@query("""
SELECT url AS link, nullif(regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '/(\\d+)[^/]*$', 1), '') AS property_id,
  trim(regexp_replace(replace(replace(replace(replace(replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', ' '), '&amp;', '&'), '[\\s\\x{A0}]+', ' ', 'g')) AS property_name,
  'predaj' AS transaction, 'Nove Zamky' AS address_town FROM pages""", proxy=False)
def page_records(spark, sf):
    """Pages as raw listings; the parts that a regular expression finds as well."""
    r = records.records(table(spark, sf, "pages"), "nehnutelnosti_sk", "nove-zamky", "predaj")
    return r.select("link", "property_id", F.coalesce("property_name", F.lit("")).alias("property_name"), "transaction", "address_town")


@query("SELECT count(*) AS total_rows, count(*) FILTER (WHERE town = 'NATION_1') AS returned_rows, 'gold/latest' AS path FROM listings")
def snapshot_meta(spark, sf):
    d = listings(spark, sf)
    return serve.snapshot_meta(d, serve.listings(d, city="NATION_1"), "gold/latest")


# --- extraction


@query("""
SELECT page_id, len(list_distinct(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]+)"', 1))) AS n_links, regexp_extract_all(html, '<a\\s[^>]*?href="([^"]+)"', 1)[1] AS first_link,
  regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS normal_url, nullif(regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '/(\\d+)[^/]*$', 1), '') AS url_id,
  nullif(trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '[\\s\\x{A0}]+', ' ', 'g')), '') AS title FROM pages""", proxy=False)
def page_links(spark, sf):
    p = table(spark, sf, "pages")
    found = extract.links(F.col("html"))
    return p.select("page_id", F.size(found).cast("long").alias("n_links"), F.get(found, F.lit(0)).alias("first_link"), extract.normal_url(F.col("url")).alias("normal_url"), extract.url_id(F.col("url")).alias("url_id"), extract.page_title(F.col("html")).alias("title"))


@query("""
, t AS (SELECT row_id, 'Predám ' || coalesce(CAST(rooms AS VARCHAR), 'pekný') || ' izb. byt, ' || coalesce(CAST(CAST(size AS BIGINT) AS VARCHAR) || ' m2', '') || ', ' || coalesce(CAST(floor AS VARCHAR) || '. poschodie', 'prízemie') || ', novostavba z ' || coalesce(CAST(year_built AS VARCHAR), 'minula') || ', cena ' || coalesce(CAST(CAST(price AS BIGINT) AS VARCHAR) || ' eur', 'dohodou') AS t FROM listings)
SELECT row_id, TRY_CAST(regexp_extract(t, '(\\d+)\\s*-?\\s*izb', 1) AS INTEGER) AS rooms, TRY_CAST(regexp_extract(t, '(\\d+)\\s*m2', 1) AS DOUBLE) AS area, CASE WHEN contains(t, 'prízem') THEN 0 ELSE TRY_CAST(regexp_extract(t, '(\\d+)\\. posch', 1) AS INTEGER) END AS floor,
  'Novostavba' AS state, TRY_CAST(regexp_extract(t, 'novostavba z (\\d+)', 1) AS INTEGER) AS year, TRY_CAST(regexp_extract(t, 'cena (\\d+) eur', 1) AS BIGINT) AS price FROM t""")
def text_mining(spark, sf):
    whole = lambda c: F.col(c).cast("long").cast("string")
    t = F.concat(
        F.lit("Predám "), F.coalesce(F.col("rooms").cast("string"), F.lit("pekný")), F.lit(" izb. byt, "), F.coalesce(F.concat(F.rint("size").cast("long").cast("string"), F.lit(" m2")), F.lit("")), F.lit(", "),
        F.coalesce(F.concat(F.col("floor").cast("string"), F.lit(". poschodie")), F.lit("prízemie")), F.lit(", novostavba z "), F.coalesce(F.col("year_built").cast("string"), F.lit("minula")),
        F.lit(", cena "), F.coalesce(F.concat(F.rint("price").cast("long").cast("string"), F.lit(" eur")), F.lit("dohodou")),
    )
    d = listings(spark, sf).select("row_id", t.alias("t"))
    c = F.col("t")
    year = extract.year_in(F.regexp_extract(c, "novostavba z (.*?),", 1))
    return d.select("row_id", extract.rooms_in(c).alias("rooms"), extract.area_in(c).alias("area"), extract.floor_in(c)["floor"].alias("floor"), extract.state_in(c).alias("state"), year.alias("year"), extract.price_in(c).alias("price"))


def marked_pages(spark, sf) -> DataFrame:
    """Pages with JSON-LD blocks of their own title, text and links: a broken one, a product, a residence, and the list of links."""
    title = F.regexp_replace(F.coalesce(extract.page_title(F.col("html")), F.lit("")), r"[^A-Za-z ]", "")
    n = F.col("page_id")
    items = F.transform(
        extract.links(F.col("html")),
        lambda u, i: F.when(i % 4 == 3, F.concat(F.lit('"'), F.lit("x"), F.lit('"'))).when(i % 4 == 2, F.lit('{"@type":"ListItem","url":""}')).when(i % 4 == 1, F.concat(F.lit('{"url":"'), F.regexp_replace(u, r"[^A-Za-z0-9/]", ""), F.lit('"}'))).otherwise(F.concat(F.lit('{"url":"/other","mainEntity":{"url":"'), F.regexp_replace(u, r"[^A-Za-z0-9/]", ""), F.lit('"}}'))),
    )
    kind = F.when(n % 3 == 0, '["Thing","Product"]').otherwise('"product"')
    price = F.when(n % 5 != 0, F.concat(F.lit(',"offers":{"price":'), (n * 10 + 5).cast("string"), F.lit(',"priceCurrency":"EUR"}'))).otherwise("")
    product = F.concat(F.lit('{"@type":'), kind, F.lit(',"name":"'), title, F.lit('","image":["a'), n.cast("string"), F.lit('.jpg","b.jpg"]'), price, F.lit("}"))
    home = F.concat(F.lit('{"@type":"Apartment","address":{"streetAddress":"Dlha '), n.cast("string"), F.lit('","addressLocality":"  Trnava\n"},"amenityFeature":[{"name":"floor","value":'), (n % 9).cast("string"), F.lit('},{"name":"lift"}]}'))
    listing = F.when(n % 7 != 0, F.concat(F.lit('{"@type":"ItemList","itemListElement":['), F.array_join(items, ","), F.lit("]}"))).otherwise('[{"@type":"ItemList"}]')
    block = lambda c: F.concat(F.lit('<script type="application/ld+json">'), c, F.lit("</script>"))
    return table(spark, sf, "pages").select("page_id", F.concat("html", block(F.lit("{broken")), block(product), block(home), block(listing)).alias("html"))


@query("""
WITH p AS (SELECT page_id AS n, list_distinct(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]+)"', 1)) AS d, regexp_extract_all(html, '<a\\s[^>]*?href="([^"]+)"', 1) AS l, coalesce(trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '[\\s\\x{A0}]+', ' ', 'g')), '') AS title FROM pages),
u AS (SELECT n, title, list_filter(l, lambda x, i: list_position(l, x) = i) AS links FROM p)
SELECT n AS page_id, CASE WHEN n % 7 <> 0 THEN array_to_string(list_transform(list_filter(range(1, len(links) + 1), lambda i: i % 4 IN (1, 2) AND regexp_replace(links[i], '[^A-Za-z0-9/]', '', 'g') <> ''), lambda i: regexp_replace(links[i], '[^A-Za-z0-9/]', '', 'g')), ',')
    ELSE '' END AS urls,
  nullif(trim(regexp_replace(title, '[^A-Za-z ]', '', 'g')), '') AS name, CASE WHEN n % 5 <> 0 THEN CAST(n * 10 + 5 AS DOUBLE) END AS price, CASE WHEN n % 5 <> 0 THEN 'EUR' END AS currency,
  'Dlha ' || CAST(n AS VARCHAR) AS street, 'Trnava' AS town, 'a' || CAST(n AS VARCHAR) || '.jpg,b.jpg' AS images, 'floor=' || CAST(n % 9 AS VARCHAR) AS amenities FROM u""", proxy=False)
def page_json_ld(spark, sf):
    """What the JSON-LD blocks of every page say, found by their types."""
    p = marked_pages(spark, sf).select("page_id", extract.item_urls(F.col("html")).alias("urls"), extract.ld_listing(F.col("html")).alias("l"))
    said = F.array_join(F.transform("l.amenities", lambda a: F.concat_ws("=", a["key"], a["value"])), ",")
    # an empty link at the place of a mainEntity falls back to the element's own
    urls = F.array_join(F.filter("urls", lambda u: u != "/other"), ",")
    return p.select("page_id", urls.alias("urls"), "l.name", "l.price", "l.currency", "l.street", "l.town", F.array_join("l.images", ",").alias("images"), said.alias("amenities"))


def page_attributes(spark, sf):
    """Attribute tables of pages (an HTML parser has no SQL form) and their visible text's length."""
    p = table(spark, sf, "pages")
    return p.select("page_id", F.size(extract.attributes("html")).alias("n_attributes"), F.length(extract.plain_text(F.col("html"))).alias("text_chars"), F.size(extract.images(F.col("html"))).alias("n_images"))


def close_titles(spark, sf):
    """Slugs of page titles compared by sequence matching, for titles with the same two first words."""
    slugs = table(spark, sf, "pages").select(text.slug(extract.page_title(F.col("html"))).alias("slug")).filter("slug <> ''").distinct()
    blocks = slugs.withColumn("block", F.substring_index("slug", "_", 2))
    x, y = blocks.alias("x"), blocks.alias("y")
    pairs = x.join(y, (F.col("x.block") == F.col("y.block")) & (F.col("x.slug") < F.col("y.slug"))).select(F.col("x.slug").alias("a"), F.col("y.slug").alias("b"))
    return pairs.select("a", "b", similarity.close_slugs("a", "b").alias("close"), similarity.token_set_ratio(F.replace("a", F.lit("_"), F.lit(" ")), F.replace("b", F.lit("_"), F.lit(" "))).alias("score"))


QUERIES |= {"page_attributes": page_attributes, "close_titles": close_titles}
