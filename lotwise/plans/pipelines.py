"""The two batch pipelines as lazy plans: site table with history, and normalised listings to golden records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotwise.functions import numbers, text
from lotwise.operators import history, resolve, stats
from lotwise.operators.counters import Counters
from lotwise.schema import NORMALIZED, SILVER, conform
from lotwise.sources import tables
from lotwise.sources.history_table import BUCKETS, MARK, HistoryTable


def listing_uid() -> F.Column:
    """The portal's id, else a hash of link, name and address."""
    parts = F.lower(F.btrim(F.concat_ws("|", *[F.coalesce(F.trim(c), F.lit("")) for c in ("link", "property_name", "address_street", "address_town")]), F.lit("|")))
    own = text.blank_to_null(F.col("property_id"))
    spare = F.sha2(F.sha2(F.concat(F.lit("fallback|"), F.coalesce("link", F.lit("")), F.lit("|"), F.coalesce("property_name", F.lit(""))).cast("binary"), 256).cast("binary"), 256)
    return F.coalesce(own, F.when(parts != "", F.sha2(parts.cast("binary"), 256)), spare)


def silver(raw: DataFrame, site: str, date: str) -> DataFrame:
    """Typed listings of a site's raw table, first row of each id."""
    area, price = numbers.positive(numbers.to_float(F.col("floor_area"))), numbers.positive(numbers.to_float(F.col("price")))
    psm = F.coalesce(F.nullif(numbers.to_float(F.col("price_area")), F.lit(0.0)), F.try_divide(price, area))
    d = raw.select(
        listing_uid().alias("listing_uid"), F.lit(site).alias("site"), text.clean(F.col("transaction")).alias("transaction"), text.clean(F.col("link")).alias("url"),
        text.clean(F.col("property_name")).alias("title"), text.clean(F.col("address_street")).alias("address_street"), text.clean(F.col("address_town")).alias("city"),
        text.clean(F.col("address_zrea")).alias("region"), numbers.to_int(F.col("room_number")).alias("rooms"), area.alias("floor_area_m2"), text.clean(F.col("building_status")).alias("status"),
        numbers.to_int(F.col("year_of_construction")).alias("year_built"), numbers.to_int(F.col("year_of_top")).alias("top_year"), text.clean(F.col("floor")).alias("floor_raw"),
        text.clean(F.col("energ_cert")).alias("energy_cert"), price.alias("price_eur"), psm.alias("price_psm_eur"), F.lit("EUR").alias("currency"), F.lit(date).alias("valid_from"), "source_path", "position",
    )
    return conform(history.keep_first(d, ["listing_uid"], ["source_path", "position"]), SILVER)


HASHED = ("transaction", "title", "address_street", "city", "region", "rooms", "floor_area_m2", "status", "year_built", "floor_raw", "energy_cert", "price_eur")


def printed(name: str, number: bool) -> F.Column:
    """A field as the content hash takes it: numbers with six decimals, nulls empty."""
    return F.when(F.col(name).isNotNull(), F.format_string("%.6f", F.col(name)) if number else text.clean(F.col(name).cast("string")))


def site_etl(raw: DataFrame, latest: DataFrame, past: DataFrame, site: str, date: str) -> dict[str, DataFrame]:
    """silver, latest, history and market statistics of a site's batch."""
    s = silver(raw, site, date)
    batch = hashed(s)
    new_latest, new_past = history.upsert(latest, past, batch, date, "listing_uid")
    market = stats.market(new_latest.filter("is_current"), ["city"], "price_eur", "price_psm_eur", "floor_area_m2")
    return {"silver": s, "latest": new_latest, "history": new_past, "market": market}


def hashed(silver_rows: DataFrame) -> DataFrame:
    """Silver rows without their date, with the content hash."""
    number = {f.name for f in SILVER if f.dataType.simpleString() == "double"}
    return silver_rows.drop("valid_from").withColumn("hash", history.content_hash(*[printed(c, c in number) for c in HASHED]))


def run_site_etl(raw: DataFrame, base: str, site: str, date: str, buckets: int = BUCKETS) -> dict[str, int]:
    """Brings a site's batch of a day into the tables under base: silver by site and date, latest and history, market statistics by day.

    Returns the run's counts: rows_in_csv, rows_silver, upserts, new_history_rows and closed_history_rows. They come out of
    the plans that write the tables; no job counts rows. A date that is done already isn't done again.
    """
    spark, counters = raw.sparkSession, Counters()
    table = HistoryTable(spark, f"{base}/gold/{site}", "listing_uid", buckets)
    where = f"{base}/silver/site={site}/date={date}"
    if not tables.exists(spark, f"{base}/gold/{site}/step={date}/{MARK}"):
        rows = silver(counters.of(raw, rows_in_csv=None), site, date)
        tables.write_table(counters.of(rows, rows_silver=None), where, SILVER)
    counts = table.apply(date, hashed(tables.read_or_empty(spark, where, SILVER)), date, counters)
    market = stats.market(table.latest(), ["city"], "price_eur", "price_psm_eur", "floor_area_m2")
    tables.write_table(market.withColumn("date", F.lit(date)), f"{base}/exports/market/site={site}/day={date}")
    return counts


def normalized(raw: DataFrame, date: str, min_price: float = numbers.MIN_PRICE) -> DataFrame:
    """Raw listings with clean fields and a row number by file and position."""
    street, town = text.street(F.col("address_street")), text.town(F.col("address_town"))
    floor = numbers.floor_parts(F.col("floor"))
    size = numbers.within(numbers.decimal(F.col("floor_area")), *numbers.SIZE_RANGE)
    price = numbers.clamp_price(numbers.digits(F.col("price")).cast("double"), min_price)
    year = lambda c: numbers.within(numbers.digits(F.col(c)), *numbers.YEAR_RANGE)
    at = F.row_number().over(W.partitionBy("source_path").orderBy("position"))
    base = raw.withColumn("__at", at)
    before = base.groupBy("source_path").agg(F.count("*").alias("__n")).withColumn("__before", F.sum("__n").over(W.orderBy("source_path")) - F.col("__n")).drop("__n")  # one row a file
    d = base.join(before, "source_path")
    address, building = text.join_address(text.fold(street), text.fold(town)), text.building_status(F.col("building_status"))
    degrees = lambda c: F.nullif(F.expr(f"try_cast(replace({c}, ',', '.') AS double)"), F.lit(float("nan"))) if c in raw.columns else F.lit(None).cast("double")
    return conform(
        d.select(
            (F.col("__before") + F.col("__at") - 1).alias("row_id"), F.lower(F.trim(F.coalesce("source", F.lit("")))).alias("portal"), text.blank_to_null(F.col("property_id")).alias("portal_listing_key"), F.col("link").alias("source_url"),
            F.lit(date).alias("updated_at"), street.alias("address_street"), town.alias("address_town"), address.alias("address_norm"), text.fold(street).alias("address_ascii"), size.alias("size_m2"), price.alias("price"),
            F.try_divide(price, size).alias("price_psm"), text.photo_tokens(F.col("photo_url_1"), F.col("photo_url_2"), F.col("photo_url_3")).alias("photo_fingerprints"),
            F.coalesce(numbers.digits(F.col("room_number")).cast("int"), numbers.rooms_of_title(F.col("property_name"))).alias("rooms"), floor["floor"].alias("floor"), floor["total"].alias("floors_total"), floor["elevator"].alias("elevator"),
            year("year_of_construction").alias("year_of_construction"), year("year_of_top").alias("year_of_top"), text.energy_class(F.col("energ_cert")).alias("energ_cert"), building.alias("building_status"), (text.blank_to_null(F.col("status")) if "status" in raw.columns else building).alias("status"),
            text.transaction(F.col("transaction")).alias("transaction"), F.lit(date).alias("run_date"), degrees("lat").alias("lat"), degrees("lng").alias("lng"),
        ),
        NORMALIZED,
    )


def resolved(rows: DataFrame, priority: list[str], previous: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(golden records, rows with cluster_id) of normalised listings."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(p) for p in priority]), F.col("portal")) - 1, F.lit(-1).cast("long")), F.lit(len(priority)).cast("long"))
    d = rows.select(
        "row_id", "portal", rank.cast("int").alias("portal_rank"), F.col("portal_listing_key").alias("listing_key"), F.col("source_url").alias("url"), F.col("address_town").alias("town"), F.col("address_street").alias("street"),
        F.nullif("address_norm", F.lit("")).alias("address"), F.nullif(F.lower("address_ascii"), F.lit("")).alias("address_ascii"), F.nullif(F.lower(F.trim("project_name_norm")), F.lit("")).alias("project"), F.col("size_m2").alias("size"), "price", "rooms", "floor", "floors_total", "elevator", F.col("energ_cert").alias("cert"), F.col("year_of_construction").alias("year_built"),
        "lat", "lng", "updated_at", "status", F.col("photo_fingerprints").alias("photos"), "transaction", "unit_no", F.col("year_of_top").alias("year_top"),
    )
    marked = resolve.labelled_by(d)
    return resolve.golden(marked), marked
