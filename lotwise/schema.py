"""Table schemas of the listing engine, and the one way to bring a frame to one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


TYPES = {"string": T.StringType(), "long": T.LongType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "array<string>": T.ArrayType(T.StringType())}


def struct(spec: str) -> T.StructType:
    """Schema from 'name type, ...'; needs no session."""
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in (part.split() for part in spec.split(","))])


# Column names and order of the tables.
RAW_COLUMNS = (
    "source transaction property_id link property_name description address_street address_town address_zrea room_number floor_area "
    "building_status year_of_construction year_of_top floor energ_cert price price_area photo_url_1 photo_url_2 photo_url_3"
).split()
RAW_LISTING = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

SILVER = struct(
    "listing_uid string, site string, transaction string, url string, title string, address_street string, city string, region string, rooms long, floor_area_m2 double, "
    "status string, year_built long, top_year long, floor_raw string, energy_cert string, price_eur double, price_psm_eur double, currency string, valid_from string"
)
LATEST = struct(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SILVER) + ", hash string, first_seen string, last_seen string, is_current boolean")
HISTORY = struct(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SILVER) + ", hash string, valid_to string, is_current boolean")

NORMALIZED = struct(
    "row_id long, portal string, portal_listing_key string, source_url string, updated_at string, address_street string, address_town string, address_norm string, "
    "address_ascii string, project_name_norm string, size_m2 double, price double, price_psm double, photo_fingerprints array<string>, lat double, lng double, unit_no string, "
    "rooms int, floor int, floors_total int, elevator boolean, year_of_construction int, year_of_top int, energ_cert string, building_status string, status string, "
    "transaction string, run_date string"
)
GOLDEN = struct(
    "listing_id string, address_town string, address_norm string, address_ascii string, project_name_norm string, unit_no string, size_m2 double, price long, price_psm double, "
    "rooms int, floor int, floors_total int, elevator boolean, year_of_construction int, year_of_top int, energ_cert string, lat double, lng double, updated_at string, status string, "
    "primary_portal string, primary_source_url string, photo_fingerprints array<string>, provenance_json string, field_conflict_flags string, cluster_size long, run_date string"
)
GOLDEN_SOURCES = struct("listing_id string, portal string, portal_listing_key string, source_url string, updated_at string, first_seen_at string, last_seen_at string, run_date string")
GOLDEN_HISTORY = struct("listing_id string, run_date string, photo_changed boolean, price long, status string, price_delta double, status_changed boolean")

#: Texts that CSV files use for a missing value.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order; absent ones are null, others are cast (null where that fails)."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def missing_to_null(df: DataFrame) -> DataFrame:
    """Strings that stand for a missing value become null; NaN becomes null."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(~c.isin(*MISSING), c)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        out.append(c.alias(f.name))
    return df.select(*out)
