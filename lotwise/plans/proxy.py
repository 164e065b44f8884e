"""A listing table derived from the order tables, as one SQL text for Spark and DuckDB.

Every line item is a listing as one portal shows it. Its key is the order line, which several portals
may share; its photo is named by part and supplier; its address by nation and part. Missing values come
from moduli, so that null paths run. row_id is a text key in a total order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "labels", "conversations")

LISTINGS = """
SELECT
  lpad(CAST(l_orderkey AS STRING), 12, '0') || '-' || CAST(l_linenumber AS STRING) || '-' || lpad(CAST(l_partkey AS STRING), 10, '0') || '-'
    || lpad(CAST(l_suppkey AS STRING), 8, '0') || '-' || lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING), 12, '0') || '-' || CAST(CAST(l_shipdate AS DATE) AS STRING) AS row_id,
  CASE l_suppkey % 3 WHEN 0 THEN 'portal_a' WHEN 1 THEN 'portal_b' ELSE 'portal_c' END AS portal,
  CAST(l_suppkey % 3 AS INT) AS portal_rank,
  'K' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS listing_key,
  'https://' || CAST(l_suppkey % 3 AS STRING) || '.example.com/detail/' || CAST(l_orderkey AS STRING) || '/' || CAST(l_partkey AS STRING) AS url,
  n_name AS town, r_name AS region,
  CASE WHEN l_partkey % 19 <> 0 THEN 'Ulica ' || p_name || ' ' || CAST(l_partkey AS STRING) END AS street,
  CASE WHEN l_partkey % 17 <> 0 THEN l_quantity + 20 + CAST(l_partkey % 10 AS DOUBLE) / 10 END AS size,
  CASE WHEN l_suppkey % 13 <> 0 THEN l_extendedprice END AS price,
  CASE WHEN l_orderkey % 11 <> 0 THEN CAST(p_size % 5 + 1 AS INT) END AS rooms,
  CASE WHEN l_orderkey % 7 <> 0 THEN CAST(l_linenumber AS INT) END AS floor,
  CASE WHEN l_suppkey % 5 <> 0 THEN CAST(l_linenumber + l_suppkey % 3 AS INT) END AS floors_total,
  CASE l_suppkey % 4 WHEN 0 THEN true WHEN 1 THEN false END AS elevator,
  CASE WHEN l_partkey % 8 < 7 THEN substring('ABCDEFG', CAST(l_partkey % 8 + 1 AS INT), 1) END AS cert,
  CASE WHEN l_orderkey % 5 <> 0 THEN CAST(year(l_shipdate) AS INT) END AS year_built,
  48 + CAST(l_partkey % 1000 AS DOUBLE) * CAST(0.0004 AS DOUBLE) AS lat,
  17 + CAST(l_suppkey % 50 AS DOUBLE) * CAST(0.0004 AS DOUBLE) AS lng,
  CAST(CAST(l_shipdate AS DATE) AS STRING) AS updated_at,
  CASE WHEN l_suppkey % 9 <> 0 THEN l_linestatus END AS status,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'prenajom' ELSE 'predaj' END AS transaction,
  'p' || CAST(l_partkey AS STRING) || 's' || CAST(l_suppkey AS STRING) AS photo,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS first_seen,
  l_quantity AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
"""


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("lineitem", "orders", "customer", "nation", "region", "part")
    frames = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}
    text = LISTINGS
    for n in names:
        text = text.replace(f"FROM {n} ", f"FROM {{{n}}} ").replace(f"JOIN {n} ", f"JOIN {{{n}}} ")
    return spark.sql(text, **frames)


def oracle(body: str, recursive: bool = False) -> str:
    """SQL over `listings`: a SELECT, or further tables of the WITH clause (after a comma) and a SELECT."""
    return f"WITH {'RECURSIVE ' if recursive else ''}listings AS ({LISTINGS}){body}"
