"""Sources, sinks, the batch pipelines, the stream, and every query against its SQL."""

import json

import duckdb
import pytest
from pyspark.sql import functions as F

from lotwise.plans import catalog, pipelines
from lotwise.schema import HISTORY, LATEST, RAW_COLUMNS, SILVER, conform
from lotwise.sources import tables
from lotwise.streaming import upserts

NAMES = "region nation customer supplier part orders lineitem events documents pages labels".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for n in NAMES:
        con.sql(f"CREATE VIEW {n} AS SELECT * FROM '{sf}/{n}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_is_its_sql(spark, sf, duck, name):
    df = catalog.QUERIES[name](spark, sf)
    want = duck.sql(catalog.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)


RAW = '''{}
portal_a,predaj,1,https://x/1,"2-izbový byt ""A""","first
second",Ulica Dlhá 5,trnava,"okres Trnava, Trnavský kraj",2,"68,5",Novostavba,1990,2001,3/3 + výťah,B,189 000,,https://h/foto/a=/tok1_fss?x,,
portal_b,predaj,1,https://y/1,byt,NA,Dlhá 5,Trnava,null,,68,iné,1700,,2,nie je,195000,0,https://h/foto/a=/tok1_fss,,
Portal_C ,,,https://z/9,3 izb. byt,,,slovensko,,,,,,,,,0,,,,
'''.format(",".join(RAW_COLUMNS))


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("raw")
    (path / "a.csv").write_text(RAW, encoding="utf-8")
    return tables.raw_csv(spark, str(path / "a.csv"))


def test_raw_records(spark, raw, tmp_path):
    rows = raw.orderBy("position").collect()
    assert len(rows) == 3 and rows[0].description == "first\nsecond" and rows[0].property_name == '2-izbový byt "A"'
    assert rows[1].description is None and rows[1].address_zrea is None and rows[2].property_id is None
    tables.csv_report(raw.drop("source_path", "position"), str(tmp_path / "r.csv"))
    assert tables.union_csv(spark, [str(tmp_path / "r.csv"), str(tmp_path / "absent.csv")]).count() == 3


def test_site_etl(spark, raw):
    latest, past = spark.createDataFrame([], LATEST), spark.createDataFrame([], HISTORY)
    out = pipelines.site_etl(raw, latest, past, "site", "2025-11-01")
    assert out["silver"].schema.names == SILVER.names
    rows = {r.listing_uid: r for r in out["silver"].collect()}
    assert len(rows) == 2 and rows["1"].floor_area_m2 == 68.5 and rows["1"].rooms == 2 and rows["1"].price_eur == 189000.0
    again = pipelines.site_etl(raw, conform(out["latest"], LATEST), conform(out["history"], HISTORY), "site", "2025-11-02")
    assert again["history"].count() == 2 and {r.last_seen for r in again["latest"].collect()} == {"2025-11-02"}
    assert out["market"].filter("city = 'trnava'").first().listings == 1


def test_normalized_to_golden(spark, raw):
    rows = pipelines.normalized(raw, "2025-11-01")
    n = {r.row_id: r for r in rows.collect()}
    assert {r.portal for r in n.values()} == {"portal_a", "portal_b", "portal_c"} and n[0].address_ascii == "dlha 5" and n[0].status == n[0].building_status == "new"
    assert sorted(n) == [0, 1, 2] and n[0].address_norm == "dlha 5, trnava" and n[0].floors_total == 3 and n[0].elevator and n[1].year_of_construction is None and n[2].rooms == 3 and n[2].price is None
    gold, marked = pipelines.resolved(rows, ["portal_a", "portal_b"])
    assert sorted(r.cluster_size for r in gold.collect()) == [1, 2] and marked.count() == 3


def test_places_of_raw_listings(spark, raw):
    """Texts with a comma or a point become degrees, so that rows at one place are merged."""
    placed = raw.withColumns({"lat": F.when(F.col("position") >= 0, "48,3771"), "lng": F.lit("17.5883")})
    rows = pipelines.normalized(placed, "2025-11-01")
    assert {(r.lat, r.lng) for r in rows.collect()} == {(48.3771, 17.5883)}
    odd = pipelines.normalized(raw.withColumns({"lat": F.lit("x"), "lng": F.lit("nan")}), "2025-11-01")
    assert {(r.lat, r.lng) for r in odd.collect()} == {(None, None)}


def test_runs_and_partitions(spark, tmp_path):
    base = str(tmp_path)
    df = spark.createDataFrame([(1, "2025-11-01"), (2, "2025-11-02")], "v int, run_date string")
    tables.replace_partition(df, f"{base}/t")
    tables.replace_partition(spark.createDataFrame([(9, "2025-11-02")], "v int, run_date string"), f"{base}/t")
    assert sorted((r.v, str(r.run_date)) for r in spark.read.parquet(f"{base}/t").collect()) == [(1, "2025-11-01"), (9, "2025-11-02")]
    for d in ("2025-11-01", "2025-11-03"):
        tables.publish(df, f"{base}/runs", d, "gold")
    assert {r.run_date: r.previous for r in tables.runs(spark, f"{base}/runs").collect()} == {"2025-11-01": None, "2025-11-03": "2025-11-01"}
    assert tables.resolve_run(spark, f"{base}/runs").endswith("latest") and tables.resolve_run(spark, f"{base}/runs", "2025-11-01").endswith("run=2025-11-01")
    assert tables.resolve_run(spark, f"{base}/runs", "2024-01-01").endswith("latest")  # no such run
    tables.remove(spark, f"{base}/runs/latest")
    assert tables.resolve_run(spark, f"{base}/runs", "2024-01-01").endswith("run=2025-11-03") and tables.resolve_run(spark, f"{base}/absent") is None
    tables.publish(df, f"{base}/runs", "2025-11-03", "gold")
    assert tables.read_or_empty(spark, f"{base}/nothing", LATEST).count() == 0
    tables.swap(spark.read.parquet(f"{base}/runs/latest/gold").withColumn("w", F.lit(1)), f"{base}/runs/latest/gold")
    assert spark.read.parquet(f"{base}/runs/latest/gold").columns == ["v", "run_date", "w"]
    (tmp_path / "c.json").write_text(json.dumps({"a": 1.5, "b": 2}))
    assert {r.key: r.value for r in tables.json_cache(spark, f"{base}/c.json", "double").collect()} == {"a": 1.5, "b": 2.0}
    (tmp_path / "broken.json").write_text("{")
    assert tables.json_cache(spark, f"{base}/broken.json").count() == 0


def test_upserts_from_a_stream(spark, tmp_path):
    base = str(tmp_path)
    rows = [("a", "1", "d1"), ("b", "1", "d1"), ("a", "2", "d2")]
    spark.createDataFrame(rows, "uid string, v string, day string").coalesce(1).write.parquet(f"{base}/in")
    stream = spark.readStream.schema("uid string, v string, day string").parquet(f"{base}/in")
    upserts.upsert_batches(stream, f"{base}/out", f"{base}/check", ["v"]).awaitTermination()
    state = lambda: sorted(tuple(r) for t in ("latest", "history") for r in upserts.current(spark, f"{base}/out", t).select("uid", "v", "hash", "valid_from").collect())
    assert {r.uid: (r.v, r.first_seen, r.last_seen) for r in upserts.current(spark, f"{base}/out", "latest").collect()} == {"a": ("2", "d1", "d2"), "b": ("1", "d1", "d1")}
    assert upserts.current(spark, f"{base}/out", "history").count() == 3
    # a crash after the tables of the second day were written, before its mark: the replay does that day again
    before = state()
    last = upserts.steps(spark, f"{base}/out")[-1]
    tables.remove(spark, f"{last}/{upserts.MARK}")
    tables.remove(spark, f"{last}/history")
    upserts.upsert_batches(stream, f"{base}/out", f"{base}/check-again", ["v"]).awaitTermination()
    assert state() == before and upserts.current(spark, f"{base}/out", "history").count() == 3


def test_an_interrupted_swap_loses_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    (tmp_path / "t").rename(tmp_path / "t.old")  # a crash between the two renames
    tables.recovered(spark, path)
    assert spark.read.parquet(path).count() == 3
    tables.swap(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5 and not (tmp_path / "t.old").exists()


def test_files_by_pattern(spark, tmp_path):
    (tmp_path / "a1.csv").write_text("x,y\n1,2\n")
    (tmp_path / "a2.csv").write_text("y,z\n3,NA\n")
    (tmp_path / "b.csv").write_text("q\n9\n")
    got = tables.union_csv(spark, [str(tmp_path / "a*.csv"), str(tmp_path / "a1.csv"), str(tmp_path / "none*.csv")])
    assert sorted((tuple(r) for r in got.collect()), key=str) == [("1", "2", None), (None, "3", None)] or sorted((r.x, r.y, r.z) for r in got.fillna("").collect()) == [("", "3", ""), ("1", "2", "")]


def test_sightings(spark, sf):
    out = upserts.sightings(spark.read.parquet(f"{sf}/events.parquet"), "user_id", "ts")
    assert out.agg(F.sum("events")).first()[0] == spark.read.parquet(f"{sf}/events.parquet").count()
