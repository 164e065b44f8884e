"""Run counters, the bucketed history table, and JSON-LD blocks as data."""

import random

import pytest
from pyspark.sql import functions as F

from lotwise.operators import enrich, extract, history
from lotwise.operators.counters import Counters, StreamCounters, streaming_counts
from lotwise.plans import pipelines
from lotwise.schema import HISTORY, LATEST, RAW_LISTING
from lotwise.sources import tables
from lotwise.sources.history_table import MARK, HistoryTable, steps
from lotwise.streaming import upserts

ROW = "uid string, v string, hash string"


def files(path):
    return {p: p.stat().st_size for p in path.rglob("*.parquet") if p.is_file()}


def day_of(spark, data):
    return spark.createDataFrame([(k, v, f"h{v}") for k, v in sorted(data.items())], ROW)


@pytest.mark.parametrize("seed", range(2))
def test_steps_are_the_full_upsert(spark, tmp_path, seed):
    rng = random.Random(seed)
    table = HistoryTable(spark, str(tmp_path), "uid", buckets=5)
    none = F.lit(None).cast("string")
    empty = spark.createDataFrame([], ROW)
    latest, past = empty.withColumns({"first_seen": none, "last_seen": none, "valid_from": none, "is_current": F.lit(True)}), empty.withColumns({"valid_from": none, "valid_to": none, "is_current": F.lit(True)})
    for day in ("d1", "d2", "d3", "d4"):
        rows = day_of(spark, {f"k{rng.randrange(30)}": str(rng.randrange(3)) for _ in range(rng.randrange(25))})
        known, opened = {r.uid: r.hash for r in latest.collect()}, past.count()
        latest, past = (spark.createDataFrame(x.collect(), x.schema) for x in history.upsert(latest, past, rows, day))
        counts = table.apply(day, rows, day)
        changed = sum(known.get(r.uid) != r.hash for r in rows.collect())
        assert counts == {"upserts": changed, "new_history_rows": changed, "closed_history_rows": changed - sum(r.uid not in known for r in rows.collect())}
        assert past.count() - opened == changed
        for got, want in ((table.latest(), latest), (table.history(), past)):
            assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert [r.step for r in table.counters().orderBy("step").collect()] == ["d1", "d2", "d3", "d4"]


def test_a_step_writes_what_it_touches(spark, tmp_path):
    """Few keys touch few buckets; history is appended; a replay, also after a crash, changes nothing."""
    table = HistoryTable(spark, str(tmp_path), "uid", buckets=64)
    first = spark.range(20_000).select(F.col("id").cast("string").alias("uid"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("hash"))
    table.apply("1", first, "d1")
    all_ = sum(files(tmp_path / "step=1" / "latest").values())
    few = first.filter("uid IN ('5', '77', '19999')").withColumn("hash", F.lit("new"))
    table.apply("2", few, "d2")
    touched = {p.parent.name for p in files(tmp_path / "step=2" / "latest")}
    assert 1 <= len(touched) <= 3 and sum(files(tmp_path / "step=2").values()) < 0.1 * all_ + 20_000
    assert spark.read.parquet(str(tmp_path / "step=2" / "history")).count() == 3
    assert table.latest().count() == 20_000 and table.history().count() == 20_003
    before = files(tmp_path)
    assert table.apply("2", few, "d2")["upserts"] == 3 and files(tmp_path) == before
    (tmp_path / "step=2" / MARK).unlink()  # a crash before the mark
    tables.remove(spark, str(tmp_path / "step=2" / "latest"))
    assert [s.rsplit("/", 1)[1] for s in steps(spark, str(tmp_path))] == ["step=1"] and table.latest().filter("hash = 'new'").isEmpty()
    table.apply("2", few, "d2")
    assert table.latest().filter("hash = 'new'").count() == 3 and table.history().count() == 20_003
    # rows of buckets that the last two steps don't refer to go
    table.apply("3", few.withColumn("hash", F.lit("newer")), "d3")
    assert {p.parent.name for p in files(tmp_path / "step=1" / "latest")}.isdisjoint(touched) and table.latest().count() == 20_000 and table.history().count() == 20_006


RAW = [("1", "byt", "trnava", "189000", "60"), ("2", "dom", "senec", "250000", "100"), ("2", "dom", "senec", "260000", "100"), ("3", "byt", "trnava", None, "30")]


def raw_of(spark, rows):
    df = spark.createDataFrame(rows, "property_id string, property_name string, address_town string, price string, floor_area string")
    for c in RAW_LISTING.fieldNames():
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df.select(*RAW_LISTING.fieldNames(), F.lit("f").alias("source_path"), F.monotonically_increasing_id().alias("position"))


def test_etl_run_counts_without_jobs_of_its_own(spark, tmp_path):
    base = str(tmp_path)
    raw = raw_of(spark, RAW)
    assert pipelines.run_site_etl(raw, base, "s", "2025-11-01", 4) == {"rows_in_csv": 4, "rows_silver": 3, "upserts": 3, "new_history_rows": 3, "closed_history_rows": 0}
    later = raw_of(spark, [("1", "byt", "trnava", "189000", "60"), ("2", "dom", "senec", "240000", "100"), ("9", "garaz", None, "9000", None)])
    want = {"rows_in_csv": 3, "rows_silver": 3, "upserts": 2, "new_history_rows": 2, "closed_history_rows": 1}
    assert pipelines.run_site_etl(later, base, "s", "2025-11-02", 4) == want
    assert pipelines.run_site_etl(later, base, "s", "2025-11-02", 4) == want  # done already
    table = HistoryTable(spark, f"{base}/gold/s", "listing_uid")
    out = pipelines.site_etl(raw, spark.createDataFrame([], LATEST), spark.createDataFrame([], HISTORY), "s", "2025-11-01")
    full = pipelines.site_etl(later, out["latest"], out["history"], "s", "2025-11-02")
    for got, name in ((table.latest(), "latest"), (table.history(), "history")):
        columns = sorted(set(got.columns) & set(full[name].columns))
        assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, full[name].select(*columns).collect()))
    market = spark.read.parquet(f"{base}/exports/market/site=s/day=2025-11-02").collect()
    assert {r.city: r.listings for r in market} == {"trnava": 2, "senec": 1, "unknown": 1}


def test_counts_stand_in_the_plan(spark, tmp_path):
    context, df = spark.sparkContext, spark.range(100)
    jobs = []
    for k in range(2):
        context.setJobGroup(f"counted-{k}", "")
        counters = Counters()
        rows = counters.of(counters.of(df, all=None).filter("id % 3 = 0"), third=None, even=F.col("id") % 2 == 0) if k else df.filter("id % 3 = 0")
        rows.write.mode("overwrite").parquet(str(tmp_path / "t"))
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"counted-{k}")))
        if k:
            assert counters.read() == {"all": 100, "third": 34, "even": 17}
    context.setJobGroup("", "")
    assert jobs[0] == jobs[1]


def test_counts_of_coordinates_and_caches(spark):
    rows = [("a", "x", 1.0, 2.0), ("b", "y", None, None), ("c", "y", None, 1.0), (None, None, None, None)]
    df = spark.createDataFrame(rows, "street string, town string, lat double, lng double")
    filled = enrich.fill_coordinates(df, spark.createDataFrame([("b|y|slovakia", 3.0, 4.0)], "key string, lat double, lng double"))
    counters = Counters()
    counters.of(filled, **enrich.coordinate_counts()).collect()
    assert counters.read() == {"total": 4, "with_coords": 2, "missing_coords": 2, "cache_hits": 1, "geocoded_now": 0, "failures": 2}
    counters = Counters()
    counters.of(spark.createDataFrame([("a",), (None,)], "v string"), **enrich.cache_counts("v")).collect()
    assert counters.read() == {"cache_hits": 1, "cache_misses": 1}


def test_counts_of_streams(spark, tmp_path):
    base = str(tmp_path)
    spark.createDataFrame([("a", "1", "d1"), ("b", "1", "d1"), ("a", "1", "d1"), ("a", "2", "d2")], "uid string, v string, day string").coalesce(1).write.parquet(f"{base}/in")
    stream = spark.readStream.schema("uid string, v string, day string").parquet(f"{base}/in")
    heard = StreamCounters()
    spark.streams.addListener(heard)
    streaming_counts(stream, "seen", rows=None, ones=F.col("v") == "1").writeStream.format("parquet").option("path", f"{base}/copy").option("checkpointLocation", f"{base}/c").trigger(availableNow=True).start().awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    for _ in range(50):
        if heard.total("seen"):
            break
        __import__("time").sleep(0.1)
    spark.streams.removeListener(heard)
    assert heard.total("seen") == {"rows": 4, "ones": 3}
    upserts.upsert_batches(stream, f"{base}/out", f"{base}/check", ["v"], buckets=3).awaitTermination()
    got = [tuple(r)[1:] for r in HistoryTable(spark, f"{base}/out", "uid").counters().orderBy("step").select("step", "rows_in", "rows", "upserts", "closed_history_rows").collect()]
    assert got == [(3, 2, 2, 0), (1, 1, 1, 1)]


def test_json_ld_blocks(spark):
    ld = lambda body: f'<script data-x="1" type="application/ld+json">{body}</script>'
    pages = [
        None,
        "",
        ld("{broken"),
        ld('{"@type":["x","ItemList"],"itemListElement":[{"mainEntity":{"url":"/a"},"url":"/no"},{"url":"/b"},"text",{"mainEntity":"text","url":"/c"},{"url":""},{}]}') + ld('{"@type":"ItemList","itemListElement":[{"url":"/second"}]}'),
        ld('[{"@type":"ItemList","itemListElement":[{"url":"/in-a-list"}]}]') + ld('{"@type":"itemlist"}'),
        ld('{"@type":"Product","name":" Byt\n 3 ","image":"one.jpg","offers":{"price":"189000.5"},"amenityFeature":[{"name":"lift","value":true},{"name":"x"}]}') + ld('{"@type":"Residence","address":{"streetAddress":"Dlha 5"}}'),
        ld('{"@type":7,"name":"odd"}') + "<script>{}</script>",
    ]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    rows = {r.i: r for r in df.select("i", extract.item_urls(F.col("html")).alias("urls"), extract.ld_listing(F.col("html")).alias("l"), F.size(extract.ld_blocks(F.col("html"))).alias("n")).collect()}
    assert [rows[i].n for i in range(7)] == [0, 0, 0, 2, 2, 2, 1]
    assert [rows[i].urls for i in range(5)] == [[], [], [], ["/a", "/b", "/c"], []]
    own = rows[5].l
    assert (own.name, own.price, own.currency, own.street, own.town, own.images) == ("Byt  3", 189000.5, None, "Dlha 5", None, ["one.jpg"])
    assert [(a.key, a.value) for a in own.amenities] == [("lift", "true")]
    assert rows[6].l.name is None and rows[0].l.images == [] and rows[0].l.amenities == []
