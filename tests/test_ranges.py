"""Exact medians and neighbours of large groups, and pair scores of large blocks, without a task that holds them."""

import itertools
import random
from math import asin, cos, radians, sin, sqrt
from statistics import median

import pytest
from pyspark.sql import functions as F
from test_resolution import ROW, closure, listing, near

from lotwise.operators import edges, ranges, resolve, stats
from lotwise.operators.components import components, extended
from lotwise.sources.cache import Cache


@pytest.fixture
def apart(spark):
    """Small ranges stay apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_medians_of_one_large_group(spark, apart):
    """Two million distinct values in one group, and some small groups."""
    n = 2_000_001
    big = spark.range(n).select(F.lit("big").alias("town"), (F.col("id") * 7919 % n).cast("double").alias("price"))
    few = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("b", 5.0), ("c", None), (" ", 2.0), (None, 9.0)], "town string, price double")
    df = big.unionByName(few).withColumns({"psm": F.col("price") * 2, "size": F.lit(1.0)})
    counts = stats.tallied(df.filter("town = 'big'"), ["town"], ["price"])
    share = [r["count"] for r in counts.groupBy("part").count().collect()]
    assert len(share) == 4 and max(share) < 0.4 * n
    got = {r.town: r for r in stats.market(df, ["town"]).collect()}
    assert (got["big"].listings, got["big"].median_price, got["big"].median_psm, got["big"].avg_price) == (n, (n - 1) / 2, n - 1, (n - 1) / 2)
    assert (got["a"].median_price, got["b"].median_price, got["c"].median_price, got["c"].listings, got["unknown"].median_price) == (2.5, 5.0, None, 1, 2.0) and None not in got
    summary = {r.town: r for r in stats.price_summary(df, "town").collect()}
    assert (summary["big"].median_price, summary["big"].min_price, summary["big"].max_price, summary[None].median_price) == ((n - 1) / 2, 0.0, n - 1, 9.0) and "c" not in summary


@pytest.mark.parametrize("seed", range(2))
def test_medians_with_repeats_and_nulls(spark, apart, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None]), float(rng.randrange(9)), rng.randrange(1, 5)) for _ in range(60)]
    df = spark.createDataFrame(rows, "k string, value double, n long").groupBy("k", "value").agg(F.sum("n").alias("n"))
    got = {r.k: r.median for r in ranges.medians(ranges.placed(df, ["k"], "value"), ["k"]).collect()}
    each = {}
    for k, v, n in rows:
        each.setdefault(k, []).extend([v] * n)
    assert got == {k: median(v) for k, v in each.items()}


def test_market_of_nothing(spark):
    none = spark.createDataFrame([], "town string, price double, psm double, size double")
    assert stats.market(none, ["town"]).collect() == [] and stats.price_summary(none, "town").collect() == []
    assert [tuple(r) for r in stats.market(none, []).collect()] == [(0, None, None, None, None, None)]


def test_neighbours_across_ranges(spark, apart):
    rng = random.Random(1)
    rows = [(k, float(v), f"{k}{v}") for k in ("a", "b", None) for v in rng.sample(range(5000), 400 if k == "a" else 3)]
    got = [tuple(r) for r in ranges.neighbours(spark.createDataFrame(rows, "k string, v double, id string"), ["k"], "v", "id").collect()]
    want = []
    for k in ("a", "b", None):
        own = sorted((v, i) for g, v, i in rows if g == k)
        want += [(k, s, t, a, b) for (s, a), (t, b) in itertools.pairwise(own)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_bands_of_a_key_with_half_the_rows(spark, apart):
    rng = random.Random(2)
    data = [listing(i, address="hot" if i % 2 else f"x{i % 9}", size=round(rng.uniform(20, 400), 1)) for i in range(300)]
    df = spark.createDataFrame(data, ROW)
    rows = df.collect()
    out = {r.row_id: r.cluster_id for r in resolve.label(df, edges.band_edges(df, ["address", "town"])).collect()}
    links = [(a.row_id, b.row_id) for a, b in itertools.combinations(rows, 2) if a.address == b.address and near(a.size, b.size) and abs(round(a.size) - round(b.size)) <= 2]
    assert out == closure([r.row_id for r in rows], links)


def metres(a, b):
    h = sin(radians(b.lat - a.lat) / 2) ** 2 + cos(radians(a.lat)) * cos(radians(b.lat)) * sin(radians(b.lng - a.lng) / 2) ** 2
    return 2 * 6_371_000 * asin(sqrt(h))


@pytest.mark.parametrize("north", [0.0, 48.1, -67.9])
def test_places_on_a_fine_grid(spark, north):
    """Continuous places: components are those of all pairs, at several latitudes."""
    rng = random.Random(int(north))
    data = [listing(i, town=rng.choice(["T", "T", "U"]), lat=north + rng.uniform(-0.003, 0.003), lng=17 + rng.uniform(-0.004, 0.004), size=round(rng.choice([50.0, 51.0, 53.0]) + rng.random(), 1)) for i in range(250)]
    df = spark.createDataFrame(data, ROW)
    rows = df.collect()
    links = [(a.row_id, b.row_id) for a, b in itertools.combinations(rows, 2) if a.town == b.town and near(a.size, b.size) and metres(a, b) <= 60]
    out = {r.row_id: r.cluster_id for r in resolve.label(df, edges.geo_edges(df)).collect()}
    assert out == closure([r.row_id for r in rows], links) and 20 < len(set(out.values())) < 230


def test_a_dense_place_has_few_pairs(spark):
    """5,000 places within some 20 m: rows of a cell are stars, so pairs are a small share of all 12 million."""
    df = spark.range(5000).select(
        F.concat(F.lit("r"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("row_id"), F.lit("T").alias("town"), (F.lit(48.1) + F.rand(1) * 0.0001).alias("lat"), (F.lit(17.1) + F.rand(2) * 0.0001).alias("lng"), (F.lit(20.0) + F.floor(F.rand(3) * 3800) / 10).alias("size"))
    found = edges.geo_edges(df)
    assert found.count() < 0.05 * 5000 * 4999 / 2
    small = df.filter("row_id < 'r00150'")
    rows = small.collect()
    links = [(a.row_id, b.row_id) for a, b in itertools.combinations(rows, 2) if near(a.size, b.size) and metres(a, b) <= 60]
    assert {r.row_id: r.cluster_id for r in resolve.label(small, edges.geo_edges(small)).collect()} == closure([r.row_id for r in rows], links)


def test_components_over_days_are_those_of_all_links(spark):
    """Three days of links, each day on top of the labels so far; only links between components are followed."""
    rng = random.Random(3)
    nodes = [f"n{i:03d}" for i in range(120)]
    links, labels = [], None
    for _ in range(3):
        new = [tuple(rng.sample(nodes, 2)) for _ in range(28)]
        links += new
        df = spark.createDataFrame(new, "a string, b string")
        labels = components(df) if labels is None else extended(labels, df)
        labels = spark.createDataFrame(labels.collect(), labels.schema)
        want = closure(nodes, links)
        got = {r.node: r.label for r in labels.collect()}
        assert len(got) == labels.count() and all(got.get(n, n) == want[n] for n in nodes)
    again = extended(labels, spark.createDataFrame(links, "a string, b string"))
    assert {r.node: r.label for r in again.collect()} == got


def test_caches_fill_merge_and_reread(spark, tmp_path):
    cache = Cache(spark, str(tmp_path / "cache"), buckets=3)
    assert cache.rows().collect() == []
    (tmp_path / "old.json").write_text('{"a": "1", "b": 2}')
    assert cache.import_json(str(tmp_path / "old.json"))["upserts"] == 2
    assert cache.import_json(str(tmp_path / "old.json"))["upserts"] == 0
    assert cache.merge(spark.createDataFrame([("b", "3"), ("b", "2"), (None, "x"), ("c", None)], "key string, value string"))["closed_history_rows"] == 1

    def fetch(batches):
        for b in batches:
            yield b.assign(value=b["text"].str.upper())[["key", "value"]]

    wanted = spark.createDataFrame([("a", "a"), ("d", "d"), ("d", "d"), ("e", "e"), (None, "n")], "key string, text string")
    assert {r.key: r.value for r in cache.fill(wanted, fetch, most=1).collect()} == {"a": "1", "b": "3", "d": "D"}
    assert {r.key: r.value for r in cache.fill(wanted, fetch).collect()} == {"a": "1", "b": "3", "d": "D", "e": "E"}
    assert {r.key: r.value for r in Cache(spark, str(tmp_path / "cache")).rows().collect()} == {"a": "1", "b": "3", "d": "D", "e": "E"}


def points(a, b):
    size = 3 if near(a.size, b.size, 0.02) else 2 if near(a.size, b.size) else 0
    return 8 * (a.listing_key == b.listing_key) + 4 * (a.address is not None and a.address == b.address) + size + 4 * bool(set(a.photos) & set(b.photos)) + bool(near(a.price, b.price, 0.05))


@pytest.mark.parametrize("least", [7, 8, 4])
def test_scores_of_a_block_with_half_the_rows(spark, least):
    rng = random.Random(least)
    data = [
        listing(i, listing_key=f"k{rng.randrange(100)}", address=rng.choice(["hot", "hot", f"x{i % 7}", None]), size=rng.choice([None, 0.0, round(rng.uniform(50, 60), 1)]), price=rng.choice([None, 100.0, 103.0, 150.0]), photos=rng.choice([[], ["hot"], [f"p{i % 5}", "q"]]))
        for i in range(160)
    ]
    df = spark.createDataFrame(data, ROW)
    rows = df.collect()
    blocked = lambda a, b: a.listing_key == b.listing_key or (a.address is not None and a.address == b.address and a.size is not None and b.size is not None) or set(a.photos) & set(b.photos)
    want = sorted((a.row_id, b.row_id, points(a, b)) for a, b in itertools.combinations(rows, 2) if blocked(a, b) and points(a, b) >= least)
    for most in (edges.CELL_ROWS, 12):
        assert sorted(map(tuple, edges.scored_pairs(df, least, most).collect())) == want
    sides = [d.groupBy("block", "home", "far", "gx", "gy").count().agg(F.max("count")).first()[0] for d in edges.dealt(edges.blocks(df, least), 12)]
    assert max(sides) <= 2 * 12 + 6  # groups by hash: about 12 rows each


def test_bounds_of_word_set_ratios(spark):
    """The ratio lies within the bounds; most pairs are settled by them."""
    from lotwise.functions import similarity

    rng = random.Random(7)
    words = ["dlha", "dlhá", "ulica", "cislo", "5", "12a", "trnava", "byt", "na", "predaj", "Kratka", "x"]
    pairs = [(" ".join(rng.choices(words, k=rng.randrange(6))), rng.choice(["", " ", "\u00a0", "\x1c"]).join(rng.choices(words, k=rng.randrange(6)))) for _ in range(400)]
    low, high = similarity.token_set_bounds(similarity.word_set(F.col("s")), similarity.word_set(F.col("t")))
    df = spark.createDataFrame(pairs, "s string, t string").select("s", "t", low.alias("low"), high.alias("high"))
    rows = df.collect()
    assert all(r.low <= similarity.token_set(r.s, r.t) <= r.high for r in rows)
    assert sum(r.low < 90 <= r.high for r in rows) < 0.25 * len(rows)
    got = sorted((r.s, r.t) for r in edges.similar(df, 90).collect())
    assert got == sorted((s, t) for s, t in pairs if similarity.token_set(s, t) >= 90)


def test_files_of_one_layout_are_one_scan_and_broken_ones_dont_stop_it(spark, tmp_path):
    import gzip

    from lotwise.sources import tables

    for i in range(3):
        (tmp_path / f"a{i}.csv").write_text(f"x,y\n{i},2\n")
    (tmp_path / "b.csv").write_text("y,z\n7,8\n")
    whole = gzip.compress(("x,y\n" + "".join(f"{i},{i * 7919 % 10007}\n" for i in range(200_000))).encode())
    (tmp_path / "c.csv.gz").write_bytes(whole[: len(whole) // 2])
    df = tables.union_csv(spark, [str(tmp_path / "*.csv*")])
    rows = df.filter("y IN ('2', '8') OR z = '8'").collect()
    assert {"0", "1", "2"} <= {r.x for r in rows} and "8" in {r.z for r in rows}
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2
