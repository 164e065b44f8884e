"""Match rules, components, golden records and history against plain Python."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from lotwise.operators import edges, enrich, history, resolve
from lotwise.operators.components import components

ROW = (
    "row_id string, portal string, portal_rank int, listing_key string, url string, town string, street string, address string, size double, price double, rooms int, floor int, floors_total int, "
    "elevator boolean, cert string, year_built int, lat double, lng double, updated_at string, status string, photos array<string>"
)


def listing(i, **own):
    base = {"row_id": f"r{i:04d}", "portal": "a", "portal_rank": 0, "listing_key": f"k{i}", "url": f"u{i}", "town": "T", "street": None, "address": f"x{i}", "size": None, "price": None, "rooms": None, "floor": None, "floors_total": None,
            "elevator": None, "cert": None, "year_built": None, "lat": None, "lng": None, "updated_at": "2025-01-01", "status": None, "photos": []}
    return tuple((base | own)[f.split()[0]] for f in ROW.split(", "))


def closure(nodes, links):
    name = {n: n for n in nodes}

    def top(x):
        while name[x] != x:
            x = name[x]
        return x

    for a, b in links:
        p, q = sorted((top(a), top(b)))
        name[q] = p
    return {n: top(n) for n in nodes}


def near(a, b, share=0.03):
    return a and b and abs(a - b) <= share * max(a, b)


@pytest.mark.parametrize("seed", range(3))
def test_rules_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    data = [
        listing(i, portal=rng.choice("ab"), listing_key=f"k{rng.randrange(25)}", town=rng.choice(["T", "U", None]), address=rng.choice(["x", "y", None]), size=rng.choice([None, *[round(rng.uniform(40, 90), 1) for _ in range(3)]]),
                lat=48 + rng.randrange(6) * 0.0004, lng=17 + rng.randrange(6) * 0.0004, photos=[f"p{rng.randrange(90)}"] if rng.random() < 0.6 else [])
        for i in range(70)
    ]
    df = spark.createDataFrame(data, ROW)
    rows = df.collect()
    pairs = list(itertools.combinations(rows, 2))
    portals = {}
    for r in rows:
        portals.setdefault(r.listing_key, set()).add(r.portal)
    from math import asin, cos, radians, sin, sqrt

    def metres(a, b):
        h = sin(radians(b.lat - a.lat) / 2) ** 2 + cos(radians(a.lat)) * cos(radians(b.lat)) * sin(radians(b.lng - a.lng) / 2) ** 2
        return 2 * 6_371_000 * asin(sqrt(h))

    want = {
        "P1": lambda a, b: bool(set(a.photos) & set(b.photos)),
        "A1": lambda a, b: a.address is not None and a.address == b.address and a.town == b.town and near(a.size, b.size) and abs(round(a.size) - round(b.size)) <= 2,
        "I1": lambda a, b: a.listing_key == b.listing_key and len(portals[a.listing_key]) > 1,
        "G1": lambda a, b: a.town is not None and a.town == b.town and near(a.size, b.size) and metres(a, b) <= 60,
    }
    got = resolve.rules(df)
    for rule, test in want.items():
        links = [(a.row_id, b.row_id) for a, b in pairs if test(a, b)]
        out = {r.row_id: r.cluster_id for r in resolve.label(df, got[rule]).collect()}
        assert out == closure([r.row_id for r in rows], links), rule


def test_merge_counts_add_up(spark):
    data = [listing(0, photos=["p"]), listing(1, photos=["p"]), listing(2, listing_key="s"), listing(3, listing_key="s", portal="b"), listing(4, address="q", size=70.0, photos=["p"]), listing(5, address="q", size=71.0)]
    counts = {r.rule: r.merges for r in resolve.merge_counts(spark.createDataFrame(data, ROW)).collect()}
    assert counts == {"P1": 2, "A1": 1, "I1": 1, "G1": 0}


def test_all_six_rules_against_all_pairs(spark):
    """Similar addresses and equal projects merge listings, in the rules, their counts and the pipeline."""
    from lotwise.functions.similarity import token_set
    from lotwise.plans import pipelines
    from lotwise.schema import NORMALIZED, conform

    rng = random.Random(5)
    streets = ["dlha ulica cislo 5, trnava", "dlha ulica cislo trnava 5", "dlha ulica cislo 99, ina obec", "kratka cesta 1", None]
    data = [
        listing(i, town=rng.choice(["T", "U", None]), address=rng.choice(streets), size=rng.choice([None, round(rng.uniform(60, 75), 1), round(rng.uniform(60, 75), 1)])) + (rng.choice(["p", "q", None, None]),)
        for i in range(60)
    ]
    df = spark.createDataFrame(data, ROW + ", project string").withColumn("address_ascii", F.col("address"))
    rows = df.collect()
    pairs = list(itertools.combinations(rows, 2))
    band = lambda a, b: a.town is not None and a.town == b.town and near(a.size, b.size) and abs(round(a.size) - round(b.size)) <= 2
    want = {
        "A2": lambda a, b: bool(band(a, b) and a.address and b.address and a.address[:12] == b.address[:12] and token_set(a.address, b.address) >= 90),
        "B1": lambda a, b: bool(band(a, b) and a.project is not None and a.project == b.project),
    }
    got = resolve.rules(df)
    assert list(got) == ["P1", "A1", "A2", "I1", "G1", "B1"]
    nodes = [r.row_id for r in rows]
    for rule, test in want.items():
        out = {r.row_id: r.cluster_id for r in resolve.label(df, got[rule]).collect()}
        assert out == closure(nodes, [(a.row_id, b.row_id) for a, b in pairs if test(a, b)]), rule
    exact = lambda a, b: a.address is not None and a.address == b.address and a.town == b.town and near(a.size, b.size) and abs(round(a.size) - round(b.size)) <= 2
    links, left, merges = [], len(nodes), {}
    for rule, test in (("A1", exact), *want.items()):
        links += [(a.row_id, b.row_id) for a, b in pairs if test(a, b)]
        now = len(set(closure(nodes, links).values()))
        merges[rule], left = left - now, now
    assert {r.rule: r.merges for r in resolve.merge_counts(df).collect()} == {"P1": 0, "I1": 0, "G1": 0} | merges and merges["A2"] and merges["B1"]
    normal = df.select(F.expr("cast(substring(row_id, 2) as long) AS row_id"), "portal", F.col("listing_key").alias("portal_listing_key"), F.col("town").alias("address_town"), F.col("address").alias("address_norm"), "address_ascii", F.col("project").alias("project_name_norm"), F.col("size").alias("size_m2"), F.col("photos").alias("photo_fingerprints"))
    gold, _ = pipelines.resolved(conform(normal, NORMALIZED), ["a"])
    assert gold.count() == left


def test_scores(spark):
    data = [listing(0, listing_key="k"), listing(1, listing_key="k"), listing(2, address="q", size=100.0), listing(3, address="q", size=98.5), listing(4, address="q", size=200.0, price=100.0), listing(5, address="q", size=300.0, price=100.0)]
    got = {(r.a, r.b): r.score for r in edges.scored_pairs(spark.createDataFrame(data, ROW)).collect()}
    assert got == {("r0000", "r0001"): 8, ("r0002", "r0003"): 7}


def test_fuzzy_rule(spark):
    data = [listing(0, address="dlha ulica cislo 5, trnava", size=70.0), listing(1, address="dlha ulica cislo trnava 5", size=71.0), listing(2, address="dlha ulica cislo 99, ina obec", size=70.0), listing(3, address="dlha ulica cislo 5, trnava", size=90.0)]
    got = [(r.a, r.b) for r in edges.fuzzy_edges(spark.createDataFrame(data, ROW), "address").collect()]
    assert got == [("r0000", "r0001")]


def test_golden_record(spark):
    data = [
        listing(0, portal="b", portal_rank=1, size=70.0, price=100.0, rooms=2, floor=3, updated_at="2025-01-03", photos=["z"], elevator=None),
        listing(1, portal="a", portal_rank=0, size=71.0, price=None, rooms=3, floor=2, floors_total=5, updated_at="2025-01-01", photos=["y", "z"], elevator=False),
        listing(2, portal="c", portal_rank=2, size=None, price=120.0, rooms=2, updated_at="2025-01-02", status="new"),
    ]
    g = resolve.golden(spark.createDataFrame(data, ROW).withColumn("cluster_id", F.lit("r0000"))).first()
    assert (g.cluster_size, g.primary_portal, g.size, g.price, g.rooms, g.floor, g.floors_total, g.elevator, g.photos, g.status) == (3, "b", 70.5, 100.0, 2, 2, 5, False, ["y", "z"], "new")
    assert g.flags == ["price_disagree", "rooms_disagree"]
    wide = [listing(0, portal_rank=1, portal="b", size=70.0), listing(1, size=80.0)]
    assert resolve.golden(spark.createDataFrame(wide, ROW).withColumn("cluster_id", F.lit("x"))).first().size == 80.0


def record(spark, *rows, more="", **columns):
    df = spark.createDataFrame(list(rows), ROW + more).withColumns({"cluster_id": F.lit("x"), **columns})
    return resolve.golden(df).first()


def test_undated_rows_are_the_oldest(spark):
    g = record(spark, listing(0, updated_at=None, price=111.0, url="old"), listing(1, updated_at="2025-01-01", price=222.0, url="new"))
    assert (g.price, g.primary_url, g.updated_at) == (222.0, "new", "2025-01-01")
    g = record(spark, listing(0, updated_at="2025-01-01T08:00:00", price=1.0), listing(1, updated_at="2025-01-01T18:00:00", price=2.0))
    assert g.price == 2.0 and g.updated_at.endswith("18:00:00")
    g = record(spark, listing(0, updated_at=None, price=1.0), listing(1, updated_at=None, price=2.0, portal_rank=-1))
    assert g.price == 2.0 and g.updated_at is None


def test_as_frequent_rooms_go_by_the_best_portal(spark):
    rows = [listing(0, rooms=2, portal_rank=1), listing(1, rooms=2, portal_rank=1), listing(2, rooms=3, portal_rank=1), listing(3, rooms=3, portal_rank=1), listing(4, rooms=1, portal_rank=0)]
    assert record(spark, *rows).rooms == 1
    assert record(spark, *rows, listing(5, rooms=3, portal_rank=1)).rooms == 3


def test_provenance_and_table(spark):
    import hashlib
    import json

    from lotwise.schema import GOLDEN

    rows = [
        listing(0, portal="b", portal_rank=1, url="ub", size=70.0, price=100.0, floor=3, floors_total=4, updated_at="2025-01-03", address=None, elevator=False, cert="B", town="T"),
        listing(1, portal="a", portal_rank=0, url="ua", size=90.0, price=None, floor=2, updated_at="2025-01-01", address="dlha 5, t", elevator=True, year_built=1990, rooms=2, status="new"),
    ]
    g = record(spark, *rows, project=F.lit("park"), unit_no=F.lit(None).cast("string"))
    p = json.loads(g.provenance)
    assert list(p) == sorted(p)
    said = {k: (v["portal"], v["source_url"], v["reason"]) for k, v in p.items()}
    assert said == {
        "address_norm": ("a", "ua", "fallback_non_null"), "address_town": ("b", "ub", "majority"), "elevator": ("a", "ua", "any_true"), "energ_cert": ("b", "ub", "priority"),
        "floor": ("b", "ub", "floor_tuple"), "floors_total": ("b", "ub", "floor_tuple"), "price": ("b", "ub", "latest"), "project_name_norm": ("a", "ua", "priority"), "rooms": ("a", "ua", "only_value"),
        "size_m2": ("a", "ua", "priority"), "status": ("a", "ua", "latest"), "updated_at": ("b", "ub", "primary_recent"), "year_of_construction": ("a", "ua", "priority"),
    }
    df = spark.createDataFrame(rows, ROW).withColumns({"cluster_id": F.lit("x"), "project": F.lit("park")})
    t = resolve.golden_table(resolve.golden(df), "2025-01-04")
    assert [(f.name, f.dataType) for f in t.schema] == [(f.name, f.dataType) for f in GOLDEN]
    one = t.first()
    assert one.listing_id == hashlib.sha1(b"dlha 5, t|90.0|3|4|1990|park|b").hexdigest() and json.loads(one.field_conflict_flags) == {"size_gt_5pct": True} and one.price == 100
    assert resolve.mean_flags(resolve.golden(df)).first().mean_flags == 1.0


def test_rows_numbered_in_order(spark):
    data = [(f"r{i:03d}", i % 3) for i in range(200)]
    got = [r.row_id for r in resolve.renumbered(spark.createDataFrame(data, "row_id string, portal_rank int").withColumn("old", F.col("row_id"))).orderBy("portal_rank", "old").collect()]
    assert got == list(range(200))


@pytest.mark.parametrize("seed", range(2))
def test_components_of_scored_pairs_without_pairs(spark, seed):
    rng = random.Random(seed)
    data = [
        listing(i, listing_key=f"k{rng.randrange(40)}" if rng.random() < 0.5 else None, address=rng.choice(["x", "y", None]), size=rng.choice([None, *[round(rng.uniform(40, 60), 1) for _ in range(3)]]), price=rng.choice([None, round(rng.uniform(90, 130), 1)]),
                photos=[f"p{rng.randrange(25)}"] if rng.random() < 0.5 else [])
        for i in range(70)
    ]
    df = spark.createDataFrame(data, ROW)
    links = [(r.a, r.b) for r in edges.scored_pairs(df).collect()]
    out = {r.row_id: r.cluster_id for r in resolve.label(df, edges.scored_edges(df)).collect()}
    assert out == closure([d[0] for d in data], links)


def test_history_of_three_days(spark):
    make = lambda pairs: spark.createDataFrame(pairs, "uid string, v string").withColumn("hash", history.content_hash(F.col("v")))
    none = make([]).withColumns({"first_seen": F.lit(""), "last_seen": F.lit(""), "valid_from": F.lit(""), "is_current": F.lit(True)})
    past = make([]).withColumns({"valid_from": F.lit(""), "valid_to": F.lit(""), "is_current": F.lit(True)})
    days = {"d1": [("a", "1")], "d2": [("a", "1"), ("b", "1")], "d3": [("a", "2")]}
    latest = none
    for day, pairs in days.items():
        latest, past = history.upsert(latest, past, make(pairs), day)
        again, past_again = history.upsert(latest, past, make(pairs), day)  # a replay changes nothing
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, latest.collect())) and past_again.count() == past.count()
    rows = {r.uid: r for r in latest.collect()}
    assert (rows["a"].first_seen, rows["a"].valid_from, rows["b"].last_seen, rows["b"].is_current) == ("d1", "d3", "d2", True)
    assert sorted((r.uid, r.v, r.valid_to, r.is_current) for r in past.filter("valid_to IS NOT NULL").collect()) == [("a", "1", "d3", False)]
    assert past.filter("is_current").count() == 2
    gone, _ = history.upsert(latest, past, make([("a", "2")]), "d4", close_missing=True)
    assert {r.uid: r.is_current for r in gone.collect()} == {"a": True, "b": False}


def test_components_of_texts(spark):
    out = {r.node: r.label for r in components(spark.createDataFrame([("c", "b"), ("b", "a"), ("y", "x")], "a string, b string")).collect()}
    assert out == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"}


def test_coordinates_are_fetched_once_a_key(spark):
    def fetch(batches):
        for b in batches:
            yield b.assign(lat=1.0, lng=2.0)[["key", "lat", "lng"]]

    df = spark.createDataFrame([(1, "s", "t", None, None), (2, "s", "t", None, None), (3, None, None, None, None), (4, "s", "u", 5.0, 6.0), (5, "q", "t", None, None), (6, "z", "z", None, None)], "i int, street string, town string, lat double, lng double")
    cache = spark.createDataFrame([("q|t|slovakia", 7.0, 8.0)], "key string, lat double, lng double")
    got = {r.i: (r.lat, r.geo_source) for r in enrich.fill_coordinates(df, cache, most_new=1, fetch=fetch).collect()}
    assert got == {1: (1.0, "new"), 2: (1.0, "new"), 3: (None, "failed"), 4: (5.0, "own"), 5: (7.0, "cache"), 6: (None, "pending")}


def test_missing_fields_are_filled(spark):
    df = spark.createDataFrame([("k", "nan", "own")], "k string, a string, b string")
    found = spark.createDataFrame([("k", "x", "y")], "k string, a string, b string")
    assert tuple(enrich.fill_missing(df, found, "k", ["a", "b"]).first()) == ("k", "x", "own")
    asked = enrich.fetch_texts(spark.createDataFrame([("t",), ("t ",), ("",)], "t string"), lambda ts: [t.upper() for t in ts], "t", "v").collect()
    assert [r.v for r in asked] == ["T"]
