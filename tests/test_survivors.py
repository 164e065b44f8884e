"""The second survivorship against plain Python, and small parts: batch answers, raw CSV files, log lines, place keys."""

import json
import random
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F
from test_resolution import ROW, listing

from lotwise.functions import text
from lotwise.operators import enrich, stats, survivors
from lotwise.schema import RAW_LISTING
from lotwise.sources import tables


def plain(records):
    """Records in row order -> golden record. Ties: Counter keeps the order of insertion."""

    def pick(c, blank=False):
        for r in sorted(records, key=lambda r: r.portal_rank):
            if blank or r[c] not in (None, ""):
                return r[c] or None if isinstance(r[c], str) else r[c]
        return None

    def mode(c):
        seen = Counter(r[c] for r in records if r[c] not in (None, "")).most_common()
        return seen

    sizes = [r["size"] for r in records if r["size"]]
    size = float(median(sizes)) if sizes else None
    newest = max(records, key=lambda r: r.updated_at or "9999")
    price, rooms, states = newest.price, mode("rooms"), mode("status")
    room = None
    if rooms:
        room = rooms[0][0]
        if len(rooms) > 1 and rooms[0][1] == rooms[1][1]:
            room = pick("rooms")
    far = lambda x, of: abs(x - of) > 0.05 * of
    prices = [r.price for r in records if r.price is not None]
    flags = {"size_m2": bool(size) and any(far(x, size) for x in sizes), "price": price is not None and any(far(x, price) for x in prices), "room_number": len(rooms) > 1, "building_status": len(states) > 1}
    return size, price, room, states[0][0] if states else "unknown", pick("floor"), pick("floors_total"), True if any(r.elevator for r in records) else None, pick("cert", True) or "unknown", pick("street"), flags


@pytest.mark.parametrize("seed", range(3))
def test_second_survivorship_by_hand(spark, seed):
    rng = random.Random(seed)
    data = [
        listing(i, portal=(p := rng.choice("abc")), portal_rank="abc".index(p), size=rng.choice([None, 50.0, 52.0, 60.0]), price=rng.choice([None, 100.0, 104.0, 120.0]), rooms=rng.choice([None, 1, 2, 3]), floor=rng.choice([None, 0, 3]), floors_total=rng.choice([None, 5]),
                elevator=rng.choice([None, True, False]), cert=rng.choice([None, "", "A"]), street=rng.choice([None, "", "Dlhá 5"]), status=rng.choice([None, "", "new", "old"]), updated_at=rng.choice([None, "2025-01-01", "2025-01-02"])) + (f"c{i % 12}",)
        for i in range(60)
    ]
    df = spark.createDataFrame(data, ROW + ", cluster_id string").repartition(3)
    gold = survivors.golden(df)
    got = {r.cluster_id: (r["size"], r.price, r.rooms, r.building_status, r.floor, r.floors_total, r.elevator, r.cert, r.street, json.loads(r.conflict_flags)) for r in gold.collect()}
    groups = {}
    for r in sorted(df.collect(), key=lambda r: r.row_id):
        groups.setdefault(r.cluster_id, []).append(r)
    assert got == {k: plain(v) for k, v in groups.items()}
    for r in survivors.with_provenance(gold, df).collect():
        said, own = json.loads(r.provenance), groups[r.cluster_id]
        first = next((x for x in own if (x.rooms == r.rooms if r.rooms is not None else x.rooms is None)), own[0])
        assert said["room_number"]["url"] == first.url and said["price"]["rule"] == "latest"
        close = [x for x in own if x["size"] is not None and r["size"] is not None and abs(x["size"] - r["size"]) <= 0.05 * r["size"]]
        want = (close[0].url, "priority") if close else (own[0].url, "default") if r["size"] is not None else (next(x for x in own if x["size"] is None).url, "priority")
        assert (said["size_m2"]["url"], said["size_m2"]["rule"]) == want


def test_answers(spark):
    rows = ['{"items":[{"id":1,"summary":"a"},{"id":1,"summary":"b"},{"id":"","listing_id":"z","summary_short_sk":" \\"c\\" "},7,{"id":"q"}]}', '[{"id":"k","summary":"v"}]', '```json\n[{"id":"k","summary":"v"}]\n```', "nothing", '{"other":[]}', None, "[]"]
    out = [r.a for r in spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string").orderBy("i").select(text.answers(F.col("t")).alias("a")).collect()]
    assert out == [{"1": "b", "z": "c"}, {"k": "v"}, {"k": "v"}, {}, {}, {}, {}]


def test_raw_listing_files(spark, tmp_path):
    names = [c for c in RAW_LISTING.fieldNames() if c != "floor"]
    cells = {"description": 'first\n\tsecond "x"', "property_name": "a\n b\t\tc", "price": None}
    df = spark.createDataFrame([tuple(cells.get(c, c) for c in names)], ", ".join(f"{c} string" for c in names))
    tables.raw_listings(df, str(tmp_path / "out"))
    back = tables.raw_csv(spark, str(tmp_path / "out")).first()
    assert back.asDict().keys() >= set(RAW_LISTING.fieldNames())
    assert (back.description, back.property_name, back.price, back.floor, back.link) == ('first\n\tsecond "x"', "a b c", None, None, "link")


def test_log_lines_and_place_keys(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(25)], "i int, k int")
    out = enrich.first_of(df, ["k", "i"]).collect()
    assert sorted(r.i for r in out) == [0, 1, 3, 6, 9, 12, 15, 18, 21, 24]
    assert {r.more for r in out} == {15} and {r.more for r in enrich.first_of(df, ["i"], 100).collect()} == {0}
    rows = spark.createDataFrame([(48.1234, 17.5, "T", "S"), (None, 17.5, "Trnava", " Dlhá "), (None, None, "Trnava", " ")], "lat double, lng double, city string, street string")
    assert [r.k for r in rows.select(stats.place_cluster(F.col("lat"), F.col("lng"), F.col("city"), F.col("street")).alias("k")).collect()] == ["geo:48.123|17.500", "text:trnava|dlhá", "city:trnava"]
