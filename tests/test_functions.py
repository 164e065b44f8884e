"""Scalars on hand-made values."""

import pytest
from pyspark.sql import functions as F

from lotwise.functions import geo, numbers, similarity, text
from lotwise.operators import extract, resolve, serve, stats

CASES = [
    ("digits", lambda c: numbers.digits(c), [("189 000", 189000), ("189000.0", 1890000), ("0", None), ("abc", None), (None, None)]),
    ("digits_strict", lambda c: numbers.digits_strict(c), [("189 000", 189000), ("189000.0", 189000)]),
    ("decimal", lambda c: numbers.decimal(c), [("68,5", 68.5), ("68 m2", 682.0), ("1.2.3", None), ("", None)]),
    ("decimal_strict", lambda c: numbers.decimal_strict(c), [("68 m2", 68.0), ("1 068,5 m2", 1068.5)]),
    ("to_int", lambda c: numbers.to_int(c), [("2.5", 2), ("3.5", 4), ("1 234", 1234), ("nan", None), ("", None)]),
    ("to_float", lambda c: numbers.to_float(c), [("1 234,5", 1234.5), ("inf", None)]),
    ("title", lambda c: text.title(c), [("košice-juh", "Košice-Juh"), ("o'neil", "O'Neil")]),
    ("slug", lambda c: text.slug(c), [("Košice - Juh", "košice_juh"), (" -- ", ""), (None, "")]),
    ("fold", lambda c: text.fold(c), [("Žilina Řß", "zilina rs")]),
    ("fold_exact", lambda c: text.fold_exact(c), [("Žilina", "zilina"), ("ﬁ", "fi")]),
    ("district", lambda c: text.district(c), [("okres Trnava, Trnavský kraj", "Trnava"), ("okres Žilina", "Žilina")]),
    ("region", lambda c: text.region(c), [("okres Trnava, Trnavský kraj", "Trnavský"), ("okres Žilina", None)]),
    ("rooms", lambda c: numbers.rooms_of_title(c), [("2,5-izbový byt", 5), ("3 izb.", 3), ("byt", None)]),
    ("energy", lambda c: text.energy_class(c), [("B", "B"), ("nie je", "none"), ("", "none"), (None, "none"), ("x", "unknown")]),
    ("building", lambda c: text.building_status(c), [("Novostavba", "new"), (" Kompletná  REKONŠTRUKCIA", "renovated-full"), ("čiastočná rekonštrukcia", "renovated-partial"), ("Pôvodný stav", "unknown"), (None, "unknown")]),
    ("token", lambda c: text.photo_token(c), [("https://h/foto/abc=/oWgMv1b7l_fss?st=1", "oWgMv1b7l"), (None, None), ("", None), ("https://h/a=b_fss2.jpg", "ab2jpg"), ("a=b_fss2.jpg", "ab2jpg"), ("https://h.sk", None), ("//h/Žlť-1.png#x", "l1png"), ("https://h/x|y z.jpg;v=2", "xyzjpg")]),
    ("tokens", lambda c: text.token_list(c), [('["a"," b ","a",""]', ["a", "b"]), ("x", ["x"]), ("", []), (None, [])]),
    ("street", lambda c: text.street(c), [("Ulica  Dlhá 5", "Dlhá 5"), ("", None)]),
    ("town", lambda c: text.town(c), [("slovensko", None), ("nové zámky", "Nové Zámky")]),
    ("transaction", lambda c: text.transaction(c), [("Predaj", "sale"), ("", "unknown"), ("prenajom", "prenajom")]),
    ("one_line", lambda c: text.one_line(c), [("a\r\nb  \t c", "a b c"), (None, "")]),
    ("fences", lambda c: text.strip_fences(c), [('```json\n[1]\n```', "[1]"), ("[1]", "[1]")]),
    ("one_decimal", lambda c: numbers.one_decimal(c.cast("double")), [("68.25", "68.2"), (None, None)]),
    ("room_type", lambda c: stats.room_type(c.cast("double")), [("2.5", "2-izbový"), ("0", "1-izbový"), (None, "Unknown")]),
    ("dash_slug", lambda c: text.dash_slug(c), [("Žilinský kraj", "zilinsky-kraj")]),
    ("year", lambda c: extract.year_in(c), [("rok 1987, 12345", 1987), ("1887", None)]),
    ("area", lambda c: extract.area_in(c), [("byt 68,5 m2", 68.5), ("x", None)]),
    ("price", lambda c: extract.price_in(c), [("cena 189 000 €", 189000), ("dohodou", None)]),
    ("state", lambda c: extract.state_in(c), [("pôvodný stav", "Pôvodný stav"), ("?", None)]),
    ("normal_url", lambda c: extract.normal_url(c), [("http://a/b/12/?q#x", "http://a/b/12")]),
    ("url_id", lambda c: extract.url_id(c), [("http://a/b/12/?q", "12"), ("http://a/b", None)]),
    ("plain_text", lambda c: extract.plain_text(c), [("<p>a&amp;b<script>x()</script> <b>c</b></p>", "a&b c")]),
]


@pytest.mark.parametrize(("name", "make", "pairs"), CASES, ids=[c[0] for c in CASES])
def test_scalar(spark, name, make, pairs):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(pairs)], "i int, v string")
    out = [r.o for r in df.select("i", make(F.col("v")).alias("o")).orderBy("i").collect()]
    assert out == [w for _, w in pairs]


def test_floor_parts(spark):
    df = spark.createDataFrame([(0, "3/3 + výťah"), (1, "2"), (2, "prízemie"), (3, None)], "i int, v string")
    got = [tuple(r.p) for r in df.select("i", numbers.floor_parts(F.col("v")).alias("p")).orderBy("i").collect()]
    assert got == [(3, 3, True), (2, None, None), (None, None, None), (None, None, None)]


def test_clamps_and_closeness(spark):
    row = spark.range(1).select(
        numbers.clamp_price(F.lit(9999)).alias("a"), numbers.clamp_price(F.lit(10000)).alias("b"), numbers.within(F.lit(9.9), 10, 1000).alias("c"), numbers.within(F.lit(1000.0), 10, 1000).alias("d"),
        numbers.close(F.lit(70.0), F.lit(72.0)).alias("e"), numbers.close(F.lit(None).cast("double"), F.lit(1.0)).alias("f"), numbers.close(F.lit(0.0), F.lit(0.0)).alias("g"),
        geo.distance_m(F.lit(48.0), F.lit(17.0), F.lit(48.001), F.lit(17.0)).alias("h"), text.join_address(F.lit(None).cast("string"), F.lit("trnava")).alias("i"),
    ).first()
    assert (row.a, row.b, row.c, row.d, row.e, row.f, row.g, row.i) == (None, 10000, None, 1000.0, True, False, False, "trnava")
    assert abs(row.h - 111.19) < 0.1


def test_common_subsequences():
    import random

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
        return row[-1]

    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcž ") for _ in range(rng.randrange(90))) for _ in range(2))
        assert similarity.matching(a, b) == plain(a, b)


def test_similarity():
    assert similarity.token_set("Ulica Dlhá 5 Trnava", "trnava dlhá 5 ulica") == 100
    assert similarity.token_set("alpha beta", "alpha beta gamma") == 100
    assert similarity.token_set("alpha", "omega") < 90
    assert similarity.near_slug("kosice", "kosice_juh") and not similarity.near_slug("kosice", "trnava") and not similarity.near_slug("", "a")


def test_attributes(spark):
    html = "<dl><dt>Plocha:</dt><dd>68 m2</dd></dl><table><tr><td>Izby</td><td>3</td></tr></table><ul><li>Stav: nový</li></ul>"
    df = spark.createDataFrame([(html,), (None,)], "h string").select(extract.attributes("h").alias("m"))
    out = df.select("m", extract.attribute(F.col("m"), ("ploch",)).alias("a")).collect()
    assert out[0].m == {"plocha": "68 m2", "izby": "3", "stav": "nový"} and out[0].a == "68 m2" and out[1].m == {} and out[1].a is None


def test_investment_and_ids(spark):
    df = spark.createDataFrame([("a", 100_000.0), ("b", None)], "row_id string, price double")
    a, b = serve.investment(df).orderBy("row_id").collect()
    assert (a.rent, a.expenses, a.cashflow, a.cap_rate, a.grade) == (400, 90, 310, 3.7, "C") and b.grade is None and b.rent is None
    got = spark.range(1).select(resolve.listing_id(F.lit("Dlhá"), F.lit(68), F.lit(None)).alias("x"), F.sha1(F.lit("dlhá|68|").cast("binary")).alias("y")).first()
    assert got.x == got.y


def test_serving_helpers(spark):
    df = spark.createDataFrame([('x summary_short_sk: " pekný byt " y',), ('INPUT DESCRIPTION: a\nb OUTPUT: "krátko"',), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(serve.plain_summary(F.col("t"))).collect()] == ["pekný byt", "krátko", None, None]
    assert [serve.path_for(p, t) for p, t in (("a/b.csv", "Rent "), ("a/b_rent.csv", "rent"), ("a.d/b", "x"), ("b.csv", ""))] == ["a/b_rent.csv", "a/b_rent.csv", "a.d/b_x", "b.csv"]
    cities = spark.createDataFrame([("Žilina",), (" - ",), (None,)], "city string")
    assert [r.city_slug for r in serve.with_slug(cities).collect()] == ["žilina"]


def test_reasons_and_backfill(spark):
    from lotwise.functions.text import cache_key
    from lotwise.operators import enrich

    gold = spark.createDataFrame([(i,) for i in range(4)], "cluster_id int")
    sources = spark.createDataFrame([(0, "a", "1"), (1, "a", "2"), (1, "b", "7"), (2, "a", "9"), (2, "c", "1")], "cluster_id int, portal string, listing_key string")
    texts = spark.createDataFrame([("a", "1", "t"), ("a", "2", " "), ("b", "8", "u")], "portal string, listing_key string, description string")
    got = {r.cluster_id: r.reasons for r in enrich.missing_reasons(gold, sources, texts).collect()}
    assert got == {1: ["a:2 empty description in CSV", "b:7 missing property_id"], 2: ["a:9 missing property_id", "c:1 missing portal CSV"], 3: ["no sources linked to listing"]}
    rows = spark.createDataFrame([("one", None, "100", "", "own"), ("two", "60", "90", "", None)], "description string, floor_area string, price string, price_area string, floor string")
    cache = rows.filter("description = 'one'").select(cache_key(F.col("description")).alias("key"), F.lit('```json\n{"floor_area": "50", "floor": "2"}\n```').alias("value"))
    out = {r.description: (r.floor_area, r.price_area, r.floor) for r in enrich.backfilled(rows, cache, "description", ["floor_area", "floor"]).collect()}
    assert out == {"one": ("50", "2", "own"), "two": ("60", "2", None)}
    assert [r.text for r in enrich.to_ask(rows, cache, "description").collect()] == ["two"]
