"""Pages of the three portals' markups as listing records, and names of towns."""

import json

import pytest
from pyspark.sql import functions as F

from lotwise.functions import towns
from lotwise.operators import extract, records
from lotwise.schema import RAW_COLUMNS

STACK = '<div class="MuiStack-root x"><p data-test-id="text">{}:</p><p data-test-id="text">{}</p></div>'
FIRST = f"""<html><body><h1> Pekný byt </h1><p data-test-id="text">Hlavná 5 - Petržalka, Ružinov, okres Bratislava II</p><h2>3 izbový byt na predaj</h2>
<p class="MuiTypography-h3 y">189 000,50 €</p><div class="MuiBox-root"><h3>Vlastnosti</h3>{STACK.format("Úžitková plocha", "68,5 m")}{STACK.format("Stav", "Novostavba")}{STACK.format("Rok výstavby", "okolo 1987")}
{STACK.format("Podlažie", "3/5")}{STACK.format("Energetický certifikát", "B")}</div>
<script type="application/ld+json">{json.dumps({"description": "krátky", "more": [{"description": "dlhší popis"}]})}</script>
<img data-src="//img.example/1.jpg"><img src="data:x"><img src="/2.svg"><img srcset="/2.jpg 2x, /3.jpg"><article>zvyšok</article></body></html>"""
SECOND = """<script type="application/ld+json">{"@type": "Product", "name": "Byt B", "offers": {"price": 120000}, "image": ["https://i/1.jpg", "https://i/2.jpg"]}</script>
<script type="application/ld+json">{broken</script>
<script type="application/ld+json">{"@type": ["Apartment"], "address": {"streetAddress": "Dlhá 1", "addressLocality": "Slovensko", "addressRegion": "Košický kraj"}, "floorSize": {"value": "60"},
 "amenityFeature": [{"name": "Počet izieb", "value": 2}, {"name": "Podlažie", "value": "2"}, {"name": "Rok výstavby", "value": "1.9.7"}]}</script><section class="detail-text">Prvý<br>druhý</section>"""
THIRD = """<span class="nadpisdetail">Predám 2-izbový byt</span><span class="cena">dohodou</span><table><tr><td>Obec</td><td>Sever</td></tr><tr><td>Okres</td><td>Košice I</td></tr></table>
<div class="popisdetail">Byt 52,5 m2 na 3. poschodie z 8 posch, po rekonštrukcii 2015, postavený v roku 1978, cena 99 000 eur, 1500 €/m2</div><img src="/a.png">"""


def one(spark, portal, html, city):
    pages = spark.createDataFrame([("https://p.example/detail/123/x", html)], "url string, html string")
    return records.records(pages, portal, city, "predaj").first()


def test_first_portal(spark):
    r = one(spark, "nehnutelnosti_sk", FIRST, "bratislava")
    assert (r.source, r.property_name, r.room_number, r.price, r.floor_area, r.building_status, r.year_of_construction, r.floor, r.energ_cert) == ("nehnutelnosti_sk", "Pekný byt", "3", "189000", "68", "Novostavba", "1987", "3/5", "B")
    assert (r.address_street, r.address_town, r.address_zrea) == ("Hlavná 5", "Bratislava", "Ružinov, okres Bratislava II")
    assert r.description == "dlhší popis" and (r.photo_url_1, r.photo_url_2, r.photo_url_3) == ("https://img.example/1.jpg", "https://p.example/2.jpg", None)


def test_second_portal(spark):
    r = one(spark, "reality_sk", SECOND, "kosice")
    assert (r.property_name, r.price, r.floor_area, r.room_number, r.floor, r.price_area, r.year_of_construction) == ("Byt B", "120000", "60", "2", "2", "2000", None)
    assert (r.address_street, r.address_town, r.address_zrea, r.photo_url_2, r.description) == ("Dlhá 1", "Košice", "Košický kraj", "https://i/2.jpg", "Prvý\ndruhý")


def test_third_portal(spark):
    r = one(spark, "bazos_sk", THIRD, "kosice")
    assert (r.property_name, r.price, r.floor_area, r.room_number, r.floor, r.building_status, r.price_area) == ("Predám 2-izbový byt", "99000", "52", "2", "3/8", "Rekonštrukcia", "1500")
    assert (r.address_town, r.address_zrea, r.year_of_construction, r.year_of_top, r.photo_url_1) == ("Košice", "Sever, Košice I", "1978", "2015", "https://p.example/a.png")


def test_references_without_an_end_stay_text(spark):
    """A title cut off within a reference keeps what is there, as the query's SQL does; JSON-LD is not touched."""
    page = '<!-- &lt --><h1>a &amp; b&amp;&amp</h1><img src="/1.jpg?a=1&b=2&amp;c=3"><script type="application/ld+json">{"description": "x &amp y &z"}</script>'
    r = one(spark, "nehnutelnosti_sk", page, "trnava")
    assert (r.property_name, r.description, r.photo_url_1) == ("a & b&&amp", "x &amp y &z", "https://p.example/1.jpg?a=1&b=2&c=3")
    whole = one(spark, "nehnutelnosti_sk", "<h1>&lt;5&#39;&#x2f&#47 &eacute;&eacute</h1>", "trnava")
    assert whole.property_name == "<5'&#x2f&#47 \u00e9&eacute"


@pytest.mark.parametrize("portal", list(records.PORTALS))
def test_pages_without_anything(spark, portal):
    pages = spark.createDataFrame([("u", None), ("v", ""), ("w", "<p><div></b>" * 50), (None, "<h1>x")], "url string, html string")
    out = records.records(pages, portal, "trnava", "predaj")
    assert out.columns == RAW_COLUMNS
    assert all(r.price is None and r.photo_url_1 is None for r in out.collect())


def test_addresses(spark):
    cases = [
        (("Dlhá 5, Trnava, okres Trnava", None, None, None, "Trnava"), ("Dlhá 5", "Trnava", "okres Trnava")),
        (("Dlhá 5 - Modranka", None, None, None, "Trnava"), ("Dlhá 5", "Modranka", "")),
        (("Trnava - Kopánka", None, None, None, "Trnava"), ("Trnava - Kopánka", "Kopánka", "")),
        (("Pri parku, Biely Kostol, okres T", "Krátka 1", "Obec", "okres Z", "Trnava"), ("Krátka 1", "Obec", "okres Z")),
        (("", None, None, None, "Trnava"), ("", "Trnava", "")),
        (("Kopánka, Modranka", None, None, None, "Trnava"), ("Kopánka", "Modranka", "")),
        ((None, None, None, None, None), ("", "", "")),
        ((" , -,okres X, okres Y", None, None, None, "Trnava"), ("-", "Trnava", "okres X")),
        (("Trnava, Trnava", None, None, None, "Trnava"), ("Trnava", "Trnava", "")),
        (("Trnava - Juh, Hlavná ulica 3, Modranka - Kopánka", None, None, None, "Trnava"), ("Hlavná ulica 3", "Kopánka", "")),
        (("Juh", None, "Juh", None, "Trnava"), ("Juh", "Trnava", "")),
        (("Dom, " * 20_000 + "Modranka", None, None, None, "Trnava"), ("Dom", "Modranka", "")),
    ]
    df = spark.createDataFrame([(i, *c[0]) for i, c in enumerate(cases)], "i int, l string, s string, t string, a string, c string")
    got = [tuple(r.x) for r in df.select("i", records.derived_address(*[F.col(c) for c in "lstac"]).alias("x")).orderBy("i").collect()]
    assert got == [c[1] for c in cases]


def test_towns(spark):
    df = spark.createDataFrame([("kosice", "Topoľová", ""), ("nove-zamky_juh", "vyšné Opátske", "x")], "slug string, name string, area string")
    a, b = df.select(towns.city_of_slug(F.col("slug")).alias("c"), towns.reported_city(F.col("name")).alias("r"), towns.first_named(F.col("area"), F.col("name")).alias("f")).collect()
    assert (a.c, a.r, a.f) == ("Košice", "Košice", "Topoľová") and (b.c, b.r, b.f) == ("Nove Zamky Juh", "Košice", "x")
    put = lambda c, t, z: tuple(spark.range(1).select(towns.within_city(F.lit(c), F.lit(t), F.lit(z)).alias("x")).first().x)
    assert put("Košice", "Sídlisko KVP", "") == ("Košice", "Sídlisko KVP") and put("Košice", "okolie - Juh", "kraj") == ("Košice", "Juh, kraj") and put("Košice", "Juh", "juh") == ("Košice", "juh")
    assert put("Trnava", "Juh", "z") == ("Juh", "z") and put("", " a ", "z") == ("a", "z") and put("Košice", None, None) == ("Košice", "")
    assert spark.range(1).select(towns.reported_city(F.lit("Džungľa"))).first()[0] is None


def test_numbers_of_pages(spark):
    df = spark.createDataFrame([("1.234.567,5 €",), ("68,5 m",), ("x",), (None,)], "t string")
    assert [tuple(r) for r in df.select(records.number(F.col("t"), True), records.number(F.col("t"))).collect()] == [(1234568, None), (68, 68), (None, None), (None, None)]
    text = spark.createDataFrame([("na 2. np z 4 posch",), ("3 / 7",), ("prízemie",), ("nič",)], "t string")
    assert [r[0] for r in text.select(extract.floor_text(F.col("t"))).collect()] == ["2/4", "3/7", "0", None]
