"""Names of cities: from slugs, spellings and the names of their districts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotwise.functions.text import clean, fold

# Cities whose names a slug does not give.
CITIES = {"bratislava": "Bratislava", "kosice": "Košice"}

# Folded names of districts, by the folded name of their city.
DISTRICTS = {
    "bratislava": (
        "stare mesto", "ruzinov", "nove mesto", "karlova ves", "petrzalka", "raca", "vajnory", "dubravka", "lamac", "devin", "devinska nova ves",
        "zahorska bystrica", "rusovce", "jarovce", "cunovo", "podunajske biskupice", "bratislava i", "bratislava ii", "bratislava iii", "bratislava iv", "bratislava v",
    ),
    "kosice": (
        "stare mesto", "sever", "zapad", "juh", "sidlisko kvp", "nad jazerom", "dargovskych hrdinov", "myslava", "peres", "lorincik", "polov", "barca",
        "kosicka nova ves", "kavecany", "saca", "sebastovce", "tahanovce", "topolova",
    ),
}

# Names that a report counts under another city, and those that it leaves out.
REPORTED = {"vyšné opátske": "Košice", "vyšne opatske": "Košice", "topoľová": "Košice", "topolova": "Košice"}
SKIPPED = ("unknown", "džungľa", "dzungla")


def literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def city_of_slug(slug: Column) -> Column:
    """`nove-zamky` is Nove Zamky; cities with a name of their own get that."""
    parts = F.filter(F.split(F.trim(F.coalesce(slug, F.lit(""))), "[-_/]"), lambda p: p != "")
    words = F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(p.substr(F.lit(2), F.length(p)))))
    return F.coalesce(literal_map(CITIES)[fold(clean(F.array_join(parts, " ")))], F.array_join(words, " "))


def within_city(city: Column, town: Column, area: Column) -> Column:
    """struct<town, area>: a town that is a district of the city becomes the city, its name leads the area."""
    city, town, area = (F.trim(F.coalesce(c, F.lit(""))) for c in (city, town, area))
    key = lambda c: fold(clean(c))
    names = F.create_map(*[x for k, v in DISTRICTS.items() for x in (F.lit(k), F.array(*[F.lit(d) for d in v]))])[key(city)]
    parts = F.array(town)
    for mark in (",", "-", "/", "|"):
        parts = F.concat(parts, F.when(F.contains(town, F.lit(mark)), F.filter(F.transform(F.split(town, f"[{mark}]"), lambda p: F.trim(p)), lambda p: p != "")).otherwise(F.array().cast("array<string>")))
    found = F.get(F.filter(parts, lambda p: F.array_contains(names, key(p))), F.lit(0))
    led = F.when(area == "", found).when(key(area) != key(found), F.concat(found, F.lit(", "), area)).otherwise(area)
    same = (town == "") | (key(town) == key(city))
    put = lambda t, a: F.struct(t.alias("town"), a.alias("area"))
    return F.when(city == "", put(town, area)).when(same, put(city, area)).when(found.isNotNull(), put(city, led)).otherwise(put(town, area))


def reported_city(name: Column) -> Column:
    """The city a report counts a name under; null for names that it leaves out."""
    t = F.trim(name)
    return F.when(~F.lower(t).isin(*SKIPPED), F.coalesce(literal_map(REPORTED)[F.lower(t)], F.nullif(t, F.lit(""))))


def first_named(*names: Column) -> Column:
    """The first that isn't blank, else Unknown."""
    return F.coalesce(*[F.nullif(F.trim(n), F.lit("")) for n in names], F.lit("Unknown"))
