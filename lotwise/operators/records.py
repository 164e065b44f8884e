"""Listing records out of portals' pages.

A table says where each portal keeps what; one pass of a parser reads a page into texts, labelled values, pictures and
JSON-LD. Everything after that, from numbers to the order of fall-backs, is columns.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions import towns
from lotwise.functions.text import clean, fold
from lotwise.operators import extract
from lotwise.schema import RAW_COLUMNS

#: A reference without its semicolon stays text, outside of what is no text anyway: comments, scripts, styles.
OPEN_REFERENCE = re.compile(r"(<!--.*?-->|<(script|style)\b.*?(?:</\2|\Z))|&(?=(?:[a-z][a-z0-9]*|#\d+|#x[0-9a-f]+)(?![a-z0-9;]))", re.IGNORECASE | re.DOTALL)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
PARSED = (
    "texts map<string,string>, fields map<string,string>, photos array<string>, described string, "
    "name string, street string, town string, area string, floor_size string, price string, images array<string>, amenities map<string,string>"
)


@dataclass(frozen=True)
class Portal:
    """Where a portal keeps a listing's parts: (tag or *, attribute, part of its value), and words of its labels."""

    texts: dict[str, tuple[tuple[str, str, str], ...]]
    labels: dict[str, tuple[str, ...]]
    whole_labels: bool = False  # labels have to be equal, else to hold the word
    structured: bool = False  # JSON-LD says most


# Marks of the three portals' pages, and words of their labels.
PORTALS = {
    "nehnutelnosti_sk": Portal(
        texts={
            "title": (("h1", "", ""),), "kind": (("h2", "", ""),), "price": (("p", "class", "MuiTypography-h3"),), "location": (("p", "data-test-id", "text"),),
            "description": (("*", "itemprop", "description"), ("*", "data-test-id", "description"), ("*", "data-testid", "description"), ("section", "data-testid", "property-description"), ("section", "data-test-id", "property-description"), ("article", "", "")),
        },
        labels={
            "street": ("ulica", "adresa"), "town": ("mesto", "obec", "lokalita"), "area": ("okres",), "rooms": ("počet izieb", "izb"), "size": ("úžitkov", "uzitkov", "podlah", "plocha bytu", "plocha"), "state": ("stav", "status", "vyhotovenie"),
            "year": ("rok výstavby", "rok vystavby", "rok rekonštrukcie", "rok prestavby"), "year_top": ("rok kolaud", "kolaud"), "floor": ("podlaž", "poschod"), "energy": ("energet", "certifik"),
        },
    ),
    "reality_sk": Portal(
        texts={"description": (("*", "itemprop", "description"), ("*", "data-testid", "description"), ("*", "data-test-id", "description"), ("section", "class", "detail-text"), ("article", "", ""))},
        labels={
            "size": ("uzitkova plocha", "podlahova plocha"), "floor": ("podlazie",), "state": ("stav nehnutelnosti",), "year": ("rok vystavby",), "year_top": ("rok kolaudacie",),
            "energy": ("energeticky certifikat", "energeticky certifikat budovy"), "rooms": ("pocet izieb", "pocet izieb / miestnosti", "pocet spalni"), "price_area": ("cena za m2", "cena za m^2", "cena za m²"),
        },
        whole_labels=True, structured=True,
    ),
    "bazos_sk": Portal(
        texts={"title": (("span", "class", "nadpisdetail"), ("h1", "", "")), "price": (("span", "class", "cena"), ("div", "class", "inzeratycena")), "description": (("div", "class", "popisdetail"),)},
        labels={
            "rooms": ("izby", "pocet izieb", "dispozicia"), "size": ("plocha", "uzitkova plocha", "podlahova plocha"), "floor": ("poschodie",), "state": ("stav",), "year": ("rok vystavby",), "year_top": ("rok kolaudacie", "rok kolaud"),
            "energy": ("energeticky certifikat", "energeticka trieda"), "price_area": ("cena za m2", "cena za m"), "street": ("ulica",), "town": ("obec", "mesto"), "area": ("okres",), "region": ("kraj",),
        },
    ),
}


class Page(HTMLParser):
    """Texts of the marked elements, labelled values, pictures and JSON-LD documents of a page."""

    def __init__(self, portal: Portal) -> None:
        super().__init__(convert_charrefs=True)
        self.rules = [(name, i, rule) for name, rules in portal.texts.items() for i, rule in enumerate(rules)]
        self.found: dict[tuple[str, int], str] = {}
        self.tags: list[str] = []
        self.open: list[tuple[int, object, list[str]]] = []  # depth, what for, text
        self.fields: dict[str, str] = {}
        self.row: list[str] = []
        self.term = ""
        self.stack: list[str] | None = None
        self.photos: list[str] = []
        self.documents: list = []

    def handle_starttag(self, tag, attrs) -> None:
        own = {k: v or "" for k, v in attrs}
        if tag == "img":
            self.photos += [own]
        if tag in VOID:
            return
        self.tags.append(tag)
        for name, i, (want, attribute, part) in self.rules:
            if (name, i) not in self.found and want in ("*", tag) and (not attribute or part in own.get(attribute, "")):
                self.open.append((len(self.tags), (name, i), []))
        if tag == "tr":
            self.row = []
        elif tag == "div" and "MuiStack-root" in own.get("class", ""):
            self.stack = []
        if tag in ("td", "th", "dt", "dd") or (tag == "p" and own.get("data-test-id") == "text" and self.stack is not None) or (tag == "script" and own.get("type") == "application/ld+json"):
            self.open.append((len(self.tags), tag, []))

    def handle_data(self, data) -> None:
        hidden = self.tags and self.tags[-1] in ("script", "style")
        for _, kind, text in self.open:
            if kind == "script" or not hidden:
                text.append(data)

    def handle_endtag(self, tag) -> None:
        if tag not in self.tags:
            return
        while self.tags:
            depth, last = len(self.tags), self.tags.pop()
            for _, kind, text in [o for o in self.open if o[0] == depth]:
                self.close_element(kind, text)
            self.open = [o for o in self.open if o[0] != depth]
            if last == "div" and self.stack is not None:
                if len(self.stack) >= 2:
                    self.put(*self.stack[:2])
                self.stack = None
            if last == tag:
                return

    def close_element(self, kind, text: list[str]) -> None:
        whole = " ".join("".join(text).split())
        if isinstance(kind, tuple):
            lines = [" ".join(t.split()) for t in text]
            if whole:
                self.found.setdefault(kind, "\n".join(t for t in lines if t) if kind[0] == "description" else whole)
        elif kind == "script":
            try:
                self.documents.append(json.loads("".join(text), strict=False))
            except json.JSONDecodeError:
                pass
        elif kind == "dt":
            self.term = whole
        elif kind == "dd":
            self.put(self.term, whole)
        elif kind == "p":
            self.stack.append(whole) if self.stack is not None else None
        else:
            self.row.append(whole)
            if len(self.row) == 2:
                self.put(*self.row)

    def put(self, label: str, value: str) -> None:
        label = label.rstrip(":").strip().lower()
        if label:
            self.fields.setdefault(label, value)

    def text(self, name: str) -> str | None:
        hits = sorted((i, t) for (n, i), t in self.found.items() if n == name)
        return hits[0][1] if hits else None


def picture(own: dict[str, str]) -> str | None:
    """Address of an image: neither inline data nor a drawing."""
    for name in ("data-src", "data-original", "src", "data-srcset", "srcset"):
        value = own.get(name, "").strip()
        if name.endswith("srcset"):
            value = value.split(",")[0].strip().split(" ")[0]
        if value and not value.startswith("data:") and not value.lower().endswith(".svg"):
            return value
    return None


def descriptions(node) -> Iterator[str]:
    """All texts named description, outer ones first."""
    if isinstance(node, dict):
        if isinstance(node.get("description"), str) and node["description"].strip():
            yield node["description"].strip()
        for child in node.values():
            yield from descriptions(child)
    elif isinstance(node, list):
        for child in node:
            yield from descriptions(child)


def of_type(documents: list, *kinds: str) -> dict:
    """The first document whose @type is one of these."""
    for d in documents:
        named = d.get("@type") if isinstance(d, dict) else None
        if {str(t).lower() for t in (named if isinstance(named, list) else [named])} & set(kinds):
            return d
    return {}


def read_page(html: str | None, portal: Portal) -> dict:
    page = Page(portal)
    page.feed(OPEN_REFERENCE.sub(lambda m: m[1] or "&amp;", html or ""))
    page.close()
    product, home = of_type(page.documents, "product"), of_type(page.documents, "residence", "apartment", "singlefamilyresidence")
    inner = lambda d, k: d.get(k) if isinstance(d.get(k), dict) else {}
    address = inner(home, "address") or inner(product, "address")
    said = list(dict.fromkeys(descriptions(page.documents))) if portal.structured else next(([*descriptions(d)] for d in page.documents if [*descriptions(d)]), [])
    listed = [a for d in (home, product) for a in (d.get("amenityFeature") or []) if isinstance(a, dict) and a.get("name") and a.get("value") is not None]
    images = product.get("image") or []
    text = lambda v: None if v is None else str(v).strip()
    return {
        "texts": {n: t for n in portal.texts if (t := page.text(n))}, "fields": page.fields, "photos": list(dict.fromkeys(p for own in page.photos if (p := picture(own)))),
        "described": (said[0] if portal.structured else max(said, key=len)) if said else None,
        "name": text(product.get("name")), "street": text(address.get("streetAddress")), "town": text(address.get("addressLocality")), "area": text(address.get("addressRegion")),
        "floor_size": text(inner(home, "floorSize").get("value")), "price": text(inner(product, "offers").get("price")), "images": [str(i) for i in (images if isinstance(images, list) else [images]) if i],
        "amenities": {str(a["name"]): str(a["value"]).strip() for a in listed},
    }


def parsed(html: Column, portal: str) -> Column:
    """A page's parts, as a struct."""
    own = PORTALS[portal]

    @F.pandas_udf(PARSED)
    def run(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read_page(h, own) for h in pages], columns=[p.split()[0] for p in PARSED.split(", ")])

    return run(html)


def number(c: Column, many_points: bool = False) -> Column:
    """The text's digits and points as a whole number, halves to even; several points: the last one is the decimal one, or no number."""
    t = F.replace(F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9.,]", ""), F.lit(","), F.lit("."))
    if many_points:
        t = F.regexp_replace(t, r"\.(?=.*\.)", "")
    return F.rint(t.try_cast("double")).cast("long")


# Words of streets.
STREETS = ("ulica", "námestie", "namestie", "cesta", "trieda", "náb", "nabrezie", "sídlisko", "sidlisko", "nám.", "nam.", "alej")


DIGIT = r"[\p{Nd}\u00b2\u00b3\u00b9\u2070-\u2089]"


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def pieces(text: Column, mark: str) -> Column:
    """What stands between marks, without blank pieces."""
    return F.filter(F.transform(F.split(text, mark), trimmed), lambda p: p != "")


def street_like(part: Column) -> Column:
    """Has a number or a word of streets."""
    return part.rlike(DIGIT) | F.lower(part).rlike("|".join(re.escape(w) for w in STREETS))


def with_value(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def derived_address(location: Column, street: Column, town: Column, area: Column, city: Column) -> Column:
    """struct<street, town, area> of a listing, its town seen within the city.

    What the labels leave empty comes from `place - place, place, okres X`: the area is the part with a district, the street
    the first place, or what stands before its dash; the town the end of the last further place that is neither city nor
    street, else what follows the dash of the first, else the city. Null and empty texts have no parts.
    """
    location, street, town, area, home = (trimmed(F.coalesce(c, F.lit(""))) for c in (location, street, town, area, city))
    same = lambda a, b: F.lower(a) == F.lower(b)
    filled = lambda *texts: F.coalesce(*[F.nullif(t, F.lit("")) for t in texts], F.lit(""))
    district = lambda p: F.contains(F.lower(p), F.lit("okres"))
    first = lambda a, test: F.get(F.filter(a, test), F.lit(0))
    nameable = lambda p: ~same(p, home) & ~street_like(p)

    def split_up(v: Column) -> Column:
        places = F.filter(v["parts"], lambda p: ~district(p))
        ends = F.transform(places, lambda p: F.element_at(F.when(F.size(pieces(p, "-")) > 0, pieces(p, "-")).otherwise(F.array(p)), -1))
        head = F.get(places, F.lit(0))
        return F.struct(places.alias("places"), ends.alias("ends"), head.alias("head"), pieces(head, "-").alias("around"), filled(v["area"], first(v["parts"], district)).alias("area"))

    def street_of(v: Column) -> Column:
        dashed = (street == "") & (F.size(v["around"]) > 1)
        before, behind = F.get(v["around"], F.lit(0)), F.get(v["ends"], F.lit(0))
        own = F.when(dashed, F.when(street_like(before) | ~same(before, home), before)).otherwise(filled(street, v["head"]))
        return F.struct(v.alias("v"), filled(own).alias("street"), filled(F.when(dashed & nameable(behind), behind)).alias("behind"))

    def town_of(w: Column) -> Column:
        later = F.reverse(F.slice(w["v"]["ends"], 2, F.greatest(F.size(w["v"]["ends"]) - 1, F.lit(0))))
        found = filled(town, first(later, lambda e: nameable(e) & ~same(e, w["street"])), w["behind"], home)
        return F.struct(w.alias("w"), found.alias("town"))

    def settled(x: Column) -> Column:
        v = x["w"]["v"]
        own = filled(x["w"]["street"], first(v["places"], street_like), F.when(~same(v["head"], x["town"]), v["head"]))
        return F.struct(own.alias("street"), F.when(same(own, x["town"]), home).otherwise(x["town"]).alias("town"), v["area"].alias("area"))

    split = with_value(F.struct(pieces(location, ",").alias("parts"), area.alias("area")), split_up)
    found = with_value(with_value(with_value(split, street_of), town_of), settled)
    return with_value(found, lambda f: with_value(towns.within_city(city, f["town"], f["area"]), lambda put: F.struct(f["street"].alias("street"), put["town"].alias("town"), put["area"].alias("area"))))


def labelled(fields: Column, words: tuple[str, ...], whole: bool) -> Column:
    """Value of the first word that a label is or holds."""

    def hit(word: str) -> Column:
        test = (lambda e: fold(clean(e["key"])) == word) if whole else (lambda e: F.contains(F.lower(e["key"]), F.lit(word)))
        return F.nullif(F.trim(F.get(F.filter(F.map_entries(fields), test), F.lit(0))["value"]), F.lit(""))

    return F.coalesce(*[hit(w) for w in words])


def records(pages: DataFrame, portal: str, city_slug: str, transaction: str) -> DataFrame:
    """Raw listings (all columns text, absent ones null) of a portal's pages (url, html), one a page."""
    own = PORTALS[portal]
    d = pages.select("url", parsed(F.col("html"), portal).alias("p"))
    of = lambda name: F.col("p.texts")[name]
    table = F.col("p.amenities") if own.structured else F.col("p.fields")
    get = lambda name: labelled(table, own.labels[name], own.whole_labels) if name in own.labels else F.lit(None).cast("string")
    city = towns.city_of_slug(F.lit(city_slug))
    strict = portal == "nehnutelnosti_sk"
    told = of("description")
    title = F.col("p.name") if own.structured else F.coalesce(of("title"), F.regexp_replace(of("kind"), r"(?i)\s+na\s+(predaj|prenájom)$", ""))
    price, size = number(F.coalesce(F.col("p.price"), of("price")), strict), number(F.coalesce(F.col("p.floor_size"), get("size")), strict)
    rooms, state, floor, year, year_top, per_square = number(get("rooms"), strict), get("state"), get("floor"), number(get("year")), number(get("year_top")), number(get("price_area"))
    if strict:
        rooms = F.coalesce(extract.rooms_in(of("kind")).cast("long"), rooms)
        year, year_top = extract.year_in(get("year")).cast("long"), extract.year_in(get("year_top")).cast("long")
        where = derived_address(of("location"), get("street"), get("town"), get("area"), city)
    elif own.structured:
        town = F.when(F.lower(F.coalesce("p.town", F.lit(""))).isin("slovensko", "slovakia", ""), city).otherwise(F.col("p.town"))
        put = towns.within_city(city, town, F.col("p.area"))
        where = F.struct(F.col("p.street").alias("street"), put["town"].alias("town"), put["area"].alias("area"))
        per_square = F.coalesce(per_square, F.rint(F.try_divide(price, F.when(size > 0, size))).cast("long"))
    else:
        put = towns.within_city(city, F.coalesce(get("town"), city), F.concat_ws(", ", get("area"), get("region")))
        where = F.struct(get("street").alias("street"), put["town"].alias("town"), put["area"].alias("area"))
        price = F.coalesce(price, extract.price_in(told), extract.price_in(title))
        rooms = F.coalesce(extract.rooms_in(get("rooms")), extract.rooms_in(title), extract.rooms_in(told)).cast("long")
        size = F.rint(F.coalesce(extract.area_in(get("size")), extract.area_in(told), extract.area_in(title))).cast("long")
        floor, state = F.coalesce(floor, extract.floor_text(told)), F.coalesce(state, extract.state_in(told))
        year = F.coalesce(year, extract.year_after(told, ("rok vystavby", "postaven")))
        year_top = F.coalesce(year_top, extract.year_after(told, ("rok kolaud", "kolaud", "rekonštruk", "rekonstru")))
        per_square = F.coalesce(per_square, extract.price_per_square(told), F.rint(F.try_divide(price, F.when(size > 0, size))).cast("long"))
    pictures = F.when(F.size("p.images") > 0, F.col("p.images")).otherwise(F.transform("p.photos", lambda u: F.when(u.startswith("//"), F.concat(F.lit("https:"), u)).otherwise(extract.absolute(u, F.col("url")))))
    values = {
        "source": F.lit(portal), "transaction": F.lit(transaction), "property_id": extract.url_id(F.col("url")), "link": F.col("url"), "property_name": title, "description": F.coalesce("p.described", told, title),
        "address_street": where["street"], "address_town": where["town"], "address_zrea": where["area"], "room_number": rooms, "floor_area": size, "building_status": state, "year_of_construction": year, "year_of_top": year_top,
        "floor": floor, "energ_cert": get("energy"), "price": price, "price_area": per_square, **{f"photo_url_{i + 1}": F.get(pictures, F.lit(i)) for i in range(3)},
    }
    return d.select(*[F.nullif(values[c].cast("string"), F.lit("")).alias(c) for c in RAW_COLUMNS])
