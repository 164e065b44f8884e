"""Links, attributes and figures out of pages and free text."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lotwise.functions.text import clean


def links(html: Column, pattern: str = r'<a\s[^>]*?href="([^"]+)"') -> Column:
    """Distinct link targets in order."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(pattern), F.lit(1)))


def absolute(link: Column, base: Column) -> Column:
    """A link with scheme and host of the base where it has none."""
    host = F.regexp_extract(base, r"^(https?://[^/?#]+)", 1)
    return F.when(F.rlike(link, F.lit("^https?://")), link).when(link.startswith("/"), F.concat(host, link)).otherwise(F.concat(host, F.lit("/"), link))


def normal_url(url: Column) -> Column:
    """Without query, fragment and trailing slash."""
    return F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"/+$", "")


def url_id(url: Column) -> Column:
    """The last number among the path's parts."""
    return F.nullif(F.regexp_extract(normal_url(url), r"/(\d+)[^/]*$", 1), F.lit(""))


def page_title(html: Column) -> Column:
    return F.nullif(clean(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))


def plain_text(html: Column) -> Column:
    """Visible text: without scripts, styles, comments and tags; usual entities decoded."""
    t = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)[^>]*>.*?</\1>|<!--.*?-->", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", " ")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        t = F.replace(t, F.lit(name), F.lit(char))
    return clean(t)


def images(html: Column, most: int = 3) -> Column:
    """The first image addresses that are neither drawings nor inline data."""
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r'(?:data-src|src)="([^"]+)"'), F.lit(1))
    return F.slice(F.array_distinct(F.filter(found, lambda u: ~F.rlike(u, F.lit(r"(?i)^data:|\.svg|\.js")))), 1, most)


def year_in(text: Column) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), r"\b((?:19|20)\d{2})\b", 1), F.lit("")).cast("int")


def area_in(text: Column) -> Column:
    """Square metres."""
    found = F.regexp_extract(F.lower(F.coalesce(text, F.lit(""))), r"(\d+(?:[.,]\d+)?)\s*m(?:2|²)", 1)
    return F.replace(found, F.lit(","), F.lit(".")).try_cast("double")


def rooms_in(text: Column) -> Column:
    return F.nullif(F.regexp_extract(F.lower(F.coalesce(text, F.lit(""))), r"(\d+)\s*-?\s*izb", 1), F.lit("")).try_cast("int")


def price_in(text: Column) -> Column:
    """The number before a euro sign or word."""
    found = F.regexp_extract(F.lower(F.coalesce(text, F.lit(""))), r"(\d[\d  ]*)\s*(?:€|eur)", 1)
    return F.nullif(F.regexp_replace(found, r"[^0-9]", ""), F.lit("")).try_cast("long")


def floor_in(text: Column) -> Column:
    """struct<floor, total>: a fraction, a numbered floor, or the ground floor as 0."""
    t = F.lower(F.coalesce(text, F.lit("")))
    part = lambda p, g: F.nullif(F.regexp_extract(t, p, g), F.lit("")).try_cast("int")
    fraction, word = r"(\d+)\s*/\s*(\d+)\s*(?:posch|p\.)", r"(\d+)\.?\s*(?:posch|podla)"
    ground = F.when(F.rlike(t, F.lit("prízem|prizem")), 0)
    return F.struct(F.coalesce(part(fraction, 1), part(word, 1), ground).alias("floor"), part(fraction, 2).alias("total"))


def floor_text(text: Column) -> Column:
    """`n/m`, `n` or `0` (ground floor) as texts tell it: a fraction, a numbered floor, the ground floor."""
    t = F.lower(F.coalesce(text, F.lit("")))
    part = lambda p, g=1: F.nullif(F.regexp_extract(t, p, g), F.lit(""))
    fraction = r"(\d+)\s*/\s*(\d+)"
    of = F.concat(F.lit("/"), part(r"z\s*(\d+)\s*(?:posch|np)"))
    with_total = lambda c: F.concat(c, F.coalesce(of, F.lit("")))
    return F.coalesce(F.concat(part(fraction), F.lit("/"), part(fraction, 2)), with_total(part(r"na\s*(\d+)\.\s*(?:poschod[ie]|np)")), with_total(F.when(F.rlike(t, F.lit("pr[ií]zem")), "0")))


def price_per_square(text: Column) -> Column:
    """The number before `€/m2`."""
    return F.nullif(F.regexp_extract(F.lower(F.coalesce(text, F.lit(""))), r"(\d{3,5})\s*(?:€|eur)\s*/\s*(?:m2|m²)", 1), F.lit("")).try_cast("long")


def year_after(text: Column, words: tuple[str, ...]) -> Column:
    """The year that follows the first of the words that has one."""
    t = F.lower(F.coalesce(text, F.lit("")))
    return F.coalesce(*[F.nullif(F.regexp_extract(t, rf"{w}[^\d]*((?:19|20)\d{{2}})", 1), F.lit("")).try_cast("long") for w in words])


# Words of a building's state in order, the first that occurs wins.
STATES = (
    ("novostav", "Novostavba"),
    ("komplet", "Kompletná rekonštrukcia"),
    ("rekonstr", "Rekonštrukcia"),
    ("rekonštr", "Rekonštrukcia"),
    ("čiastoč", "Čiastočná rekonštrukcia"),
    ("ciastoč", "Čiastočná rekonštrukcia"),
    ("čiastoc", "Čiastočná rekonštrukcia"),
    ("ciastoc", "Čiastočná rekonštrukcia"),
    ("pôvodn", "Pôvodný stav"),
    ("povodn", "Pôvodný stav"),
)


def state_in(text: Column) -> Column:
    t, out = F.lower(F.coalesce(text, F.lit(""))), F.lit(None).cast("string")
    for word, name in reversed(STATES):
        out = F.when(F.contains(t, F.lit(word)), name).otherwise(out)
    return out


class Pairs(HTMLParser):
    """Label and value pairs of definition lists, two-cell rows and 'label: value' list items."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: dict[str, str] = {}
        self.open, self.text, self.label, self.cells = None, "", None, []

    def handle_starttag(self, tag, attrs) -> None:
        if tag == "tr":
            self.cells = []
        if tag in ("dt", "dd", "th", "td", "li"):
            self.open, self.text = tag, ""

    def handle_data(self, data) -> None:
        if self.open:
            self.text += data

    def handle_endtag(self, tag) -> None:
        if tag == "tr" and len(self.cells) == 2:
            self.put(*self.cells)
        if tag != self.open:
            return
        value, self.open = " ".join(self.text.split()), None
        if tag == "dt":
            self.label = value
        elif tag == "dd" and self.label:
            self.put(self.label, value)
        elif tag in ("th", "td"):
            self.cells.append(value)
        elif tag == "li" and ":" in value:
            self.put(*value.split(":", 1))

    def put(self, label: str, value: str) -> None:
        label = label.strip().rstrip(":").lower()
        if label and label not in self.out:
            self.out[label] = value.strip()


def read_attributes(pages: pd.Series) -> pd.Series:
    def read(html):
        p = Pairs()
        p.feed(html or "")
        return p.out

    return pages.map(read)


def attributes(html) -> Column:
    """Attribute table of a page: a map of lower-case labels."""
    return F.pandas_udf(read_attributes, "map<string,string>")(html)


def attribute(found: Column, words: tuple[str, ...]) -> Column:
    """Value of the first label that holds one of the words."""
    hit = F.filter(F.map_entries(found), lambda e: F.rlike(e["key"], F.lit("|".join(words))))
    return F.get(hit, F.lit(0))["value"]


def json_ld(html: Column, schema: str) -> Column:
    """The first JSON-LD block parsed with a schema."""
    return F.from_json(F.regexp_extract(F.coalesce(html, F.lit("")), r'(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>', 1), schema)


# --- JSON-LD as data: every block of a page as a variant, no Python

LD_BLOCK = r"""(?is)<script[^>]*type\s*=\s*["']?application/ld\+json["']?[^>]*>(.*?)</script>"""


def ld_blocks(html: Column) -> Column:
    """array<variant>: the page's JSON-LD blocks in order; blocks that aren't JSON are left out, control characters in texts are blanks."""
    raw = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(LD_BLOCK), F.lit(1))
    parsed = F.transform(raw, lambda t: F.try_parse_json(F.regexp_replace(t, r"[\x00-\x1F]", " ")))
    return F.filter(parsed, lambda v: v.isNotNull())


def ld_types(block: Column) -> Column:
    """The block's @type values in lower case; a block that isn't an object has none."""
    at = "$['@type']"
    many = F.try_variant_get(block, at, "array<string>")
    one = F.array(F.try_variant_get(block, at, "string"))
    found = F.when(F.startswith(F.schema_of_variant(F.try_variant_get(block, at, "variant")), F.lit("ARRAY")), many).otherwise(one)
    return F.transform(F.filter(F.coalesce(found, F.array().cast("array<string>")), lambda t: t.isNotNull()), lambda t: F.lower(F.trim(t)))


def ld_of_type(blocks: Column, *kinds: str) -> Column:
    """The first block of one of these types."""
    return F.get(F.filter(blocks, lambda b: F.arrays_overlap(ld_types(b), F.array(*[F.lit(k) for k in kinds]))), F.lit(0))


def ld_text(block: Column, *paths: str) -> Column:
    """The first non-blank text at one of the paths."""
    return F.coalesce(*[F.nullif(F.trim(F.try_variant_get(block, p, "string")), F.lit("")) for p in paths])


def item_urls(html: Column) -> Column:
    """Links of the page's first ItemList: of each element its main entity's url, else its own; elements without one are left out."""
    elements = F.try_variant_get(ld_of_type(ld_blocks(html), "itemlist"), "$.itemListElement", "array<variant>")
    return F.array_compact(F.transform(F.coalesce(elements, F.array().cast("array<variant>")), lambda e: ld_text(e, "$.mainEntity.url", "$.url")))


def ld_listing(html: Column) -> Column:
    """struct of what a page's product and residence blocks say: name, price, currency, street, town, images, amenities (name -> value)."""
    blocks = ld_blocks(html)
    product, home = ld_of_type(blocks, "product"), ld_of_type(blocks, "residence", "apartment", "singlefamilyresidence")
    either = lambda *paths: F.coalesce(ld_text(home, *paths), ld_text(product, *paths))
    image = F.try_variant_get(product, "$.image", "array<string>")
    one = F.array_compact(F.array(ld_text(product, "$.image")))
    images = F.when(F.startswith(F.schema_of_variant(F.try_variant_get(product, "$.image", "variant")), F.lit("ARRAY")), image).otherwise(one)
    features = F.coalesce(F.try_variant_get(home, "$.amenityFeature", "array<variant>"), F.try_variant_get(product, "$.amenityFeature", "array<variant>"), F.array().cast("array<variant>"))
    pairs = F.filter(F.transform(features, lambda f: F.struct(ld_text(f, "$.name").alias("key"), ld_text(f, "$.value").alias("value"))), lambda p: p["key"].isNotNull() & p["value"].isNotNull())
    return F.struct(
        ld_text(product, "$.name").alias("name"), F.try_variant_get(product, "$.offers.price", "double").alias("price"), ld_text(product, "$.offers.priceCurrency").alias("currency"),
        either("$.address.streetAddress").alias("street"), either("$.address.addressLocality").alias("town"), F.coalesce(images, F.array().cast("array<string>")).alias("images"), pairs.alias("amenities"),
    )
