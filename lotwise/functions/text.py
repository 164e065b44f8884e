"""String cleaning of listing fields, as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Latin letters with marks and their plain forms, for the native fold.
MARKED = "áäàâãåāăąćčçďđéëèêēėęěğíïìîīįłĺľńňñóöòôõőøōřŕśšşťţúüùûūůűųýÿžźżßÁÄÀÂÃÅĀĂĄĆČÇĎĐÉËÈÊĒĖĘĚĞÍÏÌÎĪĮŁĹĽŃŇÑÓÖÒÔÕŐØŌŘŔŚŠŞŤŢÚÜÙÛŪŮŰŲÝŸŽŹŻ"
PLAIN = "aaaaaaaaacccddeeeeeeeegiiiiiilllnnnoooooooorrsssttuuuuuuuuyyzzzsAAAAAAAAACCCDDEEEEEEEEGIIIIIILLLNNNOOOOOOOORRSSSTTUUUUUUUUYYZZZ"


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def clean(c: Column) -> Column:
    """Null becomes empty; runs of white space (Unicode) become one blank."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def slug(c: Column) -> Column:
    """Lower case, runs that aren't word characters become _; letters keep their marks."""
    return F.btrim(F.regexp_replace(F.lower(clean(c)), r"(?U)[^\w]+", "_"), F.lit("_"))


def fold(c: Column) -> Column:
    """Latin letters without marks, lower case: the native form of fold_exact."""
    return F.lower(F.translate(F.coalesce(c, F.lit("")), MARKED, PLAIN))


def fold_all(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else "".join(x for x in unicodedata.normalize("NFKD", t) if not unicodedata.combining(x)).lower())


def fold_exact(c: Column) -> Column:
    """NFKD without combining marks, lower case, for any script."""
    return F.pandas_udf(fold_all, "string")(c)


def dash_slug(c: Column) -> Column:
    """a-z, 0-9 and dashes, for links."""
    return F.btrim(F.regexp_replace(fold(c), "[^a-z0-9]+", "-"), F.lit("-"))


def one_line(c: Column) -> Column:
    """For CSV cells: line breaks become blanks, runs of blanks become one."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\r\n]", " "), r"[ \t]{2,}", " "))


def title(c: Column) -> Column:
    """A capital after everything that isn't a letter: Košice-Juh, O'Neil."""
    parts = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p)))), "")


def street(c: Column) -> Column:
    return F.nullif(clean(F.regexp_replace(clean(c), r"(?i)^Ulica\s+", "")), F.lit(""))


def town(c: Column) -> Column:
    """Country names aren't towns."""
    t = clean(c)
    return F.when((t != "") & ~F.lower(t).isin("slovensko", "slovakia"), title(t))


def district(c: Column) -> Column:
    """`okres X` of an area text."""
    return F.nullif(title(F.trim(F.regexp_extract(clean(c), r"(?i)okres\s+([\p{L}\s-]+)", 1))), F.lit(""))


def region(c: Column) -> Column:
    """`X kraj` of an area text."""
    return F.nullif(title(F.trim(F.regexp_extract(clean(c), r"(?i)([\p{L}\s-]+)\s+kraj", 1))), F.lit(""))


def join_address(*parts: Column) -> Column:
    return F.concat_ws(", ", *[F.nullif(p, F.lit("")) for p in parts])


def transaction(c: Column) -> Column:
    """Sale words become sale, blank becomes unknown, others pass."""
    t = F.lower(clean(c))
    return F.when(t == "predaj", "sale").when(t == "", "unknown").otherwise(t)


# Spellings of the two kinds of transaction.
SALE, RENT = ("predaj", "sale", "sell"), ("prenajom", "prenájom", "rent", "lease")


def transaction_kind(c: Column) -> Column:
    t = F.lower(clean(c))
    return F.when(t.isin(*SALE), "predaj").when(t.isin(*RENT), "prenajom").otherwise(F.nullif(t, F.lit("")))


# Spellings of building states, and their labels.
BUILDING = {
    "novostavba": "new",
    "kompletná rekonštrukcia": "renovated-full",
    "kompletna rekonstrukcia": "renovated-full",
    "čiastočná rekonštrukcia": "renovated-partial",
    "ciastocna rekonstrukcia": "renovated-partial",
}


def building_status(c: Column) -> Column:
    pairs = [F.lit(x) for kv in BUILDING.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[clean(F.lower(c))], F.lit("unknown"))


def energy_class(c: Column) -> Column:
    """A to G; `none` where blank or denied; else `unknown`."""
    t = clean(c)
    first = F.upper(F.substring(t, 1, 1))
    return F.when((t == "") | F.contains(F.lower(t), F.lit("nie")), "none").when(first.between("A", "G"), first).otherwise("unknown")


def photo_token(url: Column) -> Column:
    """A-Z, a-z and 0-9 of the last part of a link's path, without the sizing mark `_fss`."""
    path = F.regexp_replace(F.coalesce(url, F.lit("")), r"[?#].*$", "")
    path = F.regexp_replace(path, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/]*", "")
    name = F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), ";.*$", "")
    return F.nullif(F.regexp_replace(F.replace(name, F.lit("_fss"), F.lit("")), "[^A-Za-z0-9]", ""), F.lit(""))


def photo_tokens(*urls: Column) -> Column:
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*[photo_token(u) for u in urls]))))


def token_list(c: Column) -> Column:
    """A JSON array or a scalar as trimmed, non-empty, distinct strings in order."""
    t = F.trim(F.coalesce(c, F.lit("")))
    parsed = F.when(t.startswith("["), F.from_json(t, "array<string>")).otherwise(F.array(t))
    return F.array_distinct(F.filter(F.transform(F.coalesce(parsed, F.array(t)), lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != "")))


def strip_fences(c: Column) -> Column:
    """Text inside a fenced code block, or the text."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(c), r"^```[a-zA-Z]*\s*", ""), r"\s*```$", ""))


def cache_key(c: Column) -> Column:
    return F.sha1(F.trim(F.coalesce(c, F.lit(""))).cast("binary"))


def answers(c: Column) -> Column:
    """map id -> text of a batch answer: a JSON array of objects, or an object with such an array as `items`, in a code fence or not.

    The id is `id`, else `listing_id`; the text `summary_short_sk`, else `summary`, without blanks and quotes around it. Entries
    without either are left out, the last of an id counts; an answer of another form has none.
    """
    parsed = F.try_parse_json(strip_fences(c))
    entries = F.coalesce(F.try_variant_get(parsed, "$.items", "array<variant>"), F.try_variant_get(parsed, "$", "array<variant>"), F.array().cast("array<variant>"))
    of = lambda e, *names: F.coalesce(*[F.nullif(F.try_variant_get(e, f"$.{n}", "string"), F.lit("")) for n in names])
    pairs = F.transform(entries, lambda e: F.struct(of(e, "id", "listing_id").alias("key"), of(e, "summary_short_sk", "summary").alias("value")))
    pairs = F.reverse(F.filter(pairs, lambda p: p["key"].isNotNull() & p["value"].isNotNull()))
    keys = F.transform(pairs, lambda p: p["key"])
    last = F.filter(pairs, lambda p, i: F.array_position(keys, p["key"]) == i + 1)
    return F.map_from_entries(F.reverse(F.transform(last, lambda p: F.struct(p["key"].alias("key"), F.btrim(F.trim(p["value"]), F.lit('" ')).alias("value")))))
