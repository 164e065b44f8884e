"""Text similarity that SQL can't express, as pandas UDFs used after every cheaper test."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def matching(a: str, b: str) -> int:
    """Length of the longest common subsequence; a row of the table is one whole number, a bit for each character of a."""
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full  # a zero bit: the subsequence grows here
    for y in b:
        hit = row & at.get(y, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """0 to 100 by insertions and deletions."""
    whole = len(a) + len(b)
    return 200.0 * matching(a, b) / whole if whole else 100.0


def token_set(a: str, b: str) -> int:
    """Best ratio among the shared words and each side's sorted words; 100 if one side's words are all shared."""
    x, y = set(a.lower().split()), set(b.lower().split())
    if not x or not y:
        return 0
    both = " ".join(sorted(x & y))
    if both and (x <= y or y <= x):
        return 100
    one, two = (" ".join(filter(None, [both, " ".join(sorted(s))])) for s in (x - y, y - x))
    return int(max(ratio(one, two), *([ratio(both, one), ratio(both, two)] if both else [0.0])))


def token_sets(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else token_set(x, y) for x, y in zip(a, b, strict=True)], dtype="Int32")


def near_slug(a: str, b: str) -> bool:
    return bool(a and b) and (a == b or a in b or b in a or difflib.SequenceMatcher(None, a, b).ratio() >= 0.8)


def near_slugs(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([near_slug(x or "", y or "") for x, y in zip(a, b, strict=True)])


def token_set_ratio(a, b):
    """0 to 100; null where a side is null."""
    return F.pandas_udf(token_sets, "int")(a, b)


def word_set(c: Column) -> Column:
    """Distinct lower-case words, in order; words end at any blank."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.lower(c), r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")))


def token_set_bounds(x: Column, y: Column) -> tuple[Column, Column]:
    """(least, most) that token_set_ratio() can be, from both sides' word sets alone.

    Shared words begin both sorted texts, so their ratio to either side follows from lengths; the ratio of the sides to one another
    is at most what the shorter one allows.
    """
    length = lambda a: F.char_length(F.array_join(a, " "))
    both = F.array_intersect(x, y)
    shared, one, two = length(both), length(x), length(y)
    of = lambda a, b: F.floor(200.0 * a / F.greatest(a + b, F.lit(1))).cast("int")
    some = F.size(both) > 0
    whole = some & ((F.size(both) == F.size(x)) | (F.size(both) == F.size(y)))
    least = F.when(whole, 100).when(some, of(shared, F.least(one, two))).otherwise(0)
    most = F.when((F.size(x) == 0) | (F.size(y) == 0), 0).when(whole, 100).otherwise(F.greatest(least, of(F.least(one, two), F.greatest(one, two))))
    return least, most


def close_slugs(a, b):
    """City slugs that are equal, contain one another or are nearly the same."""
    return F.pandas_udf(near_slugs, "boolean")(a, b)
