"""Numbers out of text, and arithmetic of listings, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plausible ranges; outside them a value counts as missing.
BLANKS = " \u00a0\u202f"
MIN_PRICE, SIZE_RANGE, YEAR_RANGE = 10_000, (10, 1000), (1800, 2100)


def finite(c: Column) -> Column:
    """NaN and infinities become null."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def plain(c: Column) -> Column:
    """Without blanks (also non-breaking ones), decimal comma as a point, empty as null."""
    return F.nullif(F.replace(F.translate(c, BLANKS, ""), F.lit(","), F.lit(".")), F.lit(""))


def to_float(c: Column) -> Column:
    return finite(plain(c).try_cast("double"))


def to_int(c: Column) -> Column:
    """Rounded half to even."""
    return F.rint(to_float(c)).cast("long")


def digits(c: Column) -> Column:
    """All digits of the text as one number; none or zero is null. Decimals aren't seen: 189000.0 is 1890000."""
    return F.nullif(F.regexp_replace(c, "[^0-9]", "").try_cast("long"), F.lit(0).cast("long"))


def digits_strict(c: Column) -> Column:
    """The first whole number of the text, decimals cut off."""
    return F.nullif(F.regexp_extract(F.regexp_replace(c, f"[{BLANKS}]", ""), r"(\d+)", 1).try_cast("long"), F.lit(0).cast("long"))


def decimal(c: Column) -> Column:
    """Digits and points of the text as one number; null with two points. Units aren't seen: 68 m2 is 682."""
    return F.regexp_replace(F.replace(c, F.lit(","), F.lit(".")), "[^0-9.]", "").try_cast("double")


def decimal_strict(c: Column) -> Column:
    """The first number of the text."""
    return F.regexp_extract(F.replace(F.regexp_replace(c, rf"(?<=\d)[{BLANKS}](?=\d)", ""), F.lit(","), F.lit(".")), r"(\d+(?:\.\d+)?)", 1).try_cast("double")


def coordinate(c: Column) -> Column:
    return finite(F.replace(F.trim(c), F.lit(","), F.lit(".")).try_cast("double"))


def positive(c: Column) -> Column:
    return F.when(c > 0, c)


def within(c: Column, low, high) -> Column:
    return F.when(c.between(low, high), c)


def clamp_price(c: Column, least: float = MIN_PRICE) -> Column:
    return F.when(c >= least, c)


def per_square(price: Column, size: Column) -> Column:
    return F.try_divide(price, positive(size))


def rooms_of_title(c: Column) -> Column:
    return F.nullif(F.regexp_extract(F.lower(F.coalesce(c, F.lit(""))), r"(\d)[-\s]?izb", 1), F.lit("")).cast("int")


def floor_parts(c: Column) -> Column:
    """struct<floor, total, elevator>; the elevator is true or unknown."""
    t = F.lower(F.coalesce(c, F.lit("")))
    lift = F.when(F.contains(t, F.lit("výťah")) | F.contains(t, F.lit("vytah")), True)
    head = F.regexp_replace(t, r"\+.*$", "")
    pair = lambda g: F.nullif(F.regexp_extract(head, r"(\d+)\s*/\s*(\d+)", g), F.lit("")).try_cast("int")
    single = F.nullif(F.regexp_extract(head, r"(\d+)", 1), F.lit("")).try_cast("int")
    return F.struct(F.coalesce(pair(1), single).alias("floor"), pair(2).alias("total"), lift.alias("elevator"))


def close(a: Column, b: Column, share: float = 0.03) -> Column:
    """Relative difference to the larger is at most `share`; nulls and non-positive values never match."""
    return F.coalesce((a > 0) & (b > 0) & (F.abs(a - b) <= share * F.greatest(a, b)), F.lit(False))


def bucket(c: Column) -> Column:
    return F.rint(c).cast("long")


def one_decimal(c: Column) -> Column:
    """'%.1f' with halves to even; null stays null."""
    return F.when(c.isNotNull(), F.format_string("%.1f", F.rint(c * 10) / 10))


def js_round(c: Column) -> Column:
    return F.floor(c + 0.5)
