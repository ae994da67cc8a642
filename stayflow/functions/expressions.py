"""Column expressions: clean text, numbers, ratios, laboratory strings, identifiers and time spans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number, a ratio, a threshold; words that stand for a missing laboratory value.
NUMBER = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"
RATIO = r"^\s*([0-9]+(?:[.,][0-9]+)?)\s*[:/]\s*([0-9]+(?:[.,][0-9]+)?)\s*$"
THRESHOLD = r"^\s*([<>])\s*([0-9]+(?:[.,][0-9]+)?)\s*$"
MISSING_WORDS = ("storniert", "storno", "kein material", "falsches mater.", "falsches mater", "fal.volumen", "geronnen", "entfällt", "entfaellt", "folgt")

HOUR_US = 3_600_000_000


def clean(c: Column | str) -> Column:
    """Trimmed text; blank text is null.

    Branches of a `when` are not shared, so each expression here names a costly part once.
    """
    text = _col(c).cast("string")
    return F.when(text.rlike(r"\S"), F.regexp_replace(text, r"^\s+|\s+$", ""))


def number(c: Column | str) -> Column:
    """A double where the trimmed text is a plain number, else null (so `1d` and `NaN` are null)."""
    text = _col(c).cast("string")  # the cast trims, too
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def comma_number(c: Column | str) -> Column:
    """A number with a decimal point or comma."""
    return number(F.regexp_replace(_col(c).cast("string"), ",", "."))


def ie_ratio(c: Column | str) -> Column:
    """`a:b` or `a/b` as a / b (null if b is 0), else a plain number."""
    text = _col(c).cast("string")
    a, b = (F.regexp_replace(F.regexp_extract(text, RATIO, i), ",", ".").try_cast("double") for i in (1, 2))
    return F.when(text.rlike(RATIO), F.try_divide(a, b)).otherwise(comma_number(c))


def laboratory(c: Column | str) -> Column:
    """`<x` as 0, `>x` as x, words for a missing value as null, else a number with point or comma."""
    text = _col(c).cast("string")
    word = F.lower(F.regexp_replace(clean(c), r"\s+", " "))
    limit = F.regexp_replace(F.regexp_extract(text, THRESHOLD, 2), ",", ".").try_cast("double")
    return F.when(word.isin(*MISSING_WORDS), F.lit(None)).when(text.rlike(THRESHOLD), F.when(F.regexp_extract(text, THRESHOLD, 1) == "<", 0.0).otherwise(limit)).otherwise(comma_number(c))


def local_stay_id(c: Column | str) -> Column:
    """Numeric ids in their shortest form (`0012` is `12`, `9990.0` is `9990`), other text trimmed."""
    text = _col(c).cast("string")
    exact = F.regexp_replace(text.try_cast("decimal(38,15)").cast("string"), r"\.0*$|(\.[0-9]*[1-9])0+$", "$1")
    return F.coalesce(F.when(text.rlike(NUMBER), exact), clean(text))


def global_stay_id(hospital: Column | str, local: Column | str) -> Column:
    """hospital and local id joined by an underscore; null if either is."""
    return F.concat(_col(hospital), F.lit("_"), _col(local))


UNITS = {"d": 24 * HOUR_US, "day": 24 * HOUR_US, "days": 24 * HOUR_US, "h": HOUR_US, "m": HOUR_US // 60, "min": HOUR_US // 60, "s": 1_000_000}
CLOCK = r"^(-?)(?:([0-9]+) days? ?)?([0-9]{1,2}):([0-9]{2}):([0-9]{2}(?:\.[0-9]+)?)$"
AMOUNT = r"^(-?[0-9]+(?:\.[0-9]+)?) ?(days|day|d|h|min|m|s)$"


def time_us(c: Column | str) -> Column:
    """Microseconds of `1 days 00:15:00`, `00:15:00`, `1 day`, `-1h`, `15 min`; null for other text."""
    text = clean(c)
    part = lambda i: F.coalesce(F.regexp_extract(text, CLOCK, i).try_cast("double"), F.lit(0.0))
    sign = F.when(F.regexp_extract(text, CLOCK, 1) == "-", -1).otherwise(1)
    clock = sign * (part(2) * 24.0 * HOUR_US + part(3) * float(HOUR_US) + part(4) * 60e6 + part(5) * 1e6)
    factor = F.create_map(*[F.lit(x) for pair in UNITS.items() for x in pair])
    amount = F.regexp_extract(text, AMOUNT, 1).try_cast("double") * F.element_at(factor, F.nullif(F.regexp_extract(text, AMOUNT, 2), F.lit("")))
    return F.when(text.rlike(CLOCK), F.round(clock)).when(text.rlike(AMOUNT), F.round(amount)).cast("long")


def time_text(us: Column | str) -> Column:
    """`0 days 00:15:00` of microseconds not below zero."""
    s = F.floor(_col(us) / 1_000_000)
    return F.format_string("%d days %02d:%02d:%02d", F.floor(s / 86400), F.floor(s / 3600) % 24, F.floor(s / 60) % 60, s % 60)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
