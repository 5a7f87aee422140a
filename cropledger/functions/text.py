"""Cleaning of text, numbers, dates and codes as column expressions. A null gives null unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that stand for "no value".
PLACEHOLDERS = ["(D)", "(NA)", "(Z)", "NOT SPECIFIED", "NOT AVAILABLE", "N/A", "NA", "TOTAL"]
#: Units to their singular.
UNITS = {"TONS": "TON", "BALES": "BALE", "BUSHELS": "BU", "GALLONS": "GALLON", "BARRELS": "BARREL", "DOZENS": "DOZEN"}
#: Commodity names to the usual one.
SYNONYMS = {"SOYBEANS": "SOYBEAN", "SUNFLOWER SEEDS": "SUNFLOWER"}
#: Frequency codes.
FREQUENCIES = {"A": "annual", "SA": "semiannual", "Q": "quarterly", "M": "monthly", "BW": "biweekly", "W": "weekly", "D": "daily"}


def _lookup(values: dict[str, str], c: Column) -> Column:
    """values[c], or null; a chain of comparisons stays inside generated code."""
    out = F.lit(None).cast("string")
    for k, v in values.items():
        out = F.when(c == k, v).otherwise(out)
    return out


def collapse(c: Column) -> Column:
    """Upper case, runs of any Unicode white space as one space, none at the ends."""
    return F.upper(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")))


def no_marks(c: Column) -> Column:
    """Runs of dashes, commas and full stops as one space, then collapse()."""
    return collapse(F.regexp_replace(c, "[-–—,.]+", " "))


def no_placeholder(c: Column) -> Column:
    return F.when(c.isin(PLACEHOLDERS), "").otherwise(c)


def singular_unit(c: Column) -> Column:
    return F.coalesce(_lookup(UNITS, c), c)


def usual_name(c: Column) -> Column:
    return F.coalesce(_lookup(SYNONYMS, c), c)


def frequency(c: Column) -> Column:
    """A code's name, an unknown code in lower case, and unknown if there is none."""
    return F.coalesce(_lookup(FREQUENCIES, c), F.lower(F.nullif(c, F.lit(""))), F.lit("unknown"))


def number(c: Column, places: int = 4) -> Column:
    """Text to a number without thousands commas; what is not a number is null."""
    return F.round(F.regexp_replace(F.trim(c), ",", "").try_cast("double"), places)


def to_date(c: Column) -> Column:
    """ISO dates first, then month/day/year; other text is null."""
    return F.coalesce(c.try_cast("date"), F.try_to_date(c, "M/d/yyyy"))


def no_series(c: Column) -> Column:
    return F.when(F.upper(c) != "NO PPI AVAILABLE", c)


def null_tokens(c: Column) -> Column:
    """Empty text and a lone full stop are null."""
    return F.nullif(F.nullif(F.trim(c), F.lit(".")), F.lit(""))


def week_of(c: Column) -> Column:
    return F.date_trunc("week", c).cast("date")


def clip(c: Column, lo: float, hi: float) -> Column:
    """c within [lo, hi]; null stays null."""
    return F.when(c < lo, F.lit(float(lo))).when(c > hi, F.lit(float(hi))).otherwise(c)


def classify(c: Column, steps: list[tuple], lowest: str) -> Column:
    """The label of the first (threshold, label) that c reaches, thresholds falling."""
    out = None
    for at, label in steps:
        out = F.when(c >= at, label) if out is None else out.when(c >= at, label)
    return out.otherwise(F.when(c.isNotNull(), lowest))
