"""Staged tables from raw ones whose columns are all text. What cannot be read as a number or date is null, never an error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropledger.functions import text
from cropledger.operators import windows as W

#: Columns of a raw market report that are kept in upper case, and the names they get.
MARKET_TEXT = {
    "report_title": "report_title", "cat": "ams_ingredient_group", "grade": "ams_ingredient_grade", "price_unit": "price_unit", "sale Type": "sale_type", "delivery_point": "delivery_point",
    "freight": "freight", "trans_mode": "trans_mode", "market_location_state": "market_location_state",
}
#: Price columns of a raw market report.
MARKET_PRICES = {"price Min": "price_min", "price Max": "price_max", "avg_price": "price_avg"}


def _col(name: str):
    return F.col(f"`{name}`")


def price_index(raw: DataFrame, key: str, key_type: str, *carried: str) -> DataFrame:
    """(key, carried..., ppi, ppi_date, ppi_frequency) of raw rows that hold a value; a full stop is none."""
    value = text.null_tokens(F.col("ppi"))
    return raw.where(value.isNotNull()).select(F.col(key).try_cast(key_type).alias(key), *carried, value.try_cast("double").alias("ppi"), text.to_date(F.col("date")).alias("ppi_date"), "frequency").withColumnRenamed("frequency", "ppi_frequency")


def market_reports(raw: DataFrame) -> DataFrame:
    """Market report details: names in upper case and the usual form, prices to four places, dates in either layout."""
    return raw.select(
        F.col("slug_id").try_cast("int").alias("slug_id"), text.usual_name(F.upper(F.trim("commodity"))).alias("ams_ingredient_name"),
        *(F.upper(F.trim(_col(c))).alias(to) for c, to in MARKET_TEXT.items()), *(text.number(text.null_tokens(_col(c))).alias(to) for c, to in MARKET_PRICES.items()), text.to_date(F.col("report_date")).alias("report_date"),
    )


def production(raw: DataFrame) -> DataFrame:
    """Production rows: amounts without thousands commas, withheld amounts null, load times as dates."""
    return raw.select(
        F.col("CLASS_DESC").alias("ingredient_name"), F.col("UNIT_DESC").alias("unit_of_measure"), text.number(F.col("VALUE")).alias("amount"), text.number(_col("CV_%")).alias("cv_pct"), F.col("YEAR").try_cast("int").alias("year"),
        F.col("FREQ_DESC").alias("frequency"), F.col("REFERENCE_PERIOD_DESC").alias("range"), F.col("LOAD_TIME").try_cast("timestamp_ntz").cast("date").alias("load_time"), F.col("STATE_ALPHA").alias("state"), F.col("COUNTRY_NAME").alias("country"),
    )


def mapping(raw: DataFrame) -> DataFrame:
    """Ingredients and their series; 'no ppi available' in any case is no series."""
    return raw.select(F.col("ingredient_id").try_cast("int").alias("ingredient_id"), "ingredient_group", "ingredient_description", "ingredient_name", "unit_of_measure", text.no_series(F.col("fred_series_id")).alias("fred_series_id"))


def master(parts: list[DataFrame], units: list[str]) -> DataFrame:
    """Distinct (group, description, name, unit) of raw production tables of different layouts, cleaned.

    A null is an empty text. Rows without a group, description or unit, and of units that are not among units, go; an
    empty name stays.
    """
    names = {"GROUP_DESC": "ingredient_group", "COMMODITY_DESC": "ingredient_description", "CLASS_DESC": "ingredient_name", "UNIT_DESC": "unit_of_measure"}
    every = parts[0]
    for other in parts[1:]:
        every = every.unionByName(other, allowMissingColumns=True)
    clean = every.select(*(F.coalesce(text.no_placeholder(text.no_marks(F.col(c)) if c != "UNIT_DESC" else text.collapse(F.col(c))), F.lit("")).alias(to) for c, to in names.items()))
    clean = clean.withColumn("unit_of_measure", text.singular_unit(F.col("unit_of_measure")))
    whole = (F.col("ingredient_group") != "") & (F.col("ingredient_description") != "") & F.col("unit_of_measure").isin([u for u in units if u])
    return clean.where(whole).dropDuplicates(list(names.values()))


def product_master(parts: list[DataFrame], units: list[str]) -> DataFrame:
    """master() with ingredient_id, from 10001 on in the order of group, description, name and unit."""
    order = ["ingredient_group", "ingredient_description", "ingredient_name", "unit_of_measure"]
    return W.row_ids(master(parts, units), order).withColumnRenamed("id", "ingredient_id")
