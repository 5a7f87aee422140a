"""Staged views of the tables and the marts built on them; the ingredient is the key everywhere.

Prices are DECIMAL(18,2), so sums are exact and do not depend on the order in which tasks add them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cropledger.functions import text
from cropledger.operators import windows as W
from cropledger.sources.tables import parquet, written

DAYS, MONTHS = [7, 14, 30, 90, 180, 365], [1, 3, 6, 12]


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market reports: lineitem with the brand of its part as the ingredient. Both sides are pruned to what is used."""
    part = parquet(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("ingredient"), F.col("p_type").alias("ingredient_group"))
    line = parquet(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_shipdate").cast("date").alias("report_date"), F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), F.col("l_quantity").cast("decimal(18,2)").alias("amount"), F.col("l_returnflag").alias("unit"))
    return line.join(part, "l_partkey").drop("l_partkey")


def exact_mean(c: str):
    """Mean of DECIMAL(18,2) values, rounded half up at six places: the same on any engine and plan, and wide enough for any sum."""
    return (F.sum(c) / F.count(c).cast("decimal(20,0)")).cast("decimal(28,6)")


def mean_of_means(v):
    """The mean of DECIMAL values as a double, from their exact sum: the order in which tasks add does not show."""
    return F.sum(v).cast("double") / F.count(v)


def exact_std(c: str, w) -> Column:
    """Population standard deviation over a window of DECIMAL values with six places, from exact sums: no digits cancel."""
    q = (F.col(c) * 1_000_000).cast("decimal(19,0)")
    n = F.count(c).over(w)
    return F.sqrt((n * F.sum((q * q).cast("decimal(28,0)")).over(w) - F.sum(q).over(w) * F.sum(q).over(w)).cast("double")) / n / 1e6


def dollar_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily index: mean order value."""
    return parquet(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("ppi_date"), F.col("o_totalprice").cast("decimal(18,2)").alias("v")).groupBy("ppi_date").agg(exact_mean("v").alias("ppi"))


def daily_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ingredient, report_date, total, n, low, high): all that weeks and months are rolled up from, written once."""
    rep = reports(spark, sf_dir).groupBy("ingredient", "report_date")
    return written(rep.agg(F.sum("price").alias("total"), F.count("price").alias("n"), F.min("price").alias("low"), F.max("price").alias("high"), F.count("*").alias("n_rows")), "daily_sums")


def _mean_of_days() -> Column:
    return (F.sum("total") / F.sum("n").cast("decimal(20,0)")).cast("decimal(28,6)")


def monthly_index(daily: DataFrame) -> DataFrame:
    """(ingredient, ppi_date, ppi) by month, from daily_sums()."""
    return daily.groupBy("ingredient", F.date_trunc("month", "report_date").cast("date").alias("ppi_date")).agg(_mean_of_days().alias("ppi"))


def weekly_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly feature table, one row per ingredient and week; features look backward only.

    Reports are grouped to days before anything else, so lineitem is read once and a window holds a few hundred weeks of one
    ingredient. Weekly prices are exact decimals inside, so are sums over windows.
    """
    daily = daily_sums(spark, sf_dir)
    weekly = daily.groupBy("ingredient", text.week_of(F.col("report_date")).alias("week_start")).agg(
        _mean_of_days().alias("p"), F.min("low").cast("double").alias("price_min_weekly"), F.max("high").cast("double").alias("price_max_weekly"), F.sum("n_rows").alias("n_reports_in_week")
    )
    weekly = weekly.select("ingredient", "week_start", F.col("p").cast("double").alias("price_avg_weekly"), "price_min_weekly", "price_max_weekly", "n_reports_in_week", "p")
    by = Window.partitionBy("ingredient").orderBy("week_start")
    averages = {f"price_hist_avg_{n}w": F.sum("p").over(by.rowsBetween(-n, -1)).cast("double") / F.count("p").over(by.rowsBetween(-n, -1)) for n in (4, 12, 26, 52)}
    averages["price_hist_std_12w"] = exact_std("p", by.rowsBetween(-12, -1))
    featured = weekly.withColumns(W.lags("price_avg_weekly", by, [1, 2, 4, 8, 13, 26, 52], "price_lag_{n}w") | averages).drop("p")
    di = dollar_index(spark, sf_dir).groupBy(text.week_of(F.col("ppi_date")).alias("week_start")).agg(F.max_by("ppi", "ppi_date").cast("double").alias("di_ppi"))
    macro = monthly_index(daily).groupBy("ingredient", text.week_of(F.col("ppi_date")).alias("week_start")).agg(mean_of_means("ppi").alias("macro_ppi"))
    out = featured.join(di, "week_start", "left").join(macro, ["ingredient", "week_start"], "left")
    return out.withColumns({"year": F.year("week_start"), "week_of_year": F.weekofyear("week_start"), "month": F.month("week_start"), "quarter": F.quarter("week_start")})


def filled_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly price with the two indices carried forward, written once: what is built on it uses it several times."""
    by = Window.partitionBy("ingredient").orderBy("week_start")
    t = weekly_training(spark, sf_dir).select("ingredient", "week_start", "price_avg_weekly", "di_ppi", "macro_ppi", "week_of_year")
    return written(t.withColumns({"di_ppi": W.filled("di_ppi", by), "macro_ppi": W.filled("macro_ppi", by)}), "panel")


def dollar_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = dollar_index(spark, sf_dir).withColumn("series", F.lit("DOLLAR"))
    return W.forward_averages(one, ["series"], "ppi_date", "ppi", DAYS, "d", unique=True).withColumn("ppi", F.col("ppi").cast("double"))


def _named(df: DataFrame, column: str, name: str | None, part: str | None) -> DataFrame:
    """Rows whose column is name, or contains part; all rows without either. Both are plain text, not patterns."""
    df = df if name is None else df.where(F.col(column) == name)
    return df if part is None else df.where(F.col(column).contains(part))


def macro_mart(spark: SparkSession, sf_dir: str, name: str | None = None) -> DataFrame:
    """The monthly index with forward means; name keeps one ingredient."""
    daily = _named(daily_sums(spark, sf_dir), "ingredient", name, None)
    return W.forward_averages(monthly_index(daily), ["ingredient"], "ppi_date", "ppi", MONTHS, "mo", unique=True).withColumn("ppi", F.col("ppi").cast("double"))


def market_mart(spark: SparkSession, sf_dir: str, name: str | None = None) -> DataFrame:
    """Daily roll-up per ingredient and group, with forward means of the mean price. name keeps ingredients that contain it."""
    rep = _named(reports(spark, sf_dir), "ingredient", None, name)
    daily = rep.groupBy("ingredient", "ingredient_group", "report_date").agg(F.min("price").cast("double").alias("price_min"), F.max("price").cast("double").alias("price_max"), exact_mean("price").alias("price_avg"))
    out = W.forward_averages(daily, ["ingredient", "ingredient_group"], "report_date", "price_avg", DAYS, "d", unique=True)
    return out.withColumn("price_avg", F.col("price_avg").cast("double"))


def production_mart(spark: SparkSession, sf_dir: str, name: str | None = None) -> DataFrame:
    """Every production row with the forward means of its ingredient and unit; many rows share a date. name keeps ingredients that contain it."""
    rows = _named(reports(spark, sf_dir), "ingredient", None, name).select("ingredient", "unit", "report_date", "amount")
    return W.forward_averages(rows, ["ingredient", "unit"], "report_date", "amount", [7, 30], "d").withColumn("amount", F.col("amount").cast("double"))


#: Columns of a mapping, and of a market report, by which days are rolled up.
MAPPED = ["ingredient_id", "ingredient_group", "ingredient_description", "ingredient_name", "unit_of_measure", "fred_series_id"]
REPORTED = ["report_title", "ams_ingredient_name", "price_unit", "sale_type", "report_date"]
#: Most rows of a mapping that is broadcast (about 200 bytes each); a larger one is joined by a shuffle.
MAPPING_ROWS = 100_000


def _small(mapping: DataFrame) -> DataFrame:
    return F.broadcast(mapping) if mapping.count() <= MAPPING_ROWS else mapping


def mapped_index(mapping: DataFrame, index: DataFrame, name: str | None = None) -> DataFrame:
    """The monthly index of every mapped ingredient of its id, with forward means of each id's months; name keeps ingredients of exactly that name."""
    joined = index.join(_small(_named(mapping, "ingredient_name", name, None).select(*MAPPED)), "ingredient_id")
    return W.forward_averages(joined, ["ingredient_id"], "ppi_date", "ppi", MONTHS, "mo").withColumn("ppi", F.col("ppi").cast("double"))


def mapped_market(mapping: DataFrame, market: DataFrame, part: str | None = None) -> DataFrame:
    """Market reports of every mapped ingredient of their name, rolled up by day and all the columns of MAPPED and REPORTED.

    Reports are rolled up before the join, as several ingredients may bear a name. Forward means are of an ingredient_id's days.
    """
    daily = market.groupBy(*REPORTED).agg(F.min("price_min").alias("price_min"), F.max("price_max").alias("price_max"), exact_mean("price_avg").alias("price_avg"))
    joined = daily.join(_small(_named(mapping, "ingredient_name", None, part).select(*MAPPED)), F.col("ams_ingredient_name") == F.col("ingredient_name"))
    return W.forward_averages(joined, ["ingredient_id"], "report_date", "price_avg", DAYS, "d").withColumn("price_avg", F.col("price_avg").cast("double"))


def mapped_production(mapping: DataFrame, production: DataFrame, part: str | None = None) -> DataFrame:
    """Production rows of every mapped ingredient of their name and unit, with forward means of amount by load date."""
    joined = production.join(_small(_named(mapping, "ingredient_name", None, part).select(*MAPPED)), ["ingredient_name", "unit_of_measure"])
    return W.forward_averages(joined, ["ingredient_id"], "load_time", "amount", DAYS, "d").withColumn("amount", F.col("amount").cast("double"))


def index_of_name(index: DataFrame, mapping: DataFrame, name: str) -> DataFrame:
    """Rows of index (ingredient_id, ...) whose id the mapping gives to an ingredient of exactly that name."""
    ids = mapping.where(F.col("ingredient_name") == name).select("ingredient_id")
    return index.join(_small(ids), "ingredient_id", "left_semi")
