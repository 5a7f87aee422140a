"""Backtest, landed cost, disruption, risk and seasonal tables over the weekly panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cropledger.functions.text import classify, clip
from cropledger.operators import windows as W
from cropledger.plans.panel import filled_panel

#: Cost parameters and score weights.
COST = {"miles": 200.0, "load": 1000.0, "mpg": 6.5, "diesel": 3.80, "gas": 3.50, "mmbtu": 0.002, "days": 30.0, "rate": 0.0525, "margin": 0.12}
LEVELS = [(90, "EMERGENCY"), (75, "HIGH"), (60, "MODERATE")]
RISKS = [(80, "CRITICAL"), (60, "HIGH"), (40, "MODERATE"), (20, "LOW")]
SHOCKS = [("diesel", s) for s in (-0.2, -0.1, 0.1, 0.2)] + [("nat_gas", s) for s in (-0.2, -0.1, 0.1, 0.2)] + [("fed_funds", s) for s in (-0.5, -0.25, 0.25, 0.5)] + [("miles", s) for s in (-0.2, 0.2)]
HORIZONS = 13


def weeks():
    """The rows of an ingredient in time order; made on demand, as a window needs a session."""
    return Window.partitionBy("ingredient").orderBy("week_start")


def transport(diesel: Column, miles: Column | float = COST["miles"]) -> Column:
    miles = miles if isinstance(miles, Column) else F.lit(miles)
    return (miles / COST["mpg"] * diesel + miles * 2.5) / COST["load"]


def carry(price: Column, rate: Column | float = COST["rate"]) -> Column:
    return price * rate / 365.0 * COST["days"]


def targets(panel: DataFrame) -> DataFrame:
    """Long form: the price h weeks ahead for each h of 1 to 13; rows without a target are left out."""
    wide = panel.select("ingredient", "week_start", "price_avg_weekly", *(F.lead("price_avg_weekly", h).over(weeks()).alias(f"h{h}") for h in range(1, HORIZONS + 1)))
    long = wide.unpivot(["ingredient", "week_start", "price_avg_weekly"], [f"h{h}" for h in range(1, HORIZONS + 1)], "h", "target")
    return long.withColumn("horizon", F.substring("h", 2, 2).cast("int")).drop("h").where("target is not null")


def naive_backtest(panel: DataFrame) -> DataFrame:
    """Mean over five expanding folds of the errors of y(t + h) = y(t), by ingredient and horizon."""
    key = Window.partitionBy("ingredient", "horizon")
    t = targets(panel).withColumn("i", F.row_number().over(key.orderBy("week_start")) - 1).withColumn("n", F.count("*").over(key))
    size = F.floor(F.col("n") / 6)
    t = t.withColumn("fold", F.floor((F.col("i") - (F.col("n") - 5 * size)) / size)).where((F.col("i") >= F.col("n") - 5 * size) & (size > 0))
    e = F.col("target") - F.col("price_avg_weekly")
    folds = t.groupBy("ingredient", "horizon", "fold").agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e) / F.abs(F.col("target"))).alias("mape"))
    return folds.groupBy("ingredient", "horizon").agg(*(F.avg(c).alias(c) for c in ("mae", "rmse", "mape")), F.count("*").alias("folds"))


def drift_backtest(panel: DataFrame) -> DataFrame:
    """Direction hits and skill of the trailing four-week mean as a forecast, against the naive one."""
    m = panel.withColumn("guess", F.avg("price_avg_weekly").over(weeks().rowsBetween(-3, 0)))
    t = targets(panel).join(m.select("ingredient", "week_start", "guess"), ["ingredient", "week_start"])
    hit = (F.signum(F.col("guess") - F.col("price_avg_weekly")) == F.signum(F.col("target") - F.col("price_avg_weekly"))).cast("int")
    a = t.groupBy("ingredient", "horizon").agg(F.avg(hit).alias("direction"), F.avg(F.abs(F.col("target") - F.col("guess"))).alias("mae"), F.avg(F.abs(F.col("target") - F.col("price_avg_weekly"))).alias("base"))
    return a.withColumn("skill", F.when(F.col("base") > 0, 1 - F.col("mae") / F.col("base"))).drop("base")


def landed_cost(panel: DataFrame) -> DataFrame:
    """Cost parts, total, selling price at the target margin. A price index below 50 counts as 50, a mean below 1 as 1."""
    whole = Window.partitionBy("ingredient")
    diesel = COST["diesel"] * (F.avg("di_ppi").over(whole) / F.greatest(F.col("di_ppi"), F.lit(50.0)))
    gas = COST["gas"] * (F.col("macro_ppi") / F.greatest(F.avg("macro_ppi").over(whole), F.lit(1.0)))
    t = panel.withColumns({"diesel": F.when(F.col("di_ppi").isNotNull(), diesel), "gas": gas})
    t = t.withColumns({"transport_cost": transport(F.col("diesel")), "energy_cost": F.col("gas") * COST["mmbtu"], "carry_cost": carry(F.col("price_avg_weekly"))})
    t = t.withColumn("total_landed_cost", F.col("price_avg_weekly") + F.col("transport_cost") + F.col("energy_cost") + F.col("carry_cost"))
    t = t.withColumn("implied_sell_price", F.col("total_landed_cost") / (1 - COST["margin"]))
    t = t.withColumn("gross_margin_usd", F.col("implied_sell_price") - F.col("total_landed_cost"))
    return t.withColumn("gross_margin_pct", F.col("gross_margin_usd") / F.col("implied_sell_price") * 100)


def cost_shares(cost: DataFrame) -> DataFrame:
    """(ingredient, week_start, part, usd, share_pct): the parts of the last week's landed cost."""
    parts = {"commodity": "price_avg_weekly", "transport": "transport_cost", "energy": "energy_cost", "carry": "carry_cost"}
    last = cost.groupBy("ingredient").agg(F.max_by(F.struct("week_start", "total_landed_cost", *parts.values()), "week_start").alias("s")).select("ingredient", "s.*")
    long = last.select("ingredient", "week_start", "total_landed_cost", *(F.col(c).alias(p) for p, c in parts.items())).unpivot(["ingredient", "week_start", "total_landed_cost"], list(parts), "part", "usd")
    share = F.when(F.col("total_landed_cost") > 0, F.col("usd") / F.col("total_landed_cost") * 100).otherwise(0.0)
    return long.select("ingredient", "week_start", "part", "usd", share.alias("share_pct"))


def shock_rows(cost: DataFrame, shock_pct: int = 20) -> DataFrame:
    """(ingredient, label, usd): the last week's landed cost, and under each driver's shock of shock_pct, where it has one."""
    last = cost.groupBy("ingredient").agg(F.max("week_start").alias("week_start"))
    now = cost.join(last, ["ingredient", "week_start"], "left_semi")
    moved = scenarios(now).where(F.col("shock_pct") == shock_pct).join(now.select("ingredient", "total_landed_cost"), "ingredient")
    base = now.select("ingredient", F.lit("base").alias("label"), F.col("total_landed_cost").alias("usd"))
    return base.unionByName(moved.select("ingredient", F.concat("driver", F.lit(f" +{shock_pct}%")).alias("label"), (F.col("total_landed_cost") + F.col("delta_tlc")).alias("usd")))


def scenarios(cost: DataFrame) -> DataFrame:
    """Each row of landed_cost() under each of the fourteen shocks: change of the total, in money and percent."""
    spark = cost.sparkSession
    shocks = spark.createDataFrame(SHOCKS, "driver string, shock double")
    is_ = lambda d: F.col("driver") == d
    t = cost.crossJoin(F.broadcast(shocks))  # fourteen fixed rows
    up = 1 + F.col("shock")
    moved = (
        transport(F.when(is_("diesel"), F.col("diesel") * up).otherwise(F.col("diesel")), F.when(is_("miles"), COST["miles"] * up).otherwise(COST["miles"]))
        + F.when(is_("nat_gas"), F.col("gas") * up).otherwise(F.col("gas")) * COST["mmbtu"]
        + carry(F.col("price_avg_weekly"), F.when(is_("fed_funds"), F.greatest(F.lit(0.0), COST["rate"] + F.col("shock") * 0.01)).otherwise(COST["rate"]))
        + F.col("price_avg_weekly")
    )
    return t.select("ingredient", "week_start", "driver", F.round(F.col("shock") * 100).cast("int").alias("shock_pct"), (F.round(moved - F.col("total_landed_cost"), 4) + 0.0).alias("delta_tlc"), (F.round((moved / F.col("total_landed_cost") - 1) * 100, 4) + 0.0).alias("delta_pct"))


def _z(x: str, centre: Column, spread: Column) -> Column:
    z = (F.col(x) - centre) / F.when(spread < 1e-6, 1e-6).otherwise(spread)
    return clip(50 + clip(z, -3, 3) * 15, 0, 100)


def disruption(panel: DataFrame) -> DataFrame:
    t = panel.withColumns({"c1": W.change("price_avg_weekly", weeks(), 1), "c4": W.change("price_avg_weekly", weeks(), 4), "c12": W.change("price_avg_weekly", weeks(), 12), "c26": W.change("price_avg_weekly", weeks(), 26), "s12": W.change("macro_ppi", weeks(), 12)})
    t = t.withColumns({"gap": F.coalesce("s12", F.lit(0.0)) - F.coalesce("c12", F.lit(0.0)), "momentum": F.col("c4") - F.col("c26")})
    r = lambda c, n, least, f: W.rolling(F.col(c), weeks(), n, least, f)
    # Each window is a column of its own first: the scores use them several times.
    t = t.withColumns({
        "m1": W.rolling_median(F.col("macro_ppi"), weeks(), 52, 13), "d1": r("macro_ppi", 52, 13, F.stddev_samp), "m2": r("gap", 52, 4, F.avg), "d2": r("gap", 52, 4, F.stddev_samp),
        "m3": r("momentum", 52, 4, F.avg), "d3": r("momentum", 52, 4, F.stddev_samp), "v12": r("c1", 12, 4, F.stddev_samp), "v52": r("c1", 52, 12, F.stddev_samp),
    })
    ratio = F.when(F.col("v52").isNotNull(), clip(F.col("v12") / F.greatest(F.col("v52"), F.lit(1e-6)), 0, 5))
    t = t.withColumns({
        "score_supply_deviation": _z("macro_ppi", F.col("m1"), F.col("d1")), "score_price_gap": _z("gap", F.col("m2"), F.col("d2")),
        "score_price_momentum": _z("momentum", F.col("m3"), F.col("d3")), "score_volatility_spike": clip(ratio / 3 * 100, 0, 100),
    })
    total = F.col("score_supply_deviation") * 0.3 + F.col("score_price_gap") * 0.3 + F.col("score_price_momentum") * 0.2 + F.col("score_volatility_spike") * 0.2
    t = t.withColumn("disruption_score", clip(total, 0, 100)).withColumn("level", classify(F.col("disruption_score"), LEVELS, "LOW"))
    return t.select("ingredient", "week_start", "price_avg_weekly", "disruption_score", "score_supply_deviation", "score_price_gap", "score_price_momentum", "score_volatility_spike", "level")


def risk(panel: DataFrame, weights: tuple[float, ...] = (0.3, 0.3, 0.2, 0.2), places: int = 9) -> DataFrame:
    """The four risks as percentile ranks of what they are read from, and their weighted mean; weights are divided by their sum.

    Ratios that agree to `places` places are ties in a rank: without that, ranks would depend on the order of additions.
    """
    r = lambda c, n, least, f: W.rolling(F.col(c), weeks(), n, least, f)
    t = panel.withColumn("c1", W.change("price_avg_weekly", weeks(), 1))
    t = t.withColumns({
        "longer": r("price_avg_weekly", 52, 12, F.avg), "shorter": r("price_avg_weekly", 13, 4, F.avg), "vol": F.coalesce(r("c1", 26, 4, F.stddev_samp), F.lit(0.0)),
        "year": F.coalesce(W.change("macro_ppi", weeks(), 52), F.lit(0.0)), "half": F.coalesce(W.change("price_avg_weekly", weeks(), 26), F.lit(0.0)),
    })
    t = t.withColumns({
        "r1": F.when(F.col("longer").isNotNull(), F.round(clip(F.col("shorter") / F.greatest(F.col("longer"), F.lit(1e-6)), 0.5, 2.0), places)),
        "r2": F.round("year", places),
        "r3": -F.col("di_ppi"),
        "r4": F.round(-F.col("half") * (1 - clip(F.col("vol"), 0, 0.1) / 0.1), places),
    })
    names = ["supply_risk", "cost_risk", "logistics_risk", "demand_risk"]
    t = W.expanding_ranks(t, "ingredient", "week_start", {n: f"r{i}" for i, n in enumerate(names, 1)})
    whole = sum(weights)
    total = sum((F.col(n) * (w / whole) for n, w in zip(names[1:], weights[1:])), F.col(names[0]) * (weights[0] / whole))
    t = t.withColumn("composite_risk", clip(total, 0, 100)).withColumn("level", classify(F.col("composite_risk"), RISKS, "MINIMAL"))
    return t.select("ingredient", "week_start", "price_avg_weekly", "composite_risk", *names, "level")


def as_of(df: DataFrame, day: str | None) -> DataFrame:
    """Rows of weeks that start at or before day, a date as text; all rows without one."""
    return df if day is None else df.where(F.col("week_start") <= F.lit(day).cast("date"))


def latest(df: DataFrame, n: int, value: str, day: str | None = None) -> DataFrame:
    """(ingredient, week_start, value, trend): the last row of each ingredient, at or before day if one is given, and its last n values, oldest first."""
    w = weeks().rowsBetween(1 - n, 0)
    return as_of(df, day).withColumn("trend", F.collect_list(value).over(w)).groupBy("ingredient").agg(F.max_by(F.struct("week_start", value, "trend"), "week_start").alias("s")).select("ingredient", "s.*")


#: Colour and action of each level of disruption.
ALERTS = {
    "EMERGENCY": ("#d32f2f", "Emergency sourcing action required"), "HIGH": ("#f57c00", "Procurement review recommended"),
    "MODERATE": ("#fbc02d", "Monitor closely — informational alert"), "LOW": ("#388e3c", "No action required"),
}
DISRUPTIONS = ["score_supply_deviation", "score_price_gap", "score_price_momentum", "score_volatility_spike"]
RISK_WEIGHTS = {"supply_risk": 0.3, "cost_risk": 0.3, "logistics_risk": 0.2, "demand_risk": 0.2}


def current_alert(scored: DataFrame, day: str | None = None) -> DataFrame:
    """The last row of disruption() of each ingredient, at or before day, with its level, colour and action, components, and the last 12 scores."""
    w = weeks().rowsBetween(-11, 0)
    t = as_of(scored, day).withColumn("trend", F.collect_list("disruption_score").over(w))
    last = t.groupBy("ingredient").agg(F.max_by(F.struct("week_start", "disruption_score", *DISRUPTIONS, "level", "trend"), "week_start").alias("s")).select("ingredient", "s.*")
    alert = F.create_map(*(F.lit(x) for level, (colour, action) in ALERTS.items() for x in (level, f"{colour}|{action}")))
    told = F.split(alert[F.col("level")], r"\|")
    return last.withColumn("alert", F.struct("level", told[0].alias("colour"), told[1].alias("action"))).drop("level")


def radar(scored: DataFrame, weights: dict[str, float] = RISK_WEIGHTS, day: str | None = None) -> DataFrame:
    """(ingredient, week_start, dimension, score, weight): the dimensions of the last row of risk() at or before day."""
    last = as_of(scored, day).groupBy("ingredient").agg(F.max_by(F.struct("week_start", *weights), "week_start").alias("s")).select("ingredient", "s.*")
    share = F.create_map(*(F.lit(x) for k, v in weights.items() for x in (k, v / sum(weights.values()))))
    return last.unpivot(["ingredient", "week_start"], list(weights), "dimension", "score").withColumn("weight", share[F.col("dimension")])


#: Colour and action of each level of risk.
RISK_ALERTS = {
    "CRITICAL": ("#b71c1c", "Immediate escalation required"), "HIGH": ("#d32f2f", "Senior procurement review"), "MODERATE": ("#f57c00", "Active monitoring"),
    "LOW": ("#fbc02d", "Routine monitoring"), "MINIMAL": ("#388e3c", "No action required"),
}
#: Weights of the components of disruption and the thresholds of its alerts, as its document states them.
COMPONENT_WEIGHTS = {"supply_deviation": 0.3, "price_gap": 0.3, "price_momentum": 0.2, "volatility_spike": 0.2}
THRESHOLDS = {"informational": 60, "procurement_review": 75, "emergency_action": 90}


def _alert(alerts: dict[str, tuple[str, str]], level: Column, **more: Column) -> Column:
    """struct<level, colour, action, ...> of a level."""
    of = lambda i: F.create_map(*(F.lit(x) for name, told in alerts.items() for x in (name, told[i])))[level]
    return F.struct(level.alias("level"), of(0).alias("colour"), of(1).alias("action"), *(c.alias(n) for n, c in more.items()))


def current_risk(scored: DataFrame, weights: dict[str, float] = RISK_WEIGHTS, day: str | None = None) -> DataFrame:
    """The last row of risk() of each ingredient, at or before day: its dimensions, classification (level, colour, action, score), the last 12 composites and the radar."""
    w = weeks().rowsBetween(-11, 0)
    t = as_of(scored, day).withColumn("trend", F.collect_list("composite_risk").over(w))
    last = t.groupBy("ingredient").agg(F.max_by(F.struct("week_start", "composite_risk", *weights, "level", "trend"), "week_start").alias("s")).select("ingredient", "s.*")
    whole = sum(weights.values())
    shares = F.array(*(F.struct(F.lit(k).alias("dimension"), F.round(k, 2).alias("score"), F.lit(v / whole).alias("weight")) for k, v in weights.items()))
    return last.withColumns({"classification": _alert(RISK_ALERTS, F.col("level"), score=F.round("composite_risk", 1)), "radar": shares}).drop("level")


def _struct_of(values: dict) -> Column:
    return F.struct(*(F.lit(v).alias(k) for k, v in values.items()))


def _rounded_trend() -> Column:
    return F.transform("trend", lambda x: F.round(x, 2))


def disruption_documents(scored: DataFrame, day: str | None = None) -> DataFrame:
    """A nested row per ingredient: its score, alert, components, their weights, the alerts' thresholds and the last 12 scores."""
    parts = F.struct(*(F.round(f"score_{c}", 2).alias(c) for c in COMPONENT_WEIGHTS))
    return current_alert(scored, day).select(
        "ingredient", F.col("week_start").alias("as_of"), F.round("disruption_score", 2).alias("composite_score"), "alert", parts.alias("components"),
        _struct_of(COMPONENT_WEIGHTS).alias("weights"), _struct_of(THRESHOLDS).alias("thresholds"), _rounded_trend().alias("trend_12w"),
    )


def risk_documents(scored: DataFrame, weights: dict[str, float] = RISK_WEIGHTS, day: str | None = None) -> DataFrame:
    """A nested row per ingredient: its risk, classification, dimensions, weights as shares, the last 12 composites and the radar."""
    whole = sum(weights.values())
    return current_risk(scored, weights, day).select(
        "ingredient", F.col("week_start").alias("as_of"), F.round("composite_risk", 2).alias("composite_risk"), "classification", F.struct(*(F.round(k, 2).alias(k) for k in weights)).alias("dimensions"),
        _struct_of({k: v / whole for k, v in weights.items()}).alias("weights"), _rounded_trend().alias("trend_12w"), "radar",
    )


def purchase_documents(stats: DataFrame, plan: DataFrame, panel: DataFrame, volume: float = 1_000_000.0) -> DataFrame:
    """A nested row per ingredient: its price, seasonal statistics by week, and the summary of its schedule with the weeks flagged as cheap."""
    now = panel.groupBy("ingredient").agg(F.max_by("price_avg_weekly", "week_start").alias("current_price"))
    weekly = stats.groupBy("ingredient").agg(F.array_sort(F.collect_list(F.struct("week_of_year", "p25", "median", "p75", "mean", "seasonal_factor"))).alias("seasonal_stats"))
    flagged = plan.where("opportunistic_flag").groupBy("ingredient").agg(F.array_sort(F.collect_list("week_index")).alias("weeks"))
    total = schedule_totals(plan, volume).join(flagged, "ingredient", "left")
    none = F.array().cast("array<int>")
    summary = F.struct(F.lit(volume).alias("annual_volume"), F.round("optimised_cost", 2).alias("total_cost"), F.round("flat_cost", 2).alias("naive_cost"), F.round("saving_pct", 2).alias("saving_pct"), F.coalesce("weeks", none).alias("opportunistic_buy_weeks"))
    return total.select("ingredient", summary.alias("optimiser_summary")).join(now, "ingredient").join(weekly, "ingredient")


def weekly_grid(panel: DataFrame) -> DataFrame:
    """A row for every week between the first and last of an ingredient, the price carried forward, numbered from 0."""
    ends = panel.groupBy("ingredient").agg(F.min("week_start").alias("a"), F.max("week_start").alias("b"))
    grid = ends.select("ingredient", F.explode(F.sequence("a", "b", F.expr("interval 7 days"))).alias("week_start"))
    t = grid.join(panel.select("ingredient", "week_start", "price_avg_weekly"), ["ingredient", "week_start"], "left")
    return t.select("ingredient", "week_start", W.filled("price_avg_weekly", weeks()).alias("price"), (F.row_number().over(weeks()) - 1).alias("i"))


def seasonal(grid: DataFrame) -> DataFrame:
    """grid with trend and seasonal parts of period 52: a centred mean with half weights at its ends, lines fitted to the
    nearest 51 trend points beyond it, and mean deviations by position less their mean; 0 with fewer than 104 weeks."""
    key = Window.partitionBy("ingredient")
    w = weeks().rowsBetween(-26, 26)
    # Prices have six places at most, so sums of decimals are exact and their order does not show.
    p = F.col("price").cast("decimal(28,6)")
    centred = (F.sum(p).over(w) * 2 - F.first(p).over(w) - F.last(p).over(w)).cast("double") / 104
    t = grid.withColumn("n", F.count("*").over(key)).withColumn("inner", F.when(F.count("price").over(w) == 53, centred))
    x, y = F.col("i").cast("double"), F.col("inner")
    head, tail = (F.col("i") >= 26) & (F.col("i") <= 76), (F.col("i") <= F.col("n") - 27) & (F.col("i") >= F.col("n") - 77)
    lines = t.groupBy("ingredient").agg(*(f(F.when(c, y), F.when(c, x)).alias(name) for f, c, name in ((F.regr_slope, head, "sa"), (F.regr_intercept, head, "ia"), (F.regr_slope, tail, "sb"), (F.regr_intercept, tail, "ib"))))
    t = t.join(lines, "ingredient").withColumn("trend", F.coalesce("inner", F.when(F.col("i") < 26, F.col("ia") + F.col("sa") * x).otherwise(F.col("ib") + F.col("sb") * x)))
    means = t.groupBy("ingredient", (F.col("i") % 52).alias("p")).agg(F.avg(F.col("price") - F.col("trend")).alias("dev"))
    means = means.withColumn("seasonal", F.col("dev") - F.avg("dev").over(key))
    t = t.withColumn("p", F.col("i") % 52).join(means.drop("dev"), ["ingredient", "p"])
    return t.select("ingredient", "week_start", "price", F.when(F.col("n") >= 104, F.col("trend")).alias("trend"), F.when(F.col("n") >= 104, F.col("seasonal")).otherwise(0.0).alias("seasonal"))


def seasonal_stats(parts: DataFrame) -> DataFrame:
    """Quartiles, mean and mean seasonal factor by ISO week 1 to 52."""
    q = F.percentile("price", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    t = parts.groupBy("ingredient", F.weekofyear("week_start").alias("week_of_year")).agg(q.alias("q"), F.avg("price").alias("mean"), F.avg("seasonal").alias("seasonal_factor")).where("week_of_year <= 52")
    return t.select("ingredient", "week_of_year", F.col("q")[0].alias("p25"), F.col("q")[1].alias("median"), F.col("q")[2].alias("p75"), "mean", "seasonal_factor")


def price_curve(stats: DataFrame, panel: DataFrame) -> DataFrame:
    """52 weeks ahead from the week of the last price, medians scaled so that their mean is that price."""
    last = panel.groupBy("ingredient").agg(F.max_by("price_avg_weekly", "week_start").alias("now"), F.weekofyear(F.max("week_start")).alias("start"))
    mid = stats.groupBy("ingredient").agg(F.avg("median").alias("mid"))
    ahead_of = last.join(mid, "ingredient").withColumn("week_index", F.explode(F.sequence(F.lit(1), F.lit(52)))).withColumn("week_of_year", F.pmod(F.col("start") - 2 + F.col("week_index"), F.lit(52)) + 1)
    t = ahead_of.join(stats, ["ingredient", "week_of_year"], "left")
    scale = F.when(F.col("mid") > 0, F.col("now") / F.col("mid")).otherwise(1.0)
    at = lambda c, k: F.coalesce(F.col(c), F.col("now") * k) * scale
    return t.select("ingredient", "week_index", "week_of_year", at("median", 1.0).alias("expected_price"), at("p25", 0.95).alias("p25_price"), at("p75", 1.05).alias("p75_price"), F.coalesce("seasonal_factor", F.lit(0.0)).alias("seasonal_factor"))


def schedule(curve: DataFrame, volume: float = 1_000_000.0, least: float = 0.005, most: float = 0.10, ahead: float = 0.2) -> DataFrame:
    """Cheapest purchases of each ingredient's 52 weeks within weekly bounds and prefix limits: a fold over an ingredient's 52 weeks in one row.

    Every week takes the lower bound; then, by rising price, as much as its bound and the slack of all later prefixes
    allow, which is optimal for nested limits. If that falls short of the volume it is split evenly.
    """

    lo, hi = volume * least, volume * most
    others = [c for c in curve.columns if c != "ingredient"]
    rows = curve.groupBy("ingredient").agg(F.array_sort(F.collect_list(F.struct("week_index", *(c for c in others if c != "week_index")))).alias("weeks"))
    rows = rows.withColumns({"n": F.size("weeks"), "cheapest": F.array_sort(F.transform("weeks", lambda w, i: F.struct(w["expected_price"].alias("price"), i.alias("i"))))})
    # State: what each week buys, the slack of each prefix, and what is bought in all.
    limit = lambda k: F.least((k + 1) / F.col("n") * (1 + ahead), F.lit(1.0)) * volume
    start = F.struct(
        F.transform("weeks", lambda _: F.lit(lo)).alias("q"), F.transform("weeks", lambda _, k: limit(k) - (k + 1) * lo).alias("slack"), (F.col("n") * lo).alias("sum"),
    )

    def buy(state: Column, week: Column) -> Column:
        at = week["i"]
        most_more = F.greatest(F.lit(0.0), F.least(F.lit(hi - lo), F.array_min(F.slice(state["slack"], at + 1, F.col("n"))), volume - state["sum"]))
        after = lambda more: F.struct(
            F.transform(state["q"], lambda x, k: F.when(k == at, x + more).otherwise(x)).alias("q"),
            F.transform(state["slack"], lambda x, k: F.when(k >= at, x - more).otherwise(x)).alias("slack"), (state["sum"] + more).alias("sum"),
        )
        return F.element_at(F.transform(F.array(most_more), after), 1)

    rows = rows.withColumn("state", F.aggregate("cheapest", start, buy))
    short = (F.array_min("state.slack") < -1e-6) | (F.abs(F.col("state.sum") - volume) > 1e-6 * volume)
    even = F.least(F.greatest(volume / F.col("n"), F.lit(lo)), F.lit(hi))
    bought = F.transform("state.q", lambda x: F.when(short, even / (even * F.col("n")) * volume).otherwise(x))
    t = rows.select("ingredient", F.explode(F.arrays_zip("weeks", bought.alias("bought"))).alias("z"))
    t = t.select("ingredient", *(F.col(f"z.weeks.{c}").alias(c) for c in others), F.col("z.bought").alias("recommended_purchase")).select(*curve.columns, "recommended_purchase")
    w = Window.partitionBy("ingredient").orderBy("week_index").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("total_cost", F.col("recommended_purchase") * F.col("expected_price"))
    t = t.withColumns({"cumulative_purchase": F.sum("recommended_purchase").over(w), "cumulative_cost": F.sum("total_cost").over(w)})
    return t.withColumn("opportunistic_flag", (F.col("expected_price") < F.col("p25_price")) & (F.col("recommended_purchase") < 0.9 * volume * most))


def schedule_totals(t: DataFrame, volume: float = 1_000_000.0) -> DataFrame:
    """Costs of the schedule and of even purchases, the saving, and the cheapest and dearest weeks, the first of those that tie."""
    a = t.groupBy("ingredient").agg(F.sum("total_cost").alias("optimised_cost"), (F.avg("expected_price") * volume).alias("flat_cost"), F.min_by("week_of_year", F.struct("expected_price", "week_index")).alias("trough_week"), F.max_by("week_of_year", F.struct("expected_price", -F.col("week_index"))).alias("peak_week"))
    return a.withColumn("saving_pct", (1 - F.col("optimised_cost") / F.col("flat_cost")) * 100)


def panel_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filled_panel(spark, sf_dir)
