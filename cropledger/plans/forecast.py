"""Forecasts of the weekly price 1 to 13 weeks ahead, their bands, errors and feature importance, for all ingredients at once.

Each horizon has a model of its own, fitted on the pooled panel: boosted one-split trees over binned features, of which a horizon takes
those that look back at least as far as it looks ahead. They predict the relative change of the price, so ingredients of any price
level share them. Such a model needs no more of its rows than how often two bins meet and the sum of changes in each bin, so one pass over
the rows gives these counts for every horizon and fold, and each fit reads the counts alone. Weeks are split by time: the first 85%
are fitted, the last 15% give the errors. The first 85% are cut in six stretches; each of five expanding folds is fitted on
the targets before a stretch and predicts from the weeks in it. These out-of-fold errors give the bands. No model predicts from a week
that is not past all it was fitted on, and bins are cut by the first stretch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropledger.functions.text import classify
from cropledger.operators import selection
from cropledger.operators import windows as W
from cropledger.plans import scores
from cropledger.sources.tables import written

LAGS, MEANS = (1, 2, 4, 8, 13, 26, 52), (4, 12, 26, 52)
LEVELS = [*(f"price_lag_{n}w" for n in LAGS), *(f"price_hist_avg_{n}w" for n in MEANS), "price_hist_std_12w"]
FEATURES = [*LEVELS, "di_change", "macro_change", "week_of_year"]
#: Fewest fitted rows for a horizon; a horizon with fewer is left out.
LEAST = 60
#: Share of an ingredient's weeks that is fitted, and the expanding folds in it.
FITTED, FOLDS = 0.85, 5
#: Bins of a feature; rounds of boosting, the share of each step that is taken, rows by which leaves are shrunk, and the fewest in a leaf.
BINS = 16
ROUNDS, RATE, SHRINK, LEAF = 150, 0.1, 20.0, 10
#: Changes are added up as whole millionths, of 100% at most, so that sums do not depend on their order.
UNIT = 1_000_000
#: Permutations that importance() averages.
REPEATS = 5
#: Levels of quick_risk().
QUICK = [(66, "HIGH"), (33, "MODERATE")]
TREES = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.2, "maxBins": 32, "subsamplingRate": 1.0, "seed": 7}


def features(weekly: DataFrame) -> DataFrame:
    """weekly_training() with its price levels as ratios to the price and the indices as changes over 12 rows.

    Rows with a null, NaN or infinite feature are dropped; the first 52 weeks of an ingredient are such rows.
    """
    by, price = scores.weeks(), F.col("price_avg_weekly")
    t = weekly.withColumns({c: W.filled(c, by) for c in ("di_ppi", "macro_ppi")})
    t = t.withColumns({"di_change": W.change("di_ppi", by, 12), "macro_change": F.coalesce(W.change("macro_ppi", by, 12), F.lit(0.0))})
    t = t.select("ingredient", "week_start", "price_avg_weekly", *(F.try_divide(F.col(c), price).alias(c) for c in LEVELS), "di_change", "macro_change", F.col("week_of_year").cast("double").alias("week_of_year"))
    finite = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf")) for c in t.columns if c not in ("ingredient", "week_start")]
    for ok in finite:
        t = t.where(ok)
    return t.where(price > 0)


def lag_safe(names: list[str], horizon: int) -> list[str]:
    """Names without the features that look back fewer weeks than the horizon (price_lag_<n>w and the like)."""
    return [c for c in names if not (c.endswith("w") and c.rsplit("_", 1)[1][:-1].isdigit() and int(c.rsplit("_", 1)[1][:-1]) < horizon)]


def numeric_columns(df: DataFrame, drop: tuple[str, ...] = ()) -> list[str]:
    """Names of the numeric columns of df by its schema, without those of drop."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in drop]


def usable_rows(feat: DataFrame, weekly: DataFrame) -> DataFrame:
    """(horizon, feature, n_rows): the features by schema that lag_safe() leaves a horizon, and the rows with a target there."""
    names = numeric_columns(feat, ("price_avg_weekly",))
    safe = F.create_map(*(x for h in range(1, scores.HORIZONS + 1) for x in (F.lit(h), F.array(*map(F.lit, lag_safe(names, h))))))
    t = scores.targets(weekly.select("ingredient", "week_start", "price_avg_weekly")).join(feat.select("ingredient", "week_start"), ["ingredient", "week_start"])
    return t.groupBy("horizon").agg(F.count("*").alias("n_rows")).select("horizon", F.explode(safe[F.col("horizon")]).alias("feature"), "n_rows")


def safe_at_horizon(t: DataFrame) -> DataFrame:
    """t with every feature that lag_safe() drops at a row's horizon blanked: 1, the ratio that tells nothing."""
    safe = {h: lag_safe(LEVELS, h) for h in range(1, scores.HORIZONS + 1)}
    until = {c: max((h for h, names in safe.items() if c in names), default=0) for c in LEVELS}
    return t.withColumns({c: F.when(F.col("horizon") <= n, F.col(c)).otherwise(1.0) for c, n in until.items()})


class Trained(NamedTuple):
    """Fitted models with the written tables that their forecasts, bands and errors are made of.

    models: horizon, fold (FOLDS + 1 is the final one), base, values (for each feature its bins' parts); edges: the upper ends of each feature's bins.
    """

    models: DataFrame
    edges: dict[str, list[float]]
    features: DataFrame
    rows: DataFrame
    out_of_fold: DataFrame


def rows(feat: DataFrame, weekly: DataFrame) -> DataFrame:
    """A row per ingredient, week and horizon with a target, with `since` and `fold` by the ranks of its weeks.

    since is the first fold that may be fitted on the row (FOLDS + 1: the final model alone; null: none) and follows the
    target's week; fold is the one that predicts the row out of fold (0: none) and follows its own week. Rows of the last
    weeks have fold -1 and are for errors. Ranks are within an ingredient.
    """
    placed = feat.withColumns({"i": F.row_number().over(scores.weeks()), "n": F.count("*").over(Window.partitionBy("ingredient"))})
    t = scores.targets(weekly.select("ingredient", "week_start", "price_avg_weekly")).drop("price_avg_weekly").join(placed, ["ingredient", "week_start"])
    stretch = F.col("n") * FITTED / (FOLDS + 1)
    since = F.ceil((F.col("i") + F.col("horizon")) / stretch).cast("int")
    inside = since <= FOLDS + 1
    fold = F.when(inside, F.ceil(F.col("i") / stretch).cast("int") - 1).when(F.col("i") > F.col("n") * FITTED, -1)
    t = t.withColumns({"since": F.when(inside, since), "fold": fold, "change": F.col("target") / F.col("price_avg_weekly") - 1})
    fitted = t.where("since is not null").groupBy("horizon").agg(F.count("*").alias("_n")).where(F.col("_n") >= LEAST).select("horizon")
    return t.where("fold is not null").join(F.broadcast(fitted), "horizon").drop("i", "n")  # at most thirteen rows


def bin_edges(feat: DataFrame, names: list[str]) -> dict[str, list[float]]:
    """The BINS - 1 exact percentiles between the bins of each feature, over the first stretch of each ingredient's weeks."""
    key = Window.partitionBy("ingredient")
    early = feat.withColumns({"i": F.row_number().over(key.orderBy("week_start")), "n": F.count("*").over(key)}).where(F.col("i") <= F.col("n") * FITTED / (FOLDS + 1))
    long = early.select(*(F.col(c).cast("double").alias(c) for c in names)).unpivot([], names, "feature", "value")
    found = {r.feature: sorted(set(r.q)) for r in selection.percentiles(long, ["feature"], "value", [i / BINS for i in range(1, BINS)]).collect()}  # a row a feature
    return {c: found.get(c, []) for c in names}


def binned(t: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """t with code, the number of each feature's bin: how many of its edges lie below the value."""
    at = lambda c, e: F.size(F.filter(F.array(*map(F.lit, e)), lambda x: x < F.col(c))) if e else F.lit(0)
    return t.withColumn("code", F.array(*(at(c, e) for c, e in edges.items())))


def bin_statistics(t: DataFrame, n_features: int) -> DataFrame:
    """(horizon, since, slot, value) over the rows that may be fitted: whole numbers, for all horizons and folds in one pass.

    Slot a * n + b, for bins a and b of all n bins, has how many rows are in both; slot -1 - a the sum of changes in a. A task adds up what it
    reads in arrays of fixed size.
    """
    n, pairs = n_features * BINS, [(f, g) for f in range(n_features) for g in range(f, n_features)]
    groups = (scores.HORIZONS + 1) * (FOLDS + 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, moved = np.zeros((len(pairs), groups * BINS * BINS), np.int64), np.zeros((n_features, groups * BINS), np.int64)
        for batch in batches:
            group = batch.column(0).to_numpy().astype(np.int64) * (FOLDS + 2) + batch.column(1).to_numpy()
            code, y = batch.column(2).flatten().to_numpy().reshape(-1, n_features).astype(np.int64), batch.column(3).to_numpy()
            for i, (f, g) in enumerate(pairs):
                met[i] += np.bincount((group * BINS + code[:, f]) * BINS + code[:, g], minlength=met.shape[1])
            for f in range(n_features):
                moved[f] += np.bincount(group * BINS + code[:, f], weights=y, minlength=moved.shape[1]).astype(np.int64)  # whole, far below 2 ** 53
        for i, (f, g) in enumerate(pairs):
            at = np.flatnonzero(met[i])
            group, a, b = at // (BINS * BINS), at // BINS % BINS, at % BINS
            yield told(group, (f * BINS + a) * n + g * BINS + b, met[i][at])
        for f in range(n_features):
            at = np.flatnonzero(moved[f])
            yield told(at // BINS, -1 - (f * BINS + at % BINS), moved[f][at])

    def told(group: np.ndarray, slot: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        columns = (group // (FOLDS + 2)).astype(np.int32), (group % (FOLDS + 2)).astype(np.int32), slot.astype(np.int32), value
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["horizon", "since", "slot", "value"])

    y = F.round(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("change"))) * UNIT).cast("long")
    found = t.where("since is not null").select("horizon", "since", "code", y.alias("y")).mapInArrow(run, "horizon int, since int, slot int, value long")
    return found.groupBy("horizon", "since", "slot").agg(F.sum("value").alias("value"))


def boost(met: np.ndarray, moved: np.ndarray, usable: np.ndarray) -> tuple[float, np.ndarray]:
    """(base, parts by feature and bin) of least-squares boosting with one-split trees.

    met[a, b]: rows in bins a and b; moved[a]: sum of changes in bin a. A step's effect on the residual sum of bin a is the step's
    parts times the rows that a shares with their bins, so no row is read again.
    """
    size = np.diag(met).reshape(-1, BINS)
    n = size[0].sum()
    base = moved[:BINS].sum() / n
    rest, parts = (moved - base * np.diag(met)).reshape(-1, BINS), np.zeros(size.shape)
    left_n = np.cumsum(size, 1)[:, :-1]
    fine = (left_n >= LEAF) & (n - left_n >= LEAF) & usable[:, None]
    for _ in range(ROUNDS if fine.any() else 0):
        left = np.cumsum(rest, 1)[:, :-1]
        right = rest.sum(1)[:, None] - left
        gain = np.where(fine, left**2 / (left_n + SHRINK) + right**2 / (n - left_n + SHRINK), -1.0)
        f, at = np.unravel_index(np.argmax(gain), gain.shape)
        step = np.where(np.arange(BINS) <= at, left[f, at] / (left_n[f, at] + SHRINK), right[f, at] / (n - left_n[f, at] + SHRINK)) * RATE
        parts[f] += step
        rest -= (met[:, f * BINS : (f + 1) * BINS] @ step).reshape(-1, BINS)
    return base, parts


def fit(t: DataFrame, names: list[str]) -> DataFrame:
    """(horizon, fold, base, values): a model for each horizon and fold of binned() rows with LEAST rows at least, one horizon a task.

    A horizon's statistics are as many numbers whatever the rows; folds add up those of the rows that they may see.
    """
    n = len(names) * BINS

    def models(pdf: pd.DataFrame) -> pd.DataFrame:
        horizon = int(pdf["horizon"].iloc[0])
        usable = np.isin(names, lag_safe(names, horizon))
        met, moved, found = np.zeros((n, n)), np.zeros(n), []
        for fold in range(1, FOLDS + 2):
            slot, value = (pdf.loc[pdf["since"] == fold, c].to_numpy() for c in ("slot", "value"))
            pair = slot >= 0
            met[slot[pair] // n, slot[pair] % n] += value[pair]
            moved[-1 - slot[~pair]] += value[~pair]
            if np.diag(met)[:BINS].sum() >= LEAST:
                base, parts = boost(np.triu(met) + np.triu(met, 1).T, moved, usable)
                found.append((horizon, fold, base / UNIT, (parts / UNIT).tolist()))
        return pd.DataFrame(found, columns=["horizon", "fold", "base", "values"])

    return bin_statistics(t, len(names)).groupBy("horizon").applyInPandas(models, "horizon int, fold int, base double, values array<array<double>>")


def train(weekly: DataFrame, day: str | None = None, feat: DataFrame | None = None) -> Trained:
    """Fit the models of all horizons and folds. feat: features() of weekly or a table like it; its numeric columns are the features.

    With day, a date as text, weeks after it are not seen. A fold with too few rows to fit, of a short panel, is left out.
    """
    weekly = scores.as_of(weekly, day)
    feat = written(features(weekly) if feat is None else scores.as_of(feat, day), "features")
    names = numeric_columns(feat, ("price_avg_weekly",))
    edges = bin_edges(feat, names)
    t = written(binned(rows(feat, weekly), edges), "forecast_rows")
    models = written(fit(t, names), "forecast_models")
    kept = ["ingredient", "week_start", "horizon", "fold", "price_avg_weekly", "target", "change", "moved", "p50", "parts"]
    out = predict(models, t.where("fold > 0"), F.col("fold")).select(kept)
    return Trained(models, edges, feat, t, written(out, "out_of_fold"))


_TABLES = ("models", "features", "rows", "out_of_fold")


def save(trained: Trained, path: str) -> None:
    """Overwrite the folder path with all that load() needs."""
    spark = trained.models.sparkSession
    spark.createDataFrame(list(trained.edges.items()), "feature string, edges array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/edges")
    for name in _TABLES:
        getattr(trained, name).write.mode("overwrite").parquet(f"{path}/{name}")


def load(spark: SparkSession, path: str) -> Trained:
    edges = {r.feature: list(r.edges) for r in spark.read.parquet(f"{path}/edges").collect()}
    models, *others = (spark.read.parquet(f"{path}/{name}") for name in _TABLES)
    names = numeric_columns(others[0], ("price_avg_weekly",))
    return Trained(models, {c: edges[c] for c in names}, *others)


def predict(models: DataFrame, t: DataFrame, fold) -> DataFrame:
    """binned() rows with parts (of each feature), moved and p50, the predicted price, by the model of their horizon and fold."""
    m = models.withColumnRenamed("fold", "_fold")  # at most 78 rows
    out = t.withColumn("_fold", fold).join(F.broadcast(m), ["horizon", "_fold"])
    out = out.withColumn("parts", F.zip_with("values", "code", lambda v, c: F.get(v, c)))
    out = out.withColumn("moved", F.aggregate("parts", F.col("base"), lambda a, x: a + x))
    return out.withColumn("p50", F.col("price_avg_weekly") * (1 + F.col("moved"))).drop("_fold", "base", "values")


def pooled_fit(t: DataFrame, names: list[str]) -> GBTRegressionModel:
    """One model of deeper trees with absolute loss for all horizons, to compare with: the horizon is a feature, unsafe lags are blanked."""
    blank = safe_at_horizon(t.where("since is not null")).withColumn("horizon", F.col("horizon").cast("double"))
    train = VectorAssembler(inputCols=[*names, "horizon"], outputCol="features").transform(blank).select("features", "change")
    return GBTRegressor(featuresCol="features", labelCol="change", predictionCol="moved", lossType="absolute", **TREES).fit(train)


def compared_with_pooled(trained: Trained) -> DataFrame:
    """(horizon, n_rows, mae, pooled_mae, naive_mae) on the last weeks."""
    names = list(trained.edges)
    own = predict(trained.models, trained.rows.where("fold = -1"), F.lit(FOLDS + 1)).withColumn("own", F.col("p50"))
    blank = safe_at_horizon(own).withColumn("h", F.col("horizon").cast("double")).drop("moved")
    both = pooled_fit(trained.rows, names).transform(VectorAssembler(inputCols=[*names, "h"], outputCol="features").transform(blank))
    off = lambda p: F.avg(F.abs(p - F.col("target")))
    price = F.col("price_avg_weekly")
    return both.groupBy("horizon").agg(F.count("*").alias("n_rows"), off(F.col("own")).alias("mae"), off(price * (1 + F.col("moved"))).alias("pooled_mae"), off(price).alias("naive_mae"))


def bands(out_of_fold: DataFrame) -> DataFrame:
    """(horizon, lo, hi): the exact 10th and 90th percentile of the relative errors out of fold."""
    off = out_of_fold.select("horizon", (F.col("change") - F.col("moved")).alias("off"))
    return selection.percentiles(off, ["horizon"], "off", [0.1, 0.9]).select("horizon", F.col("q")[0].alias("lo"), F.col("q")[1].alias("hi"))


def with_bands(p: DataFrame, b: DataFrame) -> DataFrame:
    at = lambda c: F.col("price_avg_weekly") * (1 + F.col("moved") + F.col(c))
    out = p.join(F.broadcast(b), "horizon")  # at most thirteen rows
    return out.withColumns({"p10": F.least("p50", F.greatest(at("lo"), F.lit(0.0))), "p90": F.greatest("p50", at("hi"))}).drop("lo", "hi")


def forecast(trained: Trained) -> DataFrame:
    """(ingredient, forecast_date, horizon_weeks, target_week_start, p10, p50, p90) from the last week of each ingredient."""
    feat = trained.features
    last = feat.groupBy("ingredient").agg(F.max_by(F.struct(*(c for c in feat.columns if c != "ingredient")), "week_start").alias("s")).select("ingredient", "s.*")
    ahead = binned(last, trained.edges).withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(scores.HORIZONS))))
    out = with_bands(predict(trained.models, ahead, F.lit(FOLDS + 1)), bands(trained.out_of_fold))
    weeks = F.col("horizon")
    return out.select("ingredient", F.col("week_start").alias("forecast_date"), weeks.alias("horizon_weeks"), F.date_add("week_start", weeks * 7).alias("target_week_start"), "p10", "p50", "p90")


def quantile_forecast(panel: DataFrame) -> DataFrame:
    """forecast()'s columns without a model: the last price, moved by the exact percentiles of all ingredients' changes over as many weeks."""
    moves = written(scores.targets(panel).select("horizon", (F.col("target") / F.col("price_avg_weekly") - 1).alias("move")), "moves")
    q = selection.percentiles(moves, ["horizon"], "move", [0.1, 0.5, 0.9])
    last = panel.groupBy("ingredient").agg(F.max("week_start").alias("forecast_date"), F.max_by("price_avg_weekly", "week_start").alias("price"))
    out = last.join(F.broadcast(q))  # thirteen rows at most
    return out.select("ingredient", "forecast_date", F.col("horizon").alias("horizon_weeks"), F.date_add("forecast_date", F.col("horizon") * 7).alias("target_week_start"), *((F.col("price") * (1 + F.col("q")[i])).alias(c) for i, c in enumerate(("p10", "p50", "p90"))))


def measures(p: DataFrame, *by, **more) -> DataFrame:
    """Errors, share of right directions and skill against the last price of predictions p, by `by`; more are further aggregates."""
    e, price, y = F.col("p50") - F.col("target"), F.col("price_avg_weekly"), F.col("target")
    a = p.groupBy("horizon", *by).agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(F.try_divide(e, y))).alias("mape"), F.avg(F.abs(price - y)).alias("naive_mae"),
        F.avg((F.signum(F.col("p50") - price) == F.signum(y - price)).cast("int")).alias("direction"), F.count("*").alias("n_rows"), *(c.alias(n) for n, c in more.items()),
    )
    return a.withColumn("skill", F.when(F.col("naive_mae") > 0, 1 - F.col("mae") / F.col("naive_mae")))


def errors(trained: Trained) -> DataFrame:
    """By horizon, on the last weeks: errors, share of right directions, skill against the last price, share inside the band."""
    p = with_bands(predict(trained.models, trained.rows.where("fold = -1"), F.lit(FOLDS + 1)), bands(trained.out_of_fold))
    inside = (F.col("target") >= F.col("p10")) & (F.col("target") <= F.col("p90"))
    return measures(p, coverage=F.avg(inside.cast("int")))


def fold_errors(trained: Trained) -> DataFrame:
    """By horizon and fold, out of fold: errors, share of right directions, skill against the last price."""
    return measures(trained.out_of_fold, "fold")


def run_summary(by_horizon: DataFrame) -> DataFrame:
    """One row: mean error and skill over the fitted horizons."""
    return by_horizon.agg(F.avg("mae").alias("mean_mae"), F.avg("skill").alias("mean_skill"), F.count("*").alias("horizons"))


def importance(trained: Trained, top: int = 12, repeats: int = REPEATS, seed: int = 7) -> DataFrame:
    """(horizon, feature, rise, spread, rank): how much the mean error out of fold grows when a feature's values change places among the
    weeks of an ingredient inside a fold: mean and deviation over random permutations; the top features of each horizon.

    A permutation puts the weeks of an ingredient, horizon and fold in hashed order, and a week takes its value from the week that has its place
    there. A model is a sum of parts by feature, so one row with both weeks' parts tells of every feature.
    """
    group = ["ingredient", "horizon", "fold", "repeat"]
    out = trained.out_of_fold.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    w = Window.partitionBy(*group)
    out = out.withColumns({"place": F.row_number().over(w.orderBy("week_start")), "hashed": F.row_number().over(w.orderBy(F.xxhash64(F.lit(seed), *group, "week_start"), "week_start"))})
    other = out.select(*group, F.col("hashed").alias("place"), F.col("parts").alias("other"))
    both = out.join(other, [*group, "place"])
    names = list(trained.edges)
    price, p, y = F.col("price_avg_weekly"), F.col("p50"), F.col("target")
    rises = (F.avg(F.abs(p + price * (F.col("other")[k] - F.col("parts")[k]) - y) - F.abs(p - y)).alias(c) for k, c in enumerate(names))
    each = both.groupBy("horizon", "repeat").agg(*rises).unpivot(["horizon", "repeat"], names, "feature", "rise")
    rise = each.groupBy("horizon", "feature").agg(F.avg("rise").alias("rise"), F.stddev_samp("rise").alias("spread"))
    rank = F.row_number().over(Window.partitionBy("horizon").orderBy(F.col("rise").desc(), "feature"))
    return rise.withColumn("rank", rank).where(F.col("rank") <= top)


def importance_summary(by_horizon: DataFrame) -> DataFrame:
    """A row per feature: its rise at each horizon, 0 where it is missing, and the mean of those."""
    horizons = list(range(1, scores.HORIZONS + 1))
    wide = by_horizon.groupBy("feature").pivot("horizon", horizons).agg(F.first("rise")).na.fill(0.0)
    wide = wide.select("feature", *(F.col(str(h)).alias(f"h{h}") for h in horizons))
    return wide.withColumn("mean_rise", sum((F.col(f"h{h}") for h in horizons), F.lit(0.0)) / len(horizons))


def forecast_cost(f: DataFrame) -> DataFrame:
    """The landed cost at each quantile of a forecast, at the base prices of fuel and gas."""
    long = f.unpivot(["ingredient", "target_week_start", "horizon_weeks"], ["p10", "p50", "p90"], "quantile", "commodity_price")
    c = scores.COST
    t = long.withColumns({"transport_cost": scores.transport(F.lit(c["diesel"])), "energy_cost": F.lit(c["gas"] * c["mmbtu"]), "carry_cost": scores.carry(F.col("commodity_price"))})
    t = t.withColumn("total_landed_cost", F.col("commodity_price") + F.col("transport_cost") + F.col("energy_cost") + F.col("carry_cost"))
    return t.withColumn("implied_sell_price", F.col("total_landed_cost") / (1 - c["margin"])).withColumnRenamed("target_week_start", "week_start")


def quick_risk(panel: DataFrame, f: DataFrame) -> DataFrame:
    """Risk of each ingredient from its last 12 prices and the band of its furthest forecast, parts cut to whole numbers of at most 100."""
    trend = scores.latest(panel, 12, "price_avg_weekly").select("ingredient", F.col("price_avg_weekly").alias("price"), "trend")
    m = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x) / F.size(xs)
    t = trend.withColumn("_mean", m(F.col("trend"))).withColumn("_sd", F.sqrt(m(F.transform("trend", lambda x: (x - F.col("_mean")) * (x - F.col("_mean"))))))
    far = f.groupBy("ingredient").agg(F.max_by(F.struct("p10", "p50", "p90"), "horizon_weeks").alias("b"))
    t = t.join(far, "ingredient", "left")
    whole = lambda x: F.least(F.lit(100), F.floor(F.coalesce(x, F.lit(0.0))).cast("int"))
    first = F.element_at("trend", 1)
    t = t.withColumns({
        "volatility": whole(F.try_divide(F.col("_sd"), F.col("_mean")) * 600),
        "band": whole(F.try_divide(F.col("b.p90") - F.col("b.p10"), F.col("b.p50")) * 180),
        "momentum": whole(F.abs(F.try_divide(F.col("price") - first, first)) * 250),
    })
    t = t.withColumn("composite", whole(F.col("volatility") * 0.4 + F.col("band") * 0.4 + F.col("momentum") * 0.2))
    return t.select("ingredient", "price", "volatility", "band", "momentum", "composite", classify(F.col("composite"), QUICK, "LOW").alias("level"))
