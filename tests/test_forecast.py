"""The forecast on the given tables: no look-ahead, ordered bands, coverage, skill, and the tables built on it."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from cropledger.plans import forecast, panel, registry, scores, staging

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def trained(spark):
    return registry._trained(spark, SF)


@pytest.fixture(scope="module")
def rows(trained):
    return trained.rows


def test_no_model_predicts_from_a_week_it_was_fitted_on(rows):
    got = rows.select("ingredient", "week_start", "horizon", "since", "fold").collect()
    until, first = {}, {}
    for r in got:
        target = r.week_start + dt.timedelta(weeks=int(r.horizon))
        for k in range(r.since or 99, forecast.FOLDS + 2):
            until[r.ingredient, k] = max(until.get((r.ingredient, k), target), target)
        k = forecast.FOLDS + 1 if r.fold == -1 else r.fold
        first[r.ingredient, k] = min(first.get((r.ingredient, k), r.week_start), r.week_start)
    shared = until.keys() & first.keys()
    assert {k for _, k in shared} == set(range(1, forecast.FOLDS + 2))
    assert all(until[key] < first[key] for key in shared)
    held = sum(r.fold == -1 for r in got if r.horizon == 1) / sum(1 for r in got if r.horizon == 1)
    assert 0.1 < held < 0.2 and not any(r.since and r.fold == -1 for r in got)


def test_errors(spark, trained):
    found = registry.QUERIES["b6_forecast_errors"](spark, SF).collect()
    assert {r.horizon for r in found} <= set(range(1, 14)) and found
    inside = sum(r.coverage * r.n_rows for r in found) / sum(r.n_rows for r in found)
    assert 0.65 <= inside <= 0.95
    assert sum(r.skill for r in found) / len(found) > 0  # prices here revert to a mean, which the last price ignores
    one = forecast.run_summary(spark.createDataFrame(found)).collect()[0]
    assert one.horizons == len(found) and one.mean_mae > 0


def test_every_row_of_a_fold_is_predicted_once_and_measured(spark, trained):
    out = trained.out_of_fold.collect()
    assert len(out) == len({(r.ingredient, r.week_start, r.horizon) for r in out}) == trained.rows.where("fold > 0").count()
    by = {(r.horizon, r.fold): r for r in registry.QUERIES["b6_fold_errors"](spark, SF).collect()}
    assert {k for _, k in by} == set(range(1, forecast.FOLDS + 1))
    for (h, k), r in by.items():
        own = [x for x in out if x.horizon == h and x.fold == k]
        assert r.n_rows == len(own) and r.mae == pytest.approx(sum(abs(x.p50 - x.target) for x in own) / len(own), abs=1e-3)
    band = {r.horizon: r for r in forecast.bands(trained.out_of_fold).collect()}
    for h in band:
        lo, hi = np.percentile([x.change - x.moved for x in out if x.horizon == h], [10, 90])
        assert band[h].lo == pytest.approx(lo, abs=1e-12) and band[h].hi == pytest.approx(hi, abs=1e-12)


def test_saved_models_forecast_alike(spark, trained, tmp_path):
    forecast.save(trained, str(tmp_path / "m"))
    again = forecast.forecast(forecast.load(spark, str(tmp_path / "m")))
    order = ["ingredient", "horizon_weeks"]
    assert again.orderBy(order).collect() == forecast.forecast(trained).orderBy(order).collect()


def test_forecast_and_what_follows(spark):
    f = registry.QUERIES["b8_forecast"](spark, SF).persist()
    got = f.collect()
    assert all(r.p10 <= r.p50 <= r.p90 and r.target_week_start == r.forecast_date + dt.timedelta(weeks=r.horizon_weeks) for r in got)
    assert len(got) == len({(r.ingredient, r.horizon_weeks) for r in got}) > 0
    cost = forecast.forecast_cost(f).collect()
    assert len(cost) == 3 * len(got) and all(r.total_landed_cost > r.commodity_price for r in cost)
    risk = forecast.quick_risk(scores.panel_of(spark, SF), f).collect()
    assert all(0 <= r.composite <= 100 and r.level == ("HIGH" if r.composite >= 66 else "MODERATE" if r.composite >= 33 else "LOW") for r in risk)


def test_quick_risk_by_hand(spark):
    weeks = [dt.date(2024, 1, 1) + dt.timedelta(weeks=i) for i in range(12)]
    p = spark.createDataFrame([("a", w, 4.0 + (i % 2) * 2) for i, w in enumerate(weeks)], "ingredient string, week_start date, price_avg_weekly double")
    f = spark.createDataFrame([("a", 13, 4.0, 5.0, 6.0), ("a", 1, 0.0, 5.0, 9.0)], "ingredient string, horizon_weeks int, p10 double, p50 double, p90 double")
    r = forecast.quick_risk(p, f).collect()[0]
    assert (r.volatility, r.band, r.momentum, r.composite, r.level) == (100, 72, 100, 88, "HIGH")


def test_importance(spark):
    found = registry.QUERIES["b9_importance"](spark, SF).collect()
    assert {r.feature for r in found} <= set(forecast.FEATURES) and found
    assert max(r.mean_rise for r in found) > 0


def test_noise_has_no_importance_and_repeats_agree(spark):
    weekly = panel.weekly_training(spark, SF)
    feat = forecast.features(weekly).withColumn("noise", F.pmod(F.xxhash64("ingredient", "week_start"), F.lit(1000)).cast("double"))
    trained = forecast.train(weekly, feat=feat)
    assert list(trained.edges) == [*forecast.FEATURES, "noise"]
    found = forecast.importance(trained, top=99).collect()
    assert len(found) == 13 * len(trained.edges)
    assert sorted(found) == sorted(forecast.importance(trained, top=99).collect())
    noise = [r for r in found if r.feature == "noise"]
    assert sum(abs(r.rise) <= 3 * r.spread + 1e-9 for r in noise) >= 11
    best = {h: max(r.rise for r in found if r.horizon == h) for h in range(1, 14)}
    assert all(r.rise < 0.3 * best[r.horizon] for r in noise)


def plain_boost(code, y, usable):
    """Boosting with one-split trees that reads the rows at every step."""
    base = y.mean()
    parts, rest = np.zeros((code.shape[1], forecast.BINS)), y - base
    for _ in range(forecast.ROUNDS):
        best = None
        for f in np.flatnonzero(usable):
            for at in range(forecast.BINS - 1):
                left = code[:, f] <= at
                n = left.sum()
                if min(n, len(y) - n) < forecast.LEAF:
                    continue
                a, b = rest[left].sum() / (n + forecast.SHRINK), rest[~left].sum() / (len(y) - n + forecast.SHRINK)
                gain = a * rest[left].sum() + b * rest[~left].sum()
                if best is None or gain > best[0] + 1e-12:
                    best = gain, f, at, a, b
        _, f, at, a, b = best
        step = np.where(np.arange(forecast.BINS) <= at, a, b) * forecast.RATE
        parts[f] += step
        rest = rest - step[code[:, f]]
    return base, parts


def test_boosting_from_statistics_is_boosting_over_rows(monkeypatch):
    monkeypatch.setattr(forecast, "ROUNDS", 25)
    rng = np.random.default_rng(6)
    code = rng.integers(0, forecast.BINS, (400, 3))
    y = 0.3 * (code[:, 0] > 5) - 0.2 * (code[:, 2] > 11) + rng.normal(size=400) * 0.1
    hot = np.zeros((400, 3 * forecast.BINS))
    for f in range(3):
        hot[np.arange(400), f * forecast.BINS + code[:, f]] = 1
    usable = np.array([True, False, True])
    base, parts = forecast.boost(hot.T @ hot, hot.T @ y, usable)
    want_base, want = plain_boost(code, y, usable)
    assert base == pytest.approx(want_base) and np.allclose(parts, want, atol=1e-9) and not parts[1].any()


def test_each_horizon_has_its_own_features_and_folds(spark, trained):
    names = list(trained.edges)
    models = trained.models.collect()
    assert {r.horizon for r in models} == set(range(1, 14)) and {r.fold for r in models} <= set(range(1, forecast.FOLDS + 2))
    for r in models:
        used = {c for c, v in zip(names, r["values"]) if any(v)}
        assert used and used <= set(forecast.lag_safe(names, r.horizon))
    small = forecast.train(panel.weekly_training(spark, SF).where("ingredient = 'Brand#11' and week_start < '1995-06-30'"))
    counts = {r.horizon: r.n for r in small.rows.where("since is not null").groupBy("horizon").agg(F.count("*").alias("n")).collect()}
    assert all(n >= forecast.LEAST for n in counts.values()) and {r.horizon for r in small.models.collect()} == set(counts)


def test_compared_with_the_pooled_model(spark):
    found = registry.QUERIES["b6_compared_with_pooled"](spark, "/root/testdata/sf0.01").collect()
    assert len(found) == 13 and sum(r.mae for r in found) < sum(r.naive_mae for r in found)


def test_lag_safe():
    names = ["price_lag_1w", "price_lag_4w", "price_hist_avg_26w", "di_change"]
    assert forecast.lag_safe(names, 4) == ["price_lag_4w", "price_hist_avg_26w", "di_change"] and forecast.lag_safe(names, 1) == names


def test_staging_of_unreadable_text(spark):
    raw = spark.createDataFrame([("x", "1,5a", "13/40/2024", "no ppi AVAILABLE"), (None, None, None, None)], "ingredient_id string, ppi string, date string, fred_series_id string").withColumn("frequency", F.lit("M"))
    assert [tuple(r) for r in staging.price_index(raw, "ingredient_id", "int").collect()] == [(None, None, None, "M")]


def test_unsafe_lags_are_blank_and_features_follow_the_schema(spark, rows):
    blank = forecast.safe_at_horizon(rows)
    for h in (1, 2, 5, 13):
        safe = set(forecast.lag_safe(forecast.LEVELS, h))
        one = blank.where(F.col("horizon") == h).select(*(F.max(F.abs(F.col(c) - 1)).alias(c) for c in forecast.LEVELS)).collect()[0]
        assert {c for c in forecast.LEVELS if one[c]} == safe
    df = spark.createDataFrame([(1, 2.0, "x", dt.date(2024, 1, 1))], "a int, b double, c string, d date")
    assert forecast.numeric_columns(df, ("a",)) == ["b"]


def test_forecast_as_of_a_day_sees_nothing_later(spark):
    weekly = panel.weekly_training(spark, SF)
    day = "1999-06-30"
    cut = forecast.forecast(forecast.train(weekly, day)).orderBy("ingredient", "horizon_weeks").collect()
    late = weekly.withColumn("price_avg_weekly", F.when(F.col("week_start") > F.lit(day).cast("date"), 1.0).otherwise(F.col("price_avg_weekly")))
    assert cut and all(r.forecast_date <= dt.date(1999, 6, 30) for r in cut)
    assert cut == forecast.forecast(forecast.train(late, day)).orderBy("ingredient", "horizon_weeks").collect()
