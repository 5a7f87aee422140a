"""Operators on small frames, and invariants that SQL does not show."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cropledger.functions import text
from cropledger.operators import quality, selection
from cropledger.operators import windows as W
from cropledger.plans import scores, staging
from cropledger.sources import tables


def test_text(spark):
    df = spark.createDataFrame([("  corn,  yellow ", "TONS", " 1,234.56789 ", "03/09/2024", "no ppi available", "."), (None, "(D)", "(NA)", "2024-02-30", "PCU1", " ")], "a string, b string, c string, d string, e string, f string")
    row, none = df.select(text.no_marks(F.col("a")), text.singular_unit(text.no_placeholder(F.col("b"))), text.number(F.col("c")), text.to_date(F.col("d")), text.no_series(F.col("e")), text.null_tokens(F.col("f"))).collect()
    assert tuple(row) == ("CORN YELLOW", "TON", 1234.5679, dt.date(2024, 3, 9), None, None)
    assert tuple(none) == (None, "", None, None, "PCU1", None)


def test_clip_and_classes(spark):
    df = spark.createDataFrame([(20.0,), (65.0,), (80.0,), (95.0,), (None,)], "x double")
    assert [r[0] for r in df.select(text.classify(F.col("x"), scores.LEVELS, "LOW")).collect()] == ["LOW", "MODERATE", "HIGH", "EMERGENCY", None]
    assert [r[0] for r in df.select(text.clip(F.col("x"), 30, 90)).collect()] == [30.0, 65.0, 80.0, 90.0, None]


def test_quarantine_is_complementary(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "C"), (None, "D")], "k int, v string")
    clean, bad = quality.split(quality.flagged(df, {"upper": quality.no_lower_case(F.col("v")), "present": quality.not_null(F.col("k"))}, {"unique": ["k"]}))
    assert clean.count() + bad.count() == 4 and [tuple(r) for r in clean.collect()] == [(2, "C")]
    assert {tuple(r.reasons) for r in bad.collect()} == {("upper", "unique"), ("present",)}


def test_no_look_ahead(spark):
    by = Window.partitionBy("k").orderBy("i")
    rows = [("a", i, float(i * i)) for i in range(20)]
    def last(rs):
        df = spark.createDataFrame(rs, "k string, i int, v double").withColumns(W.trailing("v", by, [4], "m{n}") | W.lags("v", by, [1], "l{n}"))
        return df.where("i = 10").select("m4", "l1").collect()
    assert last(rows) == last(rows[:11] + [("a", i, -1.0) for i in range(11, 20)])


def test_row_ids_are_row_numbers(spark):
    df = spark.createDataFrame([(i * 7919 % 1000,) for i in range(1000)], "x int").repartition(7)
    assert {(r.x, r.id) for r in W.row_ids(df, ["x"]).collect()} == {(i, 10001 + i) for i in range(1000)}


def test_schedule_keeps_limits(spark):
    curve = spark.createDataFrame([("a", i + 1, i + 1, 5.0 + (i * 37 % 52) / 52, 4.0, 6.0, 0.0) for i in range(52)], "ingredient string, week_index int, week_of_year int, expected_price double, p25_price double, p75_price double, seasonal_factor double")
    rows = scores.schedule(curve).orderBy("week_index").collect()
    q = [r.recommended_purchase for r in rows]
    assert abs(sum(q) - 1e6) < 1e-3 and all(5000 - 1e-6 <= x <= 100000 + 1e-6 for x in q)
    assert all(r.cumulative_purchase <= 1e6 * min((k + 1) / 52 * 1.2, 1) + 1e-3 for k, r in enumerate(rows))
    assert sum(r.total_cost for r in rows) <= 1e6 * sum(r.expected_price for r in rows) / 52


def test_landed_json(spark):
    body = '{"observations":[{"date":"2015-01-01","value":"180.7"},{"date":"2015-02-01","value":"."}]}'
    assert [tuple(r) for r in tables.observations(spark.createDataFrame([("S", body)], "s string, b string"), "b", "s").collect()] == [("S", dt.date(2015, 1, 1), 180.7)]
    report = '[{"reportSection":"Report Detail","stats":{"totalRows":2,"returnedRows":1},"results":[{"commodity":"Corn"}]},{"reportSection":"Other","results":[{"commodity":"x"}]}]'
    assert [tuple(r) for r in tables.report_details(spark.createDataFrame([(report,)], "b string"), "b", ["commodity"]).collect()] == [(True, "Corn")]


def test_delimited(spark, tmp_path):
    (tmp_path / "a.csv").write_text('name,value\n"x ""y""",1\nz,.\n')
    (tmp_path / "b.csv").write_text("value,name,more\n,q,5\n")
    rows = tables.delimited(spark, {str(tmp_path / "a.csv"): ["name", "value"], str(tmp_path / "b.csv"): ["value", "name", "more"]}).collect()
    assert sorted(tuple(r) for r in rows if r.more is None) == [('x "y"', "1", None), ("z", None, None)] and ("q", None, "5") in [tuple(r) for r in rows]


def test_forward_averages_of_exact_and_inexact_values(spark):
    """Running differences (decimals) and frames (doubles) give the means that a loop over all rows gives; nulls don't count."""
    start = dt.date(2024, 1, 1)
    rows = [(k, start + dt.timedelta(days=d), v) for k, d, v in [("a", 0, 1.25), ("a", 0, None), ("a", 3, 2.5), ("a", 7, 4.0), ("a", 8, None), ("a", 40, 8.0), ("b", 1, None), ("b", 2, 3.0)]]
    want = {}
    for k, d, _ in rows:
        ahead = [v for k2, d2, v in rows if k2 == k and 0 <= (d2 - d).days <= 7 and v is not None]
        want[k, d] = sum(ahead) / len(ahead) if ahead else None
    base = spark.createDataFrame(rows, "k string, d date, v double")
    for kind in ("double", "decimal(18,2)"):
        got = W.forward_averages(base.withColumn("v", F.col("v").cast(kind)), ["k"], "d", "v", [7], "d").collect()
        assert len(got) == len(rows)
        assert all(r.v_fwd_7d == want[r.k, r.d] for r in got)


def test_numeric_check(spark):
    texts = ["1", " 2.5 ", "1e5", "R", "", "-Infinity", "NaN", "nancy", "1,000", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", quality.numeric(F.col("t")).alias("bad")).collect()
    assert {r.t for r in rows if r.bad} == {"R", "", "nancy", "1,000"}


def test_exact_means_neither_cut_nor_overflow(spark):
    from cropledger.plans import panel

    df = spark.createDataFrame([("a", "0.01"), ("a", "0.02"), ("a", "0.02")] + [("b", "9999999999999.99")] * 200, "k string, v string").select("k", F.col("v").cast("decimal(18,2)").alias("v"))
    got = {r.k: str(r.m) for r in df.groupBy("k").agg(panel.exact_mean("v").alias("m")).collect()}
    assert got == {"a": "0.016667", "b": "9999999999999.990000"}


def test_master_keeps_allowed_units_and_empty_names(spark):
    rows = [("Crops", "Corn", "Corn, Grain", " bushels "), ("CROPS", "Total", "X", "TONS"), ("CROPS", "Corn", None, "TONS"), ("CROPS", "Corn", "(NA)", "TONS"), ("(NA)", "Corn", "Y", "TONS"), ("CROPS", "Corn", "Z", "FURLONG"), ("CROPS", None, "Z", "TONS"), ("CROPS", "Corn", "Z", None)]
    df = spark.createDataFrame(rows, "GROUP_DESC string, COMMODITY_DESC string, CLASS_DESC string, UNIT_DESC string")
    got = staging.product_master([df, df.select("UNIT_DESC", "CLASS_DESC", "COMMODITY_DESC", "GROUP_DESC")], ["TON", "BU", ""]).collect()
    assert sorted((r.ingredient_id, r.ingredient_name, r.unit_of_measure) for r in got) == [(10001, "", "TON"), (10002, "CORN GRAIN", "BU")]
    assert staging.product_master([df.limit(0)], ["TON"]).collect() == []


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", 2, 'x "y", z'), ("a", 9, None), ("b", 1, "."), ("a", 3, "q")], "k string, n int, v string").repartition(3)
    tables.write_parquet(df, f"{tmp_path}/p", "k", ("n",))
    files = sorted((tmp_path / "p").glob("k=b/*.parquet"))
    assert len(files) == 1 and [r.n for r in spark.read.parquet(str(files[0])).collect()] == [1, 2]
    tables.write_csv(df, f"{tmp_path}/c")
    back = tables.delimited(spark, {f"{tmp_path}/c/*.csv": ["k", "n", "v"]}).collect()
    assert {tuple(r) for r in back} == {("b", "2", 'x "y", z'), ("a", "9", None), ("b", "1", None), ("a", "3", "q")}
    tables.write_snapshots(df.where("n in (2, 9)"), f"{tmp_path}/s", "k")
    assert {r.value for r in spark.read.text(f"{tmp_path}/s").collect()} == {'{"k":"b","n":2,"v":"x \\"y\\", z"}', '{"k":"a","n":9,"v":null}'}


def test_alerts(spark):
    rows = [("a", dt.date(2024, 1, 1) + dt.timedelta(weeks=i), s) for i, s in enumerate([20.0, 65.0, 95.0])] + [("b", dt.date(2024, 1, 1), None)]
    df = spark.createDataFrame(rows, "ingredient string, week_start date, disruption_score double").withColumns({c: F.lit(1.0) for c in scores.DISRUPTIONS})
    df = df.withColumn("level", text.classify(F.col("disruption_score"), scores.LEVELS, "LOW"))
    now = {r.ingredient: r for r in scores.current_alert(df).collect()}
    assert now["a"].alert.level == "EMERGENCY" and now["a"].alert.colour == "#d32f2f" and now["a"].trend == [20.0, 65.0, 95.0] and now["b"].alert.action is None
    then = {r.ingredient: r for r in scores.current_alert(df, "2024-01-10").collect()}["a"]
    assert then.alert.level == "MODERATE" and then.week_start == dt.date(2024, 1, 8)


def test_schedule_is_optimal(spark):
    """Against every plan on a grid, which holds the best one as all limits lie on it."""
    import itertools

    for seed, prices in enumerate([[5.0, 3.0, 4.0, 1.0], [1.0, 2.0, 3.0, 4.0], [2.0, 2.0, 1.0, 9.0]]):
        curve = spark.createDataFrame([("a", i + 1, i + 1, p, 0.0, 9.0, 0.0) for i, p in enumerate(prices)], "ingredient string, week_index int, week_of_year int, expected_price double, p25_price double, p75_price double, seasonal_factor double")
        got = [r.recommended_purchase for r in scores.schedule(curve, volume=20.0, least=0.1, most=0.5, ahead=0.2).orderBy("week_index").collect()]
        best = min(
            (sum(q * p for q, p in zip(plan, prices)), plan)
            for plan in itertools.product(range(2, 11), repeat=4)
            if sum(plan) == 20 and all(sum(plan[: k + 1]) <= 20 * min((k + 1) / 4 * 1.2, 1) for k in range(4))
        )
        assert abs(sum(q * p for q, p in zip(got, prices)) - best[0]) < 1e-9, seed


def test_percentiles(spark):
    rng = np.random.default_rng(9)
    values = {"a": rng.normal(size=301).tolist(), "b": [1.0] * 5000 + [2.0] * 3, "c": [4.0], "d": [None, 7.0, None, 9.0], "e": [None]}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "k string, v double")
    got = {r.k: r.q for r in selection.percentiles(df, ["k"], "v", [0.0, 0.1, 0.5, 0.93, 1.0]).collect()}
    assert set(got) == set("abcd")
    for k, q in got.items():
        assert np.allclose(q, np.percentile([v for v in values[k] if v is not None], [0, 10, 50, 93, 100]), atol=1e-12)
    assert selection.percentiles(df.limit(0), ["k"], "v", [0.5]).collect() == []


def test_columns_follow_the_header(spark, tmp_path):
    for name, text_ in (("a.csv", 'a,b\n"A,1",B1\n'), ("b.csv", "b,a\nB2,A2\n"), ("c.csv", "﻿b, a\nB3,A3\n"), ("d.csv", ""), ("e.csv", "a,b\n"), ("bad.csv", "a,c\n1,2\n")):
        (tmp_path / name).write_text(text_, encoding="utf-8")
    spec = {f"{tmp_path}/*.csv": ["a", "b"]}
    with pytest.raises(ValueError, match="bad.csv"):
        tables.delimited(spark, spec)
    assert [(r.path.rsplit("/", 1)[1], r.header) for r in tables.misfits(spark, spec).collect()] == [("bad.csv", ["a", "c"])]
    got = sorted((r.a, r.b) for r in tables.delimited(spark, spec, refuse=False).collect())
    assert got == [("A,1", "B1"), ("A2", "B2"), ("A3", "B3")]
    assert len(tables.headers(spark, f"{tmp_path}/*.csv").collect()) == 5


def test_headers_of_files_in_several_stretches(spark, tmp_path):
    (tmp_path / "long.csv").write_text("b,a\n" + "".join(f"{i},x{i}\n" for i in range(20000)))
    (tmp_path / "short.csv").write_text("a,b\nx,1\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        assert sorted(r.header for r in tables.headers(spark, f"{tmp_path}/*.csv").collect()) == [["a", "b"], ["b", "a"]]
        rows = tables.delimited(spark, {f"{tmp_path}/*.csv": ["a", "b"]})
        assert rows.count() == 20001 and rows.where("a = 'x77'").collect()[0].b == "77"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_expanding_ranks(spark):
    import time

    rng = np.random.default_rng(2)
    rows = [("a", i, None if i % 7 == 3 else float(rng.integers(0, 6)), float("nan") if i == 9 else float(rng.normal())) for i in range(60)] + [("b", i, 1.0, None) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, i int, v double, w double")
    got = {(r.k, r.i): r for r in W.expanding_ranks(df.repartition(3), "k", "i", {"rv": "v", "rw": "w"}).collect()}
    for k, i, *values in rows:
        for name, c in (("rv", 2), ("rw", 3)):
            past = [r[c] for r in rows if r[0] == k and r[1] <= i and r[c] is not None]
            x, n = values[c - 2], len(past)
            key = lambda y: (y != y, y)
            want = 50.0 if n < 4 else None if x is None else (sum(key(y) < key(x) for y in past if y == y or x == x) + sum(key(y) <= key(x) or (x != x and y != y) for y in past) + 1) * 50.0 / n
            if x is None or x == x:
                assert got[k, i][name] == want
    values = rng.normal(size=100_000)
    began = time.time()
    less, upto = W.smaller_before(values)
    assert time.time() - began < 20
    for at in (0, 1, 2, 777, 99_999):
        assert less[at] == (values[:at] < values[at]).sum() and upto[at] == (values[:at] <= values[at]).sum()


def test_a_long_key_is_cut_into_stretches(spark):
    days = spark.range(9000).select(F.lit("k").alias("k"), F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).alias("d"), (F.col("id") % 17 * 0.37).alias("v"))
    days = days.unionByName(spark.createDataFrame([("k", None, 1.0), ("z", dt.date(1960, 1, 1), None)], "k string, d date, v double"))
    for kind in ("double", "decimal(12,4)"):
        out = W.forward_averages(days.withColumn("v", F.col("v").cast(kind)), ["k"], "d", "v", [3, 30], "d", unique=True)
        got = {r.d: r for r in out.where("k = 'k' and d is not null").collect()}
        first = dt.date(1990, 1, 1)
        for i in (0, 1, 209, 210, 239, 240, 241, 8999, 8995):
            for n in (3, 30):
                own = [j % 17 * 0.37 for j in range(i, min(9000, i + n + 1))]
                assert abs(got[first + dt.timedelta(i)][f"v_fwd_{n}d"] - sum(own) / len(own)) < 1e-9
        assert len(got) == 9000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_stretch" in plan


def test_a_hot_key_is_several_files_in_order(spark, tmp_path):
    rows = [("hot", i % 997, i) for i in range(5000)] + [(f"k{i}", i, i) for i in range(50)] + [("hot", None, -1)]
    df = spark.createDataFrame(rows, "k string, n int, v int").repartition(7)
    tables.write_parquet(df, f"{tmp_path}/s", "k", ("n", "v"), file_rows=600)
    back = spark.read.parquet(f"{tmp_path}/s").select("k", "n", "v", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("at")).collect()
    assert sorted((r.k, -1 if r.n is None else r.n, r.v) for r in back) == sorted((k, -1 if n is None else n, v) for k, n, v in rows)
    files = {}
    for r in sorted(back, key=lambda r: r["at"]):
        files.setdefault((r.k, r.f), []).append((-1 if r.n is None else r.n, r.v))
    assert all(x == sorted(x) and len(x) <= 600 for x in files.values())
    hot = sorted(x for (k, _), x in files.items() if k == "hot")
    assert len(hot) >= 8 and all(a[-1] <= b[0] for a, b in zip(hot, hot[1:])) and len(files) == len(hot) + 50


def test_what_a_sorted_sink_holds_and_how_it_deals_a_key_do_not_hang_on_files(spark, tmp_path, monkeypatch):
    rows = [("hot", 7, i) for i in range(6000)] + [(None, i % 900, i) for i in range(3000)] + [(f"k{i}", 1, i) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, n int, v int").repartition(5)
    kept, write = [], tables.written
    monkeypatch.setattr(tables, "written", lambda t, label: kept.append(write(t, label)) or kept[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_parquet(df, f"{tmp_path}/s", "k", ("n", "v"), file_rows=250)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(t.count() for t in kept) == 2  # hot keys, and nothing for each value or file
    back = spark.read.parquet(f"{tmp_path}/s").select("k", "n", "v", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("at")).collect()
    assert sorted((r.k or "", r.n, r.v) for r in back) == sorted((k or "", n, v) for k, n, v in rows)
    for key in ("hot", None):
        files = {}
        for r in sorted((r for r in back if r.k == key), key=lambda r: r["at"]):
            files.setdefault(r.f, []).append((r.n, r.v))
        spans = sorted(files.values())
        assert all(x == sorted(x) and len(x) <= 250 for x in spans) and all(a[-1] <= b[0] for a, b in zip(spans, spans[1:]))
        tasks = {f.split("-")[1] for f in files}
        assert len(tasks) > 1  # also where all rows agree in the first column of order, and where the key is null
    assert len({r.f for r in back if r.k and r.k != "hot"}) <= 20 and all(len({r.f for r in back if r.k == f"k{i}"}) == 1 for i in range(20))


def test_tables_are_published_at_once(spark, tmp_path):
    path = f"file://{tmp_path}/docs"
    one, two = spark.range(3).withColumn("x", F.lit("old")), spark.range(5).withColumn("x", F.lit("new"))
    tables.publish({"a": one, "b": two}, path)
    old = tables.published(spark, path, "a")
    tables.publish({"a": two, "b": one}, path)
    assert tables.published(spark, path, "a").count() == 5 and tables.published(spark, path, "b").count() == 3 and old.count() == 3
    bad = spark.range(2).select(F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(Exception):
        tables.publish({"a": one, "b": bad}, path)
    assert tables.published(spark, path, "a").count() == 5  # what failed is not seen


def test_schedule_where_limits_bind_at_the_end_and_without_python(spark):
    curve = spark.createDataFrame([("a", i + 1, 100.0 - i, 1.0) for i in range(52)] + [("b", i + 1, 5.0, 6.0) for i in range(52)], "ingredient string, week_index int, expected_price double, p25_price double")
    t = scores.schedule(curve, volume=100.0, least=0.005, most=0.02, ahead=0.2)
    got = {k: [r.recommended_purchase for r in t.where(F.col("ingredient") == k).orderBy("week_index").collect()] for k in "ab"}
    # Prices fall, so the last weeks are full; the whole volume just fits under the weekly bound and the last prefix.
    assert abs(sum(got["a"]) - 100) < 1e-9 and got["a"][-1] == 2.0 and got["a"][0] == 0.5 and all(x >= y - 1e-9 for x, y in zip(got["a"][1:], got["a"]))
    for q in got.values():
        assert all(sum(q[: k + 1]) <= 100 * min((k + 1) / 52 * 1.2, 1.0) + 1e-9 for k in range(52))
    assert "Pandas" not in t._jdf.queryExecution().executedPlan().toString() and "Arrow" not in t._jdf.queryExecution().executedPlan().toString()
    even = [r.recommended_purchase for r in scores.schedule(curve, volume=100.0, least=0.001, most=0.01).where("ingredient = 'a'").collect()]
    assert max(even) - min(even) < 1e-9 and abs(sum(even) - 100) < 1e-9


def test_risk_classification_and_documents(spark):
    weeks = [dt.date(2024, 1, 1) + dt.timedelta(weeks=i) for i in range(14)]
    scored = spark.createDataFrame([("x", w, 2.0, 70.0 + i, 1.0 * i, 2.0, 3.0, 4.0, "HIGH" if i < 10 else "CRITICAL") for i, w in enumerate(weeks)], "ingredient string, week_start date, price_avg_weekly double, composite_risk double, supply_risk double, cost_risk double, logistics_risk double, demand_risk double, level string")
    r = scores.risk_documents(scored, {"supply_risk": 1.0, "cost_risk": 1.0, "logistics_risk": 1.0, "demand_risk": 1.0}).collect()[0]
    assert (r.classification.level, r.classification.colour, r.classification.action, r.classification.score) == ("CRITICAL", "#b71c1c", "Immediate escalation required", 83.0)
    assert r.weights.asDict() == dict.fromkeys(("supply_risk", "cost_risk", "logistics_risk", "demand_risk"), 0.25) and r.trend_12w == [72.0 + i for i in range(12)]
    assert [(x.dimension, x.score, x.weight) for x in r.radar][0] == ("supply_risk", 13.0, 0.25) and r.dimensions.cost_risk == 2.0
    early = scores.current_risk(scored, day="2024-02-10").collect()[0]
    assert early.week_start == weeks[5] and early.classification.level == "HIGH" and len(early.trend) == 6


def test_scratch_tables_are_dropped_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "scratch_dir", lambda _: f"file://{tmp_path}/shared")
    assert tables.written(spark.range(3), "a").count() == 3 and tables.written(spark.range(4), "b").count() == 4
    (folder,) = (tmp_path / "shared").iterdir()
    assert len([x for x in folder.iterdir() if not x.name.startswith(".")]) == 2
    tables.drop_scratch(spark)
    assert not folder.exists()
