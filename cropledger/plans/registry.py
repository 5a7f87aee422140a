"""Registered queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cropledger.functions import text
from cropledger.operators import quality, selection
from cropledger.operators import windows as W
from cropledger.plans import forecast, panel, scores, staging
from cropledger.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, places: int = 4, exact: tuple = ("price_avg_weekly",)) -> DataFrame:
    """Round doubles whose last digits depend on the order of additions; exact ones are left as they are."""
    return df.select(*(F.round(F.col(c), places).alias(c) if kind == "double" and c not in exact else F.col(c) for c, kind in df.dtypes))


def _mean(c: str) -> str:
    """The mean of amounts with two places, rounded half up at six."""
    return f"((((sum({c}) * 100)::hugeint * 20000 + count({c})) // (2 * count({c}))) / 1e6)::decimal(28,6)"


REPORTS = """reports as (select p_brand as ingredient, p_type as ingredient_group, l_shipdate::date as report_date, l_extendedprice::decimal(18,2) as price,
  l_quantity::decimal(18,2) as amount, l_returnflag as unit from lineitem join part on p_partkey = l_partkey)"""
DOLLAR = f"""dollar as (select o_orderdate::date as ppi_date, {_mean('o_totalprice::decimal(18,2)')} as ppi from orders group by 1)"""
MONTHLY = f"""monthly as (select ingredient, date_trunc('month', report_date)::date as ppi_date, {_mean('price')} as ppi from reports group by 1, 2)"""
_LAGS = ", ".join(f"lag(price_avg_weekly, {n}) over w as price_lag_{n}w" for n in (1, 2, 4, 8, 13, 26, 52))
_OVER = "over (partition by ingredient order by week_start rows between {n} preceding and 1 preceding)"
_MEANS = ", ".join(f"(sum(p) {_OVER})::double / nullif(count(p) {_OVER}, 0) as price_hist_avg_{{n}}w".format(n=n) for n in (4, 12, 26, 52))
WEEKLY = f"""{REPORTS}, {DOLLAR}, {MONTHLY},
weekly as (select ingredient, date_trunc('week', report_date)::date as week_start, {_mean('price')} as p, p::double as price_avg_weekly, min(price)::double as price_min_weekly,
  max(price)::double as price_max_weekly, count(*) as n_reports_in_week from reports group by 1, 2),
featured as (select *, {_LAGS}, {_MEANS}, sqrt((count(p) over s * sum((p * 1000000)::hugeint * (p * 1000000)::hugeint) over s - sum((p * 1000000)::bigint) over s * sum((p * 1000000)::bigint) over s)::double) / nullif(count(p) over s, 0) / 1e6 as price_hist_std_12w
  from weekly window s as (partition by ingredient order by week_start rows between 12 preceding and 1 preceding), w as (partition by ingredient order by week_start)),
di as (select date_trunc('week', ppi_date)::date as week_start, arg_max(ppi, ppi_date)::double as di_ppi from dollar group by 1),
macro as (select ingredient, date_trunc('week', ppi_date)::date as week_start, sum(ppi)::double / count(ppi) as macro_ppi from monthly group by 1, 2)"""
PANEL = f"""{WEEKLY},
joined as (select f.ingredient, f.week_start, price_avg_weekly, di_ppi, macro_ppi, extract(week from f.week_start)::int as week_of_year
  from featured f left join di using (week_start) left join macro m on m.ingredient = f.ingredient and m.week_start = f.week_start),
panel as (select ingredient, week_start, price_avg_weekly, week_of_year, last_value(di_ppi ignore nulls) over w as di_ppi, last_value(macro_ppi ignore nulls) over w as macro_ppi
  from joined window w as (partition by ingredient order by week_start rows between unbounded preceding and current row))"""


def _forward(rows: str, key: str, date: str, value: str, spans: list[int], unit: str) -> tuple[str, str]:
    word = {"d": "days", "mo": "months"}[unit]
    over = lambda n: f"over (partition by {key} order by {date} range between current row and interval {n} {word} following)"
    means = ", ".join(f"sum({value}) {over(n)}::double / nullif(count({value}) {over(n)}, 0) as {value}_fwd_{n}{unit}" for n in spans)
    pct = ", ".join(f"case when {value} != 0 then ({value}_fwd_{n}{unit} - {value}::double) / {value}::double end as {value}_fwd_{n}{unit}_pct" for n in spans)
    return f"fwd as (select *, {means} from {rows})", pct


def _round_all(names: list[str], places: int = 4) -> str:
    return ", ".join(f"round({n}, {places}) as {n}" for n in names)


_EXACT = ["price_avg_weekly", "price_min_weekly", "price_max_weekly", *(f"price_lag_{n}w" for n in (1, 2, 4, 8, 13, 26, 52)), *(f"price_hist_avg_{n}w" for n in (4, 12, 26, 52)), "di_ppi", "macro_ppi"]
_F = ["price_hist_std_12w"]


@query(f"""with {WEEKLY} select f.ingredient, f.week_start, n_reports_in_week, {", ".join(_EXACT)}, {_round_all(_F)}, extract(year from f.week_start)::int as year, extract(week from f.week_start)::int as week_of_year,
  extract(month from f.week_start)::int as month, extract(quarter from f.week_start)::int as quarter
  from featured f left join di using (week_start) left join macro m on m.ingredient = f.ingredient and m.week_start = f.week_start""")
def m5_weekly_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(panel.weekly_training(spark, sf_dir), 4, tuple(_EXACT))


_c, _p = _forward("dollar", "1", "ppi_date", "ppi", panel.DAYS, "d")
_N = [f"ppi_fwd_{n}d" for n in panel.DAYS]


@query(f"with {DOLLAR}, {_c}, p as (select *, {_p} from fwd) select 'DOLLAR' as series, ppi_date, ppi::double as ppi, {', '.join(_N + [f'{n}_pct' for n in _N])} from p")
def m1_dollar_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.dollar_mart(spark, sf_dir)


_c, _p = _forward("monthly", "ingredient", "ppi_date", "ppi", panel.MONTHS, "mo")
_N = [f"ppi_fwd_{n}mo" for n in panel.MONTHS]


@query(f"with {REPORTS}, {MONTHLY}, {_c}, p as (select *, {_p} from fwd) select ingredient, ppi_date, ppi::double as ppi, {', '.join(_N + [f'{n}_pct' for n in _N])} from p")
def m2_macro_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.macro_mart(spark, sf_dir)


_c, _p = _forward("daily", "ingredient, ingredient_group", "report_date", "price_avg", panel.DAYS, "d")
_N = [f"price_avg_fwd_{n}d" for n in panel.DAYS]


@query(f"""with {REPORTS}, daily as (select ingredient, ingredient_group, report_date, min(price)::double as price_min, max(price)::double as price_max,
  {_mean('price')} as price_avg from reports group by 1, 2, 3), {_c}, p as (select *, {_p} from fwd)
  select ingredient, ingredient_group, report_date, price_min, price_max, price_avg::double as price_avg, {', '.join(_N + [f'{n}_pct' for n in _N])} from p""")
def m3_market_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.market_mart(spark, sf_dir)


_c, _p = _forward("reports", "ingredient, unit", "report_date", "amount", [7, 30], "d")
_N = ["amount_fwd_7d", "amount_fwd_30d"]


@query(f"with {REPORTS}, {_c}, p as (select *, {_p} from fwd) select ingredient, unit, report_date, amount::double as amount, {', '.join(_N + [f'{n}_pct' for n in _N])} from p")
def m4_production_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.production_mart(spark, sf_dir)


@query("""with t as (select p_partkey, ' ' || p_name || ',  new--crop.' as n, case when p_size % 5 = 0 then 'NA' when p_size % 5 = 1 then 'BUSHELS' when p_size % 5 = 2 then 'TONS' else upper(p_type) end as u,
  case p_size % 4 when 0 then 'M' when 1 then '' when 2 then 'XQ' else 'BW' end as f from part)
  select p_partkey, trim(regexp_replace(upper(regexp_replace(n, '[-–—,.]+', ' ', 'g')), '\\s+', ' ', 'g')) as name, case u when 'NA' then '' when 'BUSHELS' then 'BU' when 'TONS' then 'TON' else u end as unit,
  case f when 'M' then 'monthly' when 'BW' then 'biweekly' when '' then 'unknown' else lower(f) end as frequency from t""")
def f_text_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size") % 5
    raw = tables.parquet(spark, sf_dir, "part").select(
        "p_partkey", F.concat(F.lit(" "), "p_name", F.lit(",  new--crop.")).alias("n"), F.when(size == 0, "NA").when(size == 1, "bushels").when(size == 2, "Tons").otherwise(F.col("p_type")).alias("u"),
        F.element_at(F.array(F.lit("M"), F.lit(""), F.lit("XQ"), F.lit("BW")), F.col("p_size") % 4 + 1).alias("f"),
    )
    return raw.select("p_partkey", text.no_marks(F.col("n")).alias("name"), text.singular_unit(text.no_placeholder(text.collapse(F.col("u")))).alias("unit"), text.frequency(F.col("f")).alias("frequency"))


@query("""select o_orderkey, round(o_totalprice, 2) as amount, case when o_orderkey % 3 = 2 then null else o_orderdate::date end as report_date, case when o_orderkey % 4 = 0 then null else o_orderpriority end as series from orders""")
def f_numbers_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = tables.parquet(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit(" "), F.format_number("o_totalprice", 2)).alias("amount"),
        F.when(k % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k % 3 == 1, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise("soon").alias("day"), F.when(k % 4 == 0, "No PPI available").otherwise(F.col("o_orderpriority")).alias("series"),
    )
    return o.select("o_orderkey", text.number(F.col("amount"), 2).alias("amount"), text.to_date(F.col("day")).alias("report_date"), text.no_series(F.col("series")).alias("series"))


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables.parquet(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_discount", F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"))
    return quality.flagged(
        t,
        {
            "order_present": quality.not_null(F.col("l_orderkey")), "discount_not_zero": quality.holds(F.col("l_discount") != 0), "flag_numeric": quality.numeric(F.col("l_returnflag")),
            "flag_upper": quality.no_lower_case(F.col("l_returnflag")), "day_format": quality.matches(F.col("day"), r"^\d{4}-\d{2}-\d{2}$"), "old_format": quality.matches(F.col("day"), r"^\d{1,2}/\d{1,2}/\d{4}$"),
        },
        {"line_unique": ["l_orderkey", "l_linenumber"]},
    )


_CHECKS = ["order_present", "discount_not_zero", "flag_numeric", "flag_upper", "day_format", "old_format", "line_unique"]


@query("""with f as (select *, strftime(l_shipdate, '%Y-%m-%d') as day from lineitem), v as (select count(*) filter (l_orderkey is null) as order_present, count(*) filter (not (l_discount <> 0)) as discount_not_zero,
  count(*) filter (l_returnflag is not null and try_cast(l_returnflag as double) is null) as flag_numeric, count(*) filter (l_returnflag <> upper(l_returnflag)) as flag_upper,
  count(*) filter (not coalesce(regexp_matches(day, '^\\d{4}-\\d{2}-\\d{2}$'), false)) as day_format, count(*) filter (not coalesce(regexp_matches(day, '^\\d{1,2}/\\d{1,2}/\\d{4}$'), false)) as old_format,
  (select coalesce(sum(c), 0)::bigint from (select count(*) c from lineitem group by l_orderkey, l_linenumber having count(*) > 1)) as line_unique from f)
  select 'lineitem' as table_name, check_name, violations, violations = 0 as passed, bool_and(violations = 0) over () as all_passed from (unpivot v on columns(*) into name check_name value violations)""")
def q_check_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summary(_checked(spark, sf_dir), "lineitem", _CHECKS)


@query("""with c as (select l_orderkey, l_linenumber, l_discount, count(*) over (partition by l_orderkey, l_linenumber) as n from lineitem)
  select l_orderkey, l_linenumber, case when l_discount = 0 then 'discount_not_zero,' else '' end || 'flag_numeric,old_format' || case when n > 1 then ',line_unique' else '' end as reasons from c""")
def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.split(_checked(spark, sf_dir))[1].select("l_orderkey", "l_linenumber", F.array_join("reasons", ",").alias("reasons"))


@query("select l_suppkey, l_partkey, n::bigint as others from (select l_suppkey, l_partkey, sum(count(*)) over (partition by l_suppkey) - count(*) as n from lineitem group by 1, 2) where n > 0")
def j6_ambiguous_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ambiguous(tables.parquet(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey"), "l_suppkey", "l_partkey")


_LAYOUTS = """raw as (select upper(p_type) as g, p_name as d, p_brand as n, case p_size % 5 when 0 then 'TONS' when 1 then '(NA)' when 2 then 'FURLONGS' when 3 then 'Bushels' else 'ACRES' end as u from part
    union all select upper(p_type), case when p_size % 4 = 0 then 'Total' else p_name end, case when p_size % 6 = 0 then null else p_brand end, ' tons ' from part where p_size % 2 = 0),
  marked as (select trim(regexp_replace(upper(g), '[-–—,. ]+', ' ', 'g')) as g, trim(regexp_replace(upper(d), '[-–—,. ]+', ' ', 'g')) as d, trim(regexp_replace(upper(coalesce(n, '')), '[-–—,. #]+', ' ', 'g')) as n, upper(trim(u)) as u from raw),
  named as (select distinct g as ingredient_group, d as ingredient_description, n as ingredient_name, case u when 'TONS' then 'TON' when 'BUSHELS' then 'BU' else u end as unit_of_measure
    from marked where g <> '' and d not in ('', 'TOTAL', '(NA)') and u in ('TONS', 'BUSHELS', 'ACRES'))"""
_UNITS = ["TON", "BU", "ACRES", ""]


def _layouts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """part as two raw production tables whose columns differ in order, with texts and units that are not to be kept."""
    part = tables.parquet(spark, sf_dir, "part")
    name, k = F.regexp_replace("p_brand", "#", "-"), F.col("p_size")
    unit = F.when(k % 5 == 0, " tons").when(k % 5 == 1, "(NA)").when(k % 5 == 2, "Furlongs").when(k % 5 == 3, "Bushels").otherwise("acres")
    crops = part.select(F.col("p_type").alias("GROUP_DESC"), F.col("p_name").alias("COMMODITY_DESC"), name.alias("CLASS_DESC"), unit.alias("UNIT_DESC"))
    animals = part.where(k % 2 == 0).select(F.when(k % 6 != 0, name).alias("CLASS_DESC"), F.col("p_type").alias("GROUP_DESC"), F.lit(" tons ").alias("UNIT_DESC"), F.when(k % 4 == 0, "Total").otherwise(F.col("p_name")).alias("COMMODITY_DESC"))
    return [crops, animals]


@query(f"""with {_LAYOUTS} select *, 10000 + row_number() over (order by ingredient_group, ingredient_description, ingredient_name, unit_of_measure) as ingredient_id from named""")
def g1_product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.product_master(_layouts(spark, sf_dir), _UNITS)


@query("select event_type as series, ts::date as date, (props::json->>'k')::double as value from events where (props::json->>'k')::int % 10 != 0")
def s_flatten_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    value = F.when(k.cast("int") % 10 == 0, ".").otherwise(k)
    landed = tables.parquet(spark, sf_dir, "events").select("event_type", F.to_json(F.struct(F.array(F.struct(F.date_format("ts", "yyyy-MM-dd").alias("date"), value.alias("value"))).alias("observations"))).alias("body"))
    return tables.observations(landed, "body", "event_type")


@query("select o_orderpriority as series, unnest([1, 2, n_nationkey % 5 + 3])::int as ingredient_id, n_name || ' | ' || o_orderpriority as ingredient_names, o_orderkey from orders join nation on n_nationkey = o_orderkey % 25")
def s_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = tables.parquet(spark, sf_dir, "orders").select(F.concat_ws("|", "o_orderpriority", (F.col("o_orderkey") % 25).cast("string")).alias("series"), "o_orderkey")
    n = tables.parquet(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    kinds = tables.parquet(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    mapping = kinds.join(F.broadcast(n)).select(F.concat_ws("|", "o_orderpriority", F.col("n_nationkey").cast("string")).alias("series"), F.array(F.lit(1), F.lit(2), F.col("n_nationkey") % 5 + 3).alias("ids"), F.array("n_name", "o_orderpriority").alias("names"))
    return tables.fan_out(o, mapping).select(F.split("series", r"\|")[0].alias("series"), "ingredient_id", "ingredient_names", "o_orderkey")


@query(f"with {REPORTS} select ingredient, min(report_date) as first_day, max(report_date) as last_day, count(*) as n_rows, count(distinct ingredient_group) as n_groups from reports group by 1")
def s_load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.reports(spark, sf_dir).groupBy("ingredient").agg(F.min("report_date").alias("first_day"), F.max("report_date").alias("last_day"), F.count("*").alias("n_rows"), F.count_distinct("ingredient_group").alias("n_groups"))


_TARGETS = f"{PANEL}, wide as (select *, " + ", ".join(f"lead(price_avg_weekly, {h}) over w as h{h}" for h in range(1, 14)) + " from panel window w as (partition by ingredient order by week_start)), targets as (" + " union all ".join(f"select ingredient, week_start, price_avg_weekly, {h} as horizon, h{h} as target from wide where h{h} is not null" for h in range(1, 14)) + ")"


@query(f"with {_TARGETS} select ingredient, week_start, price_avg_weekly, horizon, target from targets")
def w8_horizon_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores.targets(scores.panel_of(spark, sf_dir))


@query(f"""with {_TARGETS}, n as (select *, row_number() over (partition by ingredient, horizon order by week_start) - 1 as i, count(*) over (partition by ingredient, horizon) as n from targets),
  f as (select *, (i - (n - 5 * (n // 6))) // (n // 6) as fold from n where n // 6 > 0 and i >= n - 5 * (n // 6)),
  m as (select ingredient, horizon, fold, avg(abs(target - price_avg_weekly)) as mae, sqrt(avg((target - price_avg_weekly) ** 2)) as rmse, avg(abs(target - price_avg_weekly) / abs(target)) as mape from f group by all)
  select ingredient, horizon, round(avg(mae), 4) as mae, round(avg(rmse), 4) as rmse, round(avg(mape), 4) as mape, count(*) as folds from m group by all""")
def b2_naive_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scores.naive_backtest(scores.panel_of(spark, sf_dir)))


@query(f"""with {_TARGETS}, g as (select ingredient, week_start, avg(price_avg_weekly) over (partition by ingredient order by week_start rows between 3 preceding and current row) as guess from panel),
  a as (select t.ingredient, horizon, avg((sign(guess - price_avg_weekly) = sign(target - price_avg_weekly))::int) as direction, avg(abs(target - guess)) as mae, avg(abs(target - price_avg_weekly)) as base
  from targets t join g on g.ingredient = t.ingredient and g.week_start = t.week_start group by all) select ingredient, horizon, round(direction, 4) as direction, round(mae, 4) as mae, round(1 - mae / base, 4) as skill from a""")
def b4_direction_and_skill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scores.drift_backtest(scores.panel_of(spark, sf_dir)))


_COST = f"""{PANEL}, base as (select *, 3.8e0 * (avg(di_ppi) over w / greatest(di_ppi, 50e0)) as diesel, 3.5e0 * (macro_ppi / greatest(avg(macro_ppi) over w, 1e0)) as gas from panel window w as (partition by ingredient)),
  parts as (select *, (200e0 / 6.5e0 * diesel + 200e0 * 2.5e0) / 1000e0 as transport_cost, gas * 0.002e0 as energy_cost, price_avg_weekly * 0.0525e0 / 365e0 * 30e0 as carry_cost from base),
  cost as (select *, price_avg_weekly + transport_cost + energy_cost + carry_cost as total_landed_cost from parts)"""


@query(f"""with {_COST} select ingredient, week_start, price_avg_weekly, round(transport_cost, 6) as transport_cost, round(energy_cost, 6) as energy_cost, round(carry_cost, 6) as carry_cost,
  round(total_landed_cost, 6) as total_landed_cost, round(total_landed_cost / 0.88e0, 6) as implied_sell_price, round(total_landed_cost / 0.88e0 - total_landed_cost, 6) as gross_margin_usd,
  round((total_landed_cost / 0.88e0 - total_landed_cost) / (total_landed_cost / 0.88e0) * 100, 6) as gross_margin_pct from cost""")
def c1_landed_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scores.landed_cost(scores.panel_of(spark, sf_dir)).drop("di_ppi", "macro_ppi", "week_of_year", "diesel", "gas"), 6)


_SHOCKS = ", ".join(f"('{d}', {s}::double)" for d, s in scores.SHOCKS)


@query(f"""with {_COST}, s as (select * from (values {_SHOCKS}) v(driver, shock)), m as (select ingredient, week_start, driver, shock, total_landed_cost as t,
  (case when driver = 'miles' then 200e0 * (1 + shock) else 200e0 end / 6.5e0 * case when driver = 'diesel' then diesel * (1 + shock) else diesel end + case when driver = 'miles' then 200e0 * (1 + shock) else 200e0 end * 2.5e0) / 1000e0
  + case when driver = 'nat_gas' then gas * (1 + shock) else gas end * 0.002e0 + price_avg_weekly * case when driver = 'fed_funds' then greatest(0e0, 0.0525e0 + shock * 0.01e0) else 0.0525e0 end / 365e0 * 30e0 + price_avg_weekly as moved
  from cost cross join s) select ingredient, week_start, driver, round(shock * 100)::int as shock_pct, round(moved - t, 4) + 0.0 as delta_tlc, round((moved / t - 1) * 100, 4) + 0.0 as delta_pct from m""")
def c3_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores.scenarios(scores.landed_cost(scores.panel_of(spark, sf_dir)))


def _roll(f: str, x: str, n: int, least: int) -> str:
    w = f"over (partition by ingredient order by week_start rows between {n - 1} preceding and current row)"
    return f"case when count({x}) {w} >= {least} then {f}({x}) {w} end"


def _clip(x: str, lo: float, hi: float) -> str:
    return f"case when {x} < {lo} then {lo} when {x} > {hi} then {hi} else {x} end"


def _chg(x: str, n: int) -> str:
    return f"{x} / nullif(lag({x}, {n}) over (partition by ingredient order by week_start), 0) - 1"


def _score(x: str) -> str:
    return _clip(f"(50 + 15 * ({_clip(f'(({x} - m_{x}) / greatest(s_{x}, 1e-6) + 0 * s_{x})', -3, 3)}))", 0, 100)


_DIS = f"""{PANEL}, a as (select *, {_chg('price_avg_weekly', 1)} as c1, {_chg('price_avg_weekly', 4)} - ({_chg('price_avg_weekly', 26)}) as momentum,
  coalesce({_chg('macro_ppi', 12)}, 0) - coalesce({_chg('price_avg_weekly', 12)}, 0) as gap from panel),
  b as (select *, {_roll('median', 'macro_ppi', 52, 13)} as m_macro_ppi, {_roll('stddev_samp', 'macro_ppi', 52, 13)} as s_macro_ppi, {_roll('avg', 'gap', 52, 4)} as m_gap, {_roll('stddev_samp', 'gap', 52, 4)} as s_gap,
  {_roll('avg', 'momentum', 52, 4)} as m_momentum, {_roll('stddev_samp', 'momentum', 52, 4)} as s_momentum, {_roll('stddev_samp', 'c1', 12, 4)} as v1, {_roll('stddev_samp', 'c1', 52, 12)} as v2 from a),
  c as (select *, {_score('macro_ppi')} as s1, {_score('gap')} as s2, {_score('momentum')} as s3, {_clip(f"(({_clip('(v1 / greatest(v2, 1e-6) + 0 * v2)', 0, 5)}) / 3 * 100)", 0, 100)} as s4 from b)"""


@query(f"""with {_DIS}, d as (select *, s1 * 0.3e0 + s2 * 0.3e0 + s3 * 0.2e0 + s4 * 0.2e0 as s from c) select ingredient, week_start, price_avg_weekly, round(s, 4) as disruption_score,
  round(s1, 4) as score_supply_deviation, round(s2, 4) as score_price_gap, round(s3, 4) as score_price_momentum, round(s4, 4) as score_volatility_spike,
  case when s >= 90 then 'EMERGENCY' when s >= 75 then 'HIGH' when s >= 60 then 'MODERATE' when s is not null then 'LOW' end as level from d""")
def d5_disruption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scores.disruption(scores.panel_of(spark, sf_dir)))


def _rank(x: str) -> str:
    past = f"list({x}) filter ({x} is not null) over (partition by ingredient order by week_start rows between unbounded preceding and current row)"
    n = f"coalesce(len({past}), 0)"
    return f"case when {n} < 4 then 50e0 when {x} is null then null else 50e0 * (len(list_filter({past}, lambda v: v < {x})) + len(list_filter({past}, lambda v: v <= {x})) + 1) / {n} end"


_RISK = f"""{PANEL}, a as (select *, {_chg('price_avg_weekly', 1)} as c1, coalesce({_chg('macro_ppi', 52)}, 0) as y, coalesce({_chg('price_avg_weekly', 26)}, 0) as mo from panel),
  b as (select *, {_roll('avg', 'price_avg_weekly', 13, 4)} as a13, {_roll('avg', 'price_avg_weekly', 52, 12)} as a52, coalesce({_roll('stddev_samp', 'c1', 26, 4)}, 0) as vol from a),
  c as (select *, round({_clip('(a13 / greatest(a52, 1e-6) + 0 * a52)', 0.5, 2.0)}, 9) as r1, round(y, 9) as r2, -di_ppi as r3, round(-mo * (1 - ({_clip('vol', 0, 0.1)}) / 0.1e0), 9) as r4 from b),
  k as (select *, {_rank('r1')} as k1, {_rank('r2')} as k2, {_rank('r3')} as k3, {_rank('r4')} as k4 from c), d as (select *, k1 * 0.3e0 + k2 * 0.3e0 + k3 * 0.2e0 + k4 * 0.2e0 as s from k)"""


@query(f"""with {_RISK} select ingredient, week_start, price_avg_weekly, round(s, 4) as composite_risk, round(k1, 4) as supply_risk, round(k2, 4) as cost_risk, round(k3, 4) as logistics_risk,
  round(k4, 4) as demand_risk, case when s >= 80 then 'CRITICAL' when s >= 60 then 'HIGH' when s >= 40 then 'MODERATE' when s >= 20 then 'LOW' when s is not null then 'MINIMAL' end as level from d""")
def r5_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scores.risk(scores.panel_of(spark, sf_dir)))


@query(f"""with {PANEL} select ingredient, max(week_start) as week_start, arg_max(price_avg_weekly, week_start) as price_avg_weekly,
  array_to_string(list_slice(list((floor(price_avg_weekly * 100)::bigint)::varchar order by week_start), -12, -1), ',') as trend from panel group by 1""")
def w18_latest_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = scores.latest(scores.panel_of(spark, sf_dir), 12, "price_avg_weekly")
    return t.withColumn("trend", F.array_join(F.transform("trend", lambda x: F.floor(x * 100).cast("string")), ","))


_GRID = f"""{PANEL}, ends as (select ingredient, min(week_start) as a, max(week_start) as b from panel group by 1), weeks as (select ingredient, unnest(generate_series(a, b, interval 7 days))::date as week_start from ends),
  grid as (select w.ingredient, w.week_start, last_value(price_avg_weekly ignore nulls) over (partition by w.ingredient order by w.week_start rows between unbounded preceding and current row) as price,
  row_number() over (partition by w.ingredient order by w.week_start) - 1 as i from weeks w left join panel p on p.ingredient = w.ingredient and p.week_start = w.week_start)"""
_SEASON = f"""{_GRID}, t0 as (select *, count(*) over (partition by ingredient) as n, case when count(*) over w = 53 then (2 * sum(price::decimal(28,6)) over w - first_value(price::decimal(28,6)) over w - last_value(price::decimal(28,6)) over w)::double / 104 end as inn
  from grid window w as (partition by ingredient order by week_start rows between 26 preceding and 26 following)),
  ln as (select ingredient, regr_slope(inn, i) filter (i between 26 and 76) as sa, regr_intercept(inn, i) filter (i between 26 and 76) as ia, regr_slope(inn, i) filter (i between n - 77 and n - 27) as sb,
  regr_intercept(inn, i) filter (i between n - 77 and n - 27) as ib from t0 group by 1), t1 as (select t0.*, coalesce(inn, case when i < 26 then ia + sa * i else ib + sb * i end) as trend from t0 join ln using (ingredient)),
  dv as (select ingredient, i % 52 as p, avg(price - trend) as dev from t1 group by 1, 2), sn as (select ingredient, p, dev - avg(dev) over (partition by ingredient) as seasonal from dv),
  parts as (select t1.ingredient, week_start, price, case when n >= 104 then trend end as trend, case when n >= 104 then seasonal else 0 end as seasonal from t1 join sn on sn.ingredient = t1.ingredient and sn.p = t1.i % 52)"""


@query(f"with {_SEASON} select ingredient, week_start, price, {_round_all(['trend', 'seasonal'])} from parts")
def n2_seasonal_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scores.seasonal(scores.weekly_grid(scores.panel_of(spark, sf_dir))), exact=("price",))


_STATS = f"""{_SEASON}, stats as (select ingredient, extract(week from week_start)::int as week_of_year, quantile_cont(price, 0.25) as p25, quantile_cont(price, 0.5) as median, quantile_cont(price, 0.75) as p75, avg(price) as mean,
  avg(seasonal) as seasonal_factor from parts where extract(week from week_start) <= 52 group by 1, 2)"""


# Quartiles of prices with six places have eight at most.
@query(f"with {_STATS} select ingredient, week_of_year, {_round_all(['p25', 'median', 'p75'], 8)}, {_round_all(['mean', 'seasonal_factor'])} from stats")
def a6_seasonal_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    quartiles = ("p25", "median", "p75")
    return rounded(_stats(spark, sf_dir).withColumns({c: F.round(c, 8) for c in quartiles}), 4, quartiles)


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores.seasonal_stats(scores.seasonal(scores.weekly_grid(scores.panel_of(spark, sf_dir))))


def _curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price curve from one panel, written as it is used several times."""
    p = scores.panel_of(spark, sf_dir)
    parts = tables.written(scores.seasonal(tables.written(scores.weekly_grid(p), "weekly_grid")), "seasonal_parts")
    return tables.written(scores.price_curve(scores.seasonal_stats(parts), p), "price_curve")


_CURVE = f"""{_STATS}, lastp as (select ingredient, arg_max(price_avg_weekly, week_start) as now, extract(week from max(week_start))::int as start from panel group by 1), mid as (select ingredient, avg(median) as mid from stats group by 1),
  ahead as (select ingredient, now, mid, i::int as week_index, ((start - 2 + i) % 52 + 1)::int as week_of_year from lastp join mid using (ingredient) cross join generate_series(1, 52) g(i)),
  curve as (select a.ingredient, week_index, a.week_of_year, coalesce(median, now) * now / mid as expected_price, coalesce(p25, now * 0.95) * now / mid as p25_price, coalesce(p75, now * 1.05) * now / mid as p75_price,
  coalesce(seasonal_factor, 0) as seasonal_factor from ahead a left join stats s on s.ingredient = a.ingredient and s.week_of_year = a.week_of_year)"""


@query(f"with {_CURVE} select ingredient, week_index, week_of_year, {_round_all(['expected_price', 'p25_price', 'p75_price', 'seasonal_factor'], 4)} from curve")
def n3_price_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_curve(spark, sf_dir), 4)


# The greedy of scores.schedule() as a recursion over each ingredient's weeks by rising price.
_SCHEDULE = _CURVE.replace("with ", "", 1) + """, ranked as (select *, row_number() over (partition by ingredient order by expected_price, week_index) as k from curve),
  bought(ingredient, k, slack, room, week_index, add) as (
    select ingredient, 0::bigint, list_transform(generate_series(1, 52), lambda x: 1e6::double * least(x / 52 * 1.2::double, 1) - 5e3::double * x), 1e6::double - 52 * 5e3::double, 0, 0::double from (select distinct ingredient from curve)
    union all select b.ingredient, r.k, list_transform(b.slack, lambda x, i: case when i >= r.week_index then x - greatest(0, least(95e3::double, list_min(b.slack[r.week_index:]), b.room)) else x end),
      b.room - greatest(0, least(95e3::double, list_min(b.slack[r.week_index:]), b.room)), r.week_index, greatest(0, least(95e3::double, list_min(b.slack[r.week_index:]), b.room))
    from bought b join ranked r on r.ingredient = b.ingredient and r.k = b.k + 1),
  planned as (select c.*, 5e3::double + add as q from curve c join bought b on b.ingredient = c.ingredient and b.week_index = c.week_index),
  schedule as (select *, q * expected_price as cost, sum(q) over w as q_so_far, sum(q * expected_price) over w as cost_so_far from planned window w as (partition by ingredient order by week_index))"""


@query(f"""with recursive {_SCHEDULE} select ingredient, week_index, week_of_year, {_round_all(['expected_price', 'p25_price', 'p75_price', 'seasonal_factor'])}, round(q, 4) as recommended_purchase, round(cost) as total_cost,
  round(q_so_far, 4) as cumulative_purchase, round(cost_so_far) as cumulative_cost, expected_price < p25_price and q < 90000 as opportunistic_flag from schedule""")
def n4_purchase_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs = ("total_cost", "cumulative_cost")
    return rounded(rounded(scores.schedule(_curve(spark, sf_dir)), 4, costs), 0, ("expected_price", "p25_price", "p75_price", "seasonal_factor", "recommended_purchase", "cumulative_purchase"))


@query(f"""with recursive {_SCHEDULE} select ingredient, round(sum(cost)) as optimised_cost, round(avg(expected_price) * 1e6) as flat_cost, list(week_of_year order by expected_price, week_index)[1] as trough_week, list(week_of_year order by expected_price desc, week_index)[1] as peak_week,
  round((1 - sum(cost) / (avg(expected_price) * 1e6)) * 100, 4) as saving_pct from schedule group by 1""")
def a8_schedule_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rounded(scores.schedule_totals(tables.written(scores.schedule(_curve(spark, sf_dir)), "schedule")), 4, ("optimised_cost", "flat_cost")), 0, ("saving_pct",))


@query(f"""with {PANEL}, r as (select *, row_number() over (partition by ingredient order by week_start desc) as k from panel)
  select ingredient, round(avg(price_avg_weekly), 4) as price_52, round(avg(di_ppi), 4) as di_52, count(*) as n_weeks from r where k <= 52 group by 1""")
def a7_trailing_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = Window.partitionBy("ingredient").orderBy(F.col("week_start").desc())
    t = scores.panel_of(spark, sf_dir).withColumn("k", F.row_number().over(back)).where("k <= 52")
    return rounded(t.groupBy("ingredient").agg(F.avg("price_avg_weekly").alias("price_52"), F.avg("di_ppi").alias("di_52"), F.count("*").alias("n_weeks")))


@query("""select o_custkey::int as ingredient_id, round(o_totalprice, 2) as ppi, o_orderdate::date as ppi_date, 'monthly' as ppi_frequency from orders where o_orderkey % 7 > 1""")
def g2_price_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw_index(spark, sf_dir).select(F.col("o_custkey").cast("string").alias("ingredient_id"), "ppi", "date", text.frequency(F.lit("M")).alias("frequency"))
    return staging.price_index(raw, "ingredient_id", "int")


@query("""select o_orderpriority as fred_series_id, 'DOLLAR ' || o_orderstatus as name, round(o_totalprice, 2) as ppi, o_orderdate::date as ppi_date, 'daily' as ppi_frequency from orders where o_orderkey % 7 > 1""")
def g3_dollar_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw_index(spark, sf_dir).select(F.col("o_orderpriority").alias("fred_series_id"), F.concat(F.lit("DOLLAR "), "o_orderstatus").alias("name"), "ppi", "date", text.frequency(F.lit("D")).alias("frequency"))
    return staging.price_index(raw, "fred_series_id", "string", "name")


def _raw_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as landed index rows: text, with the tokens for no value."""
    k = F.col("o_orderkey") % 7
    return tables.parquet(spark, sf_dir, "orders").withColumns({"ppi": F.when(k == 0, ".").when(k == 1, "").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")), "date": F.date_format("o_orderdate", "yyyy-MM-dd")})


@query("""select l_suppkey::int as slug_id, case l_linenumber % 3 when 0 then 'SOYBEAN' when 1 then 'SUNFLOWER' else 'CORN' end as ams_ingredient_name, 'REPORT ' || l_returnflag as report_title, l_linestatus as ams_ingredient_group,
  null::varchar as ams_ingredient_grade, 'PER BU' as price_unit, 'CASH' as sale_type, 'ELEVATOR' as delivery_point, 'FOB' as freight, 'TRUCK' as trans_mode, 'IA' as market_location_state,
  case when l_linenumber = 2 then null else round(l_extendedprice, 2) end as price_min, round(l_extendedprice, 2) as price_max, null::double as price_avg, l_shipdate::date as report_date from lineitem""")
def g4_market_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, price = F.col("l_linenumber"), F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    raw = tables.parquet(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("slug_id"), F.when(n % 3 == 0, " Soybeans").when(n % 3 == 1, "sunflower seeds ").otherwise("Corn").alias("commodity"), F.concat(F.lit("Report "), F.lower("l_returnflag")).alias("report_title"),
        F.lower("l_linestatus").alias("cat"), F.lit(None).cast("string").alias("grade"), F.lit("per bu").alias("price_unit"), F.lit("cash").alias("sale Type"), F.lit("Elevator").alias("delivery_point"), F.lit("fob").alias("freight"),
        F.lit("Truck").alias("trans_mode"), F.lit("ia").alias("market_location_state"), F.when(n == 2, " ").otherwise(price).alias("price Min"), price.alias("price Max"), F.lit("").alias("avg_price"),
        F.when(n % 2 == 0, F.date_format("l_shipdate", "MM/dd/yyyy")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("report_date"),
    )
    return staging.market_reports(raw)


@query("""select p_brand as ingredient_name, p_type as unit_of_measure, case when p_partkey % 4 = 0 then null else (p_size * 1000 + p_partkey % 1000)::double end as amount, case when p_partkey % 3 = 0 then null else p_size::double end as cv_pct,
  (1990 + p_size)::int as year, 'ANNUAL' as frequency, 'YEAR' as range, date '2020-01-01' + p_size as load_time, 'IA' as state, 'UNITED STATES' as country from part""")
def g5_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    raw = tables.parquet(spark, sf_dir, "part").select(
        F.col("p_brand").alias("CLASS_DESC"), F.col("p_type").alias("UNIT_DESC"), F.when(k % 4 == 0, " (D)").otherwise(F.format_number(size * 1000 + k % 1000, 0)).alias("VALUE"), F.when(k % 3 == 0, "(NA)").otherwise(size.cast("string")).alias("CV_%"),
        (size + 1990).cast("string").alias("YEAR"), F.lit("ANNUAL").alias("FREQ_DESC"), F.lit("YEAR").alias("REFERENCE_PERIOD_DESC"), F.concat(F.date_add(F.lit("2020-01-01").cast("date"), size).cast("string"), F.lit(" 12:00:00")).alias("LOAD_TIME"),
        F.lit("IA").alias("STATE_ALPHA"), F.lit("UNITED STATES").alias("COUNTRY_NAME"),
    )
    return staging.production(raw)


@query("""select p_partkey::int as ingredient_id, p_type as ingredient_group, p_name as ingredient_description, p_brand as ingredient_name, 'BU' as unit_of_measure, case when p_size % 3 = 0 then null else 'PCU' || p_size end as fred_series_id from part""")
def g6_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tables.parquet(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("ingredient_id"), F.col("p_type").alias("ingredient_group"), F.col("p_name").alias("ingredient_description"), F.col("p_brand").alias("ingredient_name"), F.lit("BU").alias("unit_of_measure"),
        F.when(F.col("p_size") % 3 == 0, "No PPI available").otherwise(F.concat(F.lit("PCU"), F.col("p_size").cast("string"))).alias("fred_series_id"),
    )
    return staging.mapping(raw)


@query(f"with {_LAYOUTS} select * from named")
def u1_two_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.master(_layouts(spark, sf_dir), _UNITS)


@query(f"""with {_COST}, l as (select *, row_number() over (partition by ingredient order by week_start desc) as k from cost),
  u as (select ingredient, week_start, total_landed_cost as t, unnest(['commodity', 'transport', 'energy', 'carry']) as part, unnest([price_avg_weekly, transport_cost, energy_cost, carry_cost]) as usd from l where k = 1)
  select ingredient, week_start, part, round(usd, 4) as usd, round(case when t > 0 then usd / t * 100 else 0 end, 4) as share_pct from u""")
def c4_cost_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scores.cost_shares(scores.landed_cost(scores.panel_of(spark, sf_dir))))


def _trained(spark: SparkSession, sf_dir: str) -> forecast.Trained:
    return forecast.train(panel.weekly_training(spark, sf_dir))


def _forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.forecast(_trained(spark, sf_dir))


@query()
def b8_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_forecast(spark, sf_dir))


@query()
def b6_forecast_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(forecast.errors(_trained(spark, sf_dir)))


@query()
def b6_fold_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(forecast.fold_errors(_trained(spark, sf_dir)))


@query()
def b6_compared_with_pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(forecast.compared_with_pooled(_trained(spark, sf_dir)))


@query(f"""with {_TARGETS} select horizon, count(*) as n_rows, round(quantile_cont(target / price_avg_weekly - 1, 0.1), 8) as lo, round(quantile_cont(target / price_avg_weekly - 1, 0.9), 8) as hi from targets group by 1""")
def b7_naive_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact percentiles of the relative errors of the last price, by horizon."""
    off = scores.targets(scores.panel_of(spark, sf_dir)).select("horizon", (F.col("target") / F.col("price_avg_weekly") - 1).alias("off"))
    off = tables.written(off, "naive_errors")
    q = selection.percentiles(off, ["horizon"], "off", [0.1, 0.9])
    return off.groupBy("horizon").agg(F.count("*").alias("n_rows")).join(q, "horizon").select("horizon", "n_rows", F.round(F.col("q")[0], 8).alias("lo"), F.round(F.col("q")[1], 8).alias("hi"))


@query()
def b9_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(forecast.importance_summary(forecast.importance(_trained(spark, sf_dir))), 6)


@query()
def c2_forecast_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(forecast.forecast_cost(_forecast(spark, sf_dir)))


@query()
def r6_quick_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.quick_risk(scores.panel_of(spark, sf_dir), _forecast(spark, sf_dir))


_DAY = "1997-06-30"


@query(f"""with {PANEL}, cut as (select * from panel where week_start <= date '{_DAY}') select ingredient, max(week_start) as week_start, arg_max(price_avg_weekly, week_start) as price_avg_weekly,
  array_to_string(list_slice(list((floor(price_avg_weekly * 100)::bigint)::varchar order by week_start), -12, -1), ',') as trend from cut group by 1""")
def p7_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = scores.latest(scores.panel_of(spark, sf_dir), 12, "price_avg_weekly", _DAY)
    return t.withColumn("trend", F.array_join(F.transform("trend", lambda x: F.floor(x * 100).cast("string")), ","))


# A mapping made of part: two ids for each brand, each of one unit; some brands are in none.
_MAPPING = """mapping as (select 10000 + 10 * substr(p_brand, 7)::int + k as ingredient_id, 'GROUP ' || k as ingredient_group, lower(p_brand) as ingredient_description, p_brand as ingredient_name, ['A', 'N', 'R'][k] as unit_of_measure,
    case when k = 1 then 'PCU' || substr(p_brand, 7) end as fred_series_id from (select distinct p_brand from part where substr(p_brand, 8) <> '4') cross join (values (1), (2)) v(k))"""


def _mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.substring("p_brand", 7, 2)
    brands = tables.parquet(spark, sf_dir, "part").select("p_brand").distinct().where(F.substring("p_brand", 8, 1) != "4").withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
    return brands.select(
        (10000 + 10 * code.cast("int") + F.col("k")).alias("ingredient_id"), F.concat(F.lit("GROUP "), F.col("k").cast("string")).alias("ingredient_group"), F.lower("p_brand").alias("ingredient_description"), F.col("p_brand").alias("ingredient_name"),
        F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), F.col("k")).alias("unit_of_measure"), F.when(F.col("k") == 1, F.concat(F.lit("PCU"), code)).alias("fred_series_id"),
    )


_c, _p = _forward("joined", "ingredient_id", "load_time", "amount", panel.DAYS, "d")
_N = [f"amount_fwd_{n}d" for n in panel.DAYS]


@query(f"""with {REPORTS}, {_MAPPING}, joined as (select {", ".join("m." + c for c in panel.MAPPED)}, amount, report_date as load_time, extract(year from report_date)::int as year from reports r join mapping m on r.ingredient = m.ingredient_name and r.unit = m.unit_of_measure), {_c},
  p as (select *, {_p} from fwd) select {", ".join(panel.MAPPED)}, year, load_time, amount::double as amount, {', '.join(_N + [f'{n}_pct' for n in _N])} from p""")
def m4_mapped_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = panel.reports(spark, sf_dir).select(F.col("ingredient").alias("ingredient_name"), F.col("unit").alias("unit_of_measure"), "amount", F.col("report_date").alias("load_time"), F.year("report_date").alias("year"))
    return panel.mapped_production(_mapping(spark, sf_dir), rows)


_c, _p = _forward("daily", "ingredient_id", "report_date", "price_avg", panel.DAYS, "d")
_N = [f"price_avg_fwd_{n}d" for n in panel.DAYS]


@query(f"""with {REPORTS}, {_MAPPING}, market as (select 'REPORT ' || unit as report_title, ingredient as ams_ingredient_name, 'PER BU' as price_unit, case when amount > 25 then 'CASH' else 'FORWARD' end as sale_type, report_date, price from reports),
  daily as (select {", ".join("m." + c for c in panel.MAPPED)}, report_title, ams_ingredient_name, price_unit, sale_type, report_date, min(price)::double as price_min, max(price)::double as price_max, {_mean('price')} as price_avg
    from market join mapping m on ams_ingredient_name = m.ingredient_name group by all), {_c}, p as (select *, {_p} from fwd)
  select {", ".join(panel.MAPPED + panel.REPORTED)}, price_min, price_max, price_avg::double as price_avg, {', '.join(_N + [f'{n}_pct' for n in _N])} from p""")
def m3_mapped_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = panel.reports(spark, sf_dir).select(
        F.concat(F.lit("REPORT "), "unit").alias("report_title"), F.col("ingredient").alias("ams_ingredient_name"), F.lit("PER BU").alias("price_unit"), F.when(F.col("amount") > 25, "CASH").otherwise("FORWARD").alias("sale_type"), "report_date",
        F.col("price").alias("price_avg"), F.col("price").cast("double").alias("price_min"), F.col("price").cast("double").alias("price_max"),
    )
    return panel.mapped_market(_mapping(spark, sf_dir), rows)


@query("""select substr(p_brand, 7)::int * 10 + 10001 as ingredient_id, p_partkey, round(p_retailprice, 2) as ppi from part where p_brand = 'Brand#23'""")
def j5_index_of_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = tables.parquet(spark, sf_dir, "part").select((F.substring("p_brand", 7, 2).cast("int") * 10 + 10001).alias("ingredient_id"), "p_partkey", F.round("p_retailprice", 2).alias("ppi"))
    return panel.index_of_name(index, _mapping(spark, sf_dir), "Brand#23")


_c, _p = _forward("monthly", "ingredient", "ppi_date", "ppi", panel.MONTHS, "mo")
_N = [f"ppi_fwd_{n}mo" for n in panel.MONTHS]


@query(f"with {REPORTS}, {MONTHLY}, {_c}, p as (select *, {_p} from fwd) select ingredient, ppi_date, ppi::double as ppi, {', '.join(_N + [f'{n}_pct' for n in _N])} from p where ingredient = 'Brand#23'")
def p4_macro_of_one_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.macro_mart(spark, sf_dir, "Brand#23")


_c, _p = _forward("named", "ingredient, unit", "report_date", "amount", [7, 30], "d")
_N = ["amount_fwd_7d", "amount_fwd_30d"]


@query(f"with {REPORTS}, named as (select * from reports where contains(ingredient, 'd#2')), {_c}, p as (select *, {_p} from fwd) select ingredient, unit, report_date, amount::double as amount, {', '.join(_N + [f'{n}_pct' for n in _N])} from p")
def p5_production_by_part_of_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.production_mart(spark, sf_dir, "d#2")


_ALERT = ", ".join(f"('{level}', '{colour}', '{action}')" for level, (colour, action) in scores.ALERTS.items())


@query(f"""with {_DIS}, d as (select *, s1 * 0.3e0 + s2 * 0.3e0 + s3 * 0.2e0 + s4 * 0.2e0 as s from c where week_start <= date '{_DAY}'), e as (select ingredient, max(week_start) as week_start, arg_max(s, week_start) as s, count(s) as n,
    list_sum(list_slice(list(s order by week_start), -12, -1)) as t from (select *, row_number() over (partition by ingredient order by week_start desc) as back from d) where back <= 12 group by 1),
  f as (select *, case when s >= 90 then 'EMERGENCY' when s >= 75 then 'HIGH' when s >= 60 then 'MODERATE' when s is not null then 'LOW' end as level from e)
  select ingredient, week_start, round(s, 4) as disruption_score, level, colour, action, n as n_trend, round(t, 4) as sum_trend from f left join (values {_ALERT}) v(name, colour, action) on name = level""")
def d5_current_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = scores.current_alert(scores.disruption(scores.panel_of(spark, sf_dir)), _DAY)
    total = F.when(F.size("trend") > 0, F.aggregate("trend", F.lit(0.0), lambda a, x: a + x))
    return rounded(t.select("ingredient", "week_start", "disruption_score", "alert.*", F.size("trend").cast("long").alias("n_trend"), total.alias("sum_trend")))


@query(f"""with {_RISK}, l as (select *, row_number() over (partition by ingredient order by week_start desc) as back from k), u as (select ingredient, week_start, unnest(['supply_risk', 'cost_risk', 'logistics_risk', 'demand_risk']) as dimension,
  unnest([k1, k2, k3, k4]) as score, unnest([0.3e0, 0.3e0, 0.2e0, 0.2e0]) as weight from l where back = 1) select ingredient, week_start, dimension, round(score, 4) as score, round(weight, 4) as weight from u""")
def r5_radar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scores.radar(scores.risk(scores.panel_of(spark, sf_dir))))


@query(f"""with {_COST}, l as (select *, row_number() over (partition by ingredient order by week_start desc) as k from cost), n as (select * from l where k = 1), d as (select ingredient, total_landed_cost as t, unnest(['base', 'diesel +20%', 'nat_gas +20%', 'miles +20%']) as label,
    unnest([0, (200e0 / 6.5e0 * diesel * 1.2 - 200e0 / 6.5e0 * diesel) / 1000e0, gas * 0.2 * 0.002e0, 0.2 * transport_cost]) as more from n)
  select ingredient, label, round(t + round(more, 4), 6) as usd from d""")
def c4_shock_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scores.shock_rows(scores.landed_cost(scores.panel_of(spark, sf_dir))), 6)


@query("""select o_orderkey::varchar as key, case when o_orderkey % 5 = 0 then null else o_orderpriority || ', "' || o_orderstatus || '"' end as name, case when o_orderkey % 2 = 0 then strftime(o_orderdate, '%m/%d/%Y') end as day,
  case when o_orderkey % 3 = 0 then null else o_orderstatus end as value from orders""")
def s_delimited_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders written as delimited files of two layouts, quotes and null tokens among them, and read back by name."""
    k = F.col("o_orderkey")
    named = F.when(k % 5 == 0, ".").otherwise(F.concat("o_orderpriority", F.lit(', "'), "o_orderstatus", F.lit('"')))
    o = tables.parquet(spark, sf_dir, "orders").select(k.cast("string").alias("key"), named.alias("name"), F.when(k % 3 == 0, F.when(k % 2 == 0, "").otherwise(" . ")).otherwise(F.col("o_orderstatus")).alias("value"), F.date_format("o_orderdate", "MM/dd/yyyy").alias("day"), (k % 2).alias("half"))
    path = tables.scratch_path(spark, "delimited")
    tables.write_csv(o.where("half = 0").select("key", "name", "day", "value"), f"{path}/even")
    tables.write_csv(o.where("half = 1").select("value", "name", "key"), f"{path}/odd")
    return tables.delimited(spark, {f"{path}/e*/*.csv": ["key", "name", "day", "value"], f"{path}/odd/*.csv": ["value", "name", "key"]}).select("key", "name", "day", "value")


@query("""select l_orderkey, l_orderkey % 2 = 0 as truncated, l_returnflag as flag, l_linenumber::varchar as line from lineitem where l_orderkey % 10 <> 3""")
def s_report_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as landed report documents, one per order, and the rows of their detail sections."""
    line = tables.parquet(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_returnflag").alias("flag"), F.col("l_linenumber").cast("string").alias("line"), F.col("l_orderkey").cast("string").alias("order"))).alias("results"))
    n = F.size("results").cast("long")
    section = F.struct(F.when(F.col("l_orderkey") % 10 == 3, "Report Header").otherwise("Report Detail").alias("reportSection"), F.struct((n + F.when(F.col("l_orderkey") % 2 == 0, 1).otherwise(0)).alias("totalRows"), n.alias("returnedRows")).alias("stats"), "results")
    landed = line.select(F.to_json(F.array(section)).alias("body"))
    return tables.report_details(landed, "body", ["flag", "line", "order"]).select(F.col("order").cast("long").alias("l_orderkey"), "truncated", "flag", "line")


@query("select p_brand, p_partkey, p_size, 1 as n_files from part where p_brand in ('Brand#11', 'Brand#23')")
def s_parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part written with a folder per brand, its rows in order, and two brands read back; n_files is the number of files of a brand."""
    path = tables.scratch_path(spark, "sink")
    tables.write_parquet(tables.parquet(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_size"), path, "p_brand", ("p_partkey",))
    back = spark.read.parquet(path).where(F.col("p_brand").isin("Brand#11", "Brand#23")).withColumn("file", F.input_file_name())
    files = back.groupBy("p_brand").agg(F.count_distinct("file").cast("int").alias("n_files"))
    return back.join(F.broadcast(files), "p_brand").select("p_brand", "p_partkey", "p_size", "n_files")  # two rows


@query("select c_mktsegment as key, count(*) as n, min(c_custkey) as first_key, max(c_custkey) as last_key from customer group by 1")
def s_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary of customer per segment written as a JSON document each and read back."""
    path = tables.scratch_path(spark, "snapshots")
    t = tables.parquet(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("key")).agg(F.count("*").alias("n"), F.min("c_custkey").alias("first_key"), F.max("c_custkey").alias("last_key"))
    tables.write_snapshots(t, path, "key")
    read = spark.read.text(path).select(F.from_json("value", "key string, n long, first_key long, last_key long").alias("d"))
    return read.select("d.*")


@query("select p_type as commodity, min(l_shipdate::date) as first_day, max(l_shipdate::date) as last_day, count(*) as n_rows from lineitem join part on p_partkey = l_partkey group by 1")
def s_report_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.reports(spark, sf_dir).groupBy(F.col("ingredient_group").alias("commodity")).agg(F.min("report_date").alias("first_day"), F.max("report_date").alias("last_day"), F.count("*").alias("n_rows"))


@query("""select o_orderkey::varchar as key, o_orderpriority as name, strftime(o_orderdate, '%m/%d/%Y') as day from orders where o_orderkey % 3 < 2""")
def s3_columns_in_any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders in one folder of delimited files, some of them with their columns in another order and some of another layout, read by their headers."""
    k = F.col("o_orderkey")
    o = tables.parquet(spark, sf_dir, "orders").select(k.cast("string").alias("key"), F.col("o_orderpriority").alias("name"), F.date_format("o_orderdate", "MM/dd/yyyy").alias("day"), (k % 3).alias("part"))
    path = tables.scratch_path(spark, "arranged")
    for part, columns in enumerate((["key", "name", "day"], ["day", "key", "name"], ["name", "key"])):
        tables.write_csv(o.where(F.col("part") == part).select(*columns), f"{path}/part{part}")
    return tables.delimited(spark, {f"{path}/*/*.csv": ["name", "day", "key"]}, refuse=False)


@query("""select p_brand, count(*) as n_rows, 0::bigint as out_of_order, 0::bigint as overlapping from lineitem join part on p_partkey = l_partkey group by 1""")
def k1_sorted_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports written by brand and day and read back: rows before their predecessor in a file, and files of a brand that reach into the next one."""
    path = tables.scratch_path(spark, "sorted")
    rows = panel.reports(spark, sf_dir).select(F.col("ingredient").alias("p_brand"), "report_date", "price")
    tables.write_parquet(rows, path, "p_brand", ("report_date", "price"), file_rows=500)
    back = spark.read.parquet(path).select("p_brand", F.struct("report_date", "price").alias("place"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    in_file = Window.partitionBy("p_brand", "file").orderBy("at")
    files = back.withColumn("behind", F.lag("place").over(in_file) > F.col("place")).groupBy("p_brand", "file").agg(F.count("*").alias("n"), F.count_if("behind").alias("behind"), F.min("place").alias("lo"), F.max("place").alias("hi"))
    late = F.lag("hi").over(Window.partitionBy("p_brand").orderBy("lo", "hi")) > F.col("lo")
    return files.withColumn("late", late).groupBy("p_brand").agg(F.sum("n").alias("n_rows"), F.sum("behind").alias("out_of_order"), F.count_if("late").alias("overlapping"))


@query("select count(distinct p_brand) as ingredients, count(distinct p_type) as series, count(*) as n_rows from lineitem join part on p_partkey = l_partkey")
def s9_load_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct ingredients and series of the load, and its rows."""
    return panel.reports(spark, sf_dir).agg(F.count_distinct("ingredient").alias("ingredients"), F.count_distinct("ingredient_group").alias("series"), F.count("*").alias("n_rows"))


@query("""select 'part' as table_name, 'unique_name' as check_name, (select count(*) from part where p_name in (select p_name from part group by 1 having count(*) > 1)) as violations,
  (select count(*) = count(distinct p_name) from part) as passed, (select count(*) = count(distinct p_name) from part) as all_passed""")
def q9_one_column_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = quality.flagged(tables.parquet(spark, sf_dir, "part").select("p_partkey", "p_name"), {}, {"unique_name": ["p_name"]})
    return quality.summary(checked, "part", ["unique_name"])


_c, _p = _forward("joined", "ingredient_id", "ppi_date", "ppi", panel.MONTHS, "mo")
_N = [f"ppi_fwd_{n}mo" for n in panel.MONTHS]


@query(f"""with {REPORTS}, {MONTHLY}, {_MAPPING}, keyed as (select 10000 + 10 * substr(ingredient, 7)::int + 1 as ingredient_id, ppi_date, ppi from monthly),
  joined as (select {", ".join("m." + c for c in panel.MAPPED)}, ppi_date, ppi from keyed join mapping m using (ingredient_id)), {_c}, p as (select *, {_p} from fwd)
  select {", ".join(panel.MAPPED)}, ppi_date, ppi::double as ppi, {', '.join(_N + [f'{n}_pct' for n in _N])} from p""")
def m2_mapped_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping joined with the monthly index on ingredient_id; ids of the mapping without an index and the reverse are in no row."""
    index = panel.monthly_index(panel.daily_sums(spark, sf_dir)).select((10001 + 10 * F.substring("ingredient", 7, 2).cast("int")).alias("ingredient_id"), "ppi_date", "ppi")
    return panel.mapped_index(_mapping(spark, sf_dir), index)


_WEIGHTS = {"supply_risk": 1.0, "cost_risk": 1.0, "logistics_risk": 2.0, "demand_risk": 4.0}
_RISK_ALERT = ", ".join(f"('{level}', '{colour}', '{action}')" for level, (colour, action) in scores.RISK_ALERTS.items())


@query(f"""with {_RISK}, o as (select *, k1 * 0.125e0 + k2 * 0.125e0 + k3 * 0.25e0 + k4 * 0.5e0 as t from k), l as (select *, row_number() over (partition by ingredient order by week_start desc) as back from o),
  named as (select *, case when t >= 80 then 'CRITICAL' when t >= 60 then 'HIGH' when t >= 40 then 'MODERATE' when t >= 20 then 'LOW' when t is not null then 'MINIMAL' end as level from l where back = 1)
  select ingredient, week_start, round(t, 4) as composite_risk, level, colour, action, round(k4, 2) as demand, 0.5e0 as demand_weight from named left join (values {_RISK_ALERT}) v(name, colour, action) on name = level""")
def r5_classified_by_own_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level, colour and action of the last week's risk under four weights that are divided by their sum."""
    scored = scores.risk(scores.panel_of(spark, sf_dir), tuple(_WEIGHTS.values()))
    last = scores.current_risk(scored, _WEIGHTS)
    demand = F.filter("radar", lambda r: r["dimension"] == "demand_risk")[0]
    return rounded(last.select("ingredient", "week_start", "composite_risk", "classification.level", "classification.colour", "classification.action", demand["score"].alias("demand"), demand["weight"].alias("demand_weight")))


@query(f"""with recursive {_SCHEDULE}, dis as (select ingredient, max(week_start) as as_of, arg_max(s, week_start) as s, count(s) as n from (select *, row_number() over (partition by ingredient order by week_start desc) as back
      from (select *, s1 * 0.3e0 + s2 * 0.3e0 + s3 * 0.2e0 + s4 * 0.2e0 as s from ({"with " + _DIS + " select * from c"}))) where back <= 12 group by 1),
  rk as (select ingredient, arg_max(s, week_start) as s from ({"with " + _RISK + " select * from d"}) group by 1),
  plan as (select ingredient, round(avg(expected_price) * 1e6) as naive_cost, count(*) filter (where expected_price < p25_price and q < 90000) as cheap_weeks from schedule group by 1),
  seas as (select ingredient, count(*) as seasonal_weeks from stats group by 1)
  select ingredient, as_of, round(dis.s, 2) as disruption, case when dis.s >= 90 then 'EMERGENCY' when dis.s >= 75 then 'HIGH' when dis.s >= 60 then 'MODERATE' when dis.s is not null then 'LOW' end as alert, n as trend_weeks,
    0.3e0 as gap_weight, 90 as emergency_from, round(rk.s, 2) as risk, 0.2e0 as demand_weight, naive_cost, cheap_weeks, seasonal_weeks
  from dis join rk using (ingredient) join plan using (ingredient) join seas using (ingredient)""")
def s14_published_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested documents of disruption, risk and purchases, published at once, read back as JSON text."""
    p = scores.panel_of(spark, sf_dir)
    stats = tables.written(scores.seasonal_stats(scores.seasonal(scores.weekly_grid(p))), "seasonal_stats")
    plan = tables.written(scores.schedule(scores.price_curve(stats, p)), "schedule")
    documents = {"disruption": scores.disruption_documents(scores.disruption(p)), "risk": scores.risk_documents(scores.risk(p)), "purchases": scores.purchase_documents(stats, plan, p)}
    path = tables.scratch_path(spark, "documents")
    tables.publish({name: tables.snapshots(df, "ingredient") for name, df in documents.items()}, path)
    back = {name: tables.published(spark, path, name).select("ingredient", F.from_json("document", df.schema).alias(name)) for name, df in documents.items()}
    t = back["disruption"].join(back["risk"], "ingredient").join(back["purchases"], "ingredient")
    demand = F.filter("risk.radar", lambda r: r["dimension"] == "demand_risk")[0]["weight"]
    return t.select(
        "ingredient", F.col("disruption.as_of").alias("as_of"), F.col("disruption.composite_score").alias("disruption"), F.col("disruption.alert.level").alias("alert"), F.size("disruption.trend_12w").cast("long").alias("trend_weeks"),
        F.col("disruption.weights.price_gap").alias("gap_weight"), F.col("disruption.thresholds.emergency_action").alias("emergency_from"), F.col("risk.composite_risk").alias("risk"), demand.alias("demand_weight"),
        F.round("purchases.optimiser_summary.naive_cost").alias("naive_cost"), F.size("purchases.optimiser_summary.opportunistic_buy_weeks").cast("long").alias("cheap_weeks"), F.size("purchases.seasonal_stats").cast("long").alias("seasonal_weeks"),
    )


# A forecast made by SQL as well: the last price, moved by the exact 10th, 50th and 90th percentile of how prices moved over as many weeks.
_NAIVE = f"""{_TARGETS}, q as (select horizon, quantile_cont(target / price_avg_weekly - 1, 0.1) as q10, quantile_cont(target / price_avg_weekly - 1, 0.5) as q50, quantile_cont(target / price_avg_weekly - 1, 0.9) as q90 from targets group by 1),
  lastp as (select ingredient, max(week_start) as forecast_date, arg_max(price_avg_weekly, week_start) as price from panel group by 1),
  fc as (select ingredient, forecast_date, horizon, (forecast_date + 7 * horizon)::date as target_week_start, price * (1 + q10) as p10, price * (1 + q50) as p50, price * (1 + q90) as p90 from lastp cross join q)"""


def _naive_forecast(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(panel, forecast)."""
    p = scores.panel_of(spark, sf_dir)
    return p, tables.written(forecast.quantile_forecast(p), "naive_forecast")


@query(f"with {_NAIVE} select ingredient, forecast_date, horizon as horizon_weeks, target_week_start, {_round_all(['p10', 'p50', 'p90'])} from fc")
def f13_quantile_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_naive_forecast(spark, sf_dir)[1])


@query(f"""with {_NAIVE}, u as (select ingredient, target_week_start as week_start, horizon as horizon_weeks, unnest(['p10', 'p50', 'p90']) as quantile, unnest([p10, p50, p90]) as price from fc),
  c as (select *, (200e0 / 6.5e0 * 3.8e0 + 200e0 * 2.5e0) / 1000e0 as transport_cost, 3.5e0 * 0.002e0 as energy_cost, price * 0.0525e0 / 365e0 * 30e0 as carry_cost from u)
  select ingredient, week_start, horizon_weeks, quantile, round(price, 4) as commodity_price, round(transport_cost, 4) as transport_cost, round(energy_cost, 4) as energy_cost, round(carry_cost, 4) as carry_cost,
  round(price + transport_cost + energy_cost + carry_cost, 4) as total_landed_cost, round((price + transport_cost + energy_cost + carry_cost) / 0.88e0, 4) as implied_sell_price from c""")
def c2_cost_of_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(forecast.forecast_cost(_naive_forecast(spark, sf_dir)[1]))


@query(f"""with {_NAIVE}, t as (select ingredient, list(price_avg_weekly order by week_start) as xs from (select *, row_number() over (partition by ingredient order by week_start desc) as back from panel) where back <= 12 group by 1),
  m as (select t.ingredient, xs[-1] as price, list_avg(xs) as mean, sqrt(list_avg(list_transform(xs, lambda x: (x - list_avg(xs)) ** 2))) as sd, xs[1] as first, p10, p50, p90 from t join fc on fc.ingredient = t.ingredient and horizon = 13),
  r as (select ingredient, price, least(100, floor(sd / mean * 600 + 1e-9))::int as volatility, least(100, floor((p90 - p10) / p50 * 180 + 1e-9))::int as band, least(100, floor(abs((price - first) / first) * 250 + 1e-9))::int as momentum from m),
  k as (select *, least(100, floor(volatility * 0.4e0 + band * 0.4e0 + momentum * 0.2e0))::int as composite from r) select *, case when composite >= 66 then 'HIGH' when composite >= 33 then 'MODERATE' else 'LOW' end as level from k""")
def r6_risk_of_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.quick_risk(*_naive_forecast(spark, sf_dir))


@query(f"""with {_TARGETS}, e as (select horizon, avg(abs(target - price_avg_weekly)) as mae, count(*) as n_rows from targets group by 1), r as (select *, row_number() over (order by mae desc, horizon) as rank from e)
  select horizon, n_rows, round(mae, 4) as mae, rank::int as rank, round((select avg(mae) from e), 4) as mean_mae, (select count(*) from e) as horizons from r where rank <= 5""")
def k3_worst_horizons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five horizons of the largest mean error of the last price, beside the run's summary."""
    t = scores.targets(scores.panel_of(spark, sf_dir)).withColumns({"p50": F.col("price_avg_weekly")})
    by_horizon = tables.written(forecast.measures(t), "naive_measures")
    best = by_horizon.orderBy(F.col("mae").desc(), "horizon").limit(5)
    rank = F.row_number().over(Window.orderBy(F.col("mae").desc(), "horizon"))  # five rows
    one = forecast.run_summary(by_horizon).select("mean_mae", "horizons")
    return rounded(best.join(F.broadcast(one)).select("horizon", "n_rows", "mae", rank.alias("rank"), "mean_mae", "horizons"))


_RATIOS = ", ".join(f"{c} / price_avg_weekly as {c}" for c in forecast.LEVELS)
_FEATURES = f"""{WEEKLY}, joined as (select f.*, di_ppi, macro_ppi from featured f left join di using (week_start) left join macro m on m.ingredient = f.ingredient and m.week_start = f.week_start),
  carried as (select * exclude (di_ppi, macro_ppi), last_value(di_ppi ignore nulls) over w as di_ppi, last_value(macro_ppi ignore nulls) over w as macro_ppi from joined
    window w as (partition by ingredient order by week_start rows between unbounded preceding and current row)),
  changed as (select ingredient, week_start, price_avg_weekly, {_RATIOS}, {_chg('di_ppi', 12)} as di_change, coalesce({_chg('macro_ppi', 12)}, 0) as macro_change, extract(week from week_start)::double as week_of_year from carried),
  feats as (select * from changed where {" and ".join(f"{c} is not null and isfinite({c})" for c in forecast.FEATURES)} and price_avg_weekly > 0)"""


@query(f"with {_FEATURES} select ingredient, week_start, price_avg_weekly, {_round_all(forecast.FEATURES, 6)} from feats")
def p8_features_without_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(forecast.features(panel.weekly_training(spark, sf_dir)), 6)


_NAMES = ", ".join(f"('{c}')" for c in forecast.FEATURES)


@query(f"""with {_FEATURES}, wide as (select *, {", ".join(f"lead(price_avg_weekly, {h}) over w as h{h}" for h in range(1, 14))} from weekly window w as (partition by ingredient order by week_start)),
  ahead as ({" union all ".join(f"select ingredient, week_start, {h} as horizon from wide where h{h} is not null" for h in range(1, 14))})
  select horizon, name as feature, count(*) as n_rows from ahead join feats using (ingredient, week_start) cross join (values {_NAMES}) v(name)
  where coalesce(try_cast(nullif(regexp_extract(name, '_([0-9]+)w$', 1), '') as int) >= horizon, true) group by 1, 2""")
def p10_features_of_a_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekly = tables.written(panel.weekly_training(spark, sf_dir), "weekly")
    return forecast.usable_rows(forecast.features(weekly), weekly)


@query(f"""with m as ({ORACLE_SQL["b2_naive_backtest"]}) select ingredient as feature, {", ".join(f"coalesce(max(mae) filter (where horizon = {h}), 0) as h{h}" for h in range(1, 14))}, round(sum(mae) / 13, 6) as mean_rise from m group by 1""")
def a10_wide_by_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of the last price by ingredient, a column for each horizon, and their mean."""
    long = rounded(scores.naive_backtest(scores.panel_of(spark, sf_dir))).select(F.col("ingredient").alias("feature"), "horizon", F.col("mae").alias("rise"))
    wide = forecast.importance_summary(long)
    return wide.withColumn("mean_rise", F.round("mean_rise", 6))  # a thirteenth of four places never ties at six
