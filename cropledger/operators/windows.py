"""Window operators. Every window is partitioned by a key, so no task ever holds more than one key's rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropledger.sources.tables import written


#: Frames that fit one after another into a stretch of a key's days; one more is read with it.
STRETCH = 8


def forward_averages(df: DataFrame, key: list[str], date: str, value: str, spans: list[int], unit: str, unique: bool = False) -> DataFrame:
    """Add <value>_fwd_<n><unit> and its change _pct: means over the next n days ('d') or months ('mo'), today included.

    All rows of a date share a frame, so the mean is taken over one row per key and date (sums and counts of the
    non-null values) and joined back; the window sees days, not rows, however many rows a hot key has. unique tells that
    df has one row per key and date already: it is then read and shuffled once. Sums of DECIMAL and whole values are
    exact, so they are differences of running sums, which take one step per row whatever the span; those of doubles
    would lose digits that way and are added up frame by frame.
    """
    word, reach = {"d": ("days", 1), "mo": ("months", 31)}[unit]
    daily = df.withColumns({"_s": F.col(value), "_c": F.col(value).isNotNull().cast("long")}) if unique else df.groupBy(*key, date).agg(F.sum(value).alias("_s"), F.count(value).alias("_c"))
    # A key's days are cut into stretches, each with the days behind it that its frames reach: a key of any length spreads over tasks.
    reach *= max(spans)
    day = F.unix_date(F.col(date).cast("date"))
    at = F.floor(day / (STRETCH * reach))
    halo = F.when(F.pmod(day, F.lit(STRETCH * reach)) <= reach, F.array(at, at - 1)).otherwise(F.array(at))
    dealt = daily.withColumn("_own", at).withColumn("_stretch", F.explode(F.when(day.isNull(), F.array(at)).otherwise(halo)))
    by = f"partition by {', '.join(f'`{k}`' for k in key)}, `_stretch` order by `{date}`"
    exact = not isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType))

    def ahead(c: str, n: int) -> str:
        if not exact:
            return f"sum({c}) over ({by} range between current row and interval {n} {word} following)"
        upto, before = f"range between unbounded preceding and interval {n} {word} following", "rows between unbounded preceding and 1 preceding"
        return f"(coalesce(sum({c}) over ({by} {upto}), 0) - coalesce(sum({c}) over ({by} {before}), 0))"

    means = [F.expr(f"cast({ahead('_s', n)} as double) / nullif({ahead('_c', n)}, 0)").alias(f"{value}_fwd_{n}{unit}") for n in spans]
    ahead_of = dealt.select(*(df.columns if unique else [*key, date]), *means, "_own", "_stretch").where(F.col("_own").eqNullSafe(F.col("_stretch"))).drop("_own", "_stretch")
    out = ahead_of if unique else df.join(ahead_of, [*key, date])
    v = F.col(value).cast("double")
    return out.withColumns({f"{value}_fwd_{n}{unit}_pct": F.when(v != 0, (F.col(f"{value}_fwd_{n}{unit}") - v) / v) for n in spans})


def lags(value: str, by: Window, steps: list[int], name: str) -> dict[str, Column]:
    return {name.format(n=n): F.lag(value, n).over(by) for n in steps}


def trailing(value: str, by: Window, spans: list[int], name: str, f=F.avg) -> dict[str, Column]:
    """f over the n rows before the current one."""
    return {name.format(n=n): f(value).over(by.rowsBetween(-n, -1)) for n in spans}


def rolling(value: Column, by: Window, n: int, least: int, f) -> Column:
    """f over the last n rows, the current one included; null with fewer than least values."""
    w = by.rowsBetween(1 - n, 0)
    return F.when(F.count(value).over(w) >= least, f(value).over(w))


def rolling_median(value: Column, by: Window, n: int, least: int) -> Column:
    return rolling(value, by, n, least, lambda v: F.percentile(v, F.lit(0.5)))


def filled(value: str, by: Window) -> Column:
    """The last value so far."""
    return F.last(value, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0))


def change(value: str, by: Window, n: int) -> Column:
    """Relative change over n rows; null where there is nothing to divide by."""
    return F.try_divide(F.col(value), F.lag(value, n).over(by)) - 1


def smaller_before(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(less, upto): for each value how many earlier ones are smaller, and how many are not larger; n log(n) ** 2 steps for n values.

    Stretches of 1, 2, 4, ... values are merged in pairs: sorted by value, each one of the right half has the left half's smaller ones before it.
    """
    n = len(values)
    rank = np.unique(values, return_inverse=True)[1].astype(np.int64).ravel()
    at, top = np.arange(n), int(rank.max(initial=0)) + 1
    found = np.zeros((2, n), np.int64)
    size = 1
    while size < n:
        pair, left = at // (2 * size), (at // size) % 2 == 0
        for i, tie in enumerate((left, ~left)):  # among equals the right half is first, then the left half
            order = np.argsort((pair * top + rank) * 2 + tie, kind="stable")
            counted = np.cumsum(left[order])
            before = np.zeros(int(pair[-1]) + 1, np.int64)
            before[1:] = np.minimum(np.arange(1, len(before)) * size, n)  # left halves of the pairs before are whole
            gain = counted - before[pair[order]]
            found[i, order] += np.where(left[order], 0, gain)
        size *= 2
    return found[0], found[1]


def expanding_ranks(df: DataFrame, key: str, order: str, ranks: dict[str, str]) -> DataFrame:
    """Add, for each name and column of ranks, the percentile of a value among those of its key so far: 50 * (less + not more + 1) / n.

    It is 50 with fewer than four values, and null for a null then. n log(n) ** 2 steps for a key of n rows, which is one task's.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(order)
        for name, column in ranks.items():
            values = table.column(column).cast(pa.float64())
            known = values.is_valid().to_numpy()
            less, upto = smaller_before(values.drop_null().to_numpy())
            n = np.cumsum(known)
            out = np.full(len(known), 50.0)
            out[known] = np.where(n[known] < 4, 50.0, (less + upto + 2) * 50.0 / np.maximum(n[known], 1))
            table = table.append_column(name, pa.array(out, mask=~known & (n >= 4)))
        return table

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.groupBy(key).applyInArrow(run, kinds + "".join(f", `{n}` double" for n in ranks))


def row_ids(df: DataFrame, order: list[str], first: int = 10001) -> DataFrame:
    """Add id: row numbers of a total order, from first on, without a one-task window.

    Rows are sorted by ranges; each partition's rows are numbered inside it and moved by the sizes of those before,
    a table of one row per partition. The sorted rows are written to the scratch folder, so numbers are the same in both
    passes whatever is lost.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    ranged = written(ranged, "row_ids")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = sizes.select("_part", "_first", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return ranged.join(F.broadcast(before), "_part").withColumn("id", F.col("_at") - F.col("_first") + F.col("_before") + first).drop("_part", "_at", "_first", "_before")
