"""Exact percentiles of any number of rows per key, by ranks in a range sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cropledger.sources.tables import written

#: Most keys whose sizes are broadcast (some 50 bytes each); more are joined by a shuffle.
BROADCAST_KEYS = 200_000


def ranked(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """(key, value, _count, _before, _rows): distinct non-null values with their count, the number of smaller ones of their key, and the key's rows.

    Equal values are counted first, so a value that fills a third of the table is one row. The rest is sorted by ranges of (key, value):
    a key of any size is dealt over many tasks. Ranks are running counts inside a partition, moved by the partitions' totals, a
    table of one row per partition. The sorted rows are written, so ranks hold whatever is lost.
    """
    order = [*key, value]
    counted = df.where(F.col(value).isNotNull()).groupBy(*order).agg(F.count("*").alias("_count"))
    ranged = counted.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    ranged = written(ranged, "ranked_values")
    parts = ranged.groupBy("_part").agg(F.sum("_count").alias("_n"))
    moved = parts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_moved"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.withColumn("_upto", F.sum("_count").over(inside)).join(F.broadcast(moved), "_part")
    placed = written(placed.select(*order, "_count", (F.col("_upto") + F.col("_moved") - F.col("_count")).alias("_before")), "placed_values")
    sizes = placed.groupBy(*key).agg(F.min("_before").alias("_first"), F.sum("_count").alias("_rows"))
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_KEYS else sizes
    return placed.join(sizes, key).select(*order, "_count", (F.col("_before") - F.col("_first")).alias("_before"), "_rows")


def percentiles(df: DataFrame, key: list[str], value: str, shares: list[float]) -> DataFrame:
    """(key, q): q holds the exact percentile of value for each of shares, in order, between two values by their distance (a double).

    Only the two rows on either side of each asked place leave the sort. Keys are not null; nulls of value don't count, and a key without
    values has no row.
    """
    place = lambda s: F.lit(s) * (F.col("_rows") - 1)
    asked = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("side"), f(place(s)).cast("long").alias("at"), (place(s) - F.floor(place(s))).alias("part")) for i, s in enumerate(shares) for j, f in enumerate((F.floor, F.ceil))]
    here = F.filter(F.array(*asked), lambda a: (a["at"] >= F.col("_before")) & (a["at"] < F.col("_before") + F.col("_count")))
    found = ranked(df, key, value).select(*key, F.col(value).cast("double").alias("_v"), F.explode(here).alias("_a"))
    two = found.groupBy(*key, F.col("_a.i").alias("_i")).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.first("_a.part").alias("_part"))
    each = two.select(*key, "_i", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_part")).alias("_q"))
    return each.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_q"))), lambda x: x["_q"]).alias("q"))
