"""Data-quality checks as flag columns: one pass over the rows, whatever the number of checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def not_null(c: Column) -> Column:
    """Each check is true where the row violates it."""
    return c.isNull()


def numeric(c: Column) -> Column:
    """Text that is no number. Text without a digit is cast only where it may be infinity or NaN: failing casts are slow."""
    t = c.cast("string")
    return t.isNotNull() & F.when(t.rlike("[0-9]|(?i)inf|nan"), t.try_cast("double").isNull()).otherwise(True)


def matches(c: Column, pattern: str) -> Column:
    return F.coalesce(~c.rlike(pattern), F.lit(True))


def no_lower_case(c: Column) -> Column:
    return F.coalesce(c != F.upper(c), F.lit(False))


def holds(expr: Column) -> Column:
    return F.coalesce(~expr, F.lit(False))


def flagged(df: DataFrame, checks: dict[str, Column], unique: dict[str, list[str]] | None = None) -> DataFrame:
    """df with reasons, the names of the checks each row violates. Every copy of a repeated key violates uniqueness.

    Copies are counted per key before the join, so a key with many rows is not a window's burden; only keys that occur
    more than once are joined.
    """
    for name, keys in (unique or {}).items():
        counts = df.groupBy(*(F.col(k).alias(f"_{name}_{k}") for k in keys)).agg(F.count("*").alias(f"_{name}")).where(F.col(f"_{name}") > 1)
        same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{name}_{k}")) for k in keys))
        df, checks = df.join(counts, same, "left").drop(*(f"_{name}_{k}" for k in keys)), {**checks, name: F.col(f"_{name}").isNotNull()}
    none = F.array().cast("array<string>")
    reasons = F.concat(none, *(F.when(c, F.array(F.lit(n))).otherwise(none) for n, c in checks.items()))  # stays in generated code
    return df.withColumn("reasons", reasons).drop(*(f"_{n}" for n in unique or {}))


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows) of flagged()."""
    return df.where(F.size("reasons") == 0).drop("reasons"), df.where(F.size("reasons") > 0)


def summary(df: DataFrame, table: str, names: list[str]) -> DataFrame:
    """(table_name, check_name, violations, passed, all_passed) for each check; all_passed is the table's."""
    counts = df.agg(*(F.count_if(F.array_contains("reasons", n)).alias(n) for n in names)).withColumn("all_passed", F.lit(0) == sum((F.col(n) for n in names), F.lit(0)))
    return counts.unpivot(["all_passed"], names, "check_name", "violations").select(F.lit(table).alias("table_name"), "check_name", "violations", (F.col("violations") == 0).alias("passed"), "all_passed")


def ambiguous(df: DataFrame, name: str, ident: str) -> DataFrame:
    """(id, name, others): rows of other ids that bear the same name, where there are any.

    Names are summed apart and joined back, so a name with very many ids is no one task's window.
    """
    by_id = df.groupBy(name, ident).agg(F.count("*").alias("_own"))
    names = by_id.groupBy(F.col(name).alias("_name")).agg(F.sum("_own").alias("_all"), F.count("*").alias("_ids")).where("_ids > 1")
    return by_id.join(names, F.col(name).eqNullSafe(F.col("_name"))).select(name, ident, (F.col("_all") - F.col("_own")).alias("others"))
