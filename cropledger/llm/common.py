"""Shared helpers of the training-data operators: scratch tables, table access, connected components."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Most bytes of an Arrow batch that holds more than one row.
BATCH_BYTES = 32 << 20


@functools.cache
def _own_scratch() -> str:
    return "file://" + tempfile.mkdtemp(prefix="cropledger-")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; only a local master may do without it."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return _own_scratch()


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared scratch folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Keep Arrow batches small, in rows and in bytes: texts can be very long. The session keeps these limits, as plans run later."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


#: Most rows of a table that join_named() broadcasts (some 100 bytes each).
BROADCAST_ROWS = 300_000


def join_named(rows: DataFrame, named: DataFrame, key: str) -> DataFrame:
    """rows left-joined with named, which has one row per key; columns of rows, then those of named without key.

    A small named is broadcast. Else the rows of keys that hold more than a BROADCAST_ROWS-th of all rows, of which there are
    at most BROADCAST_ROWS, are joined by a broadcast of these keys' rows, and the rest by a shuffle. Rows with a null key join nothing.
    Both tables are read several times, so they should be written ones.
    """
    more = [c for c in named.columns if c != key]
    columns = [*rows.columns, *more]
    if named.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(named), key, "left").select(*columns)
    known, unknown = rows.where(F.col(key).isNotNull()), rows.where(F.col(key).isNull())
    hot = known.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > known.count() / BROADCAST_ROWS).where("_n > 1000").select(key)
    hot = F.broadcast(materialise(named.join(hot, key, "left_semi"), "hot_keys"))
    parts = known.join(hot, key), known.join(hot.select(key), key, "left_anti").join(named, key, "left")
    none = unknown.select("*", *(F.lit(None).cast(named.schema[c].dataType).alias(c) for c in more))
    return parts[0].select(*columns).unionByName(parts[1].select(*columns)).unionByName(none)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that occurs in edges; root is the smallest node of its component.

    Each round hooks every node to its smallest lower neighbour, follows these hooks to their roots by
    pointer doubling and contracts the edges. Rounds and doublings are both logarithmic in practice.
    Self links are ignored, null ends never link; an empty edge table gives an empty result.
    """
    x, y = F.col(a), F.col(b)
    live = materialise(
        edges.where(x.isNotNull() & y.isNotNull() & (x != y)).select(F.least(x, y).alias("lo"), F.greatest(x, y).alias("hi")).distinct(),
        "edges",
    )
    nodes = live.select(F.col("lo").alias("node")).union(live.select(F.col("hi").alias("node"))).distinct()
    labels = nodes.select("node", F.col("node").alias("root"))
    while not live.isEmpty():
        hook = materialise(live.groupBy("hi").agg(F.min("lo").alias("up")), "hook")
        while True:
            above = hook.select(F.col("hi").alias("up"), F.col("up").alias("next"))
            jumped = materialise(hook.join(above, "up", "left").select("hi", F.coalesce("next", "up").alias("up"), F.col("next").isNotNull().alias("moved")), "hook")
            hook = jumped.select("hi", "up")
            if jumped.where("moved").isEmpty():
                break
        to = hook.select(F.col("hi").alias("root"), F.col("up").alias("to"))
        labels = materialise(labels.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "labels")
        lo = hook.select(F.col("hi").alias("lo"), F.col("up").alias("lo_to"))
        hi = hook.select(F.col("hi"), F.col("up").alias("hi_to"))
        p, q = F.coalesce("lo_to", "lo"), F.coalesce("hi_to", "hi")
        live = materialise(live.join(lo, "lo", "left").join(hi, "hi", "left").select(F.least(p, q).alias("lo"), F.greatest(p, q).alias("hi")).where("lo != hi").distinct(), "edges")
    return labels
