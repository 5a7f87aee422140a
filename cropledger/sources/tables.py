"""Readers and writers: delimited files with declared string columns, Parquet, landed JSON, snapshots."""

from __future__ import annotations

import csv
import functools
import tempfile
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cropledger.functions import text


def parquet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def headers(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(path, header): the names in the first line of each file that path (a glob) holds; files without a line have no row.

    Each task reads the start of one stretch of one file and stops: for a later stretch at once, for a file's first one after its first line.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                line, file, at = (batch.column(i)[0].as_py() for i in range(3))
                if at == 0:
                    names = [x.strip() for x in next(csv.reader([line.removeprefix("\ufeff")], delimiter=sep), [])]
                    yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([names], pa.list_(pa.string()))], names=["path", "header"])
                return

    conf, key = spark.conf, "spark.sql.files.openCostInBytes"
    before = conf.get(key)
    conf.set(key, str(1 << 40))  # no two stretches share a task
    try:
        first = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
        return written(first.mapInArrow(run, "path string, header array<string>"), "headers")
    finally:
        conf.set(key, before)


def misfits(spark: SparkSession, layouts: dict[str, list[str]], sep: str = ",") -> DataFrame:
    """(path, header, expected) of the files whose header is no arrangement of the names of their layout."""
    return _by_header(spark, layouts, sep).where(~_fits()).select("path", "header", "expected")


def _fits() -> Column:
    return F.array_sort("header") == F.array_sort("expected")


def _by_header(spark: SparkSession, layouts: dict[str, list[str]], sep: str) -> DataFrame:
    parts = [headers(spark, path, sep).withColumn("expected", F.array(*map(F.lit, names))) for path, names in layouts.items()]
    return reduce(DataFrame.unionAll, parts)


def delimited(spark: SparkSession, layouts: dict[str, list[str]], sep: str = ",", refuse: bool = True) -> DataFrame:
    """Rows of delimited files with a header, all columns text. layouts: glob to the header names of its files, in any order.

    The first line of each file tells how its columns stand; files of one arrangement are read together under it. Blanks around a name
    and a byte order mark don't count. A file whose header is no arrangement of its layout's names is refused with an error, or with
    refuse = False left to misfits(). Columns that a layout has not got are null, and so are empty text and a lone full stop.
    """
    found = _by_header(spark, layouts, sep).groupBy("header", "expected").agg(_fits().alias("fits"), F.sort_array(F.collect_list("path")).alias("paths")).collect()  # paths, as every listing of files has them
    wrong = [r for r in found if not r.fits]
    if wrong and refuse:
        raise ValueError("files with unexpected headers: " + "; ".join(f"{r.paths[0]} and {len(r.paths) - 1} more: {list(r.header)} for {list(r.expected)}" for r in wrong))
    names = list(dict.fromkeys(n for ns in layouts.values() for n in ns))
    parts = [spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names]))]
    for r in (r for r in found if r.fits):
        schema = T.StructType([T.StructField(n, T.StringType()) for n in r.header])
        read = spark.read.schema(schema).option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
        parts.append(read.csv(list(r.paths)))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return every.select(*(text.null_tokens(F.col(f"`{c}`")).alias(c) for c in every.columns))


def observations(landed: DataFrame, column: str, series: str) -> DataFrame:
    """(series, date, value) from landed {"observations": [{"date", "value"}]}; a full stop is no value and its row is dropped."""
    parsed = F.from_json(column, "observations array<struct<date:string,value:string>>")
    return landed.select(F.col(series).alias("series"), F.explode(parsed["observations"]).alias("o")).where("o.value != '.'").select("series", F.col("o.date").try_cast("date").alias("date"), F.col("o.value").try_cast("double").alias("value"))


def report_details(landed: DataFrame, column: str, fields: list[str]) -> DataFrame:
    """One row per result of the section Report Detail; truncated tells that fewer results came back than there are."""
    kinds = ",".join(f"`{f}`:string" for f in fields)
    shape = f"array<struct<reportSection:string,stats:struct<totalRows:long,returnedRows:long>,results:array<struct<{kinds}>>>>"
    part = landed.select(F.explode(F.from_json(column, shape)).alias("s")).where("s.reportSection = 'Report Detail'")
    return part.select(F.coalesce(F.col("s.stats.returnedRows") < F.col("s.stats.totalRows"), F.lit(False)).alias("truncated"), F.explode("s.results").alias("r")).select("truncated", "r.*")


def fan_out(series: DataFrame, mapping: DataFrame) -> DataFrame:
    """series rows for each ingredient of mapping (series, ids, names); names joined by ' | '."""
    small = mapping.select("series", F.explode("ids").alias("ingredient_id"), F.array_join("names", " | ").alias("ingredient_names"))
    return series.join(small, "series")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names; only a local master may do without it."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return _own_scratch()


@functools.cache
def _own_scratch() -> str:
    return "file://" + tempfile.mkdtemp(prefix="cropledger-")


def _application_dir(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/cropledger-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder for a table; drop_scratch() removes it with all others of this application."""
    return f"{_application_dir(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove every table that written() and the queries here have left in the scratch folder; frames that read them can't be used any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """df written to the scratch folder and read back: computed once, however often it is used, and safe from lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Most rows of a file that write_parquet() writes in order.
FILE_ROWS = 2_000_000
#: Most hot keys that are broadcast (some 50 bytes each); more are joined by a shuffle.
BROADCAST_KEYS = 200_000


def write_parquet(df: DataFrame, path: str, key: str | None = None, order: tuple[str, ...] = (), file_rows: int = FILE_ROWS) -> None:
    """Overwrite path, one folder per key so that readers of one ingredient skip the others; rows follow order, in a file and from file to file.

    A key of up to file_rows rows is one task's and one file's. A larger one is dealt to tasks by ranges of all of order, so its files don't
    overlap: a row costs a sort, however many files its key has. Only rows that agree in key and order must be one task's.
    """
    if not (key and order):
        out = (df.sortWithinPartitions(*order) if order else df).write.mode("overwrite")
        (out.partitionBy(key) if key else out).parquet(path)
        return
    hot = written(df.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > file_rows).select(F.col(key).alias("_key"), F.lit(True).alias("_hot")), "hot_keys")
    n_hot, spread = hot.count(), []
    if n_hot:
        df = df.join(F.broadcast(hot) if n_hot <= BROADCAST_KEYS else hot, F.col(key).eqNullSafe(F.col("_key")), "left")
        spread = [F.when(F.col("_hot"), F.col(c)) for c in order]
    ranged = df.repartitionByRange(key, *spread).sortWithinPartitions(key, *order).drop("_key", "_hot")
    ranged.write.mode("overwrite").option("maxRecordsPerFile", file_rows).partitionBy(key).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite path by delimited files with a header; quotes inside a value are doubled."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def snapshots(df: DataFrame, key: str) -> DataFrame:
    """(key, document): one JSON text per row."""
    return df.select(key, F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("document"))


def write_snapshots(df: DataFrame, path: str, key: str) -> None:
    """Overwrite path by one JSON document per line, in a folder per key."""
    snapshots(df, key).write.mode("overwrite").partitionBy(key).text(path)


def publish(tables: dict[str, DataFrame], path: str) -> str:
    """Write all tables under path and make them the current ones at once; the folder that holds them.

    They are written into a folder of their own, aside from what readers see. Then one small file, CURRENT, that names the folder is swapped
    by a rename, which a store does as a whole or not at all: a reader finds either all the old tables or all the new ones.
    """
    version = f"{path.rstrip('/')}/versions/{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{version}/{name}")
    jvm, spark = next(iter(tables.values())).sparkSession._jvm, next(iter(tables.values())).sparkSession
    hadoop = jvm.org.apache.hadoop.fs
    files = hadoop.FileContext.getFileContext(hadoop.Path(path).toUri(), spark._jsc.hadoopConfiguration())
    aside = hadoop.Path(f"{path.rstrip('/')}/CURRENT-{uuid.uuid4().hex}")
    create = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$CreateOpts"), 0)
    out = files.create(aside, jvm.java.util.EnumSet.of(hadoop.CreateFlag.CREATE), create)
    out.write(bytearray(version.encode()))
    out.close()
    rename = getattr(hadoop, "Options$Rename")
    swap = spark.sparkContext._gateway.new_array(rename, 1)
    swap[0] = rename.OVERWRITE
    files.rename(aside, hadoop.Path(f"{path.rstrip('/')}/CURRENT"), swap)
    return version


def published(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table of what publish() made current."""
    version = spark.read.text(f"{path.rstrip('/')}/CURRENT").first()[0]
    return spark.read.parquet(f"{version}/{name}")
