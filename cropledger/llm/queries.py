"""The registered queries of this subpackage: one opN_<name> for each operator, on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, divergence, embeddings, flac, langid, licenses, minhash, mixing, nearest, packing, pii, quality, ranked
from .common import table


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).drop("ids")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.link_turns(table(spark, sf_dir, "conversations"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.sanitise(table(spark, sf_dir, "documents")))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    info = mixing.free_name(docs.columns)
    return mixing.mix(docs, info=info).select("doc_id", "source", f"{info}.*")


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("places", "expressions")


def op10_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.decode(flac.encode(table(spark, sf_dir, "documents"))).select(
        "doc_id",
        "n_bytes",
        F.length("pcm").cast("long").alias("payload_bytes"),
        F.sha2("pcm", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(pcm, -64, 64)")).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
        F.size("blocks").cast("long").alias("n_blocks"),
        F.array_join(F.transform("blocks", lambda b: F.concat_ws(":", b["sample_offset"].cast("string"), b["byte_offset"].cast("string"))), ",").alias("block_offsets"),
    )


def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embeddings": op1_embeddings,
    "op2_packing": op2_packing,
    "op3_chat": op3_chat,
    "op4_pii": op4_pii,
    "op5_minhash": op5_minhash,
    "op6_mixing": op6_mixing,
    "op7_langid": op7_langid,
    "op8_quality": op8_quality,
    "op9_licenses": op9_licenses,
    "op10_flac": op10_flac,
    "op11_ranked": op11_ranked,
    "op12_divergence": op12_divergence,
    "op13_nearest": op13_nearest,
}
ORACLE_SQL: dict[str, str] = {"op3_chat": chat.SQL, "op11_ranked": ranked.SQL, "op12_divergence": divergence.SQL}
