"""A training corpus from raw documents: quality, near-duplicates, personal data, source mixture, packing.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of documents, and further ones that docs has,
whatever their names. Null texts count as empty, texts of any length are read whole, rows without doc_id take part, repeated
rows are each a row (drop_near_copies() leaves one of them), and an empty table goes through all stages as one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.llm import minhash, mixing, packing, pii, quality
from cropledger.llm.common import materialise, table


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accept(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the one with the smallest doc_id.

    Rows are told apart by id and text; texts without words all stay. See minhash.one_of_each().
    """
    return minhash.one_of_each(docs, width=5)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data, secrets and disclosing terms masked; n_chars, where there is one, follows the text. Others are as they were."""
    rows = pii.sanitise(docs)
    changed = F.size("all_spans") > 0
    new = {"text": F.when(changed, F.col("clean_text")).otherwise(F.col("whole.text")), "n_chars": F.when(changed, F.length("clean_text").cast("long")).otherwise(F.col("whole.n_chars"))}
    return rows.select(*(new.get(c, F.col("whole")[c]).alias(c) for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and documents of small sources up to twice, by temperature weights."""
    return mixing.mix(docs, repetition=2.0, info=None)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 token ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", accept_quality),
    ("near_copies", drop_near_copies),
    ("personal_data", mask_personal_data),
    ("mixture", mix_sources),
    ("packing", pack_sequences),
]
#: SQL has no form for the classifier, the forest or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is written to the scratch folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
