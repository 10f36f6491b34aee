"""A corpus pipeline: quality, near duplicates, repeated passages, secrets, packing.

Each stage works on all that the one before kept and is written as Parquet
before the next one reads it. All but the last return the columns of the
documents. The packed pieces carry what the sequences are made of.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import packing, quality, queries, secrets, simhash, suffixes
from tidemark.llm.common import ship
from tidemark.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier does not reject; null and empty texts score like any other."""
    ship(spark)
    return quality.keep(docs, queries.quality_weights(spark, folder))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each SimHash component, that of the smallest doc_id; nulls come last, texts without words are one."""
    ship(spark)
    return simhash.one_of_each(docs)


# Fifty words with the blanks between them, at an average of four letters a word at least: shorter
# strings that repeat are left, so that phrases of the language stay.
PASSAGE_BYTES = 50 * 5


def repeats_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without passages that an earlier row of the kept documents, or an earlier place of the text, has."""
    ship(spark)
    return suffixes.strip_texts(docs, PASSAGE_BYTES, first_stays=True)


def secrets_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts with secrets replaced by a mark; every row stays, null texts null."""
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token pieces with their sequence and place in it; null and empty texts have one piece, the end id."""
    ship(spark)
    return packing.pack(packing.token_pieces(docs, queries.tokenizer("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("suffix-array dedup", repeats_stage),
    ("secret scans", secrets_stage),
    ("best-fit packing", packing_stage),
]

# No stage but the secret scan can be expressed in SQL; tests hold each stage's rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
