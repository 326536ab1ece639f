"""A corpus from documents to training sequences: language, toxicity, near duplicates, packing.

Every stage takes all that the one before kept, as a written table. All but the last return the
columns of ``documents``.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kinweave.llm import langid, neardup, packing, toxicity
from kinweave.llm.tables import written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model, trained on labelled documents among them, does not reject."""
    return langid.keep_accepted(docs, langid.fit(docs))


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on their labels, does not call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a similarity of 0.8 or more on shingles of five words."""
    return neardup.keep_one_of_each(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, each with its place in a sequence of at most 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("toxicity", remove_toxic),
    ("near_dedup", remove_near_duplicates),
    ("packing", pack_sequences),
]

# Trained models and the packing search are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
