"""Corpus pipeline: toxicity filter, exact dedup, SimHash near-dedup, source mixing, packing.

Every stage works on all rows that its predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from biblioforge.llm import exact_dedup, mixing, packing, simhash, toxicity
from biblioforge.llm.common import drop_stash, new_path

#: The mixed corpus holds this share of the tokens that reach the stage, drawn from one epoch.
MIX_PERCENT, MIX_EPOCHS = 80, 1


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; labels of held-out documents are not learned from."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean_documents(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    return exact_dedup.distinct_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest doc_id."""
    return simhash.one_of_each_component(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights of the domain-language-source tree."""
    return mixing.drawn_documents(docs, MIX_PERCENT, MIX_EPOCHS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids and their places in training sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]
#: A trained score and SimHash components have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, old = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if old:
            drop_stash(spark, old)
        docs, old = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
