"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents that go on, with the columns
of ``documents``; the last returns the packing. What a stage returns is written as Parquet
and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm.common import table
from skyledger.llm.decision_list import keep_good
from skyledger.llm.mixing import mixed_documents
from skyledger.llm.packing import pack_documents
from skyledger.llm.simhash import drop_near_duplicates
from skyledger.llm.toxicity import drop_toxic
from skyledger.session import write_and_reread


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learnt list; the list learns from the stage's own documents."""
    return keep_good(docs, table(spark, sf_dir, "labels"), sample=20_000)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"), sample=8000, landmarks=64)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of least id."""
    return drop_near_duplicates(docs, shingle=3, radius=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that fill each source's budget, once per epoch; the one at a budget's end is cut there."""
    return mixed_documents(docs, weights=(3, 1, 2), share=1.5, epochs=2.0)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of each piece of each document in sequences of 2048 tokens."""
    return pack_documents(docs, end_id=0, capacity=2048)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity),
    ("simhash near-dedup", simhash_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learnt rules and scores, SimHash and tokenizing can't be written in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = write_and_reread(docs, f"stage{number}")
    return docs
