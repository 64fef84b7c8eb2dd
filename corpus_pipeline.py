"""A training-data pipeline over ``documents``: every stage is written as Parquet and reread.

Stages that filter return the columns of ``documents``; each works on all rows its
predecessor kept. The last gives the pieces of all documents that are left, in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rosterline.llm import decontamination, line_dedup, packing, simhash, toxicity
from rosterline.llm.queries import table, tokenizer_path
from rosterline.workspace import sized


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labels of rows not held out, does not reject."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_frequent_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more documents share."""
    return line_dedup.without_frequent_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.without_near_duplicates(docs, words=3, max_distance=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten words of a benchmark item occur in a row."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_path(), end_id=2, max_tokens=4096)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_frequent_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: A fitted model and a tokenizer cannot be said in SQL; a test uses brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = sized(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
