"""Documents in, training tokens out: the stages of the corpus pipeline.

Each stage takes what its predecessor kept. All but the last return the columns of documents, whatever they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revmill.llm.decontam import drop_contaminated
from revmill.llm.exact_dedup import drop_copies
from revmill.llm.pieces import PieceModel, encode
from revmill.llm.shelf import stage, table
from revmill.llm.simhash import drop_near_copies
from revmill.llm.toxicity import THRESHOLD, drop_toxic, learn


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labelled documents it is given."""
    return drop_toxic(docs, learn(docs, table(spark, sf_dir, "labels")), THRESHOLD)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest id stays."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of every document that is left."""
    return encode(docs, PieceModel.load())


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

# A trained classifier, edit distances and a tokenizer are not expressible in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
