"""The corpus pipeline: good documents, one of each group of near copies, none that leaks the benchmark, packed.

Every stage takes (spark, documents, folder of the tables) and works on all
rows of its predecessor; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import packing, parity_join, quality, tiling
from tallyloom.llm.common import stage, table
from tallyloom.llm.queries import vocabulary

#: The stages end in a fitted model, links and a linear program, which SQL does not express.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled rows among them, does not reject."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more over shingles of five words."""
    return parity_join.keep_first(docs, parity_join.Rule(size=5, part=80, whole=100))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no item of the benchmark."""
    return tiling.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences; workers of the stages before are still there, so these remember less."""
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), 1, remembered=400_000)


STAGES = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("leaks", drop_leaks),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
