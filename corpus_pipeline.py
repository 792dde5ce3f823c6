"""From raw documents to a training mix, stage by stage.

Each stage takes the session, the documents that the stage before it kept, and
the folder of the tables, and returns what it keeps. Between stages the
documents are written to the shared scratch folder and read again, which also
cuts the lineage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import treeframe
from treeframe.llm.decontaminate import drop_contaminated
from treeframe.llm.exact_dedup import drop_duplicates
from treeframe.llm.mixing import mix_sources
from treeframe.llm.near_dedup import drop_near_duplicates
from treeframe.llm.rows import saved
from treeframe.llm.toxicity import drop_toxic

# Python workers may not have this folder on their path, so functions travel whole.
cloudpickle.register_pickle_by_value(treeframe)

# The classifier and the mix have no SQL form; the tests hold each stage against brute force.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier, fitted on the labels, rejects."""
    return drop_toxic(docs, _table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: five words, 0.8."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, how many epochs of each, and how many words in all."""
    return mix_sources(docs).filter("taken > 0")


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", decontamination),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
