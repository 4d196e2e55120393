"""From raw documents to sampled piece ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on everything that the one before kept;
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, pieces, pii, quality, simhash
from tidemark.llm.store import durable, table


def good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The quality classifier, learnt from the labels and these documents; what it rejects goes."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the document with the smallest id stays."""
    return simhash.keep_one(docs, similarity=0.8)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values become pseudonyms, equal ones equal in every document."""
    return pii.stage(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The target mix: each document as often as its leaf's budget takes it."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of each text."""
    return pieces.encoded(docs, keep=("lang", "source")).withColumn("n_pieces", F.size("ids").cast("bigint"))


STAGES = [("quality", good_text), ("near_duplicates", one_of_each), ("pii", without_personal_data), ("mixing", mixed), ("pieces", encoded)]

#: A classifier and a sampler can't be said in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
