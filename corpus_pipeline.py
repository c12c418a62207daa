"""A corpus pipeline of five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs:

1. quality classifier: documents scored under 0.3 go (no label votes on its own document);
2. quality rules: documents that the base rules or the divergence reject go;
3. near-duplicates: one row of the least id of each class stays;
4. mixing: a document comes as often as its rate says (see ``soft_mixing.take``);
5. byte-level BPE: ids of every document, with digests of ids and decoded text.

Labels of documents that are gone no longer train anything. Null texts score the
base rate and fail the base rules, so they leave at the second stage; rows are
judged by their own texts, also where ids are null or repeated; an empty table
passes through all stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from glyphgrid.llm import common, divergence_rules, neighbour_quality, order_minhash, rank_bpe, soft_mixing


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of at least 0.3."""
    voters = neighbour_quality.fit(docs, common.read(spark, sf_dir, "labels"))
    return neighbour_quality.keep(docs, voters, 0.3)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that base rules and divergence keep."""
    return divergence_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    common.workers_find_package(spark)
    return order_minhash.keep_one(docs, 0.8)


#: Poor documents left in the first two stages, so the mixture has targets for the others only.
TARGETS = {"clean": 0.98, "toxic": 0.02}


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture asks for."""
    labels = soft_mixing.label_domains(common.read(spark, sf_dir, "labels"))
    mixture, _ = soft_mixing.fit_mixture(docs, labels, TARGETS, budget=1.02)
    return soft_mixing.take(docs, mixture)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document; the decoded digest shows the round trip."""
    common.workers_find_package(spark)
    return rank_bpe.round_trip_digests(docs, keep_ids=True)


STAGES = [("quality_classifier", quality_classifier), ("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("mixing", mixing), ("bpe", bpe)]

#: SQL can't express the classifier, the alignment or the encoder; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written below the shared checkpoint folder and read again."""
    common.workers_find_package(spark)
    folder = f"{common.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
