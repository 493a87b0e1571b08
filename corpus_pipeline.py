"""The corpus pipeline over ``documents``.

Quality classifier, quality rules, near duplicates, benchmark decontamination,
packing: each stage works on all that its predecessor kept, and is written as
Parquet to the shared folder and read again as the next stage's input.  All but
the last return the columns of ``documents``; rows without an id are kept apart
by no stage that has to name them, so they are decided by their text alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm import decontamination, jaccard_join, knn_quality, packing, quality_rules
from martforge.llm.common import table, unused, write_shared

#: A document goes on with this score or more.
MIN_QUALITY = 0.7
#: Near duplicates: words of a shingle, and percent of similarity.
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    voters = knn_quality.train(docs, table(spark, sf_dir, "labels"))
    if not len(voters.labels):
        return docs
    name = unused("score", docs)
    scored = knn_quality.score_quality(docs, voters, score_column=name)
    return scored.where(F.col(name) >= MIN_QUALITY).select(*docs.columns)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base check nor the learnt rules reject."""
    rules = quality_rules.learn_rules(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules).where("kept").select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Rows are named by id and text, so different texts under one id, or without an
    id, are judged apart; of rows that repeat both one stays.  Documents without a
    shingle are groups of their own; a row without an id stays only if no row of
    its group has one."""
    name = unused("row", docs)
    named = docs.withColumn(name, F.xxhash64("doc_id", "text"))
    found = jaccard_join.jaccard_components(named.select(F.col(name).alias("doc_id"), "text"), SHINGLE_WORDS, SIMILAR_PERCENT)
    ids = named.groupBy(name).agg(F.min("doc_id").alias("id"))
    groups = found.select(F.col("doc_id").alias(name), "component_id").distinct().join(ids, name)
    first = groups.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", name))[name].alias(name)).select(name)
    return named.join(first, name, "left_semi").dropDuplicates([name]).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found.

    Rows are named by id and text, so one without an id, or with the id of
    another text, is decided by its own text."""
    row, name = F.xxhash64("doc_id", "text"), unused("row", docs)
    hits = decontamination.find_contamination(
        docs.select(row.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark")
    )
    bad = write_shared(hits.select(F.col("doc_id").alias(name)).distinct(), "contaminated")
    return docs.withColumn(name, row).join(bad, name, "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences."""
    return packing.pack_documents(docs, *packing.vocabulary())


STAGES = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("near duplicates", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("packing", pack),
]

#: Learnt models and token ids have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to ``documents``; returns the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_shared(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
