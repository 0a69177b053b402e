"""The corpus pipeline: five stages over the documents table, each written and read again.

language -> near duplicates -> benchmark leaks -> source mix -> shards. All stages but the
last return the columns of ``documents``; the last adds ``row_number``, ``shard``, ``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import decontaminate, mixing, prefix_tree_join, sharding, string_kernel
from cohortlens.llm.tables import Scratch, read, spare_name

# Clean texts that quote another language score from about 0.4 up.
LEAST_LANGUAGE_SCORE = 0.35
SHARDS = 40


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects rows without a letter and rows that every one-versus-rest classifier turns down clearly."""
    judged = string_kernel.identify(docs)
    return judged.where((F.col("lang_pred") != string_kernel.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates. Rows with a
    NULL id form no group and stay. Of rows alike in id and text one stays; an id that
    leads one group and also stands elsewhere, with another text, stays."""
    groups = Scratch(spark).keep(prefix_tree_join.similar_groups(docs), "groups").where(F.col("doc_id").isNotNull())
    one = spare_name(docs, "_id")
    leads = groups.where("doc_id = component_id").select(F.col("doc_id").alias(one)).distinct()
    copies = groups.where("doc_id <> component_id").select(F.col("doc_id").alias(one)).distinct().join(leads, one, "left_anti")
    kept = docs.join(copies, F.col("doc_id") == F.col(one), "left_anti")
    repeated = groups.groupBy(F.col("doc_id").alias(one)).count().where("count > 1").select(one)
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, F.col("doc_id") == F.col(one), "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, F.col("doc_id") == F.col(one), "left_anti").union(once)


def no_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaking(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes the document; rows it never takes go."""
    taken = mixing.mix_sources(docs)
    times = F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(0).cast("int")
    return taken.withColumn(spare_name(taken, "_time"), F.explode(F.array_repeat(F.lit(0), times))).select(*docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(docs, [F.col("doc_id")], SHARDS, seed=2)


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", no_leaks),
    ("mixing sources to target weights", mixed),
    ("sharding", sharded),
]

# No stage but the mix can be said in SQL; the tests rebuild the chain by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), "stage")
    return docs
