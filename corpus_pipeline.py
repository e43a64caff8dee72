"""A training corpus from raw documents: quality rules, toxicity, exact and near deduplication, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read
again as the next stage's documents. All but the last return the columns of the documents
they were given. Stages treat nulls, empty tables and repeated rows as their operators do.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.llm import block_naming, line_quality, packing, superminhash, toxicity
from gridcast.llm.queries import held_out, table
from gridcast.llm.rows import text_key, without
from gridcast.operators.sizing import measure
from gridcast.store import land

# Documents go from the score at which op5 calls them toxic.
TOXIC_FROM = 0.3
NEAR = superminhash.Near(percent=80)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or depletion reject go; texts stay as they are."""
    return without(docs, line_quality.line_rules(docs).filter(~F.col("kept")))


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go. Learned from the labels of documents that are still there."""
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    model = toxicity.train(docs, labels)
    return without(docs, toxicity.score(docs, model).filter(F.col("score") >= TOXIC_FROM))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays; of equal rows one."""
    found = block_naming.exact_duplicates(docs)
    keys = land(
        found.groupBy("doc_id", "text_key").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")), "keys"
    )
    left = without(docs, keys.filter(~F.col("kept")))
    again = measure(keys.filter("kept and n > 1").select("doc_id", "text_key"), "repeated")
    if not again.rows:
        return left
    # Rows that are there several times, doc_id and text alike.
    named = again.df.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (text_key() == F.col("_key"))
    repeated = left.join(named, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return without(left, again.df).unionByName(repeated)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the smallest doc_id stays."""
    return without(docs, superminhash.near_duplicates(docs, NEAR).filter(~F.col("kept")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents that are left, in sequences of 2048."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=0)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", clean_of_toxicity),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("packing", pack),
]

# Most stages can't be said in SQL; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
