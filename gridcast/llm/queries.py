"""The registered query of each operator, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.llm import (
    block_naming,
    bpe,
    huffman,
    line_quality,
    lm_score,
    merkle,
    packing,
    sharding,
    spelling,
    substring,
    superminhash,
    toxicity,
    url_trust,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op6_huffman_ids(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    read = huffman.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op7_line_frequency(spark, sf_dir):
    return line_quality.line_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_removed_words",
    )


@query
def op8_block_naming(spark, sf_dir):
    return block_naming.exact_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


@query
def op9_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=0
    )


@query
def op10_two_pass_shuffle(spark, sf_dir):
    return sharding.shuffled_shards(table(spark, sf_dir, "documents"), shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op3_backtracking_bpe(spark, sf_dir):
    return bpe.round_trip_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


@query
def op5_noisy_or(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(~held_out()))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query
def op4_superminhash(spark, sf_dir):
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"), superminhash.Near(percent=85)).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


@query
def op1_cross_entropy_difference(spark, sf_dir):
    good = table(spark, sf_dir, "labels").filter("quality = 1")
    return lm_score.cross_entropy_difference(table(spark, sf_dir, "documents"), good)


# The rules of this query.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


@query
def op2_link_trust(spark, sf_dir):
    return url_trust.url_verdicts(table(spark, sf_dir, "pages"), RULES)


@query
def op11_merkle_manifest(spark, sf_dir):
    # Where 2 divides the checksum of the doc_id, the text has lost its line feeds.
    lost = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = F.when(lost, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return merkle.manifest(table(spark, sf_dir, "documents"), found).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


@query
def op13_doubled_windows(spark, sf_dir):
    return substring.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


@query
def op12_search_schemes(spark, sf_dir):
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents"), slips=31))
