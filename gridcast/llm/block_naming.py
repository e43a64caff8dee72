"""Exact deduplication by deterministic block naming.

Texts are normalised and cut into blocks of a fixed number of characters. The distinct blocks
are sorted and get integer names; then neighbouring names are paired and the distinct pairs
get names in the same way, until every document has one name. Two documents of the same
number of blocks have the same name only if their texts are the same: names are given to
contents, not to hashes. A hash only says where a content is sorted to; that no two contents
share one is checked, and if some did, another hash is taken.

Defined cases: a null text counts as empty and is one empty block; of rows with equal text
the smallest doc_id stays (null after all others), of equal rows exactly one; an empty table
gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.rows import empty_if_null, numbered, text_key
from gridcast.operators.sizing import attach, measure
from gridcast.params import LIMITS, Limits
from gridcast.store import land

BLOCK_CHARS = 4096
# Distinct blocks or pairs that one task sorts.
SORT_ROWS = 500_000
# Integer names: the sorted bucket in the high bits, the place in it in the low ones.
PLACE_BITS = 40


def normalised(name: str = "text") -> Column:
    """White space runs as one space; null is empty."""
    return F.regexp_replace(empty_if_null(name), r"[\x20\x09-\x0D]+", " ")


def _blocks(norm: Column, chars: int) -> Column:
    cut = F.regexp_extract_all(norm, F.lit("(?s).{1,%d}" % chars), F.lit(0))
    return F.when(norm == "", F.array(F.lit(""))).otherwise(cut)


def _hash(block: Column, attempt: int, bits: int) -> Column:
    """The hash a block is sorted by; ``bits`` are all of them from the second attempt on."""
    full = F.xxhash64(F.lit(attempt), block)
    return full if attempt or bits == 64 else F.shiftright(full, 64 - bits)


def sorted_names(distinct: DataFrame, keys: list[str], rows: int, spread: Column) -> DataFrame:
    """Give each row of ``distinct`` an integer ``name``: its bucket and its place in the sorted bucket.

    ``spread`` is a 64-bit number that tells rows apart evenly; buckets are ranges of it.
    """
    buckets = max(1, -(-rows // SORT_ROWS))
    # An unsigned range: the sign bit would make half of the buckets negative.
    bucket = F.pmod(F.shiftrightunsigned(spread, 20), F.lit(buckets))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*keys))
    return (
        distinct.withColumn("_bucket", bucket)
        .withColumn("name", F.shiftleft(F.col("_bucket"), PLACE_BITS) + place)
        .drop("_bucket")
    )


def _first_names(docs: DataFrame, chars: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """Documents with the hashes of their blocks, and the name of every hash."""
    attempt = 0
    while True:
        norm = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), normalised().alias("_norm"))
        cut = norm.withColumn("_blocks", _blocks(F.col("_norm"), chars))
        hashes = F.transform("_blocks", lambda b: _hash(b, attempt, bits))
        rows = numbered(
            cut.select(
                "doc_id", "text_key", F.sha2("_norm", 256).alias("text_sha256"),
                F.size("_blocks").alias("n_blocks"), hashes.alias("hashes"),
            ),
            "blocks",
        )
        # Every content is shuffled once, at most once from each task.
        contents = (
            cut.select(F.explode("_blocks").alias("block"))
            .select(_hash(F.col("block"), attempt, bits).alias("h"), "block")
            .groupBy("h", "block").agg(F.count(F.lit(1)).alias("n_rows"))
        )
        kept = measure(
            contents.groupBy("h").agg(F.count(F.lit(1)).alias("contents"), F.sum("n_rows").alias("n_rows")), "contents"
        )
        if not kept.df.filter("contents > 1").limit(1).count():
            return rows, sorted_names(kept.df.drop("contents"), ["h"], kept.rows, F.col("h"))
        attempt += 1


def block_names(
    docs: DataFrame, block_chars: int = BLOCK_CHARS, hash_bits: int = 64, limits: Limits = LIMITS
) -> DataFrame:
    """One row per document with its identity: (``n_blocks``, ``name``)."""
    rows, names = _first_names(docs, block_chars, hash_bits)
    named = attach(
        rows.select("uid", "n_blocks", F.posexplode("hashes").alias("pos", "h")), names, ["h"], "inner", limits, rows="n_rows"
    ).drop("h")
    named = land(named, "named-blocks")
    done = [named.filter("n_blocks = 1").select("uid", "name")]
    left, width = named.filter("n_blocks > 1"), rows.agg(F.max("n_blocks")).first()[0] or 1
    while width > 1:
        width = -(-width // 2)
        half = F.shiftright("pos", 1)
        pairs = land(
            left.groupBy("uid", "n_blocks", half.alias("pos")).agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                # The last of an odd number has no neighbour; no name is negative.
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
            ),
            "pairs",
        )
        kept = measure(pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_rows")), "distinct-pairs")
        pair_names = sorted_names(kept.df, ["a", "b"], kept.rows, F.xxhash64("a", "b"))
        left = attach(pairs, pair_names, ["a", "b"], "inner", limits, at_most=None, rows="n_rows").drop("a", "b")
        left = land(left, "named-pairs")
        if width == 1:
            done.append(left.select("uid", "name"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return attach(rows.drop("hashes"), out, ["uid"], "inner", limits)


def exact_duplicates(
    docs: DataFrame, block_chars: int = BLOCK_CHARS, hash_bits: int = 64, limits: Limits = LIMITS
) -> DataFrame:
    """One row per document: keep_id, group_size, kept, text_sha256 (and uid, text_key)."""
    named = land(block_names(docs, block_chars, hash_bits, limits), "identities")
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("uid").alias("u"))
    groups = named.groupBy("n_blocks", "name").agg(
        F.min(order).alias("_first"), F.count(F.lit(1)).alias("group_size")
    )
    groups = groups.select(
        "n_blocks", "name", F.col("_first.d").alias("keep_id"), F.col("_first.u").alias("_keep"),
        "group_size", F.col("group_size").alias("_rows_of"),
    )
    return (
        attach(named, groups, ["n_blocks", "name"], "inner", limits, rows="_rows_of")
        .withColumn("kept", F.col("uid") == F.col("_keep"))
        .select("doc_id", "keep_id", "group_size", "kept", "text_sha256", "uid", "text_key")
    )
