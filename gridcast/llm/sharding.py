"""Sharding by a two-pass external shuffle.

Pass one scatters rows into buckets by a seeded hash; there are as many buckets as keep one
bucket within a task's memory. Pass two shuffles each bucket (Fisher-Yates, seeded by the
bucket) and writes it. The buckets one after the other are a random permutation of all rows;
shards are equal runs of it, so that their row counts are at most one apart.

The order depends on the seed and the rows alone, not on files, splits or tasks. Rows with the same
doc_id and text are counted and told apart by a number, so that they do not meet in one bucket.

Defined cases: a null text has size 8 and the checksum of no bytes; a null doc_id is a value
like others; an empty table gives an empty result; columns other than doc_id and text are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcast.operators.sizing import measure
from gridcast.params import LIMITS
from gridcast.store import land

BUCKET_BYTES = 8 << 20
HEADER_BYTES = 8


def _fisher_yates(seed: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def shuffle(key: tuple, rows: pa.Table) -> pa.Table:
        # A fixed order first: how rows arrive in a task may differ between runs.
        rows = rows.take(pc.sort_indices(rows, [("_order", "ascending"), ("doc_id", "ascending"), ("text_crc32", "ascending")]))
        rng = np.random.Generator(np.random.PCG64([seed, key[0].as_py()]))
        order = np.arange(rows.num_rows)
        # Generator.shuffle is a Fisher-Yates shuffle.
        rng.shuffle(order)
        place = pa.array(np.arange(rows.num_rows, dtype=np.int64))
        return rows.take(pa.array(order)).drop_columns(["_order"]).append_column("place", place)

    return shuffle


# Equal rows that one task writes.
COPIES_A_TASK = 10_000


def _told_apart(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_order``, a hash of their content in ``_key``, and for equal rows of their number as well.

    Equal rows are the same in all columns here, so they are made anew from one of them and their count.
    """
    twice = measure(rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_key"), "repeated")
    if not twice.rows:
        return rows.withColumnRenamed("_key", "_order")
    side = F.broadcast(twice.df) if twice.bytes <= LIMITS.broadcast_bytes else twice.df
    counted = rows.join(side, "_key", "left_semi").groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    starts = F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(COPIES_A_TASK).cast("long"))
    parts = counted.withColumn("_from", F.explode(starts)).repartition("_key", "_from")
    last = F.least(F.col("_from") + COPIES_A_TASK, F.col("_n")) - 1
    copies = parts.withColumn("_copy", F.explode(F.sequence("_from", last)))
    order = F.xxhash64("_key", "_copy").alias("_order")
    columns = [c for c in rows.columns if c != "_key"]
    once = rows.join(side, "_key", "left_anti").select(*columns, F.col("_key").alias("_order"))
    return once.unionByName(copies.select(*columns, order))


def scatter(docs: DataFrame, seed: int, bucket_bytes: int, least_buckets: int) -> DataFrame:
    """Pass one: rows with their size and bucket."""
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + HEADER_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))).alias("text_crc32"),
    )
    total = sized.agg(F.sum("size")).first()[0] or 0
    buckets = max(least_buckets, -(-total // bucket_bytes))
    # Nulls are skipped by the hash: whether there is one is part of it.
    key = F.xxhash64(F.lit(seed), F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")
    told = _told_apart(sized.withColumn("_key", key))
    return told.withColumn("bucket", F.pmod(F.col("_order"), F.lit(buckets)).cast("int"))


def shuffled_shards(
    docs: DataFrame, shards: int = 24, seed: int = 1, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """The written buckets read back, every row with its ``shard`` and ``slot``; texts included."""
    scattered = scatter(docs, seed, bucket_bytes, shards)
    written = land(
        scattered.groupBy("bucket").applyInArrow(
            _fisher_yates(seed), "doc_id long, text string, size long, text_crc32 long, bucket int, place long"
        ),
        "shuffled",
    )
    # One row per bucket.
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = written.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select(
        "bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("_all"),
    )
    at = F.col("_before") + F.col("place")
    return (
        written.join(F.broadcast(starts), "bucket")
        .withColumn("_at", at)
        # Shard s holds the places from ceil(s * all / shards) on; whole numbers throughout.
        .withColumn("shard", F.expr(f"cast((_at * {shards}L) div _all as int)"))
        .withColumn("slot", F.col("_at") - F.expr(f"(shard * _all + {shards - 1}L) div {shards}L"))
        .drop("_at", "_before", "_all", "place")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order."""
    (
        sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard").parquet(path)
    )

