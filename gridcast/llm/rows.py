"""Helpers for tables of documents: rows told apart, rows taken out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.operators.sizing import measure
from gridcast.params import LIMITS, Limits
from gridcast.store import land


# Rows of texts that go to a Python worker at once; Spark's own 10,000 are 30 MB of web pages and more,
# several times over in the executor's and the worker's memory.
BATCH_ROWS = 2_000
_BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_batches(df: DataFrame) -> DataFrame:
    """``df``, to be sent to Python workers in batches of at most ``BATCH_ROWS`` rows in this session."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCHES)) <= BATCH_ROWS:
        conf.set(_BATCHES, str(BATCH_ROWS))
    return df


def empty_if_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def text_key(name: str = "text") -> Column:
    """Tells texts apart next to their doc_id; null counts as empty."""
    return F.xxhash64(empty_if_null(name))


def without(docs: DataFrame, gone: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """``docs`` without the rows named in ``gone`` (doc_id, text_key).

    The list is measured: a short one is broadcast, so that texts are not shuffled.
    """
    kept = measure(gone.select(F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key")), "gone")
    side = F.broadcast(kept.df) if kept.bytes <= limits.broadcast_bytes else kept.df
    same = F.col("doc_id").eqNullSafe(F.col("_gone_id")) & (text_key() == F.col("_gone_key"))
    return docs.join(side, same, "left_anti")


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once with a ``uid`` per row, so that equal rows can be told apart later."""
    return land(df.withColumn("uid", F.monotonically_increasing_id()), name)
