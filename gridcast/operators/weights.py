"""Training weights: recency decay times session weight."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.functions.columns import lookup, nudged_round
from gridcast.params import SESSION_WEIGHTS, Params


def recency_weight(df: DataFrame, lam: float) -> DataFrame:
    """exp(-lam * rounds ago), counted from the latest round in ``df``.

    The latest round is a scalar subquery: part of the same plan, no collect.
    """
    latest = df.agg(F.max("round_number")).scalar()
    return df.withColumn("recency_weight", F.exp(F.lit(-lam) * (latest - F.col("round_number"))))


def session_weight(df: DataFrame, weights: Mapping[str, float] = SESSION_WEIGHTS) -> DataFrame:
    """Weight by session code; NULL for a code without one."""
    return df.withColumn("session_weight", lookup(F.col("session_type"), weights).cast("double"))


def sample_weight(df: DataFrame, p: Params, unknown: str = "keep") -> DataFrame:
    """Product of both weights.

    Learners reject NULL weights, so rows of a session without a weight can be
    kept as they are (``keep``), left out (``drop``) or fail the job (``fail``).
    """
    out = session_weight(recency_weight(df, p.recency_lambda), p.session_weights)
    if unknown == "drop":
        out = out.filter(F.col("session_weight").isNotNull())
    elif unknown == "fail":
        code = F.coalesce(F.col("session_type"), F.lit("NULL"))
        message = F.concat(F.lit("no weight for session "), code)
        out = out.withColumn(
            "session_weight",
            F.when(F.col("session_weight").isNull(), F.raise_error(message).cast("double")).otherwise(
                F.col("session_weight")
            ),
        )
    elif unknown != "keep":
        raise ValueError(f"unknown must be keep, drop or fail, not {unknown!r}")
    return out.withColumn("sample_weight", F.col("recency_weight") * F.col("session_weight"))


def weight_audit(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("round_number", "session_type")
        .agg(
            *[
                nudged_round(F.avg(f"{w}_weight"), 3).alias(f"avg_{w}")
                for w in ("recency", "session", "sample")
            ]
        )
        .orderBy("round_number", "session_type")
    )
