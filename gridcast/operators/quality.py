"""Counts, null audits and the row-loss report. Each is one aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.functions.columns import nudged_round
from gridcast.operators.clean import best_per_session, drop_critical_nulls, SESSION, session_best
from gridcast.operators.sizing import attach
from gridcast.params import LIMITS, Limits, Params
from gridcast.schemas import CRITICAL


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).orderBy(*keys)


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def null_rates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Percentage of NULLs per column to one decimal; NULL for an empty frame."""
    share = [F.avg(F.col(c).isNull().cast("double")) * 100 for c in cols]
    return df.agg(*[nudged_round(s, 1).alias(c) for s, c in zip(share, cols)])


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct().orderBy(*cols)


def row_loss(bronze: DataFrame, p: Params, limits: Limits = LIMITS) -> DataFrame:
    """Rows in, dropped for NULLs, dropped by the outlier rule, kept, and percent removed.

    One pass finds the session bests and one counts all four figures.
    """
    best = best_per_session(drop_critical_nulls(bronze))
    complete = reduce(
        lambda a, b: a & b,
        (
            F.col(c).isNotNull() & ~F.isnan(F.col(c)) if c == "LapTime" else F.col(c).isNotNull()
            for c in CRITICAL
        ),
    )
    quick = complete & (F.col("LapTime") <= F.col("session_best") * p.outlier_threshold)
    total = F.count(F.lit(1))
    kept = F.count_if(quick)
    removed = F.try_divide((total - kept) * 100.0, total)
    return attach(bronze, best, SESSION, "left", limits, rows="_rows").agg(
        total.alias("bronze_rows"),
        F.count_if(~complete).alias("dropped_nulls"),
        (F.count_if(complete) - kept).alias("dropped_outliers"),
        kept.alias("silver_rows"),
        nudged_round(removed, 1).alias("removed_pct"),
    )


def breach_count(df: DataFrame, threshold: float = 1.07, limits: Limits = LIMITS) -> DataFrame:
    """Laps beyond the outlier rule; 0 on a Silver table."""
    beyond = F.col("LapTime") > F.col("session_best") * threshold
    return session_best(df, limits).agg(F.count_if(beyond).alias("breaches"))
