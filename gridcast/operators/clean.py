"""Bronze to Silver: null handling, casts, compound codes, the 107 % rule."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.functions.columns import compound
from gridcast.operators.sizing import attach
from gridcast.params import COMPOUNDS, LIMITS, UNKNOWN_COMPOUND, Limits, Params
from gridcast.schemas import CRITICAL

SESSION = ("season", "event", "session_type")


def drop_critical_nulls(df: DataFrame, cols: Sequence[str] = CRITICAL) -> DataFrame:
    """Rows where every critical column is present; NaN counts as absent."""
    return df.dropna(subset=list(cols))


def cast_lap_number(df: DataFrame) -> DataFrame:
    """Lap number as int; unreadable text gives NULL instead of failing the job."""
    return df.withColumn("LapNumber", F.col("LapNumber").try_cast("int"))


def normalise_compound(
    df: DataFrame,
    known: Iterable[str] = COMPOUNDS,
    aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    return df.withColumn("Compound", compound("Compound", known, aliases or {}, UNKNOWN_COMPOUND))


def best_per_session(df: DataFrame) -> DataFrame:
    """One row per session: its fastest lap. Combines map-side, so the shuffle is tiny."""
    return df.groupBy(*SESSION).agg(
        F.min("LapTime").alias("session_best"), F.count(F.lit(1)).alias("_rows")
    )


def session_best(df: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Laps with their session's fastest time as ``session_best``.

    Sessions are few and huge, so a window would put each into one task; the
    minimum is aggregated and joined back instead. Reads ``df`` twice.
    """
    return attach(df, best_per_session(df), SESSION, "left", limits, rows="_rows")


def filter_outlier_laps(
    df: DataFrame, threshold: float = 1.07, limits: Limits = LIMITS
) -> DataFrame:
    """Laps within ``threshold`` times the session's fastest one; untimed laps go."""
    kept = session_best(df, limits).filter(F.col("LapTime") <= F.col("session_best") * threshold)
    return kept.drop("session_best")


def silver(bronze: DataFrame, p: Params, limits: Limits = LIMITS) -> DataFrame:
    return (
        bronze.transform(drop_critical_nulls)
        .transform(cast_lap_number)
        .transform(normalise_compound, p.compounds, p.compound_aliases)
        .transform(filter_outlier_laps, p.outlier_threshold, limits)
    )
