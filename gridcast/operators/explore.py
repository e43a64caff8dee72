"""Exploration reports on Gold: distributions, group profiles, correlations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.functions.columns import nudged_round, pearson
from gridcast.operators.sizing import attach, exact_quantiles
from gridcast.params import LIMITS, UNKNOWN_COMPOUND, Limits
from gridcast.schemas import FEATURES

QUARTILES = {"p25": 0.25, "p75": 0.75}


def _struct_rows(wide: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One struct column per feature to one row per feature; runs on aggregates only."""
    named = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).alias("figures")) for c in cols]
    )
    return wide.select(*keys, F.inline(named)).select(*keys, "feature", "figures.*")


def feature_summary(
    df: DataFrame,
    cols: Sequence[str] = FEATURES,
    exact: bool = False,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles; one row per column.

    Quartiles are sketched in the same pass, or exact at the price of one more.
    """

    def figures(c: str) -> Column:
        value = F.col(c).cast("double")
        parts = [
            F.count(value).alias("n"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("stddev"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        ]
        if not exact:
            marks = F.percentile_approx(value, list(QUARTILES.values()), 10000)
            parts += [F.get(marks, i).alias(q) for i, q in enumerate(QUARTILES)]
        return F.struct(*parts).alias(c)

    summary = _struct_rows(df.agg(*[figures(c) for c in cols]), (), cols)
    if exact:
        marks = exact_quantiles(df, cols, QUARTILES, limits)
        summary = attach(summary, marks, ["feature"], "left", limits, at_most=256 * len(cols))
    return summary.select("feature", "n", "mean", "stddev", "min", "p25", "p75", "max")


# Size of a quantile sketch, and how far the rank of what it says is off at most (in shares of the
# rows; with this size the usual error is a fourth of it).
SKETCH_SIZE, RANK_ERROR = 1000, 0.01


def summary_state(df: DataFrame, by: Sequence[str], cols: Sequence[str] = FEATURES) -> DataFrame:
    """Mergeable figures and quantile sketches: one row per group (e.g. a round) and column.

    A row has a few kilobytes however many values went into it. Later rounds add rows; no value is
    read again.
    """

    def figures(c: str) -> Column:
        value = F.col(c).cast("double")
        return F.struct(
            F.count(value).alias("n"),
            F.avg(value).alias("mean"),
            (F.var_pop(value) * F.count(value)).alias("spread"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.kll_sketch_agg_double(value, F.lit(SKETCH_SIZE)).alias("sketch"),
        ).alias(c)

    return _struct_rows(df.groupBy(*by).agg(*[figures(c) for c in cols]), by, cols)


def summary_of_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """:func:`feature_summary` from the groups' states; quartiles to :data:`RANK_ERROR`."""
    n, mean = F.col("n"), F.col("mean")
    merged = states.groupBy(*by, "feature").agg(
        F.sum("n").alias("n"),
        F.try_divide(F.sum(n * mean), F.sum("n")).alias("mean"),
        # Spread inside the groups and between them.
        (F.sum("spread") + F.sum(n * mean * mean) - F.try_divide(F.sum(n * mean) * F.sum(n * mean), F.sum("n"))).alias("_spread"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double(F.when(n > 0, F.col("sketch"))).alias("_sketch"),
    )
    marks = [
        F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("_sketch", F.lit(p))).alias(q) for q, p in QUARTILES.items()
    ]
    deviation = F.when(F.col("n") > 1, F.sqrt(F.greatest(F.col("_spread"), F.lit(0.0)) / (F.col("n") - 1)))
    return merged.withColumn("stddev", deviation).select(
        *by, "feature", "n", "mean", "stddev", "min", *marks, "max"
    ).select(*by, "feature", "n", "mean", "stddev", "min", *QUARTILES, "max")


def rank_errors(df: DataFrame, summary: DataFrame, cols: Sequence[str] = FEATURES) -> DataFrame:
    """How far the exact rank of each sketched quartile is off: one row per column.

    A value's rank lies between the share of the rows below it and of those up to it.
    """
    long = df.select(*[F.col(c).cast("double") for c in cols]).unpivot([], list(cols), "feature", "value")
    # One short row per column name.
    met = long.filter("value is not null").join(F.broadcast(summary.select("feature", *QUARTILES)), "feature")

    def off(q: str, p: float) -> Column:
        below, upto = F.avg((F.col("value") < F.col(q)).cast("double")), F.avg((F.col("value") <= F.col(q)).cast("double"))
        return F.greatest(below - p, p - upto, F.lit(0.0)).alias(f"{q}_off")

    return met.groupBy("feature").agg(*[off(q, p) for q, p in QUARTILES.items()])


def profile(
    df: DataFrame,
    keys: Sequence[str],
    means: Mapping[str, str],
    mins: Mapping[str, str] | None = None,
    count: str | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Rounded means (and minima, and a row count) per group: the shape of most reports."""
    parts = [nudged_round(F.avg(c), 3).alias(name) for name, c in means.items()]
    parts += [nudged_round(F.min(c), 3).alias(name) for name, c in (mins or {}).items()]
    if count:
        parts.append(F.count(F.lit(1)).alias(count))
    out = df.groupBy(*keys).agg(*parts)
    return out.orderBy(*order) if order else out


def session_profile(gold: DataFrame) -> DataFrame:
    means = {
        "avg_lap_delta": "lap_time_delta",
        "avg_consistency": "consistency_score",
        "avg_vs_teammate": "pace_vs_teammate",
        "avg_tyre_deg": "tyre_deg_rate",
    }
    return profile(gold, ["session_type"], means, count="row_count", order=["session_type"])


def driver_leaders(gold: DataFrame) -> DataFrame:
    means = {
        "avg_lap_delta": "lap_time_delta",
        "avg_consistency": "consistency_score",
        "avg_vs_teammate": "pace_vs_teammate",
    }
    return profile(gold, ["driver", "team"], means, order=["avg_lap_delta", "driver"])


def race_leaders(gold: DataFrame) -> DataFrame:
    """Race-day means with the finishing position; empty before the race."""
    means = {
        "avg_lap_delta": "lap_time_delta",
        "avg_consistency": "consistency_score",
        "avg_tyre_deg": "tyre_deg_rate",
    }
    race = gold.filter(F.col("session_type") == "R")
    keys = ["driver", "team", "race_position"]
    return profile(race, keys, means, order=["race_position", "driver"])


def teammate_gap(gold: DataFrame) -> DataFrame:
    race = gold.filter((F.col("session_type") == "R") & F.col("race_position").isNotNull())
    return profile(
        race,
        ["driver", "team"],
        {"avg_vs_teammate": "pace_vs_teammate"},
        {"best_vs_teammate": "pace_vs_teammate"},
        count="laps",
        order=["avg_vs_teammate", "driver"],
    )


def compound_effect(gold: DataFrame) -> DataFrame:
    known = gold.filter(F.col("compound") != UNKNOWN_COMPOUND)
    means = {"avg_lap_delta": "lap_time_delta", "avg_tyre_deg": "tyre_deg_rate"}
    return profile(known, ["compound"], means, count="laps", order=["avg_lap_delta", "compound"])


def trend_leaders(gold: DataFrame) -> DataFrame:
    """Drivers by mean pace trend; negative is improving."""
    known = gold.filter((F.col("session_type") == "R") & F.col("pace_trend").isNotNull())
    return profile(
        known,
        ["driver", "team"],
        {"avg_pace_trend": "pace_trend"},
        order=["avg_pace_trend", "driver"],
    )


def feature_corr(
    df: DataFrame,
    cols: Sequence[str] = FEATURES,
    target: str = "race_position",
    by: Sequence[str] = (),
    min_n: int = 0,
) -> DataFrame:
    """Pearson r of every feature with the target, per group of at least ``min_n`` rows.

    All coefficients come from one aggregation and only its result is turned
    into rows. r is NULL, not an error, for constant or empty columns.
    """
    r = [F.struct(pearson(c, target).alias("r")).alias(c) for c in cols]
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *r)
    if min_n:
        wide = wide.filter(F.col("n") >= min_n)
    long = _struct_rows(wide, [*by, "n"], cols)
    direction = F.when(F.col("r") > 0, "worse position").otherwise("better position")
    return long.select(
        *by, "feature", "r", F.when(F.col("r").isNotNull(), direction).alias("direction"), "n"
    )


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows in a total order; planned as a distributed top-n, not a sort."""
    return df.orderBy(*order).limit(n)
