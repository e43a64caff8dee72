"""From scored laps to ranked drivers, their uncertainty and the season's record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.functions.columns import keep_in_replicate, uncertainty_level
from gridcast.operators.sizing import attach, measure, number_rows
from gridcast.params import LIMITS, Limits, Params

EVENT = ("season", "event")
DRIVER = (*EVENT, "driver")


def driver_prediction(scored: DataFrame) -> DataFrame:
    """Scored laps to one row per driver: best win probability, most common position, laps.

    Laps are counted per predicted position first, so the mode needs no window;
    equally common positions resolve to the better one.
    """
    per_position = scored.groupBy(*DRIVER, "team", "pred_pos_lap").agg(
        F.max("win_prob_lap").alias("_best"), F.count(F.lit(1)).alias("_laps")
    )
    mode = F.max(F.struct("_laps", (-F.col("pred_pos_lap")).alias("_worse")))
    return per_position.groupBy(*DRIVER, "team").agg(
        F.max("_best").alias("win_probability"),
        (-mode["_worse"]).alias("common_position"),
        F.sum("_laps").alias("lap_count"),
    )


def normalise_share(
    df: DataFrame, value: str = "win_probability", limits: Limits = LIMITS
) -> DataFrame:
    """``value`` as its share of the event's total; NULL when the total is 0.

    The drivers are kept first, as they are read for the totals and again for
    the shares; the totals are a roll-up of them and never larger.
    """
    kept = measure(df, "drivers")
    totals = kept.df.groupBy(*EVENT).agg(F.sum(value).alias("_total"))
    out = attach(kept.df, totals, EVENT, "left", limits, at_most=kept.bytes)
    return out.withColumn(value, F.try_divide(F.col(value), F.col("_total"))).drop("_total")


def subsample_uncertainty(
    scored: DataFrame, b: int, fraction: float, key: Column, limits: Limits = LIMITS
) -> DataFrame:
    """Deviation of a driver's win share over ``b`` subsamples of the scored laps.

    Each subsample is one conditional maximum, so all of them come from a
    single pass without repeating a row. ``key`` is a bigint below 2^62 that
    tells laps apart. Fewer than two usable subsamples give 0.
    """
    names = [f"_r{i}" for i in range(b)]
    best = scored.withColumn("_key", key).groupBy(*DRIVER).agg(
        *[
            F.max(F.when(keep_in_replicate(F.col("_key"), i, fraction), F.col("win_prob_lap"))).alias(n)
            for i, n in enumerate(names)
        ]
    )
    kept = measure(best, "subsamples")
    totals = kept.df.groupBy(*EVENT).agg(*[F.sum(n).alias(f"_t{n}") for n in names])
    shared = attach(kept.df, totals, EVENT, "left", limits, at_most=kept.bytes)
    # A subsample without rows, or with total 0, counts for nobody.
    shares = F.array_compact(
        F.array(*[F.when(F.col(f"_t{n}") > 0, F.col(n) / F.col(f"_t{n}")) for n in names])
    )
    n = F.size("_shares")
    mean = F.aggregate("_shares", F.lit(0.0), lambda a, x: a + x) / n
    squares = F.aggregate(
        "_shares", F.lit(0.0), lambda a, x: a + (x - F.col("_mean")) * (x - F.col("_mean"))
    )
    return (
        shared.select(*DRIVER, shares.alias("_shares"))
        .withColumn("_mean", F.when(n > 0, mean))
        .select(
            *DRIVER,
            F.when(n > 1, F.sqrt(squares / (n - 1))).otherwise(F.lit(0.0)).alias("uncertainty"),
        )
    )


def join_uncertainty(
    df: DataFrame, uncertainty: DataFrame, limits: Limits = LIMITS
) -> DataFrame:
    return attach(df, uncertainty, DRIVER, "left", limits).fillna(0.0, subset=["uncertainty"])


def rank_drivers(df: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Final position by win probability within the event; equal ones go by name."""
    order = [F.col("win_probability").desc_nulls_last(), F.col("driver").asc()]
    return number_rows(df, EVENT, order, "predicted_position", limits)


def session_scores(df: DataFrame, p: Params) -> DataFrame:
    """Mean lap delta per driver, one column per session; NULL where there is no lap.

    The session list is fixed, so this is one conditional aggregation and no
    pivot has to look up values first.
    """
    return df.groupBy(*DRIVER).agg(
        *[
            F.avg(F.when(F.col("session_type") == s, F.col("lap_time_delta"))).alias(f"score_{s}")
            for s in p.scored_sessions
        ]
    )


def session_struct(weights: Mapping[str, float], sessions: Sequence[str]) -> Column:
    """Score columns as the nested object of the export; a session without laps is NULL."""

    def member(s: str) -> Column:
        score = F.col(f"score_{s}")
        filled = F.struct(
            F.round(score, 2).alias("score"), F.lit(float(weights[s])).alias("weight")
        )
        return F.when(score.isNotNull(), filled).alias(s)

    return F.struct(*[member(s) for s in sessions])


def winner_history(
    predictions: DataFrame, gold: DataFrame, season: int, limits: Limits = LIMITS
) -> DataFrame:
    """Predicted against actual winner per event that has been raced.

    Only predictions of after-race models count. ``winner_hit``: the predicted
    winner won. ``top3_hit``: the actual winner was among the predicted three.
    """
    ours = predictions.filter(
        (F.col("season") == season)
        & F.col("model_version").startswith("base_r")
        & (F.col("predicted_position") <= 3)
    )
    three = ours.groupBy("season", "event", "round").agg(
        F.max(F.when(F.col("predicted_position") == 1, F.col("driver"))).alias("predicted"),
        # At most three names per version of the event.
        F.collect_set("driver").alias("_three"),
    )
    actual = (
        gold.filter(
            (F.col("season") == season)
            & (F.col("session_type") == "R")
            & (F.col("race_position") == 1)
        )
        .select("season", "event", F.col("driver").alias("actual"))
        .distinct()
    )
    return (
        three.join(actual, ["season", "event"])
        .select(
            "season",
            "event",
            "round",
            "predicted",
            "actual",
            (F.col("predicted") == F.col("actual")).alias("winner_hit"),
            F.array_contains("_three", F.col("actual")).alias("top3_hit"),
        )
        .orderBy("season", "round", "event")
    )


def season_accuracy(history: DataFrame) -> DataFrame:
    """Share of correctly called winners to 4 decimals, 0 before the first race."""
    hit = F.avg(F.col("winner_hit").cast("double"))
    return history.agg(
        F.coalesce(F.round(hit, 4), F.lit(0.0)).alias("winner_pct"),
        F.count(F.lit(1)).alias("races"),
    )


def top3_summary(df: DataFrame) -> DataFrame:
    """The podium per event with a ``P1``..``P3`` label; each task keeps its own top three."""
    w = Window.partitionBy(*EVENT).orderBy(
        F.col("win_probability").desc_nulls_last(), F.col("driver").asc()
    )
    return (
        df.withColumn("place", F.row_number().over(w))
        .filter(F.col("place") <= 3)
        .withColumn("label", F.concat(F.lit("P"), F.col("place").cast("string")))
    )


def uncertainty_band(df: DataFrame) -> DataFrame:
    return df.withColumn("band", uncertainty_level(F.col("uncertainty")))


def recency_table(df: DataFrame, lam: float) -> DataFrame:
    """The decay that applies to each round present, counted from the latest one."""
    # The window sees one row per round.
    latest = F.max("round_number").over(Window.partitionBy("season"))
    ago = latest - F.col("round_number")
    return (
        df.select("season", "round_number")
        .distinct()
        .withColumn("rounds_ago", ago)
        .withColumn("decay", F.exp(F.lit(-lam) * F.col("rounds_ago")))
    )


def relative_importance(df: DataFrame, floor: float = 0.01) -> DataFrame:
    """Importance over the largest one, never below ``floor``; one row per model input."""
    largest = df.agg(F.max("importance")).scalar()
    share = F.try_divide(F.col("importance"), largest)
    return df.withColumn("relative", F.greatest(share, F.lit(floor)))


def prediction_rows(df: DataFrame, p: Params, model_version: str) -> DataFrame:
    """Ranked drivers in the predictions table's order, stamped in UTC ISO-8601."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return df.select(
        "driver",
        "team",
        F.lit(p.event).alias("event"),
        F.lit(p.round_number).alias("round"),
        F.lit(p.season).alias("season"),
        F.lit(model_version).alias("model_version"),
        F.col("predicted_position").cast("int"),
        "win_probability",
        "uncertainty",
        F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("generated_at"),
    )
