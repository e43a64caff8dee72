"""Silver to Gold: lap features, cross-round pace trend, race label.

The single-feature operators are for use one at a time. :func:`gold` computes
all of them together: laps are aggregated once per driver, team and compound
of a session, everything else is worked out on that table, and it is joined to
the laps once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.operators.sizing import attach, measure
from gridcast.params import LIMITS, Limits, Params
from gridcast.schemas import FEATURES, GOLD, PACE

DRIVER_SESSION = ("season", "event", "session_type", "driver")
TEAM_SESSION = ("season", "event", "session_type", "team")
STINT = (*DRIVER_SESSION, "compound")


def base_laps(silver: DataFrame, p: Params) -> DataFrame:
    """Gold naming for the lap columns; the round is tagged where laps carry none."""
    df = silver.withColumnsRenamed(
        {"Driver": "driver", "Team": "team", "LapNumber": "lap_number", "Compound": "compound"}
    )
    return df if "round_number" in df.columns else df.withColumn("round_number", F.lit(p.round_number))


def _with_group(
    df: DataFrame, keys: Sequence[str], limits: Limits, **aggregates: Column
) -> DataFrame:
    named = [a.alias(name) for name, a in aggregates.items()]
    side = df.groupBy(*keys).agg(*named, F.count(F.lit(1)).alias("_rows"))
    return attach(df, side, keys, "left", limits, rows="_rows")


def _sector_combo() -> Column:
    return F.min("Sector1Time") + F.min("Sector2Time") + F.min("Sector3Time")


def _degradation(lap_range: Column, life_range: Column) -> Column:
    return F.when(life_range > 0, lap_range / life_range).otherwise(F.lit(0.0))


def lap_time_delta(df: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Seconds to the driver's own best lap of the session."""
    best = _with_group(df, DRIVER_SESSION, limits, _best=F.min("LapTime"))
    return best.withColumn("lap_time_delta", F.col("LapTime") - F.col("_best")).drop("_best")


def consistency_score(df: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Sample deviation of the driver's laps; NULL for a single lap."""
    return _with_group(df, DRIVER_SESSION, limits, consistency_score=F.stddev_samp("LapTime"))


def best_sector_combo(df: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Sum of the best sectors; NULL when one sector was never timed."""
    return _with_group(df, DRIVER_SESSION, limits, best_sector_combo=_sector_combo())


def tyre_deg_rate(df: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Lap time range over tyre life range per compound; 0 without a life range."""
    rate = _degradation(
        F.max("LapTime") - F.min("LapTime"), F.max("TyreLife") - F.min("TyreLife")
    )
    return _with_group(df, STINT, limits, tyre_deg_rate=rate)


def pace_vs_teammate(df: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Driver's best minus the team's best lap of the session: 0 for the faster car."""
    per_driver = measure(
        df.groupBy(*DRIVER_SESSION, "team").agg(F.min("LapTime").alias("_own"))
    )
    team = per_driver.df.groupBy(*TEAM_SESSION).agg(F.min("_own").alias("_team"))
    driver = per_driver.df.groupBy(*DRIVER_SESSION).agg(F.min("_own").alias("_best"))
    gap = attach(
        attach(per_driver.df, driver, DRIVER_SESSION, "left", limits, at_most=per_driver.bytes),
        team,
        TEAM_SESSION,
        "left",
        limits,
        at_most=per_driver.bytes,
    ).select(
        *DRIVER_SESSION, "team", (F.col("_best") - F.col("_team")).alias("pace_vs_teammate")
    )
    return attach(df, gap, (*DRIVER_SESSION, "team"), "left", limits, at_most=per_driver.bytes)


def round_avg_delta(gold: DataFrame, season: int, before_round: int) -> DataFrame:
    """Mean race lap delta per driver and earlier round."""
    return (
        gold.filter(
            (F.col("season") == season)
            & (F.col("round_number") < before_round)
            & (F.col("session_type") == "R")
        )
        .groupBy("driver", "season", "round_number")
        .agg(F.avg("lap_time_delta").alias("avg_delta"))
    )


def pace_trend(
    gold: DataFrame, season: int, round_number: int, recent: int = 2, baseline: int = 4
) -> DataFrame:
    """Mean of the recent rounds' means minus that of the rounds before them.

    One row per driver with a recent race; NULL without a baseline. Each round
    is one conditional average, so a single shuffle on the driver does it all.
    """
    rounds = [round_number - back for back in range(1, recent + baseline + 1)]
    races = gold.filter(
        (F.col("season") == season)
        & F.col("round_number").between(rounds[-1], rounds[0])
        & (F.col("session_type") == "R")
    )
    per_round = races.groupBy("driver", "season").agg(
        *[
            F.avg(F.when(F.col("round_number") == r, F.col("lap_time_delta"))).alias(f"_{i}")
            for i, r in enumerate(rounds)
        ]
    )

    def mean_of(indices: range) -> Column:
        present = F.array_compact(F.array(*[F.col(f"_{i}") for i in indices]))
        total = F.aggregate(present, F.lit(0.0), lambda a, x: a + x)
        return F.try_divide(total, F.size(present))

    return per_round.select(
        "driver",
        "season",
        mean_of(range(recent)).alias("recent_avg"),
        mean_of(range(recent, recent + baseline)).alias("baseline_avg"),
    ).filter(F.col("recent_avg").isNotNull()).select(
        "driver", "season", (F.col("recent_avg") - F.col("baseline_avg")).alias("pace_trend")
    )


def pace_state(gold: DataFrame) -> DataFrame:
    """What later rounds' pace trends need of these laps: one row per driver and round (``PACE``).

    Rows of one round may come in parts, e.g. from late files: :func:`trend_from_state` adds them.
    """
    races = gold.filter((F.col("session_type") == "R") & F.col("lap_time_delta").isNotNull())
    return races.groupBy("season", "round_number", "driver").agg(
        F.sum(F.col("lap_time_delta").cast("double")).alias("total_delta"), F.count(F.lit(1)).alias("laps")
    ).select(*PACE.fieldNames())


def trend_from_state(
    state: DataFrame, season: int, round_number: int, recent: int = 2, baseline: int = 4
) -> DataFrame:
    """:func:`pace_trend` from the rounds' states alone: no lap of an earlier round is read.

    Of a state table in folders by season and round only the rounds that count are read.
    """
    first = round_number - recent - baseline
    means = (
        state.filter(
            (F.col("season") == season) & (F.col("round_number") >= first) & (F.col("round_number") < round_number)
        )
        .groupBy("driver", "season", "round_number")
        .agg((F.sum("total_delta") / F.sum("laps")).alias("_mean"))
    )
    late = F.col("round_number") >= round_number - recent
    return (
        means.groupBy("driver", "season")
        .agg(F.avg(F.when(late, F.col("_mean"))).alias("_recent"), F.avg(F.when(~late, F.col("_mean"))).alias("_before"))
        .filter(F.col("_recent").isNotNull())
        .select("driver", "season", (F.col("_recent") - F.col("_before")).alias("pace_trend"))
    )


def join_pace_trend(df: DataFrame, trend: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    return attach(df, trend, ["driver", "season"], "left", limits)


def join_results(df: DataFrame, positions: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Race position as label; NULL for drivers or events without a result yet."""
    return attach(df, positions, ["season", "event", "driver"], "left", limits)


# What each feature needs of a group of laps; every group has its laps and fastest one.
_STATISTICS = {
    "consistency_score": {
        "_mean": F.avg,
        "_spread": lambda c: F.var_pop(c) * F.count(c),
    },
    "pace_trend": {"_mean": F.avg},
    "tyre_deg_rate": {"_slowest": F.max},
}


def _keys(features: Sequence[str]) -> tuple[str, ...]:
    """The coarsest grain from which the features can be worked out."""
    compound = ["compound"] if "tyre_deg_rate" in features else []
    return (*DRIVER_SESSION, "team", *compound, "round_number")


def lap_statistics(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """The only aggregation over laps that the features need; combines map-side."""
    parts = {"_laps": F.count, "_fastest": F.min}
    for feature in features:
        parts |= _STATISTICS.get(feature, {})
    columns = [make("LapTime").alias(name) for name, make in parts.items()]
    if "tyre_deg_rate" in features:
        columns += [F.min("TyreLife").alias("_fresh"), F.max("TyreLife").alias("_worn")]
    if "best_sector_combo" in features:
        columns += [F.min(f"Sector{i}Time").alias(f"_s{i}") for i in (1, 2, 3)]
    return df.groupBy(*_keys(features)).agg(F.count(F.lit(1)).alias("_rows"), *columns)


def _roll_up(stats: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Driver-session figures from its rows in the statistics.

    These windows run over one row per team and compound of a driver-session,
    however many laps it has.
    """
    # Sorted by driver first: the season and event are the same in most rows.
    session = Window.partitionBy("driver", *(k for k in DRIVER_SESSION if k != "driver"))
    stint = Window.partitionBy("driver", *(k for k in STINT if k != "driver"))
    out = stats.withColumn("_best", F.min("_fastest").over(session))
    if "consistency_score" in features:
        laps, mean = F.sum("_laps").over(session), F.col("_session_mean")
        # Deviations pool exactly: spread within the parts plus spread between their means.
        between = F.col("_laps") * (F.col("_mean") - mean) * (F.col("_mean") - mean)
        spread = F.sum(F.col("_spread") + between).over(session)
        total = F.sum(F.col("_laps") * F.col("_mean")).over(session)
        out = out.withColumn("_session_mean", F.try_divide(total, laps)).withColumn(
            "consistency_score", F.when(laps > 1, F.sqrt(spread / (laps - 1)))
        )
    if "best_sector_combo" in features:
        sectors = [F.min(f"_s{i}").over(session) for i in (1, 2, 3)]
        out = out.withColumn("best_sector_combo", sectors[0] + sectors[1] + sectors[2])
    if "tyre_deg_rate" in features:
        lap_range = F.max("_slowest").over(stint) - F.min("_fastest").over(stint)
        life_range = F.max("_worn").over(stint) - F.min("_fresh").over(stint)
        out = out.withColumn("tyre_deg_rate", _degradation(lap_range, life_range))
    return out


def trend_by_round(stats: DataFrame, p: Params) -> DataFrame:
    """Each driver's pace trend as of every round, from the rounds before it.

    A season has one race per round, so the mean race lap delta of a round is
    its mean lap minus its best one. The range frames then run over one row
    per driver and round.
    """

    def race(c: Column) -> Column:
        return F.when(F.col("session_type") == "R", c)

    mean_lap = F.try_divide(
        F.sum(race(F.col("_laps") * F.col("_mean"))), F.sum(race(F.col("_laps")))
    )
    per_round = stats.groupBy("driver", "season", "round_number").agg(
        (mean_lap - F.min(race(F.col("_fastest")))).alias("_delta")
    )
    rounds = Window.partitionBy("driver", "season").orderBy("round_number")
    recent = rounds.rangeBetween(-p.recent_rounds, -1)
    baseline = rounds.rangeBetween(-p.recent_rounds - p.baseline_rounds, -p.recent_rounds - 1)
    return per_round.select(
        "driver",
        "season",
        "round_number",
        (F.avg("_delta").over(recent) - F.avg("_delta").over(baseline)).alias("pace_trend"),
    )


def gold(
    silver: DataFrame,
    p: Params,
    positions: DataFrame | None = None,
    prior: DataFrame | None = None,
    limits: Limits = LIMITS,
    features: Sequence[str] = FEATURES,
    trend: DataFrame | None = None,
) -> DataFrame:
    """Feature rows, one per lap, in the Gold column order (doubles; cast at the sink).

    ``positions``: season, event, driver, race_position; absent mid-weekend.
    ``prior``: Gold rows of earlier rounds, from which ``silver``'s round takes
    its pace trend. Without it ``silver`` holds whole seasons, and every round
    takes its trend from the rounds before it in there.
    ``features``: what to compute, for a report that needs only some of them.
    ``trend``: the pace trend of ``silver``'s round per driver and season, if it is known already.
    """
    laps = base_laps(silver, p)
    keys = _keys(features)
    stats = measure(lap_statistics(laps, features), "lap-statistics")
    # Roll-ups of the statistics have no more rows and columns than they do.
    size = stats.bytes

    rolled = _roll_up(stats.df, features)
    if "pace_vs_teammate" in features:
        team = stats.df.groupBy(*TEAM_SESSION).agg(F.min("_fastest").alias("_team_best"))
        rolled = attach(rolled, team, TEAM_SESSION, "left", limits, at_most=size).withColumn(
            "pace_vs_teammate", F.col("_best") - F.col("_team_best")
        )
    if "pace_trend" in features:
        if trend is not None:
            on, bound = ["driver", "season"], None
        elif prior is None:
            trend, on, bound = trend_by_round(stats.df, p), ["driver", "season", "round_number"], size
        else:
            trend = pace_trend(prior, p.season, p.round_number, p.recent_rounds, p.baseline_rounds)
            on, bound = ["driver", "season"], None
        rolled = attach(rolled, trend, on, "left", limits, at_most=bound)
    if positions is None:
        rolled = rolled.withColumn("race_position", F.lit(None).cast("int"))
    else:
        rolled = join_results(rolled, positions, limits)

    made = [f for f in FEATURES[1:] if f in features]
    side = rolled.select(*keys, "_best", *made, "race_position", "_rows")
    # The side has the statistics' rows and at most eight bytes a column for these.
    bound = size + 8 * stats.rows * (len(made) + 2)
    df = attach(laps, side, keys, "left", limits, at_most=bound, rows="_rows")
    df = df.withColumn("lap_time_delta", F.col("LapTime") - F.col("_best")).withColumns(
        {w: F.lit(None).cast("double") for w in ("recency_weight", "session_weight", "sample_weight")}
    )
    columns = [c for c in GOLD.fieldNames() if c not in FEATURES or c in features]
    return df.select(*columns, *[c for c in laps.columns if c == "row_key"])
