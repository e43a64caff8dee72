"""The driver's star-schema test tables seen as laps and race results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.operators.sizing import number_rows
from gridcast.params import LIMITS, Limits
from gridcast.sources.readers import spread

SEASON, EVENT, ROUND = 2026, "GP7", 7

# The agreed mapping of test columns to lap columns, table by table.
_LINEITEM = {
    "Driver": "concat('D', cast(l_suppkey as string))",
    "LapNumber": "l_linenumber",
    "LapTime": (
        "case when l_orderkey % 97 = 0 then null "
        "else 80.0D + (cast(round(l_extendedprice * 100) as bigint) % 1000) / 100.0D end"
    ),
    "Sector1Time": "25.0D + (l_partkey % 100) / 100.0D",
    "Sector2Time": "30.0D + (l_orderkey % 100) / 100.0D",
    "Sector3Time": "25.0D + (cast(round(l_extendedprice * 100) as bigint) % 700) / 100.0D",
    "TyreLife": "l_quantity",
    "row_key": "l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31 + l_suppkey * 611953",
}
_ORDERS = {
    "season": f"{SEASON}",
    "round_number": "year(o_orderdate) - 1994",
    "event": "concat('GP', cast(year(o_orderdate) - 1994 as string))",
    "_practice": (
        "case o_orderpriority when '3-MEDIUM' then 'FP3' when '4-NOT SPECIFIED' then 'FP2' "
        "when '5-LOW' then 'FP1' end"
    ),
    "_finished": "case o_orderpriority when '1-URGENT' then 'R' when '2-HIGH' then 'Q' end",
    "_open": "case o_orderpriority when '1-URGENT' then 'S' when '2-HIGH' then 'SQ' end",
}
_SESSION = "coalesce(_practice, if(l_linestatus = 'F', _finished, _open))"
_PART = {
    "Compound": (
        "case p_type when 'SMALL' then 'soft' when 'MEDIUM' then 'Medium' when 'LARGE' then 'HARD' "
        "when 'STANDARD' then 'INTER' when 'ECONOMY' then 'WET' end"
    )
}

TAGS = ("season", "round_number", "event", "session_type")
LAP_COLUMNS = (*TAGS, "Driver", "Team", "LapNumber", "LapTime", "Compound")
FEATURE_COLUMNS = (*LAP_COLUMNS, "Sector1Time", "Sector2Time", "Sector3Time", "TyreLife", "row_key")


def laps(spark: SparkSession, sf_dir: str, columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Laps with the named columns; only the tables these need are joined.

    Each table is mapped on its own before the join, so that an attribute of
    an order or part is worked out once and not once per lap. A lap is a row of
    ``lineitem`` with its order; supplier and part are joined left, so which laps
    there are does not depend on the columns asked for. Sides are plain joins: Spark broadcasts a side whose files are
    small, and splits hot keys of a shuffled one (AQE skew join).
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def mapped(df: DataFrame, keys: Sequence[str], values: dict[str, str]) -> DataFrame:
        return df.select(*keys, *[F.expr(e).alias(n) for n, e in values.items()])

    keys = ("l_orderkey", "l_suppkey", "l_partkey", "l_linestatus")
    wanted = {n: e for n, e in _LINEITEM.items() if n in columns}
    df = mapped(spread(table("lineitem"), "l_orderkey", "l_linenumber"), keys, wanted)
    orders = mapped(table("orders"), ("o_orderkey",), _ORDERS)
    df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if "Team" in columns:
        teams = table("supplier").join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        teams = mapped(teams, ("s_suppkey",), {"Team": "n_name"})
        df = df.join(teams, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    if "Compound" in columns:
        parts = mapped(table("part"), ("p_partkey",), _PART)
        df = df.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    return df.withColumn("session_type", F.expr(_SESSION)).select(*columns)


# Fixed value: cars in a race.
FIELD = 22


def in_field(laps_df: DataFrame) -> DataFrame:
    """All laps, dealt to the cars of one race, two to a team.

    The number of drivers of the tables grows with their scale, and so would the number of
    finishing positions that a model learns; a race has the same field at any scale.
    """
    car = F.expr(f"cast(substr(Driver, 2) as bigint) % {FIELD}")
    return laps_df.withColumns(
        {"Driver": F.concat(F.lit("C"), car.cast("string")), "Team": F.concat(F.lit("T"), F.floor(car / 2).cast("string"))}
    )


RESULT_COLUMNS = (*TAGS, "Driver", "Team", "LapTime")


def results(laps_df: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Race results: most timed race laps, then least total time, then name."""
    totals = (
        laps_df.filter((F.col("session_type") == "R") & F.col("LapTime").isNotNull())
        .groupBy("season", "event", "round_number", "Driver", F.col("Team").alias("TeamName"))
        .agg(F.count("LapTime").alias("_laps"), F.round(F.sum("LapTime"), 2).alias("_total"))
    )
    order = [F.col("_laps").desc(), F.col("_total").asc(), F.col("Driver").asc()]
    return number_rows(totals, ["season", "event"], order, "Position", limits).drop(
        "_laps", "_total"
    )
