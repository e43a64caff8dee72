"""Bring landed columns into the declared shape: names, types, tags."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.functions.columns import lookup, null_if_nan, seconds
from gridcast.params import SESSION_NAMES, Params
from gridcast.schemas import RESULTS


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``: extra ones go, missing ones are typed NULLs.

    Text that cannot be cast gives NULL; NaN becomes NULL here, once, so that
    later stages meet only NULL.
    """
    have = {f.name: f.dataType for f in df.schema.fields}

    def shaped(f: T.StructField):
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        value = F.col(f"`{f.name}`")
        if isinstance(have[f.name], (T.FloatType, T.DoubleType)):
            value = null_if_nan(value)
        if have[f.name] != f.dataType:
            value = value.try_cast(f.dataType)
        return value.alias(f.name)

    return df.select(*map(shaped, schema.fields))


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: null_if_nan(F.col(c)) for c in floats})


def durations_to_seconds(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: seconds(c, kinds[c]) for c in cols if c in kinds})


def normalise_session(
    df: DataFrame, name_col: str, default_col: str, out: str = "session_type"
) -> DataFrame:
    """Long session name to code; a name not in the table keeps the requested code."""
    return df.withColumn(out, F.coalesce(lookup(F.col(name_col), SESSION_NAMES), F.col(default_col)))


def tag(df: DataFrame, **constants: object) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def flag_text(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Booleans as ``True`` / ``False`` text; NULL stays NULL."""
    return df.withColumns({c: F.initcap(F.col(c).cast("string")) for c in cols if c in df.columns})


def flag_values(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Stored flag text back as booleans; any other text gives NULL."""
    return df.withColumns({c: F.col(c).try_cast("boolean") for c in cols if c in df.columns})


def conform_results(df: DataFrame, p: Params) -> DataFrame:
    """Raw classification rows as the results table.

    Positions arrive as text or floats and become whole numbers; what is no
    whole number gives NULL. Columns that are missing become typed NULLs.
    """
    df = df.withColumnsRenamed({"Abbreviation": "Driver"})

    def number(name: str):
        return F.col(name).cast("string").try_cast("double")

    def whole(name: str):
        return F.when(number(name) == F.floor(number(name)), number(name)).try_cast("int")

    shaped = {"Position": whole, "GridPosition": whole, "Points": number}
    df = df.withColumns({c: make(c) for c, make in shaped.items() if c in df.columns})
    # Tags that the rows carry already stay; a file of one event has none.
    tags = {"season": p.season, "event": p.event, "round_number": p.round_number}
    return conform(tag(df, **{k: v for k, v in tags.items() if k not in df.columns}), RESULTS)


def session_coverage(
    laps: DataFrame,
    keys: Sequence[str],
    sessions: Sequence[str],
    expected: DataFrame | None = None,
) -> DataFrame:
    """Every expected session of every key: its lap count, and ingested or skipped.

    One conditional count per expected session; only its result becomes rows,
    so sessions without a lap show up without a join. ``expected`` names keys that
    must come out even if no lap has them.
    """
    if expected is not None:
        nothing = F.lit(None).cast("string").alias("session_type")
        laps = laps.select(*keys, "session_type").unionByName(expected.select(*keys, nothing))
    counted = laps.groupBy(*keys).agg(
        *[F.count_if(F.col("session_type") == s).alias(f"_{s}") for s in sessions]
    )
    rows = F.array(
        *[F.struct(F.lit(s).alias("session_type"), F.col(f"_{s}").alias("laps")) for s in sessions]
    )
    status = F.when(F.col("laps") > 0, "ingested").otherwise("skipped")
    return counted.select(*keys, F.inline(rows)).withColumn("status", status)
