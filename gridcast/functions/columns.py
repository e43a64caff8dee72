"""Column expressions shared by the operators. All stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lookup(key: Column, values: Mapping[str, object]) -> Column:
    """Value for ``key`` in a small literal map, NULL where the key is not in it."""
    if not values:
        return F.lit(None)
    pairs = [F.lit(x) for item in values.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def seconds(name: str, kind: T.DataType) -> Column:
    """Duration column as double seconds; text that is no duration gives NULL.

    Takes day-time intervals, numbers (already seconds) and text such as
    ``0 days 00:01:32.450000`` or ``00:01:32.45``.
    """
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    span = F.col(name)
    if isinstance(kind, T.StringType):
        text = F.trim(F.regexp_replace(span, r"\s*days?\s*", " "))
        text = F.when(text.contains(" "), text).otherwise(F.concat(F.lit("0 "), text))
        span = text.try_cast("interval day to second")
    # Whole numbers and decimals add exactly; only the total becomes a double.
    parts = {"DAY": 86400, "HOUR": 3600, "MINUTE": 60, "SECOND": 1}
    total = sum((F.extract(F.lit(unit), span) * size for unit, size in parts.items()), F.lit(0))
    return total.cast("double")


def compound(name: str, known: Iterable[str], aliases: Mapping[str, str], unknown: str) -> Column:
    upper = F.upper(F.col(name))
    code = F.coalesce(lookup(upper, aliases), upper) if aliases else upper
    return F.when(code.isin(*known), code).otherwise(unknown)


def pearson(x: str, y: str) -> Column:
    """Pearson r over rows where both are present; NULL for constant or empty input.

    ``corr`` raises under ANSI mode for a constant column, so the ratio is
    written out with a guarded division.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def nudged_round(value: Column, digits: int) -> Column:
    """Round after a 1e-9 shift, so exact decimal ties do not hang on float noise."""
    return F.round(value + F.lit(1e-9), digits)


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def version_label(prefix: str, round_number: Column) -> Column:
    return F.format_string(prefix + "_r%02d", round_number)


def uncertainty_level(value: Column) -> Column:
    # Band limits.
    return F.when(value < 0.05, "LOW").when(value < 0.15, "MED").otherwise("HIGH")


def trend_label(pace_trend: Column, dead_band: float) -> Column:
    """A negative trend is an improving driver."""
    return (
        F.when(pace_trend < -dead_band, "up").when(pace_trend > dead_band, "down").otherwise("flat")
    )


def row_key(*cols: str) -> Column:
    """A bigint in [0, 2^62) per row content, for :func:`keep_in_replicate`."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 2)


def keep_in_replicate(key: Column, replicate: int, fraction: float) -> Column:
    """Bernoulli draw that depends on the row key and replicate only.

    Unlike ``sample(seed)`` it gives the same rows however the data is
    partitioned, and after a lost task is run again. Squaring modulo the prime
    2^31-1 keeps replicates of one key independent of each other.
    """
    prime = 2147483647
    mixed = F.pmod(key + F.lit(replicate * 15485863).cast("long"), F.lit(prime).cast("long"))
    return F.pmod(mixed * mixed, F.lit(prime).cast("long")) % 1000 < round(fraction * 1000)
