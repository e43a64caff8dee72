"""Joins, rankings and quantiles that pick their plan from a measured size.

Every aggregate that is joined back to laps goes through :func:`attach`. The
aggregate is computed once, written to the shared checkpoint folder and measured
on the way. Up to ``Limits.broadcast_bytes`` it is broadcast, so laps are not
shuffled at all; beyond that the join shuffles and spreads hot keys. No window
ever runs over laps: ordered windows run on aggregates, in one task only up to
``Limits.task_rows``, else slice by slice over a range partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.params import LIMITS, Limits
from gridcast.store import land


@dataclass(frozen=True)
class Measured:
    df: DataFrame
    rows: int
    bytes: int


def _row_bytes(schema: T.StructType) -> Column:
    width = F.lit(16 + 8 * len(schema.fields)).cast("long")
    for f in schema.fields:
        if isinstance(f.dataType, T.StringType):
            width += F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif not isinstance(f.dataType, (T.AtomicType, T.NullType)):
            width += F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`"))))
    return width


def measure(df: DataFrame, name: str = "kept") -> Measured:
    """:func:`land` ``df`` and learn its rows and bytes in the same job."""
    seen = Observation()
    kept = land(
        df.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.sum(_row_bytes(df.schema)).alias("bytes"),
        ),
        name,
    )
    found = seen.get
    return Measured(kept, found["rows"] or 0, found["bytes"] or 0)


def _null_safe_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, shuffled: bool = False
) -> DataFrame:
    """A ``shuffled`` join has the hash of its keys as first key, by which both sides are sorted.

    The keys themselves would be compared from the first one on, which is often the same in most
    rows, and each as two, its value and whether it is NULL.
    """
    renamed = {k: f"_on_{k}" for k in on}
    hashed = shuffled and _kinds(left, on) == _kinds(right, on)
    if hashed:
        left, right = (df.withColumn(h, F.xxhash64(*on)) for df, h in ((left, "_hash"), (right, "_on_hash")))
    # Right-hand keys get names of their own, so that by-name conditions are unambiguous.
    right = right.select(
        *[F.col(k).alias(renamed[k]) for k in on],
        *[c for c in right.columns if c.lower() not in {k.lower() for k in on}],
    )
    each = [F.col(k).eqNullSafe(F.col(renamed[k])) for k in on]
    same = reduce(lambda a, b: a & b, [F.col("_hash") == F.col("_on_hash"), *each] if hashed else each)
    return left.join(right, same, how).drop("_hash", "_on_hash", *renamed.values())


def _kinds(df: DataFrame, on: Sequence[str]) -> list[T.DataType]:
    return [f.dataType for f in df.select(*on).schema.fields]


def attach(
    df: DataFrame,
    side: DataFrame,
    on: Sequence[str],
    how: str = "left",
    limits: Limits = LIMITS,
    at_most: int | None = None,
    rows: str | None = None,
) -> DataFrame:
    """Join per-key columns of ``side`` (one row per key) onto ``df``; NULL keys match.

    ``at_most`` is a proven upper bound of the side's bytes, e.g. the measured
    size of the table it is rolled up from. When it already fits the
    broadcast limit no measuring job is run. ``rows`` names a column of
    ``side`` that says how many rows of ``df`` have the key, and is dropped;
    without it a shuffled join counts them first to find hot keys.
    """
    if at_most is None or at_most > limits.broadcast_bytes:
        kept = measure(side)
        side, at_most = kept.df, kept.bytes
    if at_most <= limits.broadcast_bytes:
        side = side.drop(rows) if rows else side
        return _null_safe_join(df, F.broadcast(side), on, how)
    if rows:
        counts, side = side.select(*on, F.col(rows).alias("_rows")), side.drop(rows)
    else:
        counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    return _spread_join(df, side, counts, on, how, limits)


def _wide_of(others: int) -> Column:
    """Over how many tasks a row's key is spread: its own number, else that of the others."""
    return F.coalesce(F.col("_hot"), F.lit(others))


def _spread_join(
    df: DataFrame,
    side: DataFrame,
    counts: DataFrame,
    on: Sequence[str],
    how: str,
    limits: Limits,
) -> DataFrame:
    """Shuffled join in which hot keys are salted, and their rows of ``side`` repeated.

    The list of hot keys is broadcast. One too long for that keeps its hottest keys, those of
    ``bar`` rows or more; all other keys then have fewer than ``bar`` rows and are spread over
    ``bar / hot_rows`` tasks each, so that no hot key stays in one task.
    """
    counted = measure(counts.filter(F.col("_rows") >= limits.hot_rows), "hot-keys")
    if counted.rows == 0:
        return _null_safe_join(df, side, on, how, shuffled=True)
    hot, bar, size = counted.df, limits.hot_rows, counted
    while size.rows > 0 and size.bytes > max(limits.broadcast_bytes, 1 << 20):
        bar *= 10
        size = measure(hot.filter(F.col("_rows") >= bar))
        hot = size.df
    others = -(-bar // limits.hot_rows)

    wide = F.greatest(F.lit(limits.salts), F.ceil(F.col("_rows") / limits.hot_rows)).cast("int")
    hot = F.broadcast(hot.select(*on, wide.alias("_hot")))
    # The input partition is in the hash, so that copies of one row spread too; a task
    # that runs again has the same partition number and so gives the same salts.
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in df.columns]), _wide_of(others))
    left = _null_safe_join(df, hot, on, "left").withColumn(
        "_salt", salt.cast("int")
    )
    last = _wide_of(others) - 1
    right = _null_safe_join(side, hot, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), last))
    )
    return _null_safe_join(left.drop("_hot"), right.drop("_hot"), [*on, "_salt"], how, shuffled=True).drop("_salt")


def running_total(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    amount: Column,
    name: str,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Cumulative sum of ``amount`` in each group; ``order`` must have no ties.

    Beyond ``limits.task_rows`` rows the data is range-partitioned on group and
    order; each slice sums for itself, and the sums of the slices before it
    (one row per group and slice) are added. No task holds more than a slice.
    """
    kept = measure(df.withColumn("_amount", amount.cast("long")))
    upto = F.sum("_amount")
    if kept.rows <= limits.task_rows:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return kept.df.withColumn(name, upto.over(w)).drop("_amount")

    sliced = land(
        kept.df.repartitionByRange(*[F.col(k) for k in by], *order).withColumn(
            "_slice", F.spark_partition_id()
        ),
        "slices",
    )
    inside = (
        Window.partitionBy(*by, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        sliced.groupBy(*by, "_slice")
        .agg(F.sum("_amount").alias("_sum"))
        .select(*by, "_slice", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    )
    summed = sliced.withColumn(name, upto.over(inside))
    return (
        attach(summed, before, [*by, "_slice"], "left", limits)
        .withColumn(name, F.col(name) + F.col("_before"))
        .drop("_amount", "_slice", "_before")
    )


def number_rows(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    name: str,
    limits: Limits = LIMITS,
) -> DataFrame:
    """``row_number`` per group that stays distributed for groups of any size."""
    numbered = running_total(df, by, order, F.lit(1), name, limits)
    return numbered.withColumn(name, F.col(name).cast("int"))


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: dict[str, float], limits: Limits = LIMITS
) -> DataFrame:
    """Exact, linearly interpolated quantiles: one row per column, one column per prob.

    Built-in ``percentile`` keeps all distinct values of a group in one task.
    Here equal values are counted first and ranks come from a running total.
    """
    counted = (
        df.select(*[F.col(c).cast("double") for c in cols])
        .unpivot([], list(cols), "feature", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_total(counted, ["feature"], [F.col("value")], F.col("n"), "upto", limits)
    totals = ranked.groupBy("feature").agg(F.max("upto").alias("_total"))
    # One short row per column name.
    ranked = attach(ranked, totals, ["feature"], "left", limits, at_most=256 * len(cols))

    def at(rank: Column) -> Column:
        holds = (rank >= F.col("upto") - F.col("n")) & (rank < F.col("upto"))
        return F.max(F.when(holds, F.col("value")))

    out = []
    for name, p in probs.items():
        place = F.lit(p) * (F.col("_total") - 1)
        low, high = at(F.floor(place)), at(F.ceil(place))
        share = F.max(place - F.floor(place))
        out.append((low + (high - low) * share).alias(name))
    return ranked.groupBy("feature").agg(*out)
