"""The large-side plans give the same rows as the small-side ones, and as brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gridcast.operators import clean, features, rank
from gridcast.operators.sizing import (
    attach,
    exact_quantiles,
    measure,
    number_rows,
    running_total,
)
from gridcast.params import LIMITS, Limits, Params

TINY = Limits(broadcast_bytes=0, task_rows=10, hot_rows=50, salts=8)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, many of them copies of one row, and NULL keys."""
    rng = random.Random(7)
    rows = [("hot", i % 3, 1.5) for i in range(400)]
    rows += [(f"k{rng.randrange(60)}", rng.randrange(5), rng.random()) for _ in range(700)]
    rows += [(None, rng.randrange(5), rng.random()) for _ in range(100)]
    return spark.createDataFrame(rows, "k string, i int, v double").repartition(7)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_join_equals_broadcast_join(spark, skewed, how):
    side = skewed.filter("k is null or k != 'k3'").groupBy("k").agg(F.sum("i").alias("s"))
    small, large = (attach(skewed, side, ["k"], how, limits) for limits in (LIMITS, TINY))
    assert rows_of(small) == rows_of(large)
    assert large.columns == ["k", "i", "v", "s"]


def test_spread_join_splits_the_hot_key_only(spark, skewed):
    side = skewed.groupBy("k").agg(F.sum("i").alias("s"))
    plan = attach(skewed, side, ["k"], "left", TINY)._jdf.queryExecution().toString()
    assert "_salt" in plan and "spark_partition_id" in plan.lower()
    cool = attach(skewed, side, ["k"], "left", Limits(broadcast_bytes=0, hot_rows=10_000))
    assert "_salt" not in cool._jdf.queryExecution().toString()
    assert rows_of(cool) == rows_of(attach(skewed, side, ["k"]))


def test_a_list_of_hot_keys_beyond_a_broadcast_leaves_none_unsplit(spark):
    """45,000 hot keys are more than the list may hold: they are split by the raised bar."""
    df = spark.range(90_000).selectExpr("id % 45000 as k", "id as v").repartition(8)
    side = df.groupBy("k").agg(F.sum("v").alias("s"))
    out = attach(df, side, ["k"], "left", Limits(broadcast_bytes=0, hot_rows=2, salts=4))
    plan = out._jdf.queryExecution().toString()
    assert "_salt" in plan
    want = df.groupBy("k").agg(F.sum("v").alias("s"), F.count("*").alias("n")).selectExpr("sum(n)", "sum(s * n)")
    assert out.selectExpr("count(s)", "sum(s)").first()[:] == want.first()[:]


@pytest.mark.parametrize("limits", [LIMITS, TINY])
def test_known_row_counts_are_used_and_dropped(skewed, limits):
    side = skewed.groupBy("k").agg(F.sum("i").alias("s"), F.count("*").alias("n"))
    out = attach(skewed, side, ["k"], "left", limits, rows="n")
    assert out.columns == ["k", "i", "v", "s"]
    assert rows_of(out) == rows_of(attach(skewed, side.drop("n"), ["k"]))


def test_attach_broadcasts_only_below_the_limit(spark, skewed):
    side = skewed.groupBy("k").agg(F.sum("i").alias("s"))
    small = attach(skewed, side, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    large = attach(skewed, side, ["k"], "left", TINY)
    assert "strategy=broadcast" in small
    joins = [
        line
        for line in large._jdf.queryExecution().optimizedPlan().toString().splitlines()
        if "Join" in line
    ]
    # The outermost join, laps to statistics, is not hinted; the hot-key lists are.
    assert "broadcast" not in joins[0]


def test_measure_counts_rows_and_bytes(spark):
    kept = measure(spark.createDataFrame([("ab", 1), ("c", None)], "s string, n int"))
    assert (kept.rows, kept.bytes) == (2, 2 * (16 + 16) + 3)
    empty = measure(spark.createDataFrame([], "s string"))
    assert (empty.rows, empty.bytes) == (0, 0)


def test_row_numbers_over_slices(spark, skewed):
    order = [F.col("v").desc(), F.col("i").asc(), F.col("id").asc()]
    numbered = skewed.withColumn("id", F.monotonically_increasing_id())
    kept = measure(numbered).df
    small = number_rows(kept, ["k"], order, "place")
    large = number_rows(kept, ["k"], order, "place", TINY)
    assert rows_of(small) == rows_of(large)
    per_key = defaultdict(list)
    for r in large.collect():
        per_key[r.k].append(r)
    for group in per_key.values():
        group.sort(key=lambda r: (-r.v, r.i, r.id))
        assert [r.place for r in group] == list(range(1, len(group) + 1))


def test_running_total_of_weights(spark, skewed):
    df = skewed.groupBy("k", "v").agg(F.sum("i").alias("w"))
    small, large = (
        running_total(df, ["k"], [F.col("v")], F.col("w"), "upto", x) for x in (LIMITS, TINY)
    )
    assert rows_of(small) == rows_of(large)


@pytest.mark.parametrize("limits", [LIMITS, TINY])
def test_exact_quantiles(spark, limits):
    rng = random.Random(3)
    values = [rng.choice([1.0, 2.5, rng.random() * 9]) for _ in range(157)] + [None] * 4
    df = spark.createDataFrame([(v, 5.0) for v in values], "a double, b double")
    out = exact_quantiles(df, ["a", "b"], {"p25": 0.25, "p75": 0.75}, limits)
    got = {r.feature: (r.p25, r.p75) for r in out.collect()}
    want = df.agg(F.percentile("a", F.array(F.lit(0.25), F.lit(0.75)))).first()[0]
    assert got["a"] == pytest.approx(want)
    assert got["b"] == (5.0, 5.0)


def test_gold_and_rank_do_not_depend_on_the_limits(spark):
    rng = random.Random(11)
    sessions = ["R", "Q", "FP1"]
    rows = []
    for i in range(900):
        driver = "D0" if i % 3 == 0 else f"D{rng.randrange(1, 9)}"
        rows.append(
            (driver, f"T{int(driver[1:]) % 3}", 2026, f"GP{i % 4 + 1}", i % 4 + 1,
             rng.choice(sessions), i, 80 + rng.randrange(400) / 100, 25.0 + i % 7, 30.0, 26.0,
             rng.choice(["soft", "HARD", None]), float(rng.randrange(20)))
        )
    laps = spark.createDataFrame(
        rows,
        "Driver string, Team string, season int, event string, round_number int, "
        "session_type string, LapNumber int, LapTime double, Sector1Time double, "
        "Sector2Time double, Sector3Time double, Compound string, TyreLife double",
    )
    p = Params(2026, "GP4", 4)
    positions = laps.select("season", "event", F.col("Driver").alias("driver")).distinct()
    positions = positions.withColumn("race_position", F.substring("driver", 2, 1).cast("int") + 1)

    def result(limits):
        gold = features.gold(clean.silver(laps, p, limits), p, positions, limits=limits)
        scored = gold.withColumn("win_prob_lap", 1 / (1 + F.col("lap_time_delta"))).withColumn(
            "pred_pos_lap", F.col("lap_number") % 3
        )
        final = rank.rank_drivers(
            rank.normalise_share(rank.driver_prediction(scored), limits=limits), limits
        )
        sure = rank.subsample_uncertainty(
            scored, 5, 0.8, F.col("lap_number").cast("long") * 7919, limits
        )
        both = rank.join_uncertainty(final, sure, limits)
        floats = [f.name for f in gold.schema.fields if f.dataType.simpleString() == "double"]
        return (
            rows_of(gold.withColumns({c: F.round(c, 9) for c in floats})),
            rows_of(both.withColumns({c: F.round(c, 9) for c in ("win_probability", "uncertainty")})),
        )

    assert result(LIMITS) == result(TINY)


def test_shuffled_joins_sort_by_a_hash_first(spark):
    """All rows have the same first key, as laps have a season; NULL keys match still."""
    df = spark.createDataFrame([(1, k, i) for k in ("a", "b", None) for i in range(3)], "s int, k string, i int")
    side = spark.createDataFrame([(1, "a", 10), (1, None, 30)], "s int, k string, v int")
    for hot in (5_000_000, 2):
        limits = Limits(broadcast_bytes=0, hot_rows=hot, salts=2)
        out = attach(df, side, ["s", "k"], "left", limits)
        assert sorted(((r.k, r.i, r.v) for r in out.collect()), key=repr) == sorted(
            ((k, i, {"a": 10, None: 30}.get(k)) for k in ("a", "b", None) for i in range(3)), key=repr
        )
        assert out.columns == ["s", "k", "i", "v"]
        assert "Join [_hash#" in out._jdf.queryExecution().executedPlan().toString()
    assert "_hash" not in attach(df, side, ["s", "k"])._jdf.queryExecution().toString()


def test_keys_of_two_kinds_are_not_hashed(spark):
    df = spark.range(3).withColumn("k", F.col("id").cast("int"))
    side = spark.range(3).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    out = attach(df, side, ["k"], "left", Limits(broadcast_bytes=0))
    assert {(r.id, r.v) for r in out.collect()} == {(0, 0), (1, 2), (2, 4)}
