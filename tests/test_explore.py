from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from gridcast.operators import explore, weights
from gridcast.params import SESSION_WEIGHTS, Params
from gridcast.schemas import FEATURES

P = Params(2026, "GP", 3)


def test_weights(spark):
    df = spark.createDataFrame(
        [(1, "R"), (3, "Q"), (3, "X"), (2, None)], "round_number int, session_type string"
    )
    out = {(r.round_number, r.session_type): r for r in weights.sample_weight(df, P).collect()}
    assert out[(1, "R")].recency_weight == pytest.approx(math.exp(-0.3))
    assert out[(3, "Q")].recency_weight == 1.0
    assert out[(3, "Q")].sample_weight == 0.7
    assert out[(3, "X")].session_weight is None and out[(2, None)].sample_weight is None
    assert weights.sample_weight(df, P, "drop").count() == 2
    with pytest.raises(Exception, match="no weight for session"):
        weights.sample_weight(df, P, "fail").collect()
    with pytest.raises(ValueError):
        weights.sample_weight(df, P, "other")


def test_every_session_has_a_weight(spark):
    df = spark.createDataFrame([(s,) for s in P.session_types], "session_type string")
    got = {r.session_type: r.session_weight for r in weights.session_weight(df).collect()}
    assert got == dict(SESSION_WEIGHTS)


def test_correlation_guards(spark):
    rng = random.Random(5)
    rows = [(float(i), float(i) * 2 + rng.random(), 4.0, None, float(i) if i % 3 else None, i % 7) for i in range(40)]
    df = spark.createDataFrame(rows, "a double, b double, const double, nothing double, gaps double, y int")
    out = {r.feature: r for r in explore.feature_corr(df, ["a", "b", "const", "nothing", "gaps"], "y").collect()}
    y = [r[5] for r in rows]
    assert out["a"].r == pytest.approx(statistics.correlation([r[0] for r in rows], y))
    pairs = [(r[4], r[5]) for r in rows if r[4] is not None]
    assert out["gaps"].r == pytest.approx(statistics.correlation(*zip(*pairs)))
    assert out["const"].r is None and out["nothing"].r is None and out["const"].direction is None
    assert out["a"].direction == "worse position"
    assert {r.n for r in out.values()} == {40}


def test_correlation_skips_small_groups(spark):
    rows = [("R", float(i), i) for i in range(10)] + [("Q", float(i), i) for i in range(9)]
    df = spark.createDataFrame(rows, "s string, a double, y int")
    out = explore.feature_corr(df, ["a"], "y", by=["s"], min_n=10).collect()
    assert [(r.s, r.feature, r.n) for r in out] == [("R", "a", 10)]
    assert out[0].r == pytest.approx(1.0)


def test_summary_approx_and_exact(spark):
    rng = random.Random(9)
    rows = [(rng.gauss(5, 2), None if i % 4 else 1.0) for i in range(501)]
    df = spark.createDataFrame(rows, "a double, b double")
    exact = {r.feature: r for r in explore.feature_summary(df, ["a", "b"], exact=True).collect()}
    sketch = {r.feature: r for r in explore.feature_summary(df, ["a", "b"]).collect()}
    values = [r[0] for r in rows]
    quartiles = statistics.quantiles(values, n=4, method="inclusive")
    for r in (exact["a"], sketch["a"]):
        assert (r.n, r.min, r.max) == (501, min(values), max(values))
        assert r.mean == pytest.approx(statistics.mean(values))
        assert r.stddev == pytest.approx(statistics.stdev(values))
    assert (exact["a"].p25, exact["a"].p75) == pytest.approx((quartiles[0], quartiles[2]))
    assert sketch["a"].p25 == pytest.approx(quartiles[0], abs=0.1)
    assert exact["b"].n == 126 and exact["b"].p25 == 1.0
    nothing = explore.feature_summary(df.filter(F.lit(False)), ["a"], exact=True).first()
    assert (nothing.n, nothing.mean, nothing.p25) == (0, None, None)


def test_reports_on_an_empty_event(spark):
    cols = ", ".join(f"{c} double" for c in FEATURES)
    empty = spark.createDataFrame([], f"driver string, team string, session_type string, race_position int, {cols}")
    for report in (explore.driver_leaders, explore.race_leaders, explore.teammate_gap, explore.trend_leaders):
        assert report(empty).isEmpty()


def test_top_n_is_a_total_order(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.5), ("d", 9.0)], "k string, v double")
    assert [r.k for r in explore.top_n(df, [F.col("v"), F.col("k")], 3).collect()] == ["c", "a", "b"]


def test_states_of_rounds_merge_to_the_summary(spark):
    rng = random.Random(3)
    rows = [(k % 4, rng.gauss(80, 2), None if k % 3 else rng.random()) for k in range(4000)] + [(9, None, None)]
    df = spark.createDataFrame(rows, "round int, a double, b double")
    states = explore.summary_state(df, ["round"], ["a", "b"])
    assert states.count() == 10
    merged = explore.summary_of_states(states)
    exact = {r.feature: r for r in explore.feature_summary(df, ["a", "b"], exact=True).collect()}
    for r in merged.collect():
        want = exact[r.feature]
        assert (r.n, r.min, r.max) == (want.n, want.min, want.max)
        assert (r.mean, r.stddev) == pytest.approx((want.mean, want.stddev))
    for r in explore.rank_errors(df, merged, ["a", "b"]).collect():
        assert max(r.p25_off, r.p75_off) <= explore.RANK_ERROR
    # In any grouping: of two rounds merged first, and of a round alone.
    half = explore.summary_of_states(states.withColumn("half", F.col("round") % 2), ["half"]).count()
    assert half == 4
    alone = {r.feature: r for r in explore.summary_of_states(states.filter("round = 9")).collect()}
    assert (alone["a"].n, alone["a"].mean, alone["a"].stddev, alone["a"].p25) == (0, None, None, None)


def test_rank_errors_see_a_wrong_quartile(spark):
    df = spark.createDataFrame([(float(k),) for k in range(100)], "a double")
    wrong = spark.createDataFrame([("a", 40.0, 74.0)], "feature string, p25 double, p75 double")
    got = explore.rank_errors(df, wrong, ["a"]).first()
    assert got.p25_off == pytest.approx(0.15) and got.p75_off == 0.0
