from __future__ import annotations

import math
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridcast.functions.columns import keep_in_replicate, row_key
from gridcast.operators import rank
from gridcast.params import Params

P = Params(2026, "GP", 2)
SCHEMA = (
    "season int, event string, driver string, team string, session_type string, "
    "lap_time_delta double, win_prob_lap double, pred_pos_lap int, key long"
)
ROWS = [
    (2026, "GP", f"D{i % 7}", f"T{i % 3}" if i % 7 == 9 else "T", ["R", "Q"][i % 2], i % 5 / 10, ((i * 37) % 101) / 101, i % 4, i * 104729)
    for i in range(200)
]


@pytest.fixture
def scored(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5)


def test_driver_prediction(spark):
    rows = [(2026, "GP", "A", "T", "R", 0.0, p, pos, 0) for p, pos in ((0.1, 3), (0.4, 2), (0.2, 3), (0.3, 2), (0.2, 9))]
    out = rank.driver_prediction(spark.createDataFrame(rows, SCHEMA)).first()
    # Positions 2 and 3 are equally common: the better one.
    assert (out.win_probability, out.common_position, out.lap_count) == (0.4, 2, 5)


def test_shares_sum_to_one_and_zero_total_is_null(spark, scored):
    shares = rank.normalise_share(rank.driver_prediction(scored))
    assert shares.agg(F.sum("win_probability")).first()[0] == pytest.approx(1.0)
    zero = spark.createDataFrame([(2026, "X", "A", 0.0)], "season int, event string, driver string, win_probability double")
    assert rank.normalise_share(zero).first().win_probability is None


def test_equal_probabilities_rank_by_name(spark):
    rows = [(2026, "GP", d, p) for d, p in (("B", 0.4), ("A", 0.4), ("C", 0.9), ("N", None))]
    rows.append((2026, "X", "Z", 0.1))
    df = spark.createDataFrame(rows, "season int, event string, driver string, win_probability double")
    out = {(r.event, r.driver): r.predicted_position for r in rank.rank_drivers(df).collect()}
    assert out == {("GP", "C"): 1, ("GP", "A"): 2, ("GP", "B"): 3, ("GP", "N"): 4, ("X", "Z"): 1}


def brute_uncertainty(b, fraction):
    prime, per_driver = 2147483647, defaultdict(list)
    for rep in range(b):
        best = {}
        for r in ROWS:
            m = (r[8] + rep * 15485863) % prime
            if (m * m) % prime % 1000 < fraction * 1000:
                best[r[2]] = max(best.get(r[2], 0.0), r[6])
        total = sum(best.values())
        for driver, p in best.items():
            per_driver[driver].append(p / total)
    return {d: statistics.stdev(v) if len(v) > 1 else 0.0 for d, v in per_driver.items()}


@pytest.mark.parametrize(("b", "fraction"), [(20, 0.8), (3, 0.3)])
def test_subsample_uncertainty_matches_brute_force(scored, b, fraction):
    out = rank.subsample_uncertainty(scored, b, fraction, F.col("key"))
    got = {r.driver: r.uncertainty for r in out.collect()}
    want = brute_uncertainty(b, fraction)
    assert got.keys() == want.keys()
    for d in want:
        assert got[d] == pytest.approx(want[d], abs=1e-12)


def test_uncertainty_edges(spark, scored):
    never = rank.subsample_uncertainty(scored, 4, 0.0, F.col("key"))
    assert {r.uncertainty for r in never.collect()} == {0.0}
    once = rank.subsample_uncertainty(scored, 1, 1.0, F.col("key"))
    assert {r.uncertainty for r in once.collect()} == {0.0}
    zero = scored.withColumn("win_prob_lap", F.lit(0.0))
    assert {r.uncertainty for r in rank.subsample_uncertainty(zero, 4, 0.8, F.col("key")).collect()} == {0.0}


def test_draws_do_not_depend_on_partitioning_and_hit_the_fraction(spark):
    df = spark.range(20_000).withColumn("key", row_key("id"))
    counts = []
    for rep in (0, 1):
        kept = [df.repartition(n).filter(keep_in_replicate(F.col("key"), rep, 0.8)) for n in (2, 9)]
        first, second = ({r.id for r in k.collect()} for k in kept)
        assert first == second
        counts.append(first)
    assert all(abs(len(c) / 20_000 - 0.8) < 0.02 for c in counts)
    assert abs(len(counts[0] & counts[1]) / 20_000 - 0.64) < 0.02


def test_missing_uncertainty_is_zero(spark):
    df = spark.createDataFrame([(2026, "GP", "A", 0.5)], "season int, event string, driver string, win_probability double")
    none = spark.createDataFrame([], "season int, event string, driver string, uncertainty double")
    assert rank.join_uncertainty(df, none).first().uncertainty == 0.0


def test_session_scores(scored):
    out = {r.driver: r for r in rank.session_scores(scored, P).collect()}
    want = [r[5] for r in ROWS if r[2] == "D0" and r[4] == "Q"]
    assert out["D0"].score_Q == pytest.approx(sum(want) / len(want))
    assert out["D0"].score_FP1 is None and "score_R" not in out["D0"].asDict()


def test_history(spark):
    predictions = spark.createDataFrame(
        [
            (2026, "A", 1, "RUS", "base_r01", 1), (2026, "A", 1, "VER", "base_r01", 2),
            (2026, "B", 2, "RUS", "base_r02", 1), (2026, "B", 2, "HAM", "base_r02", 3),
            (2026, "B", 2, "HAM", "qualifying_r02", 1), (2026, "C", 3, "RUS", "base_r03", 1),
            (2025, "A", 1, "OLD", "base_r01", 1), (2026, "B", 2, "FOUR", "base_r02", 4),
        ],
        "season int, event string, round int, driver string, model_version string, predicted_position int",
    )
    gold = spark.createDataFrame(
        [(2026, "A", "RUS", "R", 1)] * 3 + [(2026, "B", "HAM", "R", 1), (2026, "B", "RUS", "Q", 1), (2026, "C", "RUS", "R", None)],
        "season int, event string, driver string, session_type string, race_position int",
    )
    history = rank.winner_history(predictions, gold, 2026)
    assert [tuple(r)[1:] for r in history.collect()] == [
        ("A", 1, "RUS", "RUS", True, True),
        ("B", 2, "RUS", "HAM", False, True),
    ]
    assert tuple(rank.season_accuracy(history).first()) == (0.5, 2)
    assert tuple(rank.season_accuracy(history.filter("round > 5")).first()) == (0.0, 0)


def test_top3_bands_and_small_tables(spark):
    df = spark.createDataFrame([(2026, "GP", f"D{i}", i / 10) for i in range(5)], "season int, event string, driver string, win_probability double")
    top = rank.top3_summary(df).orderBy("place").collect()
    assert [(r.label, r.driver) for r in top] == [("P1", "D4"), ("P2", "D3"), ("P3", "D2")]
    bands = spark.createDataFrame([(0.049,), (0.05,), (0.15,)], "uncertainty double")
    assert [r.band for r in rank.uncertainty_band(bands).collect()] == ["LOW", "MED", "HIGH"]
    rounds = spark.createDataFrame([(2026, 1), (2026, 4), (2026, 4)], "season int, round_number int")
    decay = {r.rounds_ago: r.decay for r in rank.recency_table(rounds, 0.15).collect()}
    assert decay == {0: 1.0, 3: pytest.approx(math.exp(-0.45))}
    importance = spark.createDataFrame([("a", 0.5), ("b", 0.25), ("c", 0.0)], "feature string, importance double")
    assert [r.relative for r in rank.relative_importance(importance).collect()] == [1.0, 0.5, 0.01]
