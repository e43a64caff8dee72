from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

from gridcast.operators import features
from gridcast.params import Params
from gridcast.schemas import GOLD

P = Params(2026, "GP7", 7)
SCHEMA = (
    "driver string, team string, season int, event string, round_number int, "
    "session_type string, lap_number int, LapTime double, Sector1Time double, "
    "Sector2Time double, Sector3Time double, compound string, TyreLife double"
)


def lap(driver, time, team="A", round_number=7, session="R", compound="SOFT", life=1.0,
        sectors=(25.0, 30.0, 25.0), number=1):
    return (driver, team, 2026, f"GP{round_number}", round_number, session, number, time,
            *sectors, compound, life)


ROWS = [
    lap("VER", 80.0, life=1.0, sectors=(25.5, 30.0, 24.0)),
    lap("VER", 81.0, life=5.0, sectors=(25.0, 31.0, 24.5)),
    lap("VER", 82.5, life=2.0, compound="HARD"),
    lap("HAM", 80.5, sectors=(25.0, None, 24.0)),
    lap("LEC", 79.0, team="B", life=None),
    lap("LEC", 79.5, team="B", life=None),
    lap("LEC", 90.0, team="B", session="Q"),
]


@pytest.fixture
def laps(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def by_lap(df, column):
    return {(r.driver, r.LapTime): r[column] for r in df.collect()}


def test_lap_time_delta_is_to_own_best(laps):
    got = by_lap(features.lap_time_delta(laps), "lap_time_delta")
    assert got[("VER", 82.5)] == 2.5 and got[("HAM", 80.5)] == 0.0 and got[("LEC", 90.0)] == 0.0


def test_consistency_of_one_lap_is_null(laps):
    got = by_lap(features.consistency_score(laps), "consistency_score")
    assert got[("VER", 80.0)] == pytest.approx(statistics.stdev([80.0, 81.0, 82.5]))
    assert got[("HAM", 80.5)] is None


def test_sector_combo_needs_all_sectors(laps):
    got = by_lap(features.best_sector_combo(laps), "best_sector_combo")
    assert got[("VER", 80.0)] == 25.0 + 30.0 + 24.0
    assert got[("HAM", 80.5)] is None


def test_tyre_degradation(laps):
    got = by_lap(features.tyre_deg_rate(laps), "tyre_deg_rate")
    assert got[("VER", 80.0)] == (81.0 - 80.0) / (5.0 - 1.0)
    assert got[("VER", 82.5)] == 0.0  # one lap on that compound
    assert got[("LEC", 79.0)] == 0.0  # tyre life never recorded


def test_pace_vs_teammate(laps):
    got = by_lap(features.pace_vs_teammate(laps), "pace_vs_teammate")
    assert got[("HAM", 80.5)] == 0.5 and got[("VER", 82.5)] == 0.0
    assert got[("LEC", 79.0)] == 0.0  # no teammate


def trend_laps(per_round):
    """Two race laps per round, the second ``delta`` slower than the first."""
    return [
        row
        for driver, deltas in per_round.items()
        for r, delta in deltas.items()
        for row in (lap(driver, 80.0, round_number=r), lap(driver, 80.0 + 2 * delta, round_number=r))
    ]


TRENDS = {
    "VER": {1: 1.0, 2: 2.0, 3: 3.0, 4: 4.0, 5: 1.0, 6: 2.0},
    "HAM": {5: 1.0, 6: 1.0},
    "LEC": {1: 1.0, 2: 1.0},
    "NOR": {4: 3.0, 6: 1.0},
}


def test_pace_trend(spark):
    laps = spark.createDataFrame(trend_laps(TRENDS), SCHEMA)
    gold = features.lap_time_delta(laps)
    got = {r.driver: r.pace_trend for r in features.pace_trend(gold, 2026, 7).collect()}
    # No baseline: NULL. No recent race: no row.
    assert got == {"VER": 1.5 - 2.5, "HAM": None, "NOR": -2.0}
    joined = features.join_pace_trend(gold, features.pace_trend(gold, 2026, 7))
    assert joined.count() == gold.count()
    assert {r.pace_trend for r in joined.filter("driver = 'LEC'").collect()} == {None}


def test_trend_of_every_round_equals_the_single_event_one(spark):
    rows = trend_laps(TRENDS) + [lap(d, 80.0, round_number=7, session="FP1") for d in TRENDS]
    laps = spark.createDataFrame(rows, SCHEMA)
    whole = features.gold(laps, P)
    for target in range(2, 8):
        one = features.pace_trend(features.lap_time_delta(laps), 2026, target)
        want = {r.driver: r.pace_trend for r in one.collect()}
        got = whole.filter(F.col("round_number") == target).select("driver", "pace_trend")
        for r in got.distinct().collect():
            assert r.pace_trend == pytest.approx(want.get(r.driver)), (target, r)


def test_gold_equals_the_single_operators(laps):
    single = laps
    for f in (
        features.lap_time_delta,
        features.consistency_score,
        features.best_sector_combo,
        features.tyre_deg_rate,
        features.pace_vs_teammate,
    ):
        single = f(single)
    cols = ["driver", "session_type", "compound", "lap_time_delta", "consistency_score",
            "best_sector_combo", "tyre_deg_rate", "pace_vs_teammate"]

    def rounded(df):
        floats = cols[3:]
        picked = df.select(*cols[:3], *[F.round(c, 9).alias(c) for c in floats])
        return sorted(map(str, picked.collect()))

    assert rounded(features.gold(laps, P)) == rounded(single)


def test_gold_shape_and_label(spark, laps):
    positions = spark.createDataFrame(
        [(2026, "GP7", "VER", 1), (2026, "GP6", "HAM", 2)],
        "season int, event string, driver string, race_position int",
    )
    gold = features.gold(laps, P, positions)
    assert gold.columns == GOLD.fieldNames()
    assert gold.count() == len(ROWS)
    got = {(r.driver, r.race_position) for r in gold.collect()}
    assert got == {("VER", 1), ("HAM", None), ("LEC", None)}


def test_gold_tags_the_round_and_takes_trend_from_prior(spark, laps):
    prior = features.lap_time_delta(spark.createDataFrame(trend_laps(TRENDS), SCHEMA))
    gold = features.gold(laps.drop("round_number"), P, prior=prior)
    got = {r.driver: (r.round_number, r.pace_trend) for r in gold.collect()}
    assert got == {"VER": (7, -1.0), "HAM": (7, None), "LEC": (7, None)}


def test_invariants(laps):
    gold = features.gold(laps, P)
    assert gold.filter("lap_time_delta < 0 or pace_vs_teammate < 0 or tyre_deg_rate < 0").isEmpty()
    best = gold.groupBy("event", "session_type", "team").agg(F.min("pace_vs_teammate").alias("m"))
    assert {r.m for r in best.collect()} == {0.0}


def test_trend_from_states_is_the_trend(spark, tmp_path):
    import random

    from gridcast.schemas import PACE
    from gridcast.sinks import tables
    from gridcast.sources import readers

    rng = random.Random(8)
    rows = [
        (2026, r, d, s, None if rng.random() < 0.1 else rng.random())
        for r in range(1, 10) for d in "ABCDE" if (r, d) not in ((5, "A"), (6, "A"), (1, "B")) for s in "RRQ" for _ in range(4)
    ]
    gold = spark.createDataFrame(rows, "season int, round_number int, driver string, session_type string, lap_time_delta double")
    path = str(tmp_path / "pace")
    for r in range(1, 10):
        state = features.pace_state(gold.filter(F.col("round_number") == r))
        tables.replace_partitions(state, path, {"season": 2026, "round_number": r})
    states = readers.read_table(spark, path, PACE)
    for r in range(1, 11):
        want = {x.driver: x.pace_trend for x in features.pace_trend(gold, 2026, r).collect()}
        trend = features.trend_from_state(states, 2026, r)
        got = {x.driver: x.pace_trend for x in trend.collect()}
        assert got.keys() == want.keys()
        assert all(got[d] == (pytest.approx(want[d]) if want[d] is not None else None) for d in got)
    text = features.trend_from_state(states, 2026, 7)._jdf.queryExecution().executedPlan().toString()
    # Six folders of states are all that is read.
    assert text.count("FileScan") == 1 and "pace" in text
    assert "round_number" in text.split("PartitionFilters: [")[1].split("]")[0]
