from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridcast.operators import clean, quality
from gridcast.params import Params

P = Params(2026, "GP", 2)
SCHEMA = (
    "Driver string, Team string, LapNumber string, LapTime double, Compound string, "
    "session_type string, season int, event string"
)


def lap(driver="VER", team="A", number="1", time=80.0, compound="SOFT", session="R"):
    return (driver, team, number, time, compound, session, 2026, "GP")


@pytest.fixture
def laps(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SCHEMA)


def test_null_and_nan_laps_go(laps):
    df = laps(lap(), lap(time=None), lap(time=float("nan")), lap(driver=None), lap(team=None))
    assert clean.drop_critical_nulls(df).count() == 1


def test_unreadable_lap_number_is_null(laps):
    out = clean.cast_lap_number(laps(lap(number="12"), lap(number="out lap"))).collect()
    assert [r.LapNumber for r in out] == [12, None]


def test_compounds(laps):
    df = laps(*[lap(compound=c) for c in ("soft", None, "HYPERSOFT", "Wet", "INTERMEDIATE")])
    plain = [r.Compound for r in clean.normalise_compound(df).collect()]
    assert plain == ["SOFT", "UNKNOWN", "UNKNOWN", "WET", "UNKNOWN"]
    aliased = clean.normalise_compound(df, aliases={"INTERMEDIATE": "INTER"}).collect()
    assert aliased[-1].Compound == "INTER" and aliased[1].Compound == "UNKNOWN"


def test_outlier_limit_is_inclusive_and_per_session(laps):
    df = laps(
        lap(time=100.0), lap(time=100.0 * 1.07), lap(time=107.01), lap(time=200.0, session="Q"),
        lap(time=None),
    )
    kept = clean.filter_outlier_laps(df)
    assert sorted(r.LapTime for r in kept.collect()) == [100.0, 100.0 * 1.07, 200.0]
    assert kept.columns == df.columns
    assert quality.breach_count(kept).first().breaches == 0
    assert quality.breach_count(df).first().breaches == 1


def test_row_loss_adds_up(laps):
    df = laps(lap(time=100.0), lap(time=150.0), lap(time=None), lap(time=float("nan")), lap())
    loss = quality.row_loss(df, P).first()
    assert tuple(loss) == (5, 2, 2, 1, 80.0)
    silver = clean.silver(df, P)
    assert silver.count() == loss.silver_rows


def test_row_loss_of_nothing(laps):
    assert tuple(quality.row_loss(laps(), P).first()) == (0, 0, 0, 0, None)


def test_null_audits(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, None)], "a int, b string")
    assert tuple(quality.null_counts(df, ["a", "b"]).first()) == (1, 3)
    assert tuple(quality.null_rates(df, ["a", "b"]).first()) == (33.3, 100.0)
    assert tuple(quality.null_rates(df.filter(F.lit(False)), ["a"]).first()) == (None,)
