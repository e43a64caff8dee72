"""Three rounds run through every step on files, the last one before its race."""

from __future__ import annotations

import glob
import json
import random

import pytest
from pyspark.sql import functions as F

from gridcast.params import Params
from gridcast.plans import pipeline
from gridcast.plans.pipeline import Paths
from gridcast.schemas import GOLD, PACE, PREDICTIONS
from gridcast.sinks import tables

LAP_SCHEMA = (
    "Driver string, DriverNumber string, Team string, LapNumber double, LapTime string, "
    "Sector1Time string, Sector2Time string, Sector3Time string, Compound string, "
    "TyreLife double, FreshTyre boolean, session string, session_name string"
)
NAMES = {"R": "Race", "Q": "Qualifying", "FP1": "Practice 1", "SQ": "Sprint Shootout"}


def raw_laps(spark, round_number, sessions):
    rng = random.Random(round_number)
    rows = []
    for session in sessions:
        for d in range(5):
            for n in range(12):
                time = 80 + d / 2 + rng.randrange(200) / 100
                text = "NaT" if n == 11 else f"0 days 00:01:{time - 60:09.6f}"
                rows.append(
                    (f"D{d}", str(d), f"T{d // 2}", float(n + 1), text, "00:00:25.1",
                     f"00:00:{30 + d / 2}", "00:00:26.5", ["soft", "HARD", None][n % 3], float(n), n < 3, session, NAMES[session])
                )
    return spark.createDataFrame(rows, LAP_SCHEMA)


def raw_results(spark):
    rows = [(f"D{d}", f"T{d // 2}", float(d + 1), "25.0") for d in range(5)]
    return spark.createDataFrame(rows, "Abbreviation string, TeamName string, Position double, Points string")


def params(round_number):
    return Params(2026, f"Grand Prix {round_number}", round_number, trees=5, depth=3)


@pytest.fixture(scope="module")
def paths(spark, tmp_path_factory):
    paths = Paths(str(tmp_path_factory.mktemp("season")))
    for r in (1, 2):
        pipeline.run(spark, raw_laps(spark, r, ["FP1", "Q", "SQ", "R"]), raw_results(spark), params(r), paths)
    pipeline.run(spark, raw_laps(spark, 3, ["FP1", "Q"]), None, params(3), paths)
    return paths


def test_tables(spark, paths):
    gold = spark.read.schema(GOLD).parquet(paths.features)
    got = {r.event: (r.n, r.labelled) for r in gold.groupBy("event").agg(
        F.count("*").alias("n"), F.count("race_position").alias("labelled")).collect()}
    # The untimed lap of every driver-session is gone.
    assert got == {"Grand Prix 1": (220, 220), "Grand Prix 2": (220, 220), "Grand Prix 3": (110, 0)}
    assert {r[0] for r in gold.select("session_type").distinct().collect()} == {"FP1", "Q", "SQ", "R"}
    assert {r[0] for r in gold.select("compound").distinct().collect()} == {"SOFT", "HARD", "UNKNOWN"}


def test_predictions(spark, paths):
    rows = spark.read.schema(PREDICTIONS).parquet(paths.predictions).collect()
    versions = {(r.event, r.model_version) for r in rows}
    assert versions == {
        ("Grand Prix 1", "base_r01"), ("Grand Prix 2", "base_r02"), ("Grand Prix 3", "qualifying_r03"),
    }
    last = sorted((r for r in rows if r.round == 3), key=lambda r: r.predicted_position)
    assert [r.predicted_position for r in last] == [1, 2, 3, 4, 5]
    assert sum(r.win_probability for r in last) == pytest.approx(1.0, abs=1e-5)
    shares = [r.win_probability for r in last]
    assert shares == sorted(shares, reverse=True) and all(r.uncertainty >= 0 for r in last)
    assert {r.driver for r in last} == {f"D{d}" for d in range(5)}


def test_document(spark, paths):
    text = "\n".join(r.value for r in spark.read.text(f"{paths.export}/2026/Grand Prix 3/qualifying_r03", wholetext=True).collect())
    doc = json.loads(text)
    assert doc["model_version"] == "qualifying_r03" and doc["sessions_used"] == ["FP1", "Q"]
    assert [h["event"] for h in doc["history"]] == ["Grand Prix 1", "Grand Prix 2"]
    assert doc["season_accuracy"]["races"] == 2
    assert len(doc["predictions"]) == 5 and doc["predictions"][0]["sessions"]["SQ"] is None
    assert doc["predictions"][0]["sessions"]["Q"]["weight"] == 0.7


def test_models_are_kept_per_version(paths):
    names = {p.rsplit("/", 1)[1] for p in glob.glob(f"{paths.models}/*")}
    assert {"base_r01", "base_r02", "qualifying_r03", "lr_baseline_r03"} <= names


def test_a_run_reports_every_check(spark, paths, tmp_path):
    run = pipeline.run(spark, raw_laps(spark, 1, ["Q", "R"]), raw_results(spark), params(1), Paths(str(tmp_path)))
    report = run.report.collect()
    assert {r.step for r in report} == {"silver", "gold"} and all(r.breaches == 0 for r in report)
    assert {r.row_count for r in report} == {110}
    assert len(report) == len(pipeline.silver_checks(params(1))) + len(pipeline.gold_checks()) + 2
    assert {(r.session_type, r.status) for r in run.coverage.collect() if r.laps} == {("Q", "ingested"), ("R", "ingested")}
    assert run.ranked.count() == 5 and run.training.evaluation.count() == 2


def test_bad_gold_never_replaces_good_gold(spark, paths):
    p, where = params(2), {"season": 2026, "event": "Grand Prix 2"}
    stored = spark.read.schema(GOLD).parquet(paths.features)
    good = stored.filter("event = 'Grand Prix 2'")
    before = sorted(map(str, stored.collect()))
    bad = good.withColumn("lap_time_delta", F.when(F.col("driver") == "D1", F.lit(-1.0)).otherwise(F.col("lap_time_delta")))
    with pytest.raises(tables.BreachError) as e:
        pipeline.write_gold(bad, paths.features, where)
    broken = {r.check: r.breaches for r in e.value.report.collect() if r.breaches}
    assert broken == {"no lap beats the driver's best": good.filter("driver = 'D1'").count()}
    assert spark.read.parquet(e.value.aside).select("driver").distinct().collect()[0].driver == "D1"
    assert sorted(map(str, spark.read.schema(GOLD).parquet(paths.features).collect())) == before
    # A lap of another event is refused as well.
    stray = good.withColumn("event", F.lit("Grand Prix 9"))
    with pytest.raises(tables.BreachError, match="outside"):
        pipeline.write_gold(good.unionByName(stray), paths.features, where)
    assert p.round_number == 2


def test_states_are_rebuilt_from_gold(spark, paths):
    stored = spark.read.schema(PACE).parquet(paths.pace)
    before = sorted(map(str, stored.filter("round_number < 3").collect()))
    assert before
    pipeline.rebuild_pace(spark, paths)
    assert sorted(map(str, spark.read.schema(PACE).parquet(paths.pace).collect())) == before


def test_a_step_can_run_again(spark, paths):
    p = params(3)
    before = sorted(map(str, spark.read.parquet(paths.features).collect()))
    pipeline.clean_event(spark, p, paths)
    pipeline.build_features(spark, p, paths)
    assert sorted(map(str, spark.read.parquet(paths.features).collect())) == before


def test_nothing_to_predict(spark, paths):
    p = Params(2026, "Nowhere", 3)
    with pytest.raises(ValueError, match="no features"):
        pipeline.predict(spark, p, paths)
    with pytest.raises(FileNotFoundError):
        pipeline.predict(spark, Params(2026, "Nowhere", 9), paths)
    with pytest.raises(AttributeError):
        paths.unknown
