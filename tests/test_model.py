from __future__ import annotations

import random
import shutil

import pytest
from pyspark.sql import functions as F

from gridcast.operators import model
from gridcast.params import Limits, Params
from gridcast.schemas import FEATURES

P = Params(2026, "GP3", 3, trees=5, depth=3)
SCHEMA = (
    "season int, event string, round_number int, session_type string, driver string, "
    "compound string, " + ", ".join(f"{c} double" for c in FEATURES) + ", race_position int"
)


def rows(rounds=(1, 2, 3), drivers=4, laps=25):
    rng = random.Random(1)
    return [
        (2026, f"GP{r}", r, "RQ"[i % 2], f"D{d}", rng.choice(["SOFT", "HARD"]),
         d + rng.random() / 4, rng.random(), 80.0 + d, None, float("nan"), rng.random(), d + 1)
        for r in rounds for d in range(drivers) for i in range(laps)
    ]


@pytest.fixture(scope="module")
def gold(spark):
    return spark.createDataFrame(rows(), SCHEMA).cache()


@pytest.fixture(scope="module")
def fitted(gold):
    return model.fit(model.training_frame(gold, P), P)


def test_imputation_removes_null_and_nan(gold):
    out = model.impute_numeric(gold)
    bad = [F.count_if(F.col(c).isNull() | F.isnan(c)).alias(c) for c in FEATURES]
    assert set(out.agg(*bad).first()) == {0}
    assert {r.tyre_deg_rate for r in out.select("tyre_deg_rate").distinct().collect()} == {0.0}


def test_labels_and_versions(spark, gold):
    mixed = gold.withColumn("race_position", F.when(F.col("round_number") < 3, F.col("race_position")))
    assert model.labelled(mixed).count() == 200 and model.unlabelled(mixed).count() == 100
    assert model.impute_label(mixed).filter("race_position = -1").count() == 100
    got = {r.round_number: r.model_version for r in model.model_version(mixed).collect()}
    assert got == {1: "base_r01", 2: "base_r02", 3: "qualifying_r03"}
    assert model.version_of(mixed, P) == "qualifying_r03" and model.version_of(gold, P) == "base_r03"


def test_temporal_split(gold):
    out = model.temporal_split(gold).groupBy("split", "round_number").count().collect()
    assert {(r.split, r.round_number) for r in out} == {("fit", 1), ("fit", 2), ("holdout", 3)}


def test_forest_learns_and_scores(gold, fitted):
    evaluation = model.evaluation(fitted, "forest").first()
    assert (evaluation.holdout_rows, evaluation.leaked) == (100, False)
    assert evaluation.exact_accuracy > 0.9 and evaluation.within_2_accuracy >= evaluation.exact_accuracy
    # Scoring needs no label column at all.
    frame = model.impute_numeric(gold.drop("race_position"))
    scored = model.win_probability(model.score(fitted.model, frame, fitted.labels), fitted.labels)
    best = scored.groupBy("driver").agg(F.avg("win_prob_lap").alias("p"), F.mode("pred_pos_lap").alias("w"))
    got = {r.driver: (r.p, r.w) for r in best.collect()}
    assert max(got, key=lambda d: got[d][0]) == "D0"
    assert {d: w for d, (_, w) in got.items()} == {"D0": 1, "D1": 2, "D2": 3, "D3": 4}
    assert scored.filter("win_prob_lap < 0 or win_prob_lap > 1").isEmpty()


def test_unseen_compound_is_scored(spark, gold, fitted):
    new = model.impute_numeric(gold.withColumn("compound", F.lit("WET")))
    assert model.score(fitted.model, new, fitted.labels).filter("pred_pos_lap is null").isEmpty()


def test_win_class_must_exist(gold, fitted):
    scored = model.score(fitted.model, model.impute_numeric(gold), fitted.labels)
    with pytest.raises(ValueError, match="position 1"):
        model.win_probability(scored, ("2", "3"))


def test_baseline_and_small_fit_set(spark):
    few = spark.createDataFrame(rows(rounds=(1, 2), drivers=3, laps=8), SCHEMA)
    train = model.training_frame(few, P)
    evaluation = model.evaluation(model.fit(train, P, "logistic"), "logistic").first()
    assert not evaluation.leaked and evaluation.holdout_rows == 24
    evaluation = model.evaluation(model.fit(train, P, "logistic", leak_below=50), "logistic").first()
    assert evaluation.leaked and evaluation.holdout_rows == 24
    alone = model.fit(model.training_frame(few.filter("round_number = 2"), P), P, "logistic")
    evaluation = model.evaluation(alone, "logistic").first()
    assert alone.holdout is None and tuple(evaluation)[1:] == (0, None, None, False)
    with pytest.raises(ValueError):
        model.build_pipeline("other", P)


def test_importance_covers_all_inputs(spark, fitted):
    table = model.importance_table(spark, fitted.model).collect()
    assert sum(r.importance for r in table) == pytest.approx(1.0)
    assert [r.importance for r in table] == sorted((r.importance for r in table), reverse=True)
    assert {r.feature for r in table if not r.exported} == {"compound_idx"}


def test_save_resolve_load(spark, gold, fitted, tmp_path):
    root = str(tmp_path / "models")
    with pytest.raises(FileNotFoundError):
        model.resolve_model(spark, root, 3)
    first = model.save_model(fitted, root, "base_r03")
    assert model.resolve_model(spark, root, 3) == ("base_r03", first)
    model.save_model(fitted, root, "qualifying_r03")
    again = model.save_model(fitted, root, "qualifying_r03")
    assert model.resolve_model(spark, root, 3) == ("qualifying_r03", again)
    assert [p.name for p in (tmp_path / "models" / "qualifying_r03").iterdir()] == ["000002"]
    # A save that broke off is not found, whatever it has so far.
    half = tmp_path / "models" / "qualifying_r04" / "_half"
    shutil.copytree(again, half)
    with pytest.raises(FileNotFoundError):
        model.resolve_model(spark, root, 4)
    loaded = model.load_model(first)
    assert loaded.labels == fitted.labels
    frame = model.impute_numeric(gold)
    a, b = (model.score(m.model, frame, m.labels).select("probability").collect() for m in (fitted, loaded))
    assert a == b


def test_accuracies(spark):
    df = spark.createDataFrame([(1, 1), (2, 4), (9, 1), (None, 1)], "p int, a int")
    assert model.exact_accuracy(df, "p", "a").first()[0] == pytest.approx(1 / 3)
    assert model.within_k_accuracy(df, "p", "a", 2).first()[0] == pytest.approx(2 / 3)


def test_a_fit_deals_its_rows_out(gold, monkeypatch):
    """A task of a fit gets so many rows, however few tasks the scan has."""
    train = model.training_frame(gold.coalesce(1), P).select("round_number", "driver")
    per_task = model.in_slices(train, Limits(fit_rows=50)).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 300 and max(r["count"] for r in per_task) <= 60
    assert model.in_slices(train, Limits(fit_rows=300)) is train
    dealt = []
    monkeypatch.setattr(model, "in_slices", lambda df, limits: dealt.append(df.columns) or df)
    model.fit(model.training_frame(gold, P), P)
    assert dealt == [[*model.INPUTS, "label", "sample_weight"]] * 2
