from __future__ import annotations

import random

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gridcast.operators import model, trees
from gridcast.params import Limits
from tests.test_model import P, SCHEMA, rows


@pytest.fixture(scope="module")
def frame(spark):
    gold = spark.createDataFrame(rows(), SCHEMA).withColumn("row_key", F.monotonically_increasing_id())
    return model.training_frame(gold, P).cache()


@pytest.fixture(scope="module")
def saved(spark, frame, tmp_path_factory):
    fitted = model.fit(frame, P, evaluate=False)
    return fitted, model.save_model(fitted, str(tmp_path_factory.mktemp("models")), "base_r03")


def inputs_of(fitted, df):
    """The compound's number as a column next to the numeric inputs."""
    return fitted.model.stages[0].transform(df)


@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_bytes=0)])
def test_walk_gives_the_models_probabilities(spark, frame, saved, limits):
    fitted, path = saved
    nodes = trees.saved_nodes(spark, path)
    # An unseen compound goes where its category goes.
    df = inputs_of(fitted, frame.withColumn("compound", F.when(F.col("row_key") % 7 == 0, "WET").otherwise(F.col("compound"))))
    walked = trees.walk(df.select("row_key", *model.INPUTS), nodes, model.INPUTS, P.depth, limits)
    shares = trees.class_shares(walked, nodes, ["row_key"], len(fitted.labels), limits)
    got = {r.row_key: r.probability for r in shares.collect()}
    own = fitted.model.stages[2].transform(fitted.model.stages[1].transform(df))
    want = own.select("row_key", vector_to_array("probability").alias("p"), "prediction").collect()
    assert len(got) == len(want) == 300
    for r in want:
        assert got[r.row_key] == pytest.approx(r.p, abs=1e-9)
        assert max(range(len(r.p)), key=lambda k: r.p[k]) == r.prediction


def test_importances_are_the_models(spark, saved):
    fitted, path = saved
    got = {r.feature: r.importance for r in trees.importances(trees.saved_nodes(spark, path), model.INPUTS).collect()}
    want = fitted.model.stages[-1].featureImportances.toArray()
    assert [got[n] for n in model.INPUTS] == pytest.approx(want.tolist(), abs=1e-9)
    assert len(got) == len(model.INPUTS)


def _few_values(spark):
    rng = random.Random(4)
    data = []
    for i in range(400):
        a, b = rng.randrange(8), rng.randrange(5)
        label = 0 if a < 3 else (1 if b < 2 else 2)
        data.append((i, float(a), float(b), float(label if rng.random() < 0.9 else rng.randrange(3)), rng.choice([0.25, 1.0, 2.0])))
    return spark.createDataFrame(data, "row_key long, a double, b double, label double, w double")


def test_splits_are_those_of_the_library(spark):
    """One tree without bootstrap, on inputs with few values: midpoints are tried by both."""
    df = _few_values(spark)
    forest = RandomForestClassifier(numTrees=1, maxDepth=2, seed=1, weightCol="w", bootstrap=False,
                                    subsamplingRate=1.0, featureSubsetStrategy="all")
    fitted = forest.fit(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df))
    text = fitted.trees[0].toDebugString
    cuts = {"a": [k + 0.5 for k in range(7)], "b": [k + 0.5 for k in range(4)]}
    at = df.withColumn("node", F.lit(0)).withColumn("label", F.col("label").cast("int"))
    root = trees.best_splits(trees.histogram(at, cuts, "label", "w"), cuts).first()
    assert f"If (feature {root.feature} <= {root.threshold})" in text.split("\n")[1]
    name = list(cuts)[root.feature]
    below = at.withColumn("node", F.when(F.col(name) <= root.threshold, 1).otherwise(2))
    children = {r.node: r for r in trees.best_splits(trees.histogram(below, cuts, "label", "w"), cuts).collect()}
    # The library merges the left child's leaves again: both predict the same class.
    assert f"(feature {children[2].feature} <= {children[2].threshold})" in text
    assert root.gain == pytest.approx(fitted.trees[0]._java_obj.rootNode().gain(), abs=1e-8)


def test_a_grown_tree_is_a_node_table(spark):
    df = _few_values(spark).cache()
    nodes = trees.grow(df, ["a", "b"], 3, 2, weight="w")
    assert nodes.count() == 7 and {r.node for r in nodes.filter("feature is null").collect()} == {3, 4, 5, 6}
    root = nodes.filter("node = 0").first()
    assert sum(root.stats) == pytest.approx(df.agg(F.sum("w")).first()[0])
    walked = trees.walk(df, nodes, ["a", "b"], 2)
    shares = trees.class_shares(walked, nodes, ["row_key", "label"], 3)
    hits = shares.agg(F.avg((trees.likeliest(F.col("probability")) == F.col("label")).cast("double"))).first()[0]
    assert hits > 0.8
    per_leaf = {r.node: r.n for r in walked.groupBy("node").agg(F.sum("w").alias("n")).collect()}
    assert per_leaf == pytest.approx({r.node: sum(r.stats) for r in nodes.filter("feature is null").collect()})


def test_bins_count_the_cuts_passed(spark):
    """At cuts, between them and at odd values."""
    cuts = {"a": [-1.0, 0.0, 2.5], "b": [], "c": [k / 4 for k in range(31)]}
    odd = [-0.0, 0.0, -1.0, 2.5, 2.500001, float("inf"), -float("inf"), float("nan"), 1e-9]
    rows = [(k, x, x, x) for k, x in enumerate(odd)]
    got = trees.binned(spark.createDataFrame(rows, "k int, a double, b double, c double"), cuts).collect()
    for r in got:
        assert r.bins == [sum(r.a != r.a or r.a > t for t in cuts[c]) for c in cuts]


def test_growing_reads_the_rows_twice(spark):
    """Once for the cuts and once for the bins, however many levels there are."""
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = _few_values(spark)
    counted = df.mapInArrow(seen, df.schema)
    nodes = trees.grow(counted, ["a", "b"], 3, 3, weight="w").collect()
    assert max(r.node for r in nodes) > 6
    assert read.value <= 2 * 400


def test_trees_that_cannot_split(spark):
    df = spark.createDataFrame([(k, 1.0, float(k % 2), 1.0) for k in range(6)], "row_key int, a double, label double, w double")
    nodes = trees.grow(df, ["a"], 2, 3, weight="w").collect()
    assert [(r.node, r.feature, r.stats) for r in nodes] == [(0, None, [3.0, 3.0])]
    got = trees.importances(trees.grow(df, ["a"], 2, 3, weight="w"), ["a", "b"]).collect()
    assert {r.feature: r.importance for r in got} == {"a": 0.0, "b": 0.0}


def test_gradient_is_nothing_at_the_fitted_coefficients(spark, frame):
    fitted = model.fit(frame, P, "logistic", evaluate=False)
    df = inputs_of(fitted, model.index_labels(frame).transform(frame))
    scored = fitted.model.stages[2].transform(fitted.model.stages[1].transform(df)).withColumn("probability", vector_to_array("probability"))
    loss = {r["class"]: r for r in model.logistic_gradient(scored, model.INPUTS).collect()}
    price = {r["class"]: r for r in model.penalty_gradient(spark, fitted, scored, model.INPUTS).collect()}
    assert set(loss) == set(price) == set(range(4))
    far = max(abs(loss[k][c]) for k in loss for c in model.INPUTS)
    for k in loss:
        assert abs(loss[k].intercept) < 1e-3
        for c in model.INPUTS:
            assert abs(loss[k][c] + price[k][c]) < 1e-2, (k, c, far)


def test_holdout_rows(spark):
    df = spark.createDataFrame([("a", "1", 1), ("b", "4", 2), ("c", "9", None), ("d", "2", 5)], "driver string, position string, pred_pos_lap int")
    got = [tuple(r) for r in model.holdout_rows(df, "driver").collect()]
    assert got == [("a", 1, 1, 0, True, True), ("b", 4, 2, 2, False, True), ("c", 9, None, None, None, None), ("d", 2, 5, 3, False, False)]


def test_win_slot_of_an_array(spark):
    df = spark.createDataFrame([([0.2, 0.7, 0.1],)], "probability array<double>")
    assert model.win_probability(df, ("3", "1", "2")).first().win_prob_lap == 0.7
    numbers = spark.createDataFrame([(0.0,), (2.0,), (3.0,), (None,)], "prediction double")
    assert [r[0] for r in numbers.select(model.position_of(F.col("prediction"), ("3", "1", "2"))).collect()] == [3, 2, None, None]
