"""Decision trees as tables: growing, walking and weighing them with joins and aggregations.

A forest is a node table with one row per node of a tree: the input it splits on and the
threshold up to which a row goes left (or the categories that go left), its children, the gain
of the split, and the weight of each class among its training rows. :func:`saved_nodes` reads it
from a saved model without loading the model; :func:`grow` makes one by histogram splits. Rows
are walked down it by one join per level, so that scoring is a plan like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.functions.columns import nudged_round
from gridcast.operators.sizing import attach, exact_quantiles
from gridcast.params import LIMITS, Limits
from gridcast.store import land

NODES = (
    "tree int, node int, feature int, threshold double, categories array<double>, "
    "left int, right int, gain double, stats array<double>"
)


def saved_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The node table of the forest in a saved pipeline; the table it was saved as, renamed."""
    files = f"{path.rstrip('/')}/stages/*_RandomForestClassifier_*/data"
    stored = spark.read.schema(
        "treeID int, nodeData struct<id: int, impurityStats: array<double>, gain: double, leftChild: int, "
        "rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
    ).parquet(files)
    inner = F.col("nodeData.leftChild") >= 0
    ordered = F.col("nodeData.split.numCategories") < 0
    split = F.col("nodeData.split.leftCategoriesOrThreshold")
    return stored.select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.when(inner, F.col("nodeData.split.featureIndex")).alias("feature"),
        F.when(inner & ordered, F.get(split, F.lit(0))).alias("threshold"),
        F.when(inner & ~ordered, split).alias("categories"),
        F.when(inner, F.col("nodeData.leftChild")).alias("left"),
        F.when(inner, F.col("nodeData.rightChild")).alias("right"),
        F.when(inner, F.col("nodeData.gain")).alias("gain"),
        F.col("nodeData.impurityStats").alias("stats"),
    )


def _goes_left(value: Column) -> Column:
    return F.coalesce(value <= F.col("threshold"), F.array_contains("categories", value))


def walk(
    rows: DataFrame, nodes: DataFrame, inputs: Sequence[str], depth: int, limits: Limits = LIMITS
) -> DataFrame:
    """Each row once per tree, with the ``node`` of it that the row ends in.

    One join per level with the nodes' short table, which is broadcast up to the limit; rows are
    neither shuffled nor repeated beyond the number of trees. NULL inputs must be imputed before.
    """
    steps = land(nodes.select("tree", "node", "feature", "threshold", "categories", "left", "right"), "steps")
    size = steps.agg(F.count(F.lit(1)), F.max("tree")).first()
    # 9 numbers a node at most, and its categories.
    at_most = 128 * size[0]
    out = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(size[1])))).withColumn("node", F.lit(0))
    values = F.array(*[F.col(c).cast("double") for c in inputs])
    for _ in range(depth):
        met = attach(out, steps, ["tree", "node"], "left", limits, at_most=at_most)
        step = F.when(_goes_left(F.get(values, F.col("feature"))), F.col("left")).otherwise(F.col("right"))
        out = met.withColumn("node", F.when(F.col("feature").isNull(), F.col("node")).otherwise(step)).select(out.columns)
    return out


def class_shares(
    walked: DataFrame, nodes: DataFrame, keys: Sequence[str], classes: int, limits: Limits = LIMITS
) -> DataFrame:
    """``probability`` per row: the mean over the trees of the class shares where it ended.

    The trees' rows are added up in the task that made them before anything is shuffled.
    """
    total = F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
    shares = nodes.filter("feature is null").select(
        "tree", "node", F.transform("stats", lambda x: F.try_divide(x, total)).alias("shares")
    )
    met = attach(walked, shares, ["tree", "node"], "left", limits)
    sums = [F.sum(F.get("shares", F.lit(k))).alias(f"_{k}") for k in range(classes)]
    votes = F.array(*[F.coalesce(F.col(f"_{k}"), F.lit(0.0)) for k in range(classes)])
    added = met.groupBy(*keys).agg(*sums).withColumn("_votes", votes)
    all_votes = F.aggregate("_votes", F.lit(0.0), lambda a, x: a + x)
    return added.select(*keys, F.transform("_votes", lambda x: F.try_divide(x, all_votes)).alias("probability"))


def likeliest(probability: Column) -> Column:
    """Number of the class with the largest share; of equal ones the first."""
    return F.array_position(probability, F.array_max(probability)).cast("int") - 1


def importances(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """Weighted gain per input, as a share of its tree's, averaged over trees that split at all."""
    weight = F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
    gains = (
        nodes.filter("feature is not null")
        .groupBy("tree", "feature").agg(F.sum(F.col("gain") * weight).alias("gained"))
    )
    trees = gains.groupBy("tree").agg(F.sum("gained").alias("of_tree")).filter("of_tree > 0")
    shares = gains.join(trees, "tree").groupBy("feature").agg(F.sum(F.col("gained") / F.col("of_tree")).alias("share"))
    every = nodes.sparkSession.createDataFrame(list(enumerate(names)), "feature int, name string")
    total = shares.agg(F.sum("share")).scalar()
    return every.join(shares, "feature", "left").select(
        F.col("name").alias("feature"), F.coalesce(F.try_divide("share", total), F.lit(0.0)).alias("importance")
    )


# Growing


def cut_points(frame: DataFrame, inputs: Sequence[str], bins: int = 32, limits: Limits = LIMITS) -> dict[str, list[float]]:
    """Distinct exact quantiles of each input: where splits are tried. At most ``bins - 1`` numbers an input."""
    probs = {f"q{k}": k / bins for k in range(1, bins)}
    found = {r["feature"]: r for r in exact_quantiles(frame, inputs, probs, limits).collect()}
    return {
        c: sorted({round(found[c][q] + 1e-9, 6) for q in probs}) if c in found else [] for c in inputs
    }


def binned(frame: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """``frame`` with the array ``bins``: the bin of each input in ``cuts``; bin k is up to cut k.

    The library's bucketizer looks a value up among its cuts, so the code compiled for a row is short
    however many cuts there are. Its buckets include their lower end: it is given negated values.
    """
    names = {c: f"_bin_{k}" for k, c in enumerate(cuts) if cuts[c]}
    down = {c: [-float("inf"), *sorted({0.0 - t for t in cuts[c]}), float("inf")] for c in names}
    out = frame.withColumns({n: F.nanvl(F.lit(0.0) - F.col(c), F.lit(-float("inf"))) for c, n in names.items()})
    if names:
        out = Bucketizer(
            splitsArray=list(down.values()), inputCols=list(names.values()),
            outputCols=[f"{n}_of" for n in names.values()], handleInvalid="keep",
        ).transform(out)
    bins = [len(down[c]) - 2 - F.col(f"{names[c]}_of").cast("int") if c in names else F.lit(0) for c in cuts]
    return out.select(*frame.columns, F.array(*bins).alias("bins"))


def histogram(
    frame: DataFrame, cuts: dict[str, list[float]], label: str, weight: str, by: Sequence[str] = ("node",)
) -> DataFrame:
    """(by, feature, bin, label, w): weight per node, input, bin and class; bin k is up to cut k."""
    return _weights(binned(frame, cuts), label, weight, by)


def _weights(rows: DataFrame, label: str = "label", weight: str = "w", by: Sequence[str] = ("node",)) -> DataFrame:
    """The histogram of rows with ``bins``.

    Map-side sums: what is shuffled has nodes x inputs x bins x classes rows a task at most.
    """
    return (
        rows.select(*by, F.col(label).alias("label"), F.col(weight).alias("w"), F.posexplode("bins").alias("feature", "bin"))
        .groupBy(*by, "feature", "bin", "label").agg(F.sum("w").alias("w"))
    )


def best_splits(hist: DataFrame, cuts: dict[str, list[float]], by: Sequence[str] = ("node",)) -> DataFrame:
    """The split of each node with the best Gini gain: (by, feature, cut, threshold, gain).

    Prefix sums over the bins of one input and class are arrays of at most the number of bins.
    Gains are compared to nine digits; of equal ones the first input's least threshold is taken.
    Splits that gain nothing, or leave a side empty, are none.
    """
    tables = F.create_map(
        *[x for k, c in enumerate(cuts) for x in (F.lit(k), F.array(*[F.lit(t) for t in cuts[c]]).cast("array<double>"))]
    )
    points = tables[F.col("feature")]
    filled = F.map_from_entries(F.collect_list(F.struct("bin", "w")))
    per_class = hist.groupBy(*by, "feature", "label").agg(filled.alias("_w"), F.sum("w").alias("_total"))
    below = F.transform(
        F.sequence(F.lit(0), F.size(points) - 1),
        lambda k: F.aggregate(
            F.sequence(F.lit(0), k), F.lit(0.0), lambda a, j: a + F.coalesce(F.try_element_at("_w", j), F.lit(0.0))
        ),
    )
    tried = per_class.filter(F.size(points) > 0).select(*by, "feature", "_total", F.posexplode(below).alias("cut", "_left"))
    sides = tried.groupBy(*by, "feature", "cut").agg(
        F.sum("_left").alias("l"),
        F.sum("_total").alias("t"),
        F.sum(F.col("_left") * F.col("_left")).alias("ll"),
        F.sum((F.col("_total") - F.col("_left")) * (F.col("_total") - F.col("_left"))).alias("rr"),
        F.sum(F.col("_total") * F.col("_total")).alias("tt"),
    )
    # Gini impurity of the node less that of its sides, each weighed by its rows.
    r = F.col("t") - F.col("l")
    gain = (F.try_divide("ll", "l") + F.try_divide("rr", r) - F.try_divide("tt", "t")) / F.col("t")
    gained = nudged_round(gain, 9)
    best = F.max_by(F.struct("feature", "cut", F.get(points, F.col("cut")).alias("threshold"), gained.alias("gain")),
                    F.struct(gained, -F.col("feature"), -F.col("cut")))
    return (
        sides.filter((F.col("l") > 1e-9) & (r > 1e-9)).groupBy(*by).agg(best.alias("b"))
        .select(*by, "b.*").filter("gain > 0")
    )


def grow(
    frame: DataFrame,
    inputs: Sequence[str],
    classes: int,
    depth: int,
    label: str = "label",
    weight: str = "sample_weight",
    bins: int = 32,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Node table of one tree, grown level by level; ``label`` is the number of the class.

    Rows are landed with the bins of their inputs, and each level is one pass over these: weights per
    node, input, bin and class. From them come the splits, the nodes' own class weights and, below the
    last splits, those of the leaves. ``frame`` is read twice: land it first. Inputs are compared as
    six-digit numbers.
    """
    six = frame.select(*[nudged_round(F.col(c), 6).alias(c) for c in inputs], F.col(label).cast("int").alias("label"), F.col(weight).alias("w"))
    cuts = cut_points(six, inputs, bins, limits)
    at = land(binned(six, cuts).select("label", "w", "bins"), "bins").withColumn("node", F.lit(0))
    leaves, parts = at, []
    child = 2 * F.col("node") + F.when(F.col("bin") <= F.col("cut"), 1).otherwise(2)

    def stats(rows: DataFrame) -> DataFrame:
        sums = [F.coalesce(F.sum(F.when(F.col("label") == k, F.col("w"))), F.lit(0.0)) for k in range(classes)]
        return rows.groupBy("node").agg(F.array(*sums).alias("stats"))

    for _ in range(depth):
        found = land(_weights(at), "histogram")
        splits = land(best_splits(found, cuts), "splits")
        # Each row is in the bins of every input once.
        own = stats(found.filter("feature = 0"))
        parts.append(attach(own, splits.drop("cut"), ["node"], "left", limits).select("node", "feature", "threshold", "gain", "stats"))
        chosen = splits.select("node", "feature", "cut")
        leaves = attach(found, chosen, ["node", "feature"], "inner", limits).select(child.alias("node"), "label", "w")
        met = attach(at, chosen, ["node"], "inner", limits).withColumn("bin", F.get("bins", F.col("feature")))
        at = met.withColumn("node", child).drop("feature", "cut", "bin")
    parts.append(stats(leaves).selectExpr("node", "cast(null as int) feature", "cast(null as double) threshold", "cast(null as double) gain", "stats"))
    nodes = reduce(DataFrame.unionByName, parts)
    inner = F.col("feature").isNotNull()
    return land(
        nodes.select(
            F.lit(0).alias("tree"), "node", "feature", "threshold", F.lit(None).cast("array<double>").alias("categories"),
            F.when(inner, 2 * F.col("node") + 1).alias("left"), F.when(inner, 2 * F.col("node") + 2).alias("right"),
            "gain", "stats",
        ),
        "nodes",
    )
