"""Training frame, pipelines, evaluation, scoring, model folders."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from gridcast.functions.columns import version_label
from gridcast.operators.weights import sample_weight
from gridcast.params import LIMITS, Limits, Params
from gridcast.schemas import FEATURES
from gridcast.sources.readers import file_system

INPUTS = (*FEATURES, "compound_idx")
WIN = "1"


def impute_numeric(df: DataFrame, cols: Sequence[str] = FEATURES, value: float = 0.0) -> DataFrame:
    """NULL and NaN alike become ``value``."""
    fill = F.lit(value)
    return df.withColumns({c: F.coalesce(F.nanvl(F.col(c), fill), fill) for c in cols})


def impute_label(df: DataFrame, value: int = -1) -> DataFrame:
    return df.fillna(value, subset=["race_position"])


def labelled(df: DataFrame) -> DataFrame:
    return df.filter(F.col("race_position").isNotNull())


def unlabelled(df: DataFrame) -> DataFrame:
    return df.filter(F.col("race_position").isNull())


def model_version(df: DataFrame, by: Sequence[str] = ("season", "round_number")) -> DataFrame:
    """Version name per round: ``base`` once the round has a result, else ``qualifying``."""
    has_result = F.coalesce(F.bool_or(F.col("race_position").isNotNull()), F.lit(False))
    return df.groupBy(*by).agg(has_result.alias("has_result")).select(
        *by,
        F.when(F.col("has_result"), version_label("base", F.col("round_number")))
        .otherwise(version_label("qualifying", F.col("round_number")))
        .alias("model_version"),
    )


def version_of(gold: DataFrame, p: Params) -> str:
    """The version name of the current round; stops at the first labelled row."""
    current = (F.col("season") == p.season) & (F.col("round_number") == p.round_number)
    found = labelled(gold.filter(current)).select("season").limit(1).count()
    return f"{'base' if found else 'qualifying'}_r{p.round_number:02d}"


def temporal_split(df: DataFrame) -> DataFrame:
    """Latest round as ``holdout``, earlier ones as ``fit``, in column ``split``."""
    latest = df.agg(F.max("round_number")).scalar()
    return df.withColumn("split", F.when(F.col("round_number") < latest, "fit").otherwise("holdout"))


def training_frame(gold: DataFrame, p: Params, features: Sequence[str] = FEATURES) -> DataFrame:
    """Labelled rows with weights, imputed features, label text and split."""
    return (
        labelled(gold)
        .transform(sample_weight, p, p.unknown_session)
        .transform(impute_numeric, features)
        .transform(temporal_split)
        .withColumn("position", F.col("race_position").cast("string"))
    )


def feature_stages() -> list:
    return [
        StringIndexer(inputCol="compound", outputCol="compound_idx", handleInvalid="keep"),
        VectorAssembler(inputCols=list(INPUTS), outputCol="features", handleInvalid="keep"),
    ]


def build_pipeline(kind: str, p: Params) -> Pipeline:
    """Feature stages and the classifier, ``forest`` or ``logistic``.

    The label is indexed outside (:func:`index_labels`), so scoring needs no
    stand-in label.
    """
    common = {"featuresCol": "features", "labelCol": "label", "weightCol": "sample_weight"}
    if kind == "forest":
        learner = RandomForestClassifier(
            numTrees=p.trees, maxDepth=p.depth, seed=p.seed, **common
        )
    elif kind == "logistic":
        # Iterations and regularisation of the baseline.
        learner = LogisticRegression(maxIter=100, regParam=0.01, **common)
    else:
        raise ValueError(f"kind must be forest or logistic, not {kind!r}")
    return Pipeline(stages=[*feature_stages(), learner])


def index_labels(train: DataFrame) -> StringIndexerModel:
    return StringIndexer(inputCol="position", outputCol="label", handleInvalid="error").fit(train)


def in_slices(train: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Training rows dealt evenly to tasks of ``limits.fit_rows`` rows; up to that many stay as they are.

    What a learner keeps of a row is many times the row's size in its file, so the tasks of a scan,
    which are cut by bytes, would grow with the table.
    """
    rows = train.count()
    if rows <= limits.fit_rows:
        return train
    return train.repartition(max(-(-rows // limits.fit_rows), train.sparkSession.sparkContext.defaultParallelism))


def _learn(pipeline: Pipeline, rows: DataFrame, limits: Limits) -> PipelineModel:
    """``pipeline`` fitted; only the columns that the learner reads are dealt out."""
    indexer, assembler, learner = pipeline.getStages()
    compounds = indexer.fit(rows)
    read = compounds.transform(rows).select(*INPUTS, learner.getLabelCol(), learner.getWeightCol())
    return PipelineModel([compounds, assembler, learner.fit(assembler.transform(in_slices(read, limits)))])


@dataclass(frozen=True)
class Fitted:
    """A pipeline model with its class order and how it was evaluated."""

    model: PipelineModel
    labels: tuple[str, ...]
    holdout: DataFrame | None = None
    leaked: bool = False


def fit(
    train: DataFrame,
    p: Params,
    kind: str = "forest",
    refit: bool = True,
    leak_below: int = 0,
    evaluate: bool = True,
    limits: Limits = LIMITS,
) -> Fitted:
    """Fit on the earlier rounds, score the latest one, then refit on everything.

    ``train`` is a :func:`training_frame` read several times: land it first. Without
    earlier rounds there is nothing to evaluate on: all rows are used and ``holdout`` is
    None; with ``evaluate=False`` that is so in any case, and there is one fit only.
    With fewer earlier rows than ``leak_below`` everything is fitted on and the latest
    round scored all the same, which is marked as leaked.
    """
    indexer = index_labels(train)
    indexed = indexer.transform(train)
    pipeline = build_pipeline(kind, p)
    labels = tuple(indexer.labels)
    if not evaluate:
        return Fitted(_learn(pipeline, indexed, limits), labels)
    sizes = {r["split"]: r["n"] for r in train.groupBy("split").agg(F.count("*").alias("n")).collect()}
    earlier = sizes.get("fit", 0)
    leaked = earlier < leak_below
    if not earlier and not leaked:
        return Fitted(_learn(pipeline, indexed, limits), labels)
    evaluated = _learn(pipeline, indexed if leaked else indexed.filter(F.col("split") == "fit"), limits)
    holdout = score(evaluated, indexed.filter(F.col("split") == "holdout"), labels)
    final = _learn(pipeline, indexed, limits) if refit and not leaked else evaluated
    return Fitted(final, labels, holdout, leaked)


def position_of(number: Column, labels: Sequence[str]) -> Column:
    """The finishing position a class number stands for; NULL for a number without one."""
    return F.get(F.array(*[F.lit(int(x)) for x in labels]), number.cast("int"))


def score(model: PipelineModel, df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Class probabilities, and the predicted class as a finishing position."""
    return model.transform(df).withColumn("pred_pos_lap", position_of(F.col("prediction"), labels))


def win_probability(scored: DataFrame, labels: Sequence[str], win: str = WIN) -> DataFrame:
    """Probability of the class whose label is ``win``; a missing class is an error.

    ``probability`` is the model's vector, or an array of the classes' probabilities.
    """
    if win not in labels:
        raise ValueError(f"no row with position {win} in the training data: no win probability")
    slot = list(labels).index(win)
    is_array = isinstance(scored.schema["probability"].dataType, ArrayType)
    shares = F.col("probability") if is_array else vector_to_array("probability")
    return scored.withColumn("win_prob_lap", F.get(shares, F.lit(slot)))


def holdout_rows(scored: DataFrame, *keys: str) -> DataFrame:
    """Actual and predicted position of the scored rows side by side, and how far they are apart."""
    actual, predicted = F.col("position").cast("int"), F.col("pred_pos_lap")
    return scored.select(
        *keys, actual.alias("actual_position"), predicted.alias("predicted_position"),
        F.abs(predicted - actual).alias("off_by"), (predicted == actual).alias("hit"),
        (F.abs(predicted - actual) <= 2).alias("within_2"),
    )


def logistic_gradient(
    scored: DataFrame, inputs: Sequence[str], label: str = "label", weight: str = "sample_weight"
) -> DataFrame:
    """Gradient of the weighted multinomial loss: one row per class, one column per input.

    ``scored`` has the classes' probabilities as an array and the inputs as columns. For each row
    and class it is the outer product of probability less truth and the inputs, added up in one
    pass; what is shuffled has as many rows a task as there are classes.
    """
    share = F.posexplode("probability").alias("class", "p")
    rest = F.col("p") - (F.col("class") == F.col(label)).cast("double")
    long = scored.select(*inputs, F.col(label).alias(label), F.col(weight).alias("_w"), share).withColumn("_rest", F.col("_w") * rest)
    sums = [F.sum(F.col("_rest") * F.col(c)).alias(c) for c in inputs]
    added = long.groupBy("class").agg(F.sum("_rest").alias("intercept"), *sums, F.sum("_w").alias("_weight"))
    return added.select("class", *[(F.col(c) / F.col("_weight")).alias(c) for c in ("intercept", *inputs)])


def penalty_gradient(
    spark: SparkSession, fitted: Fitted, frame: DataFrame, inputs: Sequence[str], weight: str = "sample_weight"
) -> DataFrame:
    """What the penalty of the fitted coefficients adds to :func:`logistic_gradient`.

    Coefficients are penalised per standard deviation of their input; the intercepts are not.
    The coefficients are as many as classes times inputs and come from the model itself.
    """
    learner = fitted.model.stages[-1]
    w = F.col(weight)
    total = F.sum(w) - F.sum(w * w) / F.sum(w)
    spread = [
        ((F.sum(w * F.col(c) * F.col(c)) - F.sum(w * F.col(c)) * F.sum(w * F.col(c)) / F.sum(w)) / total).alias(c)
        for c in inputs
    ]
    matrix = learner.coefficientMatrix.toArray()
    rows = [(k, *map(float, line)) for k, line in enumerate(matrix)]
    coefficients = spark.createDataFrame(rows, "class int, " + ", ".join(f"_{c} double" for c in inputs))
    variances = frame.agg(*spread)
    price = learner.getOrDefault("regParam")
    return coefficients.select(
        "class", *[(F.lit(price) * F.col(f"_{c}") * variances.select(c).scalar()).alias(c) for c in inputs]
    )


def _hit(predicate: Column) -> Column:
    return F.avg(predicate.cast("double"))


def exact_accuracy(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    return df.agg(_hit(F.col(predicted) == F.col(actual)).alias("exact_accuracy"))


def within_k_accuracy(df: DataFrame, predicted: str, actual: str, k: int = 2) -> DataFrame:
    near = F.abs(F.col(predicted) - F.col(actual)) <= k
    return df.agg(_hit(near).alias(f"within_{k}_accuracy"))


def evaluation(fitted: Fitted, name: str) -> DataFrame:
    """Holdout rows, exact and within-two accuracy in one pass; 0 and NULL without a holdout."""
    predicted, actual = F.col("pred_pos_lap"), F.col("position").cast("int")
    scored = fitted.holdout
    if scored is None:
        scored = SparkSession.active().createDataFrame([], "pred_pos_lap int, position string")
    return scored.agg(
        F.count(F.lit(1)).alias("holdout_rows"),
        _hit(predicted == actual).alias("exact_accuracy"),
        _hit(F.abs(predicted - actual) <= 2).alias("within_2_accuracy"),
    ).select(F.lit(name).alias("model"), "*", F.lit(fitted.leaked).alias("leaked"))


def importance_table(
    spark: SparkSession, model: PipelineModel, names: Sequence[str] = INPUTS
) -> DataFrame:
    """Importance per model input, largest first; ``exported`` marks the numeric features."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(v), n in FEATURES) for n, v in zip(names, values)]
    df = spark.createDataFrame(rows, "feature string, importance double, exported boolean")
    return df.orderBy(F.desc("importance"), "feature")


# A save that is still being written, and a model of this run that is not published.
_UNFINISHED = "_"


def save_model(fitted: Fitted, root: str, version: str) -> str:
    """Save pipeline and class order as one model, and publish it by one rename.

    The class order is the pipeline's last stage. A version's saves are numbered; a new one is
    written under a name that nobody reads, renamed to the next number, and only then are the
    earlier ones removed. So at any moment a reader finds a whole model.
    """
    spark = SparkSession.active()
    names = IndexToString(inputCol="prediction", outputCol="pred_position", labels=list(fitted.labels))
    whole = PipelineModel([*fitted.model.stages, names])
    folder = f"{root}/{version}"
    staged = f"{folder}/{_UNFINISHED}{uuid.uuid4().hex}"
    whole.write().save(staged)
    fs, paths = file_system(spark, folder)
    earlier = _saves(spark, folder)
    path = f"{folder}/{(earlier[-1] if earlier else 0) + 1:06d}"
    if not fs.rename(paths(staged), paths(path)):
        raise OSError(f"cannot publish {staged} as {path}")
    for number in earlier:
        fs.delete(paths(f"{folder}/{number:06d}"), True)
    return path


def _saves(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of a version's published saves, in order."""
    fs, paths = file_system(spark, folder)
    if not fs.exists(paths(folder)):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(paths(folder))]
    return sorted(int(name) for name in names if name.isdigit())


def resolve_model(spark: SparkSession, root: str, round_number: int) -> tuple[str, str]:
    """(version, path) to predict with: the weekend's own model, else the base one.

    Only published saves count; one whose writing broke off is not found.
    """
    versions = [f"{kind}_r{round_number:02d}" for kind in ("qualifying", "base")]
    for version in versions:
        if saves := _saves(spark, f"{root}/{version}"):
            return version, f"{root}/{version}/{saves[-1]:06d}"
    raise FileNotFoundError(f"no model for round {round_number} in {root}: looked for {versions}")


def load_model(path: str) -> Fitted:
    """A saved model by its path, as :func:`resolve_model` or :func:`save_model` give it."""
    whole = PipelineModel.load(path)
    *stages, names = whole.stages
    return Fitted(PipelineModel(stages), tuple(names.getLabels()))
