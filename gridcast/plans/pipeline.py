"""The medallion run of one event: Bronze, Silver, Gold, model, predictions, export.

Each step reads the tables before it and replaces exactly its own partition,
so any step can be run again. Silver and Gold are verified in the job that writes
them: a row that must not be there fails the step before anything is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.functions.columns import row_key
from gridcast.operators import clean, features, model, rank
from gridcast.store import land
from gridcast.params import LIMITS, UNKNOWN_COMPOUND, Limits, Params
from gridcast.schemas import BRONZE, CRITICAL, DURATIONS, FEATURES, FLAGS, GOLD, PACE, PREDICTIONS, RESULTS, SILVER
from gridcast.sinks import export, tables
from gridcast.sources import conform, readers


@dataclass(frozen=True)
class Paths:
    """Sibling table roots; results are no folder of the raw laps."""

    root: str

    def __getattr__(self, table: str) -> str:
        if table not in ("raw", "results", "clean", "features", "pace", "models", "predictions", "export"):
            raise AttributeError(table)
        return f"{self.root}/{table}"


def _event(p: Params) -> dict[str, object]:
    return {"season": p.season, "event": p.event}


def _is_event(p: Params):
    return (F.col("season") == p.season) & (F.col("event") == p.event)


def ingest_laps(raw: DataFrame, p: Params, paths: Paths) -> DataFrame:
    """Landed laps of the event to Bronze; returns which sessions came in.

    ``raw`` has the requested code as ``session`` and may have the long
    ``session_name``. Only sessions that ``raw`` has laps of are replaced.
    """
    if "session_name" not in raw.columns:
        raw = raw.withColumn("session_name", F.lit(None).cast("string"))
    laps = (
        raw.transform(conform.durations_to_seconds, DURATIONS)
        .transform(conform.flag_text, FLAGS)
        .transform(conform.normalise_session, "session_name", "session")
        .transform(conform.tag, **_event(p))
        .transform(conform.conform, BRONZE)
    )
    tables.write_partitions(laps, paths.raw, ("season", "event", "session"))
    spark = raw.sparkSession
    stored = readers.read_table(spark, paths.raw, BRONZE, _is_event(p))
    expected = spark.createDataFrame([(p.season, p.event)], "season int, event string")
    return conform.session_coverage(stored, ("season", "event"), p.session_types, expected)


def ingest_results(raw: DataFrame, p: Params, paths: Paths) -> None:
    tables.replace_partitions(conform.conform_results(raw, p), paths.results, _event(p))


def silver_checks(p: Params) -> list[tables.Check]:
    """What no Silver row may be; ``session_best`` is the best lap of the row's session in Silver."""
    known = ", ".join(f"'{c}'" for c in (*p.compounds, UNKNOWN_COMPOUND))
    return [
        *[tables.Check(f"{c} is there", f"{c} is null" + (f" or isnan({c})" if c == "LapTime" else "")) for c in CRITICAL],
        tables.Check("compound is known", f"Compound is null or Compound not in ({known})"),
        tables.Check("lap within the outlier rule", f"LapTime > session_best * {p.outlier_threshold!r}D"),
    ]


def gold_checks() -> list[tables.Check]:
    """What no Gold row may be."""
    keys = [f.name for f in GOLD.fields if not f.nullable]
    return [
        *[tables.Check(f"{c} is there", f"{c} is null") for c in keys],
        *[tables.Check(f"{c} is a number", f"isnan({c})") for c in FEATURES],
        tables.Check("no lap beats the driver's best", "lap_time_delta is null or lap_time_delta < 0"),
        tables.Check("no driver beats the team's best", "pace_vs_teammate < 0"),
        tables.Check("positions count from 1", "race_position < 1"),
    ]


def write_silver(
    silver: DataFrame, p: Params, path: str, where: dict[str, object] | None = None, limits: Limits = LIMITS
) -> DataFrame:
    """Replace partitions of Silver if its rows pass :func:`silver_checks`; returns the report."""
    kept = land(silver, "silver")
    best = clean.session_best(kept, limits)
    return tables.verified_replace(
        best, path, ("season", "event"), silver_checks(p), "silver", where, only_checked=["session_best"]
    )


def write_gold(gold: DataFrame, path: str, where: dict[str, object] | None = None) -> DataFrame:
    """Replace partitions of Gold if its rows pass :func:`gold_checks`; returns the report."""
    return tables.verified_replace(gold, path, ("season", "event"), gold_checks(), "gold", where)


def clean_event(spark: SparkSession, p: Params, paths: Paths, limits: Limits = LIMITS) -> DataFrame:
    bronze = readers.read_table(spark, paths.raw, BRONZE, _is_event(p))
    return write_silver(clean.silver(bronze, p, limits), p, paths.clean, _event(p), limits)


def rebuild_pace(spark: SparkSession, paths: Paths) -> None:
    """The pace states of all rounds anew from Gold, e.g. for a Gold table older than its states."""
    state = features.pace_state(readers.read_table(spark, paths.features, GOLD))
    tables.write_partitions(land(state, "pace"), paths.pace, ("season", "round_number"))


def build_features(spark: SparkSession, p: Params, paths: Paths, limits: Limits = LIMITS) -> DataFrame:
    """Gold of the event; the trend comes from earlier rounds' states, not from their laps."""
    silver = readers.read_table(spark, paths.clean, SILVER, _is_event(p))
    if readers.path_exists(spark, paths.features) and not readers.path_exists(spark, paths.pace):
        rebuild_pace(spark, paths)
    states = readers.read_optional(spark, paths.pace, PACE)
    trend = features.trend_from_state(states, p.season, p.round_number, p.recent_rounds, p.baseline_rounds)
    results = readers.read_optional(spark, paths.results, RESULTS).filter(_is_event(p))
    positions = readers.result_positions(results)
    gold = features.gold(silver, p, positions, limits=limits, trend=trend)
    report = write_gold(tables.to_storage(gold, GOLD), paths.features, _event(p))
    stored = readers.read_table(spark, paths.features, GOLD, _is_event(p))
    where = {"season": p.season, "round_number": p.round_number}
    tables.replace_partitions(features.pace_state(stored), paths.pace, where)
    return report


def _season(spark: SparkSession, p: Params, paths: Paths) -> DataFrame:
    return readers.read_table(spark, paths.features, GOLD, F.col("season") == p.season)


@dataclass(frozen=True)
class Training:
    version: str
    evaluation: DataFrame
    importance: DataFrame


def train(spark: SparkSession, p: Params, paths: Paths) -> Training:
    """Forest and logistic baseline on the season so far; both are saved."""
    gold = _season(spark, p, paths)
    version = model.version_of(gold, p)
    frame = land(model.training_frame(gold, p), "train")
    forest = model.fit(frame, p, "forest")
    baseline = model.fit(frame, p, "logistic")
    model.save_model(forest, paths.models, version)
    model.save_model(baseline, paths.models, f"lr_baseline_r{p.round_number:02d}")
    evaluation = model.evaluation(forest, "forest").unionByName(
        model.evaluation(baseline, "logistic")
    )
    return Training(version, evaluation, model.importance_table(spark, forest.model))


def predict(
    spark: SparkSession,
    p: Params,
    paths: Paths,
    dead_band: float | None = None,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Score and rank the event, store the predictions, export the document."""
    version, path = model.resolve_model(spark, paths.models, p.round_number)
    fitted = model.load_model(path)
    gold = _season(spark, p, paths)
    current = gold.filter(F.col("event") == p.event)
    if current.isEmpty():
        raise ValueError(f"no features for {p.event}: build them first")

    scored = model.win_probability(
        model.score(fitted.model, model.impute_numeric(current), fitted.labels), fitted.labels
    )
    lap = ("driver", "session_type", "lap_number", "compound", "lap_time_delta", "win_prob_lap")
    # The model is applied once; ranking and every subsample read this table.
    scored = land(
        scored.select(
            *rank.DRIVER, "team", "session_type", "lap_time_delta", "pace_trend", "win_prob_lap",
            "pred_pos_lap", row_key(*lap).alias("row_key"),
        ),
        "scored",
    )
    ranked = rank.rank_drivers(
        rank.normalise_share(rank.driver_prediction(scored), limits=limits), limits
    )
    uncertainty = rank.subsample_uncertainty(
        scored, p.replicates, p.resample_fraction, F.col("row_key"), limits
    )
    final = land(rank.join_uncertainty(ranked, uncertainty, limits), "predictions")

    stored = readers.read_optional(spark, paths.predictions, PREDICTIONS)
    # Landed before the table is written to: history is the season up to this run.
    history = land(rank.winner_history(stored, gold, p.season, limits), "history")
    rows = tables.to_storage(rank.prediction_rows(final, p, version), PREDICTIONS)
    where = {**_event(p), "model_version": version}
    tables.replace_partitions(rows, paths.predictions, where)

    scores = rank.session_scores(scored, p)
    if dead_band is not None:
        trend = scored.groupBy(*rank.DRIVER).agg(F.max("pace_trend").alias("pace_trend"))
        scores = scores.join(trend, list(rank.DRIVER))
    parts = export.document_parts(
        export.export_entries(final, scores, p, dead_band, limits),
        scored.select("session_type"),
        model.importance_table(spark, fitted.model),
        history,
        p,
        version,
    )
    export.write_parts(parts, f"{paths.export}/{p.season}/{p.event}/{version}")
    return final


@dataclass(frozen=True)
class Run:
    """What a run gives: the ranked drivers, and what each step says of itself."""

    ranked: DataFrame
    coverage: DataFrame
    report: DataFrame
    training: Training


def run(
    spark: SparkSession,
    laps: DataFrame,
    results: DataFrame | None,
    p: Params,
    paths: Paths,
    limits: Limits = LIMITS,
) -> Run:
    """All steps of one event in order. A breach of a check stops the run before that step's write."""
    coverage = ingest_laps(laps, p, paths)
    if results is not None:
        ingest_results(results, p, paths)
    report = clean_event(spark, p, paths, limits).unionByName(build_features(spark, p, paths, limits))
    training = train(spark, p, paths)
    return Run(predict(spark, p, paths, limits=limits), coverage, report, training)
