"""The nested prediction document: one JSON object per event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.functions.columns import trend_label
from gridcast.operators.rank import DRIVER, season_accuracy, session_struct
from gridcast.operators.sizing import attach
from gridcast.params import LIMITS, Limits, Params

# The document's fields before and after its drivers.
BEFORE = ("model_version", "generated_at", "event", "round", "season", "sessions_used",
          "season_accuracy", "recency_lambda")
AFTER = ("feature_importance", "history")

def export_entries(
    predictions: DataFrame, scores: DataFrame, p: Params, dead_band: float | None = None,
    limits: Limits = LIMITS,
) -> DataFrame:
    """One ``entry`` struct per driver with rank, share, uncertainty and session scores.

    ``dead_band`` derives the trend from ``pace_trend``; without it every
    driver is ``flat``.
    """
    trend = F.lit("flat") if dead_band is None else trend_label(F.col("pace_trend"), dead_band)
    joined = attach(predictions, scores, DRIVER, "left", limits)
    entry = F.struct(
        "driver",
        "team",
        "predicted_position",
        F.round("win_probability", 4).alias("win_probability"),
        F.round("uncertainty", 4).alias("uncertainty"),
        F.coalesce(trend, F.lit("flat")).alias("trend"),
        session_struct(p.session_weights, p.scored_sessions).alias("sessions"),
    )
    return joined.select("season", "event", "predicted_position", entry.alias("entry"))


def _in_order(items: Column) -> Column:
    """Collected (order, item) pairs as the sorted list of items."""
    return F.transform(F.array_sort(F.collect_list(items)), lambda x: x["item"])


def _header(
    sessions_used: DataFrame,
    importance: DataFrame,
    history: DataFrame,
    p: Params,
    model_version: str,
) -> list[Column]:
    """The parts around the driver list; each is bounded by sessions, inputs or rounds."""
    used = sessions_used.agg(F.array_sort(F.collect_set("session_type"))).scalar()
    features = (
        importance.filter("exported")
        .select(
            F.struct(
                (-F.col("importance")).alias("order"),
                F.struct("feature", F.round("importance", 4).alias("importance")).alias("item"),
            ).alias("x")
        )
        .agg(_in_order(F.col("x")))
        .scalar()
    )
    # The document's readers know the exact winner match under this older name.
    past = (
        history.select(
            F.struct(
                F.col("round").alias("order"),
                F.struct(
                    "event", "predicted", "actual", F.col("winner_hit").alias("top3_hit")
                ).alias("item"),
            ).alias("x")
        )
        .agg(_in_order(F.col("x")))
        .scalar()
    )
    record = season_accuracy(history).select(
        F.struct(F.col("winner_pct").alias("top3_pct"), "races").alias("x")
    ).scalar()
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return [
        F.lit(model_version).alias("model_version"),
        F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("generated_at"),
        F.lit(p.event).alias("event"),
        F.lit(p.round_number).alias("round"),
        F.lit(p.season).alias("season"),
        used.alias("sessions_used"),
        record.alias("season_accuracy"),
        F.lit(p.recency_lambda).alias("recency_lambda"),
        features.alias("feature_importance"),
        past.alias("history"),
    ]


def export_document(
    entries: DataFrame,
    sessions_used: DataFrame,
    importance: DataFrame,
    history: DataFrame,
    p: Params,
    model_version: str,
) -> DataFrame:
    """One row holding the nested document of the event, for a field that fits a row.

    :func:`document_parts` gives the same document for a field of any size.
    """
    drivers = entries.agg(
        _in_order(
            F.struct(F.col("predicted_position").alias("order"), F.col("entry").alias("item"))
        ).alias("predictions")
    )
    head = _header(sessions_used, importance, history, p, model_version)
    return drivers.select("*", *head).select(*BEFORE, "predictions", *AFTER)


def _object(names: Sequence[str]) -> Column:
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


def document_parts(
    entries: DataFrame,
    sessions_used: DataFrame,
    importance: DataFrame,
    history: DataFrame,
    p: Params,
    model_version: str,
) -> DataFrame:
    """The document as text lines (part, predicted_position, value), with no bound on its drivers.

    Part 0 is what stands before the drivers, part 1 one line per driver, part 2 the rest.
    Positions number the drivers of the event, so each is there once.
    """
    first = entries.agg(F.min("predicted_position")).scalar()
    comma = F.when(F.col("predicted_position") > first, ",").otherwise("")
    driver = F.concat(comma, F.to_json("entry", {"ignoreNullFields": "false"}))
    body = entries.select(F.lit(1).alias("part"), "predicted_position", driver.alias("value"))
    head = _header(sessions_used, importance, history, p, model_version)
    frame = entries.sparkSession.range(1).select(*head)
    before = F.concat(F.regexp_replace(_object(BEFORE), r"\}$", ""), F.lit(',"predictions":['))
    after = F.concat(F.lit("],"), F.regexp_replace(_object(AFTER), r"^\{", ""))
    ends = frame.select(F.array(before, after).alias("ends")).select(
        F.posexplode("ends").alias("end", "value")
    )
    nowhere = F.lit(None).cast(entries.schema["predicted_position"].dataType)
    ends = ends.select(
        (F.col("end") * 2).alias("part"), nowhere.alias("predicted_position"), "value"
    )
    return ends.unionByName(body)


def write_parts(parts: DataFrame, path: str) -> None:
    """Text files whose lines, read in order of their names, are the document."""
    order = ("part", "predicted_position")
    (
        parts.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("value").write.mode("overwrite").text(path)
    )


def to_json_text(document: DataFrame) -> DataFrame:
    """The document as JSON text; absent sessions are kept as null."""
    whole = F.to_json(F.struct(*document.columns), {"ignoreNullFields": "false", "pretty": "true"})
    return document.select(whole.alias("value"))


def export_lines(entries: DataFrame) -> DataFrame:
    """One JSON line per driver, for a field of any size; stays distributed."""
    line = F.to_json("entry", {"ignoreNullFields": "false"})
    return entries.select("season", "event", "predicted_position", line.alias("value"))
