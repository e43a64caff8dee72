"""One named query per operator, over the star-schema test tables seen as laps.

Queries that read laps more than once land them first (as the Bronze table of
a real run); single-pass queries go straight from the tables. Fractions are
rounded to six decimals so that two engines agree in spite of float noise.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.functions.columns import nudged_round
from gridcast.operators import clean, explore, features, model, quality, rank, trees, weights
from gridcast.operators.sizing import attach
from gridcast.params import SESSION_NAMES, SESSION_TYPES, Params
from gridcast.plans import pipeline
from gridcast.schemas import CRITICAL, FEATURES, GOLD, LAPS, PACE, RESULTS
from gridcast.sinks import export, tables
from gridcast.sources import conform, fixture, mixed_csv, readers
from gridcast.store import land, new_path

P = Params(fixture.SEASON, fixture.EVENT, fixture.ROUND)
LAP = (*fixture.LAP_COLUMNS, "row_key")
TIMED = (*fixture.TAGS, "Driver", "LapTime", "row_key")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def r6(value: Column | str) -> Column:
    return nudged_round(F.col(value) if isinstance(value, str) else value, 6)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in cols})


def bronze(spark: SparkSession, sf_dir: str, columns=fixture.FEATURE_COLUMNS) -> DataFrame:
    return land(fixture.laps(spark, sf_dir, columns), "bronze")


def silver_laps(spark: SparkSession, sf_dir: str, columns=fixture.FEATURE_COLUMNS) -> DataFrame:
    return clean.silver(bronze(spark, sf_dir, columns), P)


def base(spark: SparkSession, sf_dir: str, columns=fixture.FEATURE_COLUMNS) -> DataFrame:
    """Silver laps under Gold names, landed for the operators that read them twice."""
    return land(features.base_laps(silver_laps(spark, sf_dir, columns), P), "silver")


# Lap columns that single features are made of, beyond those of every lap.
SOURCES = {
    "best_sector_combo": ("Sector1Time", "Sector2Time", "Sector3Time"),
    "tyre_deg_rate": ("TyreLife",),
}


def gold_laps(
    spark: SparkSession,
    sf_dir: str,
    *wanted: str,
    label: bool = True,
    row_key: bool = False,
    field: bool = False,
) -> DataFrame:
    """Gold with the named features (all of them by default), down from the raw tables.

    ``field``: every lap goes to one of as many cars as a race has, see :func:`fixture.in_field`.
    """
    wanted = wanted or FEATURES
    extra = [c for f in wanted for c in SOURCES.get(f, ())]
    columns = (*fixture.LAP_COLUMNS, *extra, *(["row_key"] if row_key else []))
    if field:
        # The field's cars have teams of their own: those of the tables are not looked up.
        own = fixture.laps(spark, sf_dir, [c for c in columns if c != "Team"])
        laps = land(fixture.in_field(own).select(*columns), "bronze")
    else:
        laps = bronze(spark, sf_dir, columns)
    positions = readers.result_positions(fixture.results(laps)) if label else None
    return features.gold(clean.silver(laps, P), P, positions, features=wanted)


def landed_gold(spark: SparkSession, sf_dir: str, *wanted: str, **options: bool) -> DataFrame:
    """Gold as a table, for queries that read it more than once."""
    return land(gold_laps(spark, sf_dir, *wanted, **options), "gold")


# What the stand-in score below is made of.
SCORE = ("lap_time_delta", "consistency_score", "pace_vs_teammate")


def scored_laps(gold: DataFrame) -> DataFrame:
    """Laps with a computed stand-in for the model's output, the same in any engine."""
    gap = F.col("lap_time_delta") + F.col("pace_vs_teammate") + F.coalesce("consistency_score", F.lit(0.0))
    return gold.select(
        *rank.DRIVER, "team", "round_number", "session_type", "lap_time_delta", "race_position",
        "row_key",
        nudged_round(1.0 / (1.0 + gap), 6).alias("win_prob_lap"),
        (F.col("row_key") % 20 + 1).cast("int").alias("pred_pos_lap"),
    )


def ranked(scored: DataFrame) -> DataFrame:
    return rank.rank_drivers(rank.normalise_share(rank.driver_prediction(scored)))


def uncertainty_of(scored: DataFrame) -> DataFrame:
    return rank.subsample_uncertainty(scored, P.replicates, P.resample_fraction, F.col("row_key"))


def season_predictions(gold: DataFrame) -> DataFrame:
    """The predicted three of every event with the version that made them; a record asks for no more."""
    versions = model.model_version(gold, ("season", "event", "round_number")).withColumnRenamed(
        "round_number", "round"
    )
    three = rank.top3_summary(rank.normalise_share(rank.driver_prediction(scored_laps(gold))))
    return attach(three.withColumnRenamed("place", "predicted_position"), versions, rank.EVENT)


# Sources and sinks


@query
def scan_laps(spark, sf_dir):
    path = new_path(spark, "landed-laps")
    raw = fixture.laps(spark, sf_dir).withColumn("session", F.col("session_type"))
    conform.conform(raw, LAPS).write.parquet(path)
    return readers.read_laps(spark, path).select(
        "Driver", "Team", "LapNumber", r6(F.col("LapTime").cast("double")).alias("lap_seconds"),
        "Compound", "session_type", "season", "event",
    )


@query
def conform_columns(spark, sf_dir):
    df = conform.conform(fixture.laps(spark, sf_dir), LAPS)
    return df.select(
        "Driver", "DriverNumber", "Team", "LapNumber", r6(F.col("TyreLife").cast("double")).alias("tyre_life"),
        F.col("SpeedI1").cast("double").alias("speed_i1"), "FreshTyre", "season", "event", "session",
    )


@query
def durations_to_seconds(spark, sf_dir):
    df = fixture.laps(spark, sf_dir, (*TIMED, "Sector1Time"))
    lap = F.col("LapTime")
    clock = F.format_string("0 days 00:%02d:%09.6f", F.floor(lap / 60), lap % 60)
    text = df.select(
        "row_key",
        F.coalesce(F.when(lap.isNotNull(), clock), F.lit("NaT")).alias("LapTime"),
        F.format_string("00:00:%05.2f", "Sector1Time").alias("Sector1Time"),
    )
    return rounded(
        conform.durations_to_seconds(text, ("LapTime", "Sector1Time")), "LapTime", "Sector1Time"
    )


@query
def normalise_session(spark, sf_dir):
    names = {code: name for name, code in SESSION_NAMES.items()} | {"SQ": "Sprint Shootout"}
    df = fixture.laps(spark, sf_dir, ("session_type", "row_key")).replace(names, subset="session_type")
    df = df.withColumnRenamed("session_type", "session_name").withColumn("requested", F.lit("SQ"))
    return conform.normalise_session(df, "session_name", "requested")


@query
def flag_text(spark, sf_dir):
    df = fixture.laps(spark, sf_dir, ("row_key", "TyreLife", "LapTime"))
    flags = df.select(
        "row_key",
        (F.col("TyreLife") <= 3).alias("FreshTyre"),
        (F.col("LapTime") < 85).alias("IsPersonalBest"),
    )
    return conform.flag_text(flags, ("FreshTyre", "IsPersonalBest"))


@query
def roundtrip_partitioned(spark, sf_dir):
    """Write all sessions, write one session again, read back under the declared schema."""
    path = new_path(spark, "roundtrip")
    laps = bronze(spark, sf_dir, (*LAP, "TyreLife")).withColumn("session", F.col("session_type"))
    typed = conform.conform(laps, LAPS)
    keys = ("season", "event", "session")
    tables.write_partitions(typed, path, keys)
    again = (F.col("event") == P.event) & (F.col("session") == "R")
    tables.write_partitions(typed.filter(again), path, keys)
    return (
        readers.read_laps(spark, path)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("laps"),
            F.count("LapTime").alias("timed"),
            r6(F.sum(F.col("TyreLife").cast("double"))).alias("tyre_life"),
        )
    )


@query
def session_coverage(spark, sf_dir):
    df = fixture.laps(spark, sf_dir, (*fixture.TAGS, "Driver"))
    return conform.session_coverage(df, ("season", "event", "Driver"), SESSION_TYPES)


@query
def session_coverage_expected(spark, sf_dir):
    """Coverage of the calendar: the events with laps and the one after them, which has none."""
    df = land(fixture.laps(spark, sf_dir, fixture.TAGS), "tags")
    rounds = df.select("season", "round_number").distinct()
    calendar = rounds.unionByName(
        rounds.groupBy("season").agg((F.max("round_number") + 1).alias("round_number"))
    )
    event = F.concat(F.lit("GP"), F.col("round_number").cast("string")).alias("event")
    expected = calendar.select("season", event)
    return conform.session_coverage(df, ("season", "event"), SESSION_TYPES, expected)


@query
def results_conform(spark, sf_dir):
    results = fixture.results(fixture.laps(spark, sf_dir, fixture.RESULT_COLUMNS))
    raw = results.select(
        "season",
        "event",
        "round_number",
        F.col("Driver").alias("Abbreviation"),
        "TeamName",
        F.when(F.col("Position") % 10 == 0, "NC")
        .otherwise(F.concat(F.col("Position").cast("string"), F.lit(".0")))
        .alias("Position"),
        F.lit("").alias("Points"),
    )
    return conform.conform_results(raw, P).select(
        "Driver", "TeamName", "Position", "GridPosition", "Status",
        F.col("Points").cast("double").alias("Points"), "season", "event", "round_number",
    )


def _per_session(df: DataFrame) -> DataFrame:
    return df.groupBy("season", "event", "session_type").agg(F.count(F.lit(1)).alias("laps"))


@query
def replace_partitions(spark, sf_dir):
    """Silver, then the current event again with its race only: its other sessions are gone."""
    path = new_path(spark, "replace")
    silver = land(silver_laps(spark, sf_dir, LAP), "silver")
    tables.write_partitions(silver, path, ("season", "event"))
    race = silver.filter((F.col("event") == P.event) & (F.col("session_type") == "R"))
    tables.replace_partitions(race, path, {"season": P.season, "event": P.event})
    return _per_session(readers.read_table(spark, path, silver.schema))


@query
def merge_schema(spark, sf_dir):
    """Earlier rounds without, the current one with an added column."""
    path = new_path(spark, "evolved")
    laps = bronze(spark, sf_dir, (*fixture.TAGS, "TyreLife", "LapNumber"))
    current = F.col("round_number") == P.round_number
    tables.write_partitions(laps.filter(~current).drop("TyreLife"), path, ("season", "event"))
    tables.write_partitions(laps.filter(current), path, ("season", "event"))
    return tables.read_evolved(spark, path).groupBy("season", "event").agg(
        F.count(F.lit(1)).alias("laps"),
        F.count("TyreLife").alias("with_tyre_life"),
        F.sum(F.col("LapNumber").cast("long")).alias("lap_numbers"),
    )


@query
def scan_csv_mixed(spark, sf_dir):
    """Laps landed as CSV in two layouts, some records cut short: those are in quarantine, none is lost."""
    path = new_path(spark, "mixed")
    laps = bronze(spark, sf_dir, (*LAP, "TyreLife")).withColumn("session", F.col("session_type"))
    broken = F.col("row_key") % 50 == 0
    one = ["Driver", "Team", "LapNumber", "LapTime", "session_type", "season", "event", "session", "row_key"]
    other = ["event", "row_key", "LapTime", "LapNumber", "TyreLife", "session", "Driver", "season", "session_type"]
    early, late = laps.filter(F.col("round_number") <= 3), laps.filter(F.col("round_number") > 3)
    early.filter(~broken).select(one).write.option("header", True).csv(f"{path}/one")
    late.filter(~broken).select(other).write.option("header", True).csv(f"{path}/other")
    # Records of their first and last field alone. Every task writes a file under the whole header,
    # which is one name to a writer that separates by tabs.
    ends = laps.filter(broken).select(F.concat_ws(",", "Driver", "row_key").alias(",".join(one)))
    ends.write.option("header", True).option("sep", "\t").csv(f"{path}/cut")
    schema = T.StructType([*LAPS.fields, T.StructField("row_key", T.LongType())])
    landed = mixed_csv.read_csv_layouts(spark, [f"{path}/one", f"{path}/other", f"{path}/cut"], schema)
    rows = landed.rows.select(
        "row_key", "Driver", "LapNumber", "session_type", r6(F.col("LapTime").cast("double")).alias("lap_seconds"),
        r6(F.col("TyreLife").cast("double")).alias("tyre_life"), F.lit(None).cast("string").alias("reason"),
    )
    fields = F.split("record", ",")
    kept = landed.quarantine.select(F.get(fields, F.lit(1)).cast("long").alias("row_key"), F.get(fields, F.lit(0)).alias("Driver"), "reason")
    return rows.unionByName(kept, allowMissingColumns=True)


@query
def tag_constants(spark, sf_dir):
    """Landed laps of one session, which carry no tags, tagged with season, event and session."""
    laps = fixture.laps(spark, sf_dir, (*fixture.TAGS, "Driver", "row_key"))
    now = (F.col("event") == P.event) & (F.col("session_type") == "Q")
    untagged = laps.filter(now).select("Driver", "row_key")
    return conform.tag(untagged, season=P.season, event=P.event, session="Q", session_type="Q")


@query
def optional_table(spark, sf_dir):
    """Laps joined to results that are there, and to a results table not written yet."""
    laps = bronze(spark, sf_dir, LAP)
    path = new_path(spark, "results")
    conform.conform(fixture.results(laps), RESULTS).write.parquet(path)
    there = readers.result_positions(readers.read_optional(spark, path, RESULTS))
    absent = readers.result_positions(readers.read_optional(spark, f"{path}-none", RESULTS))
    df = features.join_results(features.base_laps(laps, P), there).withColumnRenamed("race_position", "position_now")
    both = features.join_results(df, absent).withColumnRenamed("race_position", "position_before")
    return both.select("row_key", "driver", "event", "position_now", "position_before")


@query
def merge_widened(spark, sf_dir):
    """Rounds stored with narrow numbers and later ones with wide ones, which no merged scan reads."""
    path = new_path(spark, "widened")
    laps = bronze(spark, sf_dir, (*fixture.TAGS, "LapTime", "LapNumber", "TyreLife", "row_key"))
    early = F.col("round_number") <= 3
    narrow = laps.filter(early).withColumns({"LapNumber": F.col("LapNumber").cast("int"), "LapTime": F.col("LapTime").cast("float")})
    wide = laps.filter(~early).withColumns({"LapNumber": F.col("LapNumber").cast("long") + (1 << 40), "LapTime": F.col("LapTime").cast("double")})
    tables.write_partitions(narrow.drop("TyreLife"), path, ("season", "event"))
    tables.write_partitions(wide, path, ("season", "event"))
    return tables.read_widened(spark, path).select(
        "row_key", "event", "LapNumber", r6("LapTime").alias("lap_seconds"), r6(F.col("TyreLife").cast("double")).alias("tyre_life")
    )


@query
def calendar_pruned_scan(spark, sf_dir):
    """Laps of the rounds that a filtered calendar names; the scan's folders are chosen at run time."""
    path = new_path(spark, "pruned")
    laps = bronze(spark, sf_dir, (*fixture.TAGS, "Driver", "LapTime"))
    tables.write_partitions(laps, path, ("season", "event"))
    calendar = laps.select("season", "event", "round_number").distinct()
    calendar.write.parquet(f"{path}-calendar")
    late = spark.read.schema(calendar.schema).parquet(f"{path}-calendar").filter(F.col("round_number") >= 6)
    return readers.read_chosen(spark, path, laps.schema, late).select(
        "event", "Driver", "session_type", r6("LapTime").alias("lap_seconds")
    )


@query
def verify_silver(spark, sf_dir):
    """All of Silver written under its checks: how many rows breach each, of how many."""
    path = new_path(spark, "verified")
    return pipeline.write_silver(silver_laps(spark, sf_dir, LAP), P, path)


@query
def verify_gold(spark, sf_dir):
    path = new_path(spark, "verified")
    stored = tables.to_storage(gold_laps(spark, sf_dir), GOLD)
    return pipeline.write_gold(stored, path)


@query
def verify_refused(spark, sf_dir):
    """Laps not cleaned are refused: what each check finds, and that nothing was stored."""
    path = new_path(spark, "refused")
    laps = clean.normalise_compound(bronze(spark, sf_dir, LAP))
    try:
        pipeline.write_silver(laps, P, path)
    except tables.BreachError as refused:
        kept = spark.read.parquet(refused.aside).count()
        return refused.report.withColumns({"rows_aside": F.lit(kept).cast("long"), "stored": F.lit(bool(tables.data_files(spark, path)))})
    raise AssertionError("laps that breach the rules were stored")


@query
def replace_where(spark, sf_dir):
    """Race counts per driver, the current event's replaced by its sprint counts."""
    path = new_path(spark, "where")
    laps = bronze(spark, sf_dir, (*fixture.TAGS, "Driver"))
    counted = laps.groupBy("season", "event", "session_type", "Driver").agg(
        F.count(F.lit(1)).alias("laps")
    )
    now = (F.col("season") == P.season) & (F.col("event") == P.event)
    counted.filter(F.col("session_type") == "R").write.parquet(path)
    tables.replace_where(spark, path, counted.filter(now & (F.col("session_type") == "S")), now, counted.schema)
    return readers.read_table(spark, path, counted.schema)


@query
def partition_pruned_scan(spark, sf_dir):
    path = new_path(spark, "pruned")
    laps = fixture.laps(spark, sf_dir, (*fixture.TAGS, "Driver", "LapTime"))
    tables.write_partitions(laps, path, ("season", "event"))
    where = (F.col("season") == P.season) & (F.col("event") == P.event)
    return readers.read_table(spark, path, laps.schema, where).select(
        "Driver", "session_type", r6("LapTime").alias("lap_seconds")
    )


# Cleaning and quality


@query
def drop_critical_nulls(spark, sf_dir):
    return rounded(clean.drop_critical_nulls(fixture.laps(spark, sf_dir, LAP), CRITICAL), "LapTime")


@query
def cast_lap_number(spark, sf_dir):
    df = fixture.laps(spark, sf_dir, ("row_key", "LapNumber"))
    text = F.when(F.col("LapNumber") == 7, "in lap").otherwise(F.col("LapNumber").cast("string"))
    return clean.cast_lap_number(df.withColumn("LapNumber", text))


@query
def normalise_compound(spark, sf_dir):
    return clean.normalise_compound(fixture.laps(spark, sf_dir, ("row_key", "Compound")))


@query
def session_best(spark, sf_dir):
    return rounded(clean.session_best(bronze(spark, sf_dir, TIMED)), "LapTime", "session_best")


@query
def rule_107(spark, sf_dir):
    return rounded(clean.filter_outlier_laps(bronze(spark, sf_dir, TIMED)), "LapTime")


@query
def silver(spark, sf_dir):
    return rounded(silver_laps(spark, sf_dir, LAP), "LapTime")


@query
def row_loss(spark, sf_dir):
    return quality.row_loss(bronze(spark, sf_dir, LAP), P)


@query
def breach_count(spark, sf_dir):
    """On Bronze, where the rule is breached; on Silver the count is 0."""
    return quality.breach_count(bronze(spark, sf_dir, TIMED))


@query
def breach_count_silver(spark, sf_dir):
    return quality.breach_count(land(silver_laps(spark, sf_dir, LAP), "silver"))


@query
def count_by_session(spark, sf_dir):
    return quality.count_by(fixture.laps(spark, sf_dir, fixture.TAGS), "session_type")


@query
def count_by_round_session(spark, sf_dir):
    df = fixture.laps(spark, sf_dir, fixture.TAGS)
    return quality.count_by(df, "round_number", "event", "session_type")


@query
def null_counts(spark, sf_dir):
    return quality.null_counts(fixture.laps(spark, sf_dir), (*CRITICAL, "Compound"))


@query
def null_rates(spark, sf_dir):
    return quality.null_rates(gold_laps(spark, sf_dir), (*FEATURES, "race_position"))


@query
def distinct_compounds(spark, sf_dir):
    laps = fixture.laps(spark, sf_dir, ("Compound",))
    return quality.distinct_values(clean.normalise_compound(laps), "Compound")


@query
def sessions_used(spark, sf_dir):
    return quality.distinct_values(silver_laps(spark, sf_dir, LAP), "event", "session_type")


# Features


@query
def lap_time_delta(spark, sf_dir):
    df = features.lap_time_delta(base(spark, sf_dir, LAP))
    return rounded(df.select("row_key", "driver", "session_type", "lap_time_delta"), "lap_time_delta")


@query
def consistency_score(spark, sf_dir):
    df = features.consistency_score(base(spark, sf_dir, LAP))
    return rounded(df.select("row_key", "driver", "session_type", "consistency_score"), "consistency_score")


@query
def best_sector_combo(spark, sf_dir):
    df = features.best_sector_combo(base(spark, sf_dir))
    return rounded(df.select("row_key", "driver", "session_type", "best_sector_combo"), "best_sector_combo")


@query
def tyre_deg_rate(spark, sf_dir):
    df = features.tyre_deg_rate(base(spark, sf_dir))
    return rounded(df.select("row_key", "driver", "compound", "tyre_deg_rate"), "tyre_deg_rate")


@query
def pace_vs_teammate(spark, sf_dir):
    df = features.pace_vs_teammate(base(spark, sf_dir, LAP))
    return rounded(df.select("row_key", "driver", "team", "pace_vs_teammate"), "pace_vs_teammate")


@query
def round_avg_delta(spark, sf_dir):
    df = features.lap_time_delta(base(spark, sf_dir, LAP))
    return rounded(features.round_avg_delta(df, P.season, P.round_number), "avg_delta")


@query
def pace_trend(spark, sf_dir):
    df = features.lap_time_delta(base(spark, sf_dir, LAP))
    return rounded(features.pace_trend(df, P.season, P.round_number), "pace_trend")


@query
def pace_trend_state(spark, sf_dir):
    """The same trend from a table of round states, written round by round."""
    path = new_path(spark, "pace")
    df = land(features.lap_time_delta(base(spark, sf_dir, LAP)), "deltas")
    for number in range(1, P.round_number):
        now = df.filter((F.col("season") == P.season) & (F.col("round_number") == number))
        where = {"season": P.season, "round_number": number}
        tables.replace_partitions(features.pace_state(now), path, where)
    states = readers.read_table(spark, path, PACE)
    return rounded(features.trend_from_state(states, P.season, P.round_number), "pace_trend")


@query
def pace_trend_joined(spark, sf_dir):
    df = features.lap_time_delta(base(spark, sf_dir, LAP))
    trend = features.pace_trend(df, P.season, P.round_number)
    now = (F.col("season") == P.season) & (F.col("event") == P.event)
    out = features.join_pace_trend(df.filter(now), trend)
    return rounded(out.select("row_key", "driver", "season", "pace_trend"), "pace_trend")


@query
def label_join(spark, sf_dir):
    laps = bronze(spark, sf_dir, LAP)
    positions = readers.result_positions(fixture.results(laps))
    df = features.join_results(features.base_laps(clean.silver(laps, P), P), positions)
    return df.select("row_key", "season", "event", "driver", "race_position")


@query
def gold(spark, sf_dir):
    """All stored columns; the weights are placeholders until training."""
    return rounded(gold_laps(spark, sf_dir, row_key=True), *FEATURES)


# Weights and training frame


def _weighted_columns(df: DataFrame, weight: str) -> DataFrame:
    return rounded(df.select("row_key", "round_number", "session_type", weight), weight)


@query
def session_weight(spark, sf_dir):
    df = fixture.laps(spark, sf_dir, (*fixture.TAGS, "row_key"))
    return _weighted_columns(weights.session_weight(df), "session_weight")


@query
def recency_weight(spark, sf_dir):
    df = bronze(spark, sf_dir, (*fixture.TAGS, "row_key"))
    return _weighted_columns(weights.recency_weight(df, P.recency_lambda), "recency_weight")


@query
def sample_weight(spark, sf_dir):
    df = bronze(spark, sf_dir, (*fixture.TAGS, "row_key"))
    return _weighted_columns(weights.sample_weight(df, P), "sample_weight")


@query
def weight_audit(spark, sf_dir):
    train = model.labelled(landed_gold(spark, sf_dir, "lap_time_delta"))
    return weights.weight_audit(weights.sample_weight(train, P))


@query
def impute_numeric(spark, sf_dir):
    df = model.impute_numeric(gold_laps(spark, sf_dir, label=False, row_key=True))
    return rounded(df.select("row_key", *FEATURES), *FEATURES)


@query
def impute_label(spark, sf_dir):
    df = gold_laps(spark, sf_dir, "lap_time_delta", row_key=True)
    return model.impute_label(df).select("row_key", "driver", "race_position")


@query
def labelled_rows(spark, sf_dir):
    df = model.labelled(gold_laps(spark, sf_dir, "lap_time_delta", row_key=True))
    return df.select("row_key", "driver", "event", "race_position")


@query
def predicate_filters(spark, sf_dir):
    """Race laps of earlier rounds on known compounds."""
    laps = clean.normalise_compound(fixture.laps(spark, sf_dir, LAP))
    return rounded(
        laps.filter(
            (F.col("season") == P.season)
            & (F.col("round_number") < P.round_number)
            & (F.col("session_type") == "R")
            & (F.col("Compound") != "UNKNOWN")
            & F.col("LapTime").isNotNull()
        ),
        "LapTime",
    )


@query
def model_version(spark, sf_dir):
    return model.model_version(gold_laps(spark, sf_dir, "lap_time_delta"))


@query
def temporal_split(spark, sf_dir):
    df = model.temporal_split(model.labelled(landed_gold(spark, sf_dir, "lap_time_delta")))
    return df.groupBy("split", "round_number").agg(F.count(F.lit(1)).alias("row_count"))


# Exploration


@query
def feature_summary(spark, sf_dir):
    df = explore.feature_summary(model.labelled(landed_gold(spark, sf_dir)), exact=True)
    return rounded(df, "mean", "stddev", "min", "p25", "p75", "max")


@query
def feature_summary_approx(spark, sf_dir):
    """Merged from a state per round; counts and moments are exact, quartiles within a stated rank error."""
    labelled = land(model.labelled(gold_laps(spark, sf_dir)), "labelled")
    states = land(explore.summary_state(labelled, ["round_number"]), "states")
    summary = land(explore.summary_of_states(states), "summary")
    off = explore.rank_errors(labelled, summary)
    near = {f"{q}_within_error": F.coalesce(F.col(f"{q}_off") <= explore.RANK_ERROR, F.lit(False)) for q in explore.QUARTILES}
    df = summary.join(F.broadcast(off), "feature", "left").withColumns(near)
    return rounded(df.select("feature", "n", "mean", "stddev", "min", "max", *near), "mean", "stddev", "min", "max")


@query
def session_profile(spark, sf_dir):
    return explore.session_profile(gold_laps(spark, sf_dir, *SCORE, "tyre_deg_rate", label=False))


@query
def driver_leaders(spark, sf_dir):
    gold_df = gold_laps(spark, sf_dir, *SCORE, label=False)
    return explore.driver_leaders(gold_df.filter(F.col("event") == P.event))


@query
def race_leaders(spark, sf_dir):
    gold_df = gold_laps(spark, sf_dir, "lap_time_delta", "consistency_score", "tyre_deg_rate")
    return explore.race_leaders(gold_df.filter(F.col("event") == P.event))


@query
def teammate_gap(spark, sf_dir):
    return explore.teammate_gap(gold_laps(spark, sf_dir, "pace_vs_teammate"))


@query
def compound_effect(spark, sf_dir):
    wanted = ("lap_time_delta", "tyre_deg_rate")
    return explore.compound_effect(gold_laps(spark, sf_dir, *wanted, label=False))


@query
def trend_leaders(spark, sf_dir):
    return explore.trend_leaders(gold_laps(spark, sf_dir, "pace_trend", label=False))


@query
def feature_corr(spark, sf_dir):
    race = model.labelled(gold_laps(spark, sf_dir)).filter(F.col("session_type") == "R")
    return rounded(explore.feature_corr(race), "r")


@query
def feature_corr_by_session(spark, sf_dir):
    done = model.labelled(gold_laps(spark, sf_dir))
    return rounded(explore.feature_corr(done, by=["session_type"], min_n=10), "r")


@query
def top_n(spark, sf_dir):
    leaders = explore.driver_leaders(gold_laps(spark, sf_dir, *SCORE, label=False))
    return explore.top_n(leaders, [F.col("avg_lap_delta"), F.col("driver")], 20)


# Ranking


@query
def driver_prediction(spark, sf_dir):
    df = rank.driver_prediction(scored_laps(gold_laps(spark, sf_dir, *SCORE, label=False, row_key=True)))
    return rounded(df, "win_probability")


@query
def normalise_share(spark, sf_dir):
    df = rank.driver_prediction(scored_laps(gold_laps(spark, sf_dir, *SCORE, label=False, row_key=True)))
    shares = rank.normalise_share(df)
    return rounded(shares.select(*rank.DRIVER, "win_probability"), "win_probability")


@query
def rank_drivers(spark, sf_dir):
    df = ranked(scored_laps(gold_laps(spark, sf_dir, *SCORE, label=False, row_key=True)))
    return rounded(df.drop("common_position", "lap_count"), "win_probability")


@query
def subsample_uncertainty(spark, sf_dir):
    return rounded(uncertainty_of(scored_laps(gold_laps(spark, sf_dir, *SCORE, label=False, row_key=True))), "uncertainty")


def _with_uncertainty(gold_df: DataFrame) -> DataFrame:
    scored = scored_laps(gold_df)
    return rank.join_uncertainty(ranked(scored), uncertainty_of(scored))


@query
def uncertainty_join(spark, sf_dir):
    df = _with_uncertainty(landed_gold(spark, sf_dir, *SCORE, label=False, row_key=True))
    return rounded(
        df.select(*rank.DRIVER, "win_probability", "uncertainty"), "win_probability", "uncertainty"
    )


@query
def uncertainty_band(spark, sf_dir):
    """Bands of the uncertainty relative to the driver's own win share."""
    df = _with_uncertainty(landed_gold(spark, sf_dir, *SCORE, label=False, row_key=True))
    relative = df.withColumn("uncertainty", r6(F.col("uncertainty") / F.col("win_probability")))
    return rank.uncertainty_band(relative.select(*rank.DRIVER, "uncertainty"))


@query
def prediction_rows(spark, sf_dir):
    gold_df = landed_gold(spark, sf_dir, *SCORE, label=False, row_key=True)
    current = gold_df.filter(F.col("event") == P.event)
    df = rank.prediction_rows(_with_uncertainty(current), P, "base_r07").drop("generated_at")
    return rounded(df, "win_probability", "uncertainty")


@query
def session_scores(spark, sf_dir):
    df = rank.session_scores(gold_laps(spark, sf_dir, "lap_time_delta", label=False), P)
    return rounded(df, *[f"score_{s}" for s in P.scored_sessions])


@query
def winner_history(spark, sf_dir):
    gold_df = landed_gold(spark, sf_dir, *SCORE, row_key=True)
    return rank.winner_history(season_predictions(gold_df), gold_df, P.season)


@query
def season_accuracy(spark, sf_dir):
    gold_df = landed_gold(spark, sf_dir, *SCORE, row_key=True)
    return rank.season_accuracy(
        rank.winner_history(season_predictions(gold_df), gold_df, P.season)
    )


def _finishers(spark, sf_dir) -> DataFrame:
    gold_df = landed_gold(spark, sf_dir, *SCORE, row_key=True)
    places = gold_df.select(*rank.DRIVER, "race_position").distinct()
    return attach(ranked(scored_laps(gold_df)), places, rank.DRIVER)


@query
def exact_accuracy(spark, sf_dir):
    df = _finishers(spark, sf_dir)
    return rounded(model.exact_accuracy(df, "predicted_position", "race_position"), "exact_accuracy")


@query
def within_k_accuracy(spark, sf_dir):
    df = _finishers(spark, sf_dir)
    return rounded(
        model.within_k_accuracy(df, "predicted_position", "race_position", 2), "within_2_accuracy"
    )


@query
def top3_summary(spark, sf_dir):
    df = rank.normalise_share(rank.driver_prediction(scored_laps(gold_laps(spark, sf_dir, *SCORE, label=False, row_key=True))))
    top = rank.top3_summary(df).select(*rank.DRIVER, "team", "win_probability", "place", "label")
    return rounded(top, "win_probability")


@query
def recency_table(spark, sf_dir):
    df = bronze(spark, sf_dir, fixture.TAGS)
    return rounded(rank.recency_table(df, P.recency_lambda), "decay")


def _corr_as_importance(gold_df: DataFrame) -> DataFrame:
    """Size of the correlation with the result: an importance any engine can compute."""
    corr = explore.feature_corr(model.labelled(gold_df))
    return corr.select(
        "feature", r6(F.abs(F.coalesce("r", F.lit(0.0)))).alias("importance"), F.lit(True).alias("exported")
    )


@query
def relative_importance(spark, sf_dir):
    table = land(_corr_as_importance(gold_laps(spark, sf_dir)), "importance")
    return rounded(rank.relative_importance(table).drop("exported"), "relative")


# Export


def _event_entries(gold_df: DataFrame) -> DataFrame:
    current = gold_df.filter(F.col("event") == P.event)
    return export.export_entries(
        _with_uncertainty(current), rank.session_scores(current, P), P
    )


@query
def export_lines(spark, sf_dir):
    """Fields read back out of the exported JSON lines."""
    gold_df = landed_gold(spark, sf_dir, *SCORE, label=False, row_key=True)
    lines = export.export_lines(_event_entries(gold_df))

    def at(field: str) -> Column:
        return F.get_json_object("value", f"$.{field}")

    return lines.select(
        "event",
        at("driver").alias("driver"),
        at("predicted_position").cast("int").alias("predicted_position"),
        at("win_probability").cast("double").alias("win_probability"),
        at("trend").alias("trend"),
        at("sessions.Q.score").cast("double").alias("q_score"),
        at("sessions.Q.weight").cast("double").alias("q_weight"),
    )


def _written_document(spark, sf_dir) -> tuple[DataFrame, T.DataType]:
    """The lines of the document's written parts, and the type of a driver's entry."""
    gold_df = landed_gold(spark, sf_dir, row_key=True)
    history = rank.winner_history(season_predictions(gold_df), gold_df, P.season)
    entries = land(_event_entries(gold_df), "entries")
    parts = export.document_parts(
        entries,
        gold_df.filter(F.col("event") == P.event).select("session_type"),
        land(_corr_as_importance(gold_df), "importance"),
        land(history, "history"),
        P,
        "base_r07",
    )
    path = new_path(spark, "document")
    export.write_parts(parts, path)
    return spark.read.text(path), entries.schema["entry"].dataType


DRIVER_LINE = r'^,?\{"driver"'
# Fields of the document's first and last line that its query shows.
HEAD = (
    "model_version string, event string, round int, season int, sessions_used array<string>, "
    "season_accuracy struct<top3_pct: double, races: bigint>, recency_lambda double"
)
FOOT = "feature_importance array<struct<feature: string>>, history array<struct<event: string>>"


@query
def export_document(spark, sf_dir):
    """The document's scalar fields, read back out of its written parts; no row holds the drivers."""
    lines, kind = _written_document(spark, sf_dir)
    is_driver = F.col("value").rlike(DRIVER_LINE)
    entry = F.from_json(F.regexp_replace("value", "^,", ""), kind)
    one = F.when(is_driver, entry)
    first = F.regexp_replace("value", r',"predictions":\[$', "}")
    last = F.regexp_replace("value", r"^\],", "{")
    whole = lines.select(
        one.alias("e"),
        F.when(F.col("value").startswith("{") & ~is_driver, first).alias("first"),
        F.when(F.col("value").startswith("]"), last).alias("last"),
    ).agg(
        F.from_json(F.max("first"), HEAD).alias("d"),
        F.from_json(F.max("last"), FOOT).alias("f"),
        F.count("e.driver").alias("drivers"),
        F.min_by(
            F.struct("e.driver", "e.win_probability"), F.col("e.predicted_position")
        ).alias("top"),
    )
    return whole.select(
        "d.model_version",
        "d.event",
        "d.round",
        "d.season",
        F.array_join("d.sessions_used", ",").alias("sessions_used"),
        F.col("d.season_accuracy.top3_pct").alias("top3_pct"),
        F.col("d.season_accuracy.races").alias("races"),
        F.col("d.recency_lambda").alias("recency_lambda"),
        "drivers",
        F.col("top.driver").alias("winner"),
        F.col("top.win_probability").alias("top_probability"),
        F.get("f.feature_importance", F.lit(0))["feature"].alias("top_feature"),
        F.size("f.history").cast("long").alias("history_rows"),
    )


@query
def export_document_entries(spark, sf_dir):
    """The drivers of the document, read back out of its written parts."""
    lines, kind = _written_document(spark, sf_dir)
    entry = F.from_json(F.regexp_replace("value", "^,", ""), kind)
    return (
        lines.filter(F.col("value").rlike(DRIVER_LINE))
        .select(entry.alias("e"))
        .select("e.driver", "e.team", "e.predicted_position", "e.win_probability")
    )


@query
def compound_index(spark, sf_dir):
    """The number each compound gets, by frequency and then name."""
    gold_df = landed_gold(spark, sf_dir, "lap_time_delta", label=False)
    stage = model.feature_stages()[0].fit(gold_df)
    found = stage.transform(gold_df).groupBy("compound", "compound_idx")
    return found.agg(F.count(F.lit(1)).alias("laps"))


@query
def label_index(spark, sf_dir):
    """The class each finishing position gets, by frequency and then as text."""
    # Which laps are labelled, and how, hangs on no feature.
    only = ("lap_time_delta",)
    train = model.training_frame(landed_gold(spark, sf_dir, *only), P, only)
    found = model.index_labels(train).transform(train).groupBy("position", "label")
    return found.agg(F.count(F.lit(1)).alias("laps"))


# Learning


@dataclass(frozen=True)
class Season:
    """Training frame of the season with class and compound numbers, and what these stand for."""

    gold: DataFrame
    train: DataFrame
    labels: tuple[str, ...]
    compounds: model.StringIndexerModel

    def numbered(self, laps: DataFrame) -> DataFrame:
        return self.compounds.transform(model.impute_numeric(laps))

    def now(self) -> DataFrame:
        return self.gold.filter(F.col("event") == P.event)


# What fits, trees and reports read of a training row.
TRAINED = ("lap", "row_key", "driver", "compound", "position", "split", "sample_weight", "label", *model.INPUTS)


def season(spark: SparkSession, sf_dir: str) -> Season:
    # Two laps may have the same row key.
    laps = gold_laps(spark, sf_dir, row_key=True, field=True).withColumn("lap", F.monotonically_increasing_id())
    gold_df = land(laps, "gold")
    # The numbers are learned from two columns; only the frame that has them is landed.
    train = model.training_frame(gold_df, P)
    indexer = model.index_labels(train)
    compounds = model.feature_stages()[0].fit(train)
    numbered = land(compounds.transform(indexer.transform(train)).select(*TRAINED), "numbered")
    return Season(gold_df, numbered, tuple(indexer.labels), compounds)


# Levels of the tree that SQL grows as well.
TREE_DEPTH = 2


def grown(s: Season, rows: DataFrame) -> DataFrame:
    return trees.grow(rows, model.INPUTS, len(s.labels), TREE_DEPTH)


def _input_name(number: Column) -> Column:
    return F.get(F.array(*[F.lit(c) for c in model.INPUTS]), number)


def _walked(s: Season, nodes: DataFrame, laps: DataFrame, *keys: str) -> DataFrame:
    """Laps with the probabilities of a tree's classes and the likeliest of these."""
    six = laps.withColumns({c: r6(c) for c in model.INPUTS})
    walked = trees.walk(six.select("lap", *keys, *model.INPUTS), nodes, model.INPUTS, TREE_DEPTH)
    shares = trees.class_shares(walked, nodes, ["lap", *keys, "node"], len(s.labels))
    return shares.withColumn("pred_pos_lap", model.position_of(trees.likeliest(F.col("probability")), s.labels))


@query
def feature_vector(spark, sf_dir):
    """The learner's input per training row, read back out of the assembled vector."""
    s = season(spark, sf_dir)
    vector = vector_to_array(F.col("features"))
    row = model.feature_stages()[1].transform(s.train).select("row_key", vector.alias("v"))
    return row.select("row_key", *[r6(F.get("v", F.lit(k))).alias(c) for k, c in enumerate(model.INPUTS)])


@query
def class_to_position(spark, sf_dir):
    """Stand-in class numbers, one of them beyond the classes, as finishing positions."""
    s = season(spark, sf_dir)
    number = (F.col("row_key") % (len(s.labels) + 1)).cast("int")
    laps = s.train.select("row_key", number.alias("class"))
    return laps.withColumn("position", model.position_of(F.col("class"), s.labels))


@query
def win_slot(spark, sf_dir):
    """The win probability out of stand-in probabilities of all classes."""
    s = season(spark, sf_dir)
    shares = [((F.col("row_key") + 7919 * k) % 1000) / F.lit(1000.0) for k in range(len(s.labels))]
    laps = s.now().select("row_key", F.array(*shares).alias("probability"))
    return model.win_probability(laps, s.labels).select("row_key", r6("win_prob_lap").alias("win_prob_lap"))


@query
def grown_tree(spark, sf_dir):
    """Splits found in histograms of all training rows, weighted by recency and session."""
    s = season(spark, sf_dir)
    weight = F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
    position = model.position_of(trees.likeliest(F.col("stats")), s.labels)
    return grown(s, s.train).select(
        "node", _input_name(F.col("feature")).alias("feature"), r6("threshold").alias("threshold"), r6("gain").alias("gain"),
        r6(weight).alias("weight"), position.alias("position"),
    )


@query
def tree_walk(spark, sf_dir):
    """Laps of the current event walked down the grown tree: where they end, win share, position."""
    s = season(spark, sf_dir)
    walked = _walked(s, grown(s, s.train), s.numbered(s.now()), "row_key", "driver")
    won = model.win_probability(walked, s.labels)
    return rounded(won.select("row_key", "driver", "node", "win_prob_lap", "pred_pos_lap"), "win_prob_lap")


@query
def tree_importance(spark, sf_dir):
    s = season(spark, sf_dir)
    return rounded(trees.importances(grown(s, s.train), model.INPUTS), "importance")


@query
def holdout_rows(spark, sf_dir):
    """Laps of the latest round next to what a tree grown on the earlier rounds says of them."""
    s = season(spark, sf_dir)
    nodes = grown(s, s.train.filter("split = 'fit'"))
    scored = _walked(s, nodes, s.train.filter("split = 'holdout'"), "row_key", "driver", "position")
    return model.holdout_rows(scored, "row_key", "driver")


@query
def model_round_trip(spark, sf_dir):
    """Fit, save, resolve, load and score: each lap scored as without saving, from the named version."""
    s = season(spark, sf_dir)
    fitted = model.fit(s.train.drop("label", "compound_idx"), CHECKED, evaluate=False)
    root = new_path(spark, "models")
    model.save_model(fitted, root, "base_r07")
    version, path = model.resolve_model(spark, root, P.round_number)
    loaded = model.load_model(path)
    laps = model.impute_numeric(s.now())

    def scored(m: model.Fitted, name: str) -> DataFrame:
        out = model.win_probability(model.score(m.model, laps, m.labels), m.labels)
        return out.select("lap", "row_key", F.struct("win_prob_lap", "pred_pos_lap").alias(name))

    both = scored(fitted, "before").join(scored(loaded, "after").drop("row_key"), "lap")
    return both.select("row_key", F.lit(version).alias("model_version"), (F.col("before") == F.col("after")).alias("same"))


# The saved forest's table against the library's own model: fewer trees than the season's model has.
CHECKED = replace(P, trees=20)


def _saved_forest(s: Season, spark: SparkSession) -> tuple[model.Fitted, DataFrame]:
    fitted = model.fit(s.train.drop("label", "compound_idx"), CHECKED, evaluate=False)
    path = model.save_model(fitted, new_path(spark, "models"), "base_r07")
    return fitted, trees.saved_nodes(spark, path)


@query
def forest_walk(spark, sf_dir):
    """A saved forest's node table walked by joins; each lap compared with the model itself."""
    s = season(spark, sf_dir)
    fitted, nodes = _saved_forest(s, spark)
    laps = s.numbered(s.now()).select("lap", "row_key", "driver", *model.INPUTS)
    walked = trees.walk(laps, nodes, model.INPUTS, CHECKED.depth)
    shares = trees.class_shares(walked, nodes, ["lap", "row_key", "driver"], len(s.labels))
    mine = model.win_probability(
        shares.withColumn("position", model.position_of(trees.likeliest(F.col("probability")), s.labels)), s.labels
    ).withColumnRenamed("win_prob_lap", "win")
    theirs = model.score(fitted.model, model.impute_numeric(s.now()), fitted.labels)
    theirs = model.win_probability(theirs, fitted.labels).select(
        "lap", vector_to_array("probability").alias("p"), "win_prob_lap", "pred_pos_lap"
    )
    apart = F.aggregate(
        F.zip_with("p", "probability", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda a, x: F.greatest(a, x)
    )
    return mine.join(theirs, "lap").select(
        "row_key", "driver", F.size("probability").alias("classes"),
        (apart < 1e-9).alias("same_probabilities"),
        (F.abs(F.col("win") - F.col("win_prob_lap")) < 1e-9).alias("same_win_probability"),
        # Of classes equally likely to nine digits either may be named.
        ((F.col("position") == F.col("pred_pos_lap")) | (_gap("p") < 1e-9)).alias("same_position"),
    )


def _gap(shares: str) -> Column:
    """How far the likeliest class is ahead of the next."""
    ordered = F.sort_array(shares, asc=False)
    return F.get(ordered, F.lit(0)) - F.get(ordered, F.lit(1))


@query
def forest_importance(spark, sf_dir):
    """Importances added up from the saved nodes, compared with those that the model reports."""
    s = season(spark, sf_dir)
    fitted, nodes = _saved_forest(s, spark)
    own = trees.importances(nodes, model.INPUTS).withColumnRenamed("importance", "from_nodes")
    both = own.join(model.importance_table(spark, fitted.model), "feature")
    return both.select("feature", "exported", (F.abs(F.col("from_nodes") - F.col("importance")) < 1e-9).alias("same"))


@query
def baseline_gradient(spark, sf_dir):
    """Gradient of the baseline's loss per class: at equal probabilities, and whether it is nothing when fitted."""
    s = season(spark, sf_dir)
    fitted = model.fit(s.train.drop("label", "compound_idx"), P, "logistic", evaluate=False)
    *_, learner = fitted.model.stages
    scored = learner.transform(fitted.model.stages[1].transform(s.train))
    scored = scored.withColumn("probability", vector_to_array("probability"))
    six = s.train.withColumns({c: r6(c) for c in model.INPUTS})
    even = six.withColumn("probability", F.array(*[F.lit(1.0 / len(s.labels))] * len(s.labels)))
    start = model.logistic_gradient(even, model.INPUTS)
    loss = model.logistic_gradient(scored, model.INPUTS)
    price = model.penalty_gradient(spark, fitted, s.train, model.INPUTS)
    price = price.select("class", *[F.col(c).alias(f"_{c}") for c in model.INPUTS])
    rest = [F.abs(F.col(c) + F.col(f"_{c}")) for c in model.INPUTS]
    done = loss.join(price, "class").select("class", (F.greatest(F.abs("intercept"), *rest) < GRADIENT_LEFT).alias("converged"))
    named = start.join(done, "class").withColumn("position", model.position_of(F.col("class"), s.labels))
    return rounded(named.drop("class"), "intercept", *model.INPUTS)


# What a hundred iterations leave of the gradient, in units of an input's mean.
GRADIENT_LEFT = 0.01


# Fits themselves. No SQL equivalent; row counts and invariants are tested instead.


def _train(spark, sf_dir, kind: str) -> tuple[model.Fitted, DataFrame]:
    """One fit on all labelled rounds; nothing here looks at a holdout."""
    gold_df = landed_gold(spark, sf_dir, row_key=True, field=True)
    train = land(model.training_frame(gold_df, P), "train")
    return model.fit(train, P, kind, evaluate=False), gold_df


@query
def train_score(spark, sf_dir):
    """Forest fitted on the season; the current event scored and ranked."""
    fitted, gold_df = _train(spark, sf_dir, "forest")
    current = model.impute_numeric(gold_df.filter(F.col("event") == P.event))
    scored = model.win_probability(
        model.score(fitted.model, current, fitted.labels), fitted.labels
    ).select(*rank.DRIVER, "team", "row_key", "win_prob_lap", "pred_pos_lap")
    scored = land(scored, "scored")
    return rank.join_uncertainty(ranked(scored), uncertainty_of(scored))


@query
def holdout_evaluation(spark, sf_dir):
    """Forest against the logistic baseline, both fitted on the earlier rounds."""
    train = land(model.training_frame(landed_gold(spark, sf_dir, field=True), P), "train")
    forest = model.fit(train, P, "forest", refit=False)
    logistic = model.fit(train, P, "logistic", refit=False)
    return model.evaluation(forest, "forest").unionByName(model.evaluation(logistic, "logistic"))


@query
def feature_importance(spark, sf_dir):
    fitted, _ = _train(spark, sf_dir, "forest")
    return model.importance_table(spark, fitted.model)


@query
def train_baseline(spark, sf_dir):
    """Logistic baseline; its win probability per driver of the current event."""
    fitted, gold_df = _train(spark, sf_dir, "logistic")
    current = model.impute_numeric(gold_df.filter(F.col("event") == P.event))
    scored = model.win_probability(
        model.score(fitted.model, current, fitted.labels), fitted.labels
    ).select(*rank.DRIVER, "team", "win_prob_lap", "pred_pos_lap")
    return ranked(scored)
