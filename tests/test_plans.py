"""The physical plans are the intended ones: pruning, pushdown, no windows over laps, no UDFs."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from gridcast.operators import clean, explore, features, quality, rank, weights
from gridcast.store import land
from gridcast.params import Params
from gridcast.plans import queries as Q
from gridcast.sinks import tables
from gridcast.sources import fixture, readers

SF = "/root/testdata/sf0.001"
P = Params(2026, "GP7", 7)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scan_of(text: str, folder: str) -> list[str]:
    return [line for line in text.splitlines() if "FileScan" in line and folder in line]


@pytest.fixture(scope="module")
def bronze(spark):
    return Q.bronze(spark, SF)


@pytest.fixture(scope="module")
def gold(spark, bronze):
    return land(features.gold(clean.silver(bronze, P), P), "gold")


def test_only_needed_tables_are_joined(spark):
    counts = plan(quality.count_by(fixture.laps(spark, SF, fixture.TAGS), "session_type"))
    assert "part.parquet" not in counts and "supplier.parquet" not in counts
    scan = scan_of(counts, "lineitem.parquet")[0]
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_linestatus:string>" in scan


def test_silver_shuffles_no_laps(bronze):
    text = plan(clean.silver(bronze, P))
    assert "Exchange hashpartitioning" not in text and "Window" not in text
    assert "BroadcastHashJoin" in text
    assert "PushedFilters: [IsNotNull(LapTime)]" in text


def test_gold_shuffles_no_laps(bronze):
    """The only shuffles are of the statistics; laps go from scan to output."""
    text = plan(features.gold(clean.silver(bronze, P), P))
    laps = text[text.index("BroadcastHashJoin") :].split("BroadcastExchange")[0]
    assert "FileScan parquet" in laps and "Exchange" not in laps.replace("BroadcastExchange", "")
    # Laps are scanned once, above all windows; those sit on the statistics table.
    assert len(scan_of(text, "bronze-")) == 1 and len(scan_of(text, "lap-statistics-")) > 1
    assert text.index("bronze-") < text.index("Window")


def test_wanted_features_prune_the_work(bronze):
    text = plan(features.gold(clean.silver(bronze, P), P, features=("lap_time_delta",)))
    assert "Sector1Time" not in text and "TyreLife" not in text


def test_partition_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(2026, "A", 1), (2026, "B", 2)], "season int, event string, n int")
    tables.write_partitions(df, path, ("season", "event"))
    where = (F.col("season") == 2026) & (F.col("event") == "A")
    text = plan(readers.read_table(spark, path, df.schema, where))
    assert re.search(r"PartitionFilters: \[.*event#\d+ = A", text)


def test_correlations_are_one_aggregation(gold):
    text = plan(explore.feature_corr(gold, by=["session_type"], min_n=10))
    assert len(scan_of(text, "gold-")) == 1 and text.count("Exchange") == 1


def test_pace_trend_is_one_shuffle(gold):
    text = plan(features.pace_trend(gold, 2026, 7))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
    assert "GreaterThanOrEqual(round_number,1), LessThanOrEqual(round_number,6)" in text


def test_recency_needs_no_collect_and_no_cross_join(gold):
    text = plan(weights.recency_weight(gold, 0.15))
    assert "Subquery" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_top_n_is_not_a_sort(gold):
    text = plan(explore.top_n(gold, [F.col("lap_time_delta"), F.col("driver")], 5))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_top3_keeps_three_per_task_before_the_shuffle(spark):
    df = spark.range(100).select(
        (F.col("id") % 2).alias("season"),
        (F.col("id") % 3).alias("event"),
        F.col("id").cast("string").alias("driver"),
        (F.col("id") / 7).alias("win_probability"),
    )
    text = plan(rank.top3_summary(df))
    assert text.count("WindowGroupLimit") == 2


def test_subsamples_do_not_repeat_rows(gold, spark):
    scored = gold.withColumn("win_prob_lap", F.lit(0.5)).withColumn("key", F.lit(1).cast("long"))
    text = plan(rank.subsample_uncertainty(scored, 20, 0.8, F.col("key")))
    assert "Generate" not in text and "Expand" not in text


@pytest.mark.parametrize("name", ["gold", "driver_leaders", "feature_corr", "rank_drivers", "session_scores"])
def test_no_python_and_no_cross_products(spark, name):
    text = plan(Q.QUERIES[name](spark, SF))
    for word in ("Python", "Pandas", "NestedLoop", "Cartesian", "SinglePartition"):
        assert word not in text or (word == "SinglePartition" and name == "feature_corr")


def test_document_query_gathers_no_drivers(spark):
    text = plan(Q.QUERIES["export_document"](spark, SF))
    assert "collect_list" not in text and "partial_count" in text


def test_numbers_of_compounds_and_labels_need_no_feature(spark, monkeypatch):
    """Neither the sectors nor the tyre life that other features are made of are landed."""
    seen = []
    bronze = Q.bronze
    monkeypatch.setattr(Q, "bronze", lambda spark, sf_dir, columns: seen.append(columns) or bronze(spark, sf_dir, columns))
    for name in ("compound_index", "label_index"):
        assert Q.QUERIES[name](spark, SF).count()
    assert len(seen) == 2 and not {"TyreLife", "Sector1Time"} & {c for columns in seen for c in columns}


def test_a_record_ranks_three_drivers_an_event(gold, monkeypatch):
    """The season's record numbers no whole fields."""
    monkeypatch.setattr(rank, "number_rows", lambda *_, **__: pytest.fail("all drivers were numbered"))
    found = Q.season_predictions(gold.withColumn("row_key", F.monotonically_increasing_id()))
    assert found.groupBy("season", "event").count().agg(F.max("count")).first()[0] <= 3


def test_a_field_looks_up_no_teams_and_lands_what_fits_read(spark, monkeypatch):
    asked, real = [], fixture.laps
    monkeypatch.setattr(fixture, "laps", lambda s, d, columns: asked.append(set(columns)) or real(s, d, columns))
    train = Q.season(spark, SF).train
    assert asked and all("Team" not in columns for columns in asked)
    assert set(train.columns) == set(Q.TRAINED)
