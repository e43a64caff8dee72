from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast.params import SESSION_TYPES, Params
from gridcast.plans import queries
from gridcast.schemas import LAPS, RESULTS
from gridcast.sources import conform, fixture, mixed_csv, readers

P = Params(2026, "GP", 2)


def test_conform_adds_drops_and_casts(spark):
    df = spark.createDataFrame([("VER", "12", float("nan"), "x")], "Driver string, LapNumber string, LapTime double, other string")
    out = conform.conform(df, LAPS)
    assert out.columns == LAPS.fieldNames()
    row = out.first()
    assert (row.Driver, row.LapNumber, row.LapTime, row.Team) == ("VER", 12, None, None)
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in LAPS.fields]


def test_nan_becomes_null(spark):
    df = conform.nan_to_null(spark.createDataFrame([(float("nan"), 1)], "a double, b int"))
    assert tuple(df.first()) == (None, 1)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("0 days 00:01:32.450000", 92.45),
        ("1 day 00:00:01", 86401.0),
        ("00:01:32.5", 92.5),
        ("0 00:01:32.5", 92.5),
        ("NaT", None),
        ("", None),
        (None, None),
    ],
)
def test_text_durations(spark, text, want):
    df = spark.createDataFrame([(text,)], "LapTime string")
    assert conform.durations_to_seconds(df, ["LapTime", "absent"]).first().LapTime == want


def test_interval_and_numeric_durations(spark):
    df = spark.createDataFrame(
        [(dt.timedelta(minutes=1, seconds=32, microseconds=450000), 91.5)],
        T.StructType([T.StructField("a", T.DayTimeIntervalType()), T.StructField("b", T.FloatType())]),
    )
    assert tuple(conform.durations_to_seconds(df, ["a", "b"]).first()) == (92.45, 91.5)


def test_session_names(spark):
    df = spark.createDataFrame(
        [("Practice 1", "FP1"), ("Sprint Shootout", "SQ"), (None, "Q")], "n string, d string"
    )
    out = conform.normalise_session(df, "n", "d").collect()
    assert [r.session_type for r in out] == ["FP1", "SQ", "Q"]


def test_flags(spark):
    df = spark.createDataFrame([(True, "false"), (None, None)], "FreshTyre boolean, IsPersonalBest string")
    out = conform.flag_text(df, ["FreshTyre", "IsPersonalBest", "absent"]).collect()
    assert [tuple(r) for r in out] == [("True", "False"), (None, None)]
    text = spark.createDataFrame([("True", "maybe"), ("False", None)], "FreshTyre string, IsPersonalBest string")
    back = conform.flag_values(text, ["FreshTyre", "IsPersonalBest"]).collect()
    assert [tuple(r) for r in back] == [(True, None), (False, None)]


def test_results(spark):
    raw = spark.createDataFrame(
        [("VER", "Red", 1.0, "1", "25"), ("HAM", "Silver", float("nan"), "NC", None), ("X", "Y", 2.5, "", "n/a")],
        "Abbreviation string, TeamName string, Position double, GridPosition string, Points string",
    )
    out = conform.conform_results(raw, P)
    assert out.columns == RESULTS.fieldNames()
    assert [(r.Driver, r.Position, r.GridPosition, r.Points, r.Status, r.round_number) for r in out.collect()] == [
        ("VER", 1, 1, 25.0, None, 2), ("HAM", None, None, None, None, 2), ("X", None, None, None, None, 2),
    ]


def test_coverage_lists_skipped_sessions(spark):
    laps = spark.createDataFrame([(2026, "GP", "R"), (2026, "GP", "R"), (2026, "GP", "Q")], "season int, event string, session_type string")
    out = {r.session_type: (r.laps, r.status) for r in conform.session_coverage(laps, ["season", "event"], SESSION_TYPES).collect()}
    assert out["R"] == (2, "ingested") and out["Q"] == (1, "ingested")
    assert [s for s in SESSION_TYPES if out[s] == (0, "skipped")] == ["FP1", "FP2", "FP3", "SQ", "S"]
    none = laps.filter("session_type = 'X'")
    for df in (laps, none):
        expected = laps.select("season", "event").distinct()
        out = conform.session_coverage(df, ["season", "event"], SESSION_TYPES, expected).collect()
        assert {r.session_type: r.laps for r in out} == {s: {"R": 2, "Q": 1}.get(s, 0) if df is laps else 0 for s in SESSION_TYPES}


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc"])
def test_read_laps_formats(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    df = conform.conform(
        spark.createDataFrame([("VER", 7, 80.5)], "Driver string, LapNumber int, LapTime float"), LAPS
    )
    writer = df.write.option("header", True)
    writer.csv(path) if fmt == "csv" else writer.format(fmt).save(path)
    out = readers.read_laps(spark, path, fmt)
    assert out.columns == LAPS.fieldNames()
    assert (out.first().Driver, out.first().LapNumber, out.first().LapTime) == ("VER", 7, 80.5)


def test_csv_is_read_by_name(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = spark.createDataFrame([("Ferrari", "LEC", "5", "x", "9")], "Team string, Driver string, LapNumber string, LapTime string, Extra string")
    rows.write.option("header", True).csv(path)
    out = readers.read_laps(spark, path, "csv")
    assert out.dtypes == [(f.name, f.dataType.simpleString()) for f in LAPS.fields]
    lap = out.first()
    assert (lap.Driver, lap.Team, lap.LapNumber, lap.LapTime, lap.DriverNumber) == ("LEC", "Ferrari", 5, None, None)


def test_optional_table(spark, tmp_path):
    missing = readers.read_optional(spark, str(tmp_path / "none"), RESULTS)
    assert missing.schema == RESULTS and missing.isEmpty()
    # Present but unreadable is an error, not an empty table.
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        readers.read_optional(spark, str(broken), RESULTS).collect()


def test_spread_leaves_wide_scans_alone(spark):
    for splits in (1, 2, 7):
        assert readers.spread(spark.range(100, numPartitions=splits)).rdd.getNumPartitions() == 8
    for splits in (8, 9, 100):
        wide = spark.range(100, numPartitions=splits)
        assert readers.spread(wide) is wide


def test_partition_value_wins_over_file_value(spark, tmp_path):
    path = str(tmp_path / "raw")
    conform.tag(spark.range(1), season=2026, event="GP", session="Practice 1").write.parquet(
        f"{path}/season=2026/event=GP/session=FP1"
    )
    assert readers.read_laps(spark, path).select("session").first()[0] == "FP1"
    assert readers.read_table(spark, path, LAPS, F.col("session") == "Q").isEmpty()


def test_laps_do_not_depend_on_the_columns_asked_for(spark, tmp_path):
    """Laps of unknown suppliers and parts stay, with NULL for what these would say."""
    sf, path = "/root/testdata/sf0.001", str(tmp_path)
    for name in ("orders", "supplier", "nation", "part"):
        os.symlink(f"{sf}/{name}.parquet", f"{path}/{name}.parquet")
    orphan = F.col("l_orderkey") % 10 == 0
    lineitem = spark.read.parquet(f"{sf}/lineitem.parquet")
    for key in ("l_suppkey", "l_partkey"):
        none = F.lit(-1).cast(lineitem.schema[key].dataType)
        lineitem = lineitem.withColumn(key, F.when(orphan, none).otherwise(F.col(key)))
    lineitem.write.parquet(f"{path}/lineitem.parquet")
    narrow, wide = (fixture.laps(spark, path, c) for c in (fixture.TAGS, fixture.FEATURE_COLUMNS))
    lost = lineitem.filter(orphan).count()
    assert lost and narrow.count() == wide.count() == lineitem.count()
    assert wide.filter("Team is null").count() == lost


def test_csv_files_of_several_layouts(spark, tmp_path):
    files = {
        "season=2026/a.csv": "Driver,Team,LapNumber,LapTime\nNOR,McLaren,1,80.5\nVER,Red Bull,2\nLEC,\"Ferrari, Scuderia\",x,81\n",
        "season=2026/b.csv": "Team,Driver,Extra,LapNumber\n\nMcLaren,PIA,q,3\nMcLaren,PIA,q,4,5\n\n",
        "season=2025/c.csv": "Team,Driver,Extra,LapNumber\nHaas,BEA,,\n",
        "season=2025/d.csv": "Driver,Team\n",
    }
    for name, text in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    got = mixed_csv.read_csv_layouts(spark, str(tmp_path), LAPS)
    assert got.rows.schema.simpleString() == LAPS.simpleString()
    rows = {(r.Driver, r.Team, r.LapNumber, r.LapTime, r.season) for r in got.rows.collect()}
    assert rows == {
        ("NOR", "McLaren", 1, 80.5, 2026), ("LEC", "Ferrari, Scuderia", None, 81.0, 2026),
        ("PIA", "McLaren", 3, None, 2026), ("BEA", "Haas", None, None, 2025),
    }
    bad = {(r.file.rsplit("/", 1)[1], r.line, r.record, r.reason) for r in got.quarantine.collect()}
    assert bad == {("a.csv", 3, "VER,Red Bull,2", "not 4 fields"), ("b.csv", 4, "McLaren,PIA,q,4,5", "not 4 fields")}
    assert readers.read_laps(spark, str(tmp_path), "csv").count() == 4
    one = mixed_csv.read_csv_layouts(spark, str(tmp_path / "season=2025" / "d.csv"), LAPS)
    assert one.rows.isEmpty() and one.quarantine.isEmpty()


def test_line_numbers_count_over_blocks(spark, tmp_path):
    (tmp_path / "long.csv").write_text("a\n" + "".join(f"{k}{'x' * (k % 50)}\n" for k in range(2, 4001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        read = mixed_csv.lines(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() >= 1
        wrong = read.filter((F.col("line") > 1) & (F.regexp_extract("value", r"^\d+", 0) != F.col("line").cast("string")))
        assert read.count() == 4000 and wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_another_table_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "laps")
    rows = [(2026, f"GP{k}", k) for k in range(1, 9)]
    spark.createDataFrame(rows, "season int, event string, n int").write.partitionBy("season", "event").parquet(path)
    calendar = spark.createDataFrame([(2026, f"GP{k}", k) for k in range(1, 12)], "season int, event string, round int")
    schema = spark.read.parquet(path).schema
    out = readers.read_chosen(spark, path, schema, calendar.filter("round >= 7"))
    assert {r.n for r in out.collect()} == {7, 8}
    assert "dynamicpruning" in out._jdf.queryExecution().executedPlan().toString()
    # Files of the other folders are not opened: they may hold anything.
    for k in range(1, 7):
        folder = tmp_path / "laps" / "season=2026" / f"event=GP{k}"
        for f in folder.glob("*"):
            f.unlink()
        (folder / "part-0.parquet").write_text("not parquet")
    assert {r.n for r in readers.read_chosen(spark, path, schema, calendar.filter("round >= 7")).collect()} == {7, 8}
    with pytest.raises(Exception):
        readers.read_chosen(spark, path, schema, calendar.filter("round >= 6")).collect()


def test_cut_records_are_written_by_every_task(spark, monkeypatch):
    """No task reads all laps: each writes a file of its own under the whole header."""
    paths = []
    read = mixed_csv.read_csv_layouts
    monkeypatch.setattr(mixed_csv, "read_csv_layouts", lambda s, p, *a: paths.extend(p) or read(s, p, *a))
    queries.QUERIES["scan_csv_mixed"](spark, "/root/testdata/sf0.01")
    cut = mixed_csv.lines(spark, paths[-1]).collect()
    headers = [r for r in cut if r.line == 1]
    assert len(headers) > 1 and {r.value for r in headers} == {"Driver,Team,LapNumber,LapTime,session_type,season,event,session,row_key"}
    assert all(r.value.count(",") == 1 for r in cut if r.line > 1) and len(cut) > len(headers)
