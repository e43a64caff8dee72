from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from gridcast.params import Params
from gridcast.schemas import GOLD
from gridcast.sinks import export, tables

SCHEMA = "season int, event string, session_type string, n int"


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def content(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("season", "event", "session_type", "n").collect())


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


ROWS = [(2026, "A", "R", 1), (2026, "A", "Q", 2), (2026, "Chinese Grand Prix", "R", 3)]
KEYS = ("season", "event")


def test_write_leaves_other_partitions(spark, path):
    tables.write_partitions(table(spark, *ROWS), path, KEYS)
    tables.write_partitions(table(spark, (2026, "A", "R", 9)), path, KEYS)
    assert content(spark, path) == [(2026, "A", "R", 9), ROWS[2]]


def test_replace_drops_sessions_no_longer_there_and_repeats(spark, path):
    tables.write_partitions(table(spark, *ROWS), path, KEYS)
    for _ in range(2):
        tables.replace_partitions(table(spark, (2026, "A", "R", 9)), path, {"season": 2026, "event": "A"})
        assert content(spark, path) == [(2026, "A", "R", 9), ROWS[2]]


@pytest.mark.parametrize("stray", [(2026, "B", "R", 9), (2026, None, "R", 9), (2025, "A", "R", 9)])
def test_replace_refuses_stray_rows_and_keeps_the_table(spark, path, stray):
    tables.write_partitions(table(spark, *ROWS), path, KEYS)
    with pytest.raises(Exception, match="row (outside|without)"):
        tables.replace_partitions(
            table(spark, (2026, "A", "R", 9), stray), path, {"season": 2026, "event": "A"}
        )
    assert content(spark, path) == sorted(ROWS)


@pytest.mark.parametrize("event", ["A", "Chinese Grand Prix", "50% / odd: name"])
def test_replace_with_nothing_empties_the_partition(spark, path, event):
    tables.write_partitions(table(spark, *ROWS, (2026, "50% / odd: name", "R", 4)), path, KEYS)
    tables.replace_partitions(table(spark).filter("n > 0"), path, {"season": 2026, "event": event})
    left = content(spark, path)
    assert left and event not in {r[1] for r in left} and len({r[1] for r in left}) == 2


def test_evolved_columns(spark, path):
    tables.write_partitions(table(spark, *ROWS), path, KEYS)
    wider = table(spark, (2026, "B", "R", 5)).withColumn("extra", F.lit(1.5))
    tables.write_partitions(wider, path, KEYS)
    out = {r.event: r.extra for r in tables.read_evolved(spark, path).collect()}
    assert out == {"A": None, "Chinese Grand Prix": None, "B": 1.5}


def test_replace_where(spark, path):
    tables.replace_where(spark, path, table(spark, *ROWS, (None, "A", "Q", 7)), F.lit(True))
    event = (F.col("season") == 2026) & (F.col("event") == "A")
    tables.replace_where(spark, path, table(spark, (2026, "A", "S", 9)), event)
    got = {tuple(r) for r in spark.read.parquet(path).collect()}
    # The row for which the condition is unknown stays.
    assert got == {ROWS[2], (None, "A", "Q", 7), (2026, "A", "S", 9)}
    with pytest.raises(Exception, match="does not match"):
        tables.replace_where(spark, path, table(spark, (2026, "B", "S", 9)), event)
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == got


def test_a_hot_partition_is_written_by_several_tasks(spark, path):
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        df = spark.range(300_000).select(
            F.lit(2026).alias("season"),
            F.when(F.col("id") % 3 == 0, F.concat(F.lit("E"), F.col("id") % 20)).otherwise("hot").alias("event"),
            F.rand(1).alias("x"),
        )
        tables.write_partitions(df, path, KEYS)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)

    def files(event):
        return [f for f in os.listdir(f"{path}/season=2026/event={event}") if f.endswith(".parquet")]

    assert len(files("hot")) > 1 and len(files("E3")) == 1
    assert spark.read.parquet(path).count() == 300_000


def test_storage_types(spark):
    wide = spark.range(1).select(*[F.lit(None).cast("string").alias(c) for c in GOLD.fieldNames()])
    stored = tables.to_storage(wide, GOLD)
    assert [f.dataType for f in stored.schema.fields] == [f.dataType for f in GOLD.fields]


P = Params(2026, "GP", 2)
# The golden document's keys.
TOP = ["model_version", "generated_at", "event", "round", "season", "sessions_used",
       "season_accuracy", "recency_lambda", "predictions", "feature_importance", "history"]


@pytest.fixture
def parts(spark):
    predictions = spark.createDataFrame(
        [(2026, "GP", "HAM", "B", 2, 0.3, 0.00001, 0.4), (2026, "GP", "ANT", "A", 1, 0.70004, 0.01, -0.4)],
        "season int, event string, driver string, team string, predicted_position int, "
        "win_probability double, uncertainty double, pace_trend double",
    )
    scores = spark.createDataFrame(
        [(2026, "GP", "ANT", 3.091, None, None, 0.55, None, None), (2026, "GP", "HAM", None, None, None, None, None, None)],
        "season int, event string, driver string, score_FP1 double, score_FP2 double, "
        "score_FP3 double, score_Q double, score_SQ double, score_S double",
    )
    used = spark.createDataFrame([("Q",), ("FP1",), ("Q",)], "session_type string")
    importance = spark.createDataFrame(
        [("a", 0.1, True), ("compound_idx", 0.3, False), ("b", 0.6, True)],
        "feature string, importance double, exported boolean",
    )
    history = spark.createDataFrame(
        [(2026, "Y", 2, "RUS", "HAM", False, True), (2026, "X", 1, "RUS", "RUS", True, True)],
        "season int, event string, round int, predicted string, actual string, "
        "winner_hit boolean, top3_hit boolean",
    )
    return predictions, scores, used, importance, history


def test_document_shape(spark, parts):
    predictions, scores, used, importance, history = parts
    entries = export.export_entries(predictions, scores, P)
    document = export.export_document(entries, used, importance, history, P, "base_r02")
    assert document.count() == 1
    doc = json.loads(export.to_json_text(document).first().value)
    assert list(doc) == TOP
    assert doc["sessions_used"] == ["FP1", "Q"]
    assert doc["season_accuracy"] == {"top3_pct": 0.5, "races": 2}
    assert [d["driver"] for d in doc["predictions"]] == ["ANT", "HAM"]
    first = doc["predictions"][0]
    assert list(first) == ["driver", "team", "predicted_position", "win_probability", "uncertainty", "trend", "sessions"]
    assert first["win_probability"] == 0.7 and first["trend"] == "flat"
    assert list(first["sessions"]) == ["FP1", "FP2", "FP3", "Q", "SQ", "S"]
    assert first["sessions"]["FP1"] == {"score": 3.09, "weight": 0.15} and first["sessions"]["FP2"] is None
    assert [f["feature"] for f in doc["feature_importance"]] == ["b", "a"]
    assert doc["history"][0] == {"event": "X", "predicted": "RUS", "actual": "RUS", "top3_hit": True}
    assert [h["top3_hit"] for h in doc["history"]] == [True, False]
    assert doc["generated_at"].endswith("+00:00") and doc["recency_lambda"] == 0.15


def test_document_without_history(spark, parts):
    predictions, scores, used, importance, history = parts
    entries = export.export_entries(predictions, scores, P)
    document = export.export_document(entries, used, importance, history.filter("round > 9"), P, "v")
    doc = json.loads(export.to_json_text(document).first().value)
    assert doc["history"] == [] and doc["season_accuracy"] == {"top3_pct": 0.0, "races": 0}


def test_trend_and_lines(spark, parts):
    predictions, scores, *_ = parts
    entries = export.export_entries(predictions, scores, P, dead_band=0.05)
    lines = [json.loads(r.value) for r in export.export_lines(entries).collect()]
    assert {d["driver"]: d["trend"] for d in lines} == {"ANT": "up", "HAM": "down"}
    assert {d["driver"]: d["sessions"]["SQ"] for d in lines} == {"ANT": None, "HAM": None}


def test_written_parts_are_the_document(spark, parts, tmp_path):
    predictions, scores, used, importance, history = parts
    entries = export.export_entries(predictions, scores, P)
    for name, rows in (("two", entries), ("none", entries.filter("predicted_position > 9"))):
        path = str(tmp_path / name)
        export.write_parts(export.document_parts(rows, used, importance, history, P, "v"), path)
        text = "".join(f.read_text() for f in sorted((tmp_path / name).glob("part-*")))
        whole = export.to_json_text(export.export_document(rows, used, importance, history, P, "v"))
        got, want = json.loads(text), json.loads(whole.first().value)
        assert list(got) == TOP and got.pop("generated_at") and want.pop("generated_at")
        assert got == want


def test_replace_where_keeps_columns_of_later_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a")], "k int, v string").coalesce(1).write.parquet(path)
    spark.createDataFrame([(2, "b", 7)], "k int, v string, extra int").coalesce(1).write.mode("append").parquet(path)
    tables.replace_where(spark, path, spark.createDataFrame([(1, "c")], "k int, v string"), F.col("k") == 1)
    assert {tuple(r) for r in spark.read.parquet(path).select("k", "v", "extra").collect()} == {(1, "c", None), (2, "b", 7)}


def _where_table(spark, path):
    rows = [(k, f"v{k}") for k in range(40)]
    spark.createDataFrame(rows, "k int, v string").repartitionByRange(4, "k").write.parquet(path)
    return rows, {f for f in os.listdir(path) if f.endswith(".parquet")}


def _pairs(spark, path):
    return sorted(tuple(r) for r in spark.read.schema("k int, v string").parquet(path).collect())


def test_replace_where_touches_only_files_that_are_hit(spark, path):
    rows, before = _where_table(spark, path)
    new = spark.createDataFrame([(3, "new"), (4, "new")], "k int, v string")
    hit = tables.replace_where(spark, path, new, (F.col("k") >= 3) & (F.col("k") < 6), new.schema)
    after = {f for f in os.listdir(path) if f.endswith(".parquet")}
    assert len(hit) == 1 and before - after == set(hit)
    assert _pairs(spark, path) == sorted([r for r in rows if r[0] not in (3, 4, 5)] + [(3, "new"), (4, "new")])
    assert not [f for f in os.listdir(path) if f.startswith(("_staged", "_commit"))]
    # Nothing to replace: rows are added, no file is touched.
    assert tables.replace_where(spark, path, new.filter("k = 99"), F.col("k") == 99, new.schema) == []
    assert after <= set(os.listdir(path))


@pytest.mark.parametrize("crash", ["write", "draft", "rename", "remove", "add0", "add1", "note"])
def test_replace_where_recovers_from_a_crash_at_any_step(spark, path, crash, monkeypatch):
    rows, _ = _where_table(spark, path)
    new = spark.createDataFrame([(k, "new") for k in range(5, 25)], "k int, v string").repartition(3)
    where = (F.col("k") >= 5) & (F.col("k") < 25)
    done = sorted([r for r in rows if not 5 <= r[0] < 25] + [(k, "new") for k in range(5, 25)])

    class Stop(Exception):
        pass

    def fail(*args):
        raise Stop

    real = tables._steps
    if crash == "write":
        monkeypatch.setattr(tables, "_commit", fail)
    elif crash == "draft":
        monkeypatch.setattr(tables, "_write_text", fail)
    elif crash == "rename":
        monkeypatch.setattr(tables, "_steps", fail)
    else:

        def partly(spark, path, note):
            # The steps in order, and nothing after the one named.
            part = {**note, "add": {"remove": [], "add0": note["add"][:1], "add1": note["add"][:2]}.get(crash, note["add"])}
            fs, paths = tables.file_system(spark, path)
            keep = f"{path}/{tables._NOTE}{note['run']}.json"
            text, staged = tables._read_text(spark, keep), f"{path}/{tables._STAGED}{note['run']}"
            fs.rename(paths(staged), paths(f"{path}/_kept"))
            part["add"] = [[new_.replace(f"{tables._STAGED}{note['run']}", "_kept"), place] for new_, place in part["add"]]
            real(spark, path, part)
            fs.rename(paths(f"{path}/_kept"), paths(staged))
            tables._write_text(spark, keep, text)
            raise Stop

        monkeypatch.setattr(tables, "_steps", partly)
    with pytest.raises(Stop):
        tables.replace_where(spark, path, new, where, new.schema)
    monkeypatch.undo()
    if crash in ("write", "draft"):
        assert _pairs(spark, path) == sorted(rows)
    tables.recover(spark, path)
    assert _pairs(spark, path) == (sorted(rows) if crash in ("write", "draft") else done)
    tables.replace_where(spark, path, new, where, new.schema)
    assert _pairs(spark, path) == done
    assert not [f for f in os.listdir(path) if f.startswith(("_staged", "_commit"))]


POSITIVE = tables.Check("n is positive", "n <= 0")


def test_verified_replace_swaps_whole_partitions(spark, path):
    report = tables.verified_replace(table(spark, *ROWS), path, KEYS, [POSITIVE], "first")
    assert [tuple(r) for r in report.collect()] == [("first", "n is positive", 3, 0)]
    for _ in range(2):
        tables.verified_replace(table(spark, (2026, "A", "R", 9)), path, KEYS, [POSITIVE], "again", {"season": 2026, "event": "A"})
        assert content(spark, path) == [(2026, "A", "R", 9), ROWS[2]]
    tables.verified_replace(table(spark).filter("n > 0"), path, KEYS, [POSITIVE], "none", {"season": 2026, "event": "A"})
    assert content(spark, path) == [ROWS[2]]


@pytest.mark.parametrize("bad", [(2026, "A", "R", -1), (2026, "B", "R", 5), (2026, None, "R", 5)])
def test_a_breach_never_replaces_a_good_partition(spark, path, bad):
    tables.verified_replace(table(spark, *ROWS), path, KEYS, [POSITIVE], "first")
    where = {"season": 2026, "event": "A"}
    with pytest.raises(tables.BreachError) as e:
        tables.verified_replace(table(spark, (2026, "A", "R", 9), bad), path, KEYS, [POSITIVE], "second", where)
    assert content(spark, path) == sorted(ROWS)
    assert sorted(r.breaches for r in e.value.report.collect()) == [0, 1]
    aside = spark.read.parquet(e.value.aside).select(*SCHEMA.replace(",", "").split()[::2]).collect()
    assert [tuple(r) for r in aside] == [bad]


def test_widened(spark, path):
    first = spark.createDataFrame([(1, 1.5, "a", 7)], "season int, x float, s string, gone int").withColumn("k", F.lit(1).cast("byte"))
    first.write.partitionBy("season").parquet(path)
    later = spark.createDataFrame([(2, 1e300, "b", 1 << 40)], "season int, x double, s string, k long")
    later.write.mode("append").partitionBy("season").parquet(path)
    out = tables.read_widened(spark, path)
    assert dict(out.dtypes) == {"x": "double", "s": "string", "gone": "int", "k": "bigint", "season": "int"}
    assert {(r.season, r.x, r.s, r.gone, r.k) for r in out.collect()} == {(1, 1.5, "a", 7, 1), (2, 1e300, "b", None, 1 << 40)}
    spark.createDataFrame([(3, "no number")], "season int, k string").write.mode("append").partitionBy("season").parquet(path)
    with pytest.raises(ValueError, match="wider"):
        tables.read_widened(spark, path)


def test_wider_types():
    from pyspark.sql import types as T

    kinds = {"b": T.ByteType(), "i": T.IntegerType(), "l": T.LongType(), "f": T.FloatType(), "d": T.DoubleType(), "s": T.StringType()}
    for pair, want in {"bi": "i", "il": "l", "fd": "d", "if": "d", "bd": "d", "ss": "s"}.items():
        assert tables.wider(kinds[pair[0]], kinds[pair[1]]) == tables.wider(kinds[pair[1]], kinds[pair[0]]) == kinds[want]
    for pair in ("ld", "is"):
        with pytest.raises(ValueError):
            tables.wider(kinds[pair[0]], kinds[pair[1]])
