from __future__ import annotations

from collections import Counter
from zlib import crc32

import pytest

from gridcast.llm import sharding
from gridcast.llm.queries import QUERIES
from tests.llm.conftest import ODD, SF


def check(got, docs, shards=24):
    want = sorted((str(d), len((t or "").encode()) + 8, crc32((t or "").encode())) for d, t in docs)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    counts = Counter(r.shard for r in got)
    assert set(counts) <= set(range(shards))
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in counts:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))


def test_query_keeps_every_row_in_even_shards(spark, documents):
    got = QUERIES["op10_two_pass_shuffle"](spark, SF).collect()
    check(got, [(d["doc_id"], d["text"]) for d in documents])
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    # Shuffled: neighbours in the input are apart.
    place = {r.doc_id: (r.shard, r.slot) for r in got}
    near = sum(place[i][0] == place[i + 1][0] and abs(place[i][1] - place[i + 1][1]) == 1 for i in range(len(place) - 1))
    assert near < 20


def test_same_seed_same_order_other_seed_other_order(spark, documents):
    df = spark.read.parquet(f"{SF}/documents.parquet")

    def order(seed):
        return {r.doc_id: (r.shard, r.slot) for r in sharding.shuffled_shards(df, 5, seed).select("doc_id", "shard", "slot").collect()}

    assert order(1) == order(1) != order(2)


def test_order_does_not_depend_on_files_or_tasks(spark, monkeypatch):
    """Also of equal rows, some of them more than a task writes."""
    monkeypatch.setattr(sharding, "COPIES_A_TASK", 7)
    rows = [(i, f"text {i}") for i in range(300)] + [(5, "again")] * 50 + [(None, None)] * 3 + [(None, "")] * 2 + [(6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")

    def order(part):
        got = sharding.shuffled_shards(part, 6, bucket_bytes=900)
        return sorted(map(str, got.select("doc_id", "text", "shard", "slot").collect()))

    first = order(df.coalesce(1))
    check(sharding.shuffled_shards(df, 6, bucket_bytes=900).collect(), rows, 6)
    assert order(df.repartition(4)) == order(df.repartition(9, "text")) == first
    # Equal rows are spread over the shards.
    assert len({r.split("shard=")[1][0] for r in first if "again" in r}) == 6


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_odd_rows(spark, odd, nothing, shards):
    check(sharding.shuffled_shards(odd, shards).collect(), [(d, t) for d, t, _ in ODD], shards)
    assert sharding.shuffled_shards(nothing, shards).collect() == []


def test_written_shards_hold_their_rows_in_slot_order(spark, odd, tmp_path):
    sharded = sharding.shuffled_shards(odd, 3)
    sharding.write_shards(sharded, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, back.select("shard", "slot", "doc_id").collect())) == sorted(
        map(str, sharded.select("shard", "slot", "doc_id").collect())
    )
