from __future__ import annotations

import corpus_pipeline as cp
from gridcast.llm.queries import QUERIES
from tests.llm.conftest import SF, rows
from tests.llm.test_superminhash import groups


def test_stages_in_order():
    assert [f.__name__ for _, f in cp.STAGES] == ["quality_rules", "clean_of_toxicity", "exact_dedup", "near_dedup", "pack"]


def test_each_stage_on_odd_rows_and_on_nothing(spark, odd, nothing):
    for _, stage in cp.STAGES[:-1]:
        for docs in (odd, nothing):
            got = stage(spark, docs, SF)
            assert got.columns == docs.columns and got.count() <= docs.count()
    assert cp.pack(spark, odd, SF).count() >= odd.count()
    # Of equal texts one row stays.
    left = cp.exact_dedup(spark, odd, SF).collect()
    assert sorted(str(r.doc_id) for r in left) == ["1", "3", "4", "5", "6", "8", "None"]


def test_toxicity_stage_rejects_what_op5_calls_toxic(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").drop("n_chars")
    toxic = {r.doc_id for r in QUERIES["op5_noisy_or"](spark, SF).collect() if r.predicted}
    left = {r.doc_id for r in cp.clean_of_toxicity(spark, docs, SF).select("doc_id").collect()}
    assert toxic and left == {r["doc_id"] for r in rows("documents")} - toxic
    assert cp.TOXIC_FROM == 0.3


def test_whole_run_keeps_one_of_each_group(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").drop("n_chars")
    clean = cp.clean_of_toxicity(spark, cp.quality_rules(spark, docs, SF), SF)
    one = cp.near_dedup(spark, cp.exact_dedup(spark, clean, SF), SF).collect()
    want = [d for d, _, _, kept in groups([(r.doc_id, r.text) for r in clean.collect()], 80) if kept]
    assert sorted(str(r.doc_id) for r in one) == sorted(want)
    toxic = {r["doc_id"] for r in rows("labels") if r["toxic"]}
    assert len(toxic & {r.doc_id for r in one}) < 0.3 * len(toxic)
