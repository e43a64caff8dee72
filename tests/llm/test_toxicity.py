from __future__ import annotations

from zlib import crc32

import pytest

from gridcast.llm import toxicity
from gridcast.llm.queries import QUERIES
from tests.llm.conftest import ODD, SF, rows

KNOWN = [(i, int(i % 4 == 0)) for i in range(200)]


def text(i, toxic):
    clean = [f"The quiet word{i} and stone{i % 7}.", f"Some other line {i % 11}!", "A closing sentence"]
    return " ".join(clean[:1] + ([f"You zorblax{i % 3} of it."] if toxic else []) + clean[1:])


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([(i, text(i, y)) for i, y in KNOWN], "doc_id long, text string")
    labels = spark.createDataFrame([*KNOWN, (5, None), (None, 1), (9999, 1)], "doc_id long, toxic int")
    return toxicity.train(docs, labels)


def test_learns_stems_and_finds_the_sentence(spark, model):
    unseen = [(1, text(901, 0)), (2, text(902, 1)), (3, "Fine. Quite fine.\nzorblax77 again")]
    df = spark.createDataFrame(unseen, "doc_id long, text string")
    score = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    # An unseen ending leaves the word itself without evidence, its stem has some.
    assert score[1] < 0.05 < score[3] < score[2] and score[2] > 0.9
    found = toxicity.locate(df, model, least=0.1).collect()
    assert {r.doc_id for r in found} == {2, 3} and all("zorblax" in r.sentence for r in found)
    texts = dict(unseen)
    assert all(texts[r.doc_id].encode()[r.start_byte : r.end_byte].decode() == r.sentence for r in found)


def test_query_is_right_on_held_out_documents(spark):
    labels = {r["doc_id"]: r["toxic"] for r in rows("labels")}
    got = QUERIES["op5_noisy_or"](spark, SF).collect()
    assert len(got) == len(rows("documents"))
    for r in got:
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in good for b in bad)
    assert wins / (len(good) * len(bad)) > 0.8


def test_odd_rows(spark, odd, nothing, model):
    got = toxicity.score(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score < 0.3 for r in got)
    assert toxicity.score(nothing, model).collect() == []
    no_labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(odd, toxicity.train(odd, no_labels)).collect()} == {0.0}
