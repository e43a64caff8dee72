"""Hashes of words: foreign texts must not find two words that count as one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridcast.llm import bpe, line_quality, lm_score, superminhash, tokens, toxicity
from gridcast.llm import text as tx
from tests.llm.test_bpe import PATH as BPE
from tests.llm.test_huffman import PATH, library_ids


def twins(n):
    """The word of Thue and Morse, and its complement: alike under any polynomial modulo 2**64."""
    bits = [bin(k).count("1") % 2 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


SIZES = [1024, 4096, 65536]


@pytest.mark.parametrize("n", SIZES)
def test_twins_are_two_words_in_every_operator(spark, n):
    a, b = twins(n)
    col = pa.array([a.encode(), b.encode()])
    data, offsets = tx.flat(col)
    starts, ends, _ = tx.words(data, offsets)
    assert len(set(tx.hash_runs(data, starts, ends).tolist())) == 2
    first, inverse = tx.distinct_runs(data, starts, ends)
    assert inverse.tolist() == [0, 1] or inverse.tolist() == [1, 0]
    shingles, _, _ = superminhash.shingle_sets(col, 5)
    assert len(set(shingles.tolist())) == 2
    assert len(set(line_quality.profile_texts(col)["line_hash"].tolist())) == 2
    assert len(set(lm_score._keys(col)[0][:2].tolist())) == 2
    both = toxicity.features(col)
    assert len(set(both["feature"].tolist())) > len(set(toxicity.features(col[:1])["feature"].tolist()))
    df = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    assert {r.component_id for r in superminhash.near_duplicates(df).collect()} == {1, 2}


@pytest.mark.parametrize("n", [1024, 4096])
def test_ids_of_twins_are_the_librarys(spark, n):
    texts = list(twins(n))
    ids, offsets = tokens.Encoder(PATH).encode(pa.array([t.encode() for t in texts]))
    assert [ids[x:y].tolist() for x, y in zip(offsets, offsets[1:])] == [list(x) for x in library_ids(texts)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in bpe.decode(bpe.encode(df, BPE), BPE).collect()}
    assert got == dict(enumerate(texts))


def test_runs_that_share_a_hash_are_separate(monkeypatch):
    words = [b"one", b"two", b"one", b"three", b"two", b"longer_than_a_lane", b"longer_than_a_LANE", b"one"]
    data = np.frombuffer(b" ".join(words), np.uint8)
    starts, ends, _ = tx.words(data, np.array([0, len(data)]))
    kind = np.array([0, 0, 0, 0, 0, 0, 0, 1], bool)
    for hashes in (tx.hash_runs, lambda d, s, e: np.zeros(len(s), np.uint64), lambda d, s, e: ((e - s) % 2).astype(np.uint64)):
        monkeypatch.setattr(tx, "hash_runs", hashes)
        first, inverse = tx.distinct_runs(data, starts, ends, kind)
        shown = [(words[first[k]], bool(kind[first[k]])) for k in inverse]
        assert shown == list(zip(words, kind.tolist())) and len(first) == 6


@settings(max_examples=50, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=40), max_size=30), st.sampled_from([16, 1 << 20]))
def test_hash_depends_on_the_bytes_alone(runs, window):
    data = np.frombuffer(b"".join(runs), np.uint8)
    sizes = np.array([len(r) for r in runs], np.int64)
    ends = np.cumsum(sizes)
    before, tx.WINDOW_BYTES = tx.WINDOW_BYTES, window
    try:
        got = tx.hash_runs(data, ends - sizes, ends).tolist()
    finally:
        tx.WINDOW_BYTES = before
    alone = [tx.hash_runs(np.frombuffer(r, np.uint8), np.array([0]), np.array([len(r)]))[0] for r in runs]
    assert got == alone and len(set(got)) == len(set(runs))
