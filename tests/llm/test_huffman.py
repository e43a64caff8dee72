from __future__ import annotations

from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridcast.llm import huffman, tokens
from gridcast.llm.queries import QUERIES
from tests.llm.conftest import ODD, SF

PATH = public_tokenizers.path("word_bpe_49k.json")


def library_ids(texts):
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids):
    return crc32(np.array(ids, "<u4").tobytes())


def test_query_matches_the_library(spark, documents):
    docs = sorted(documents, key=lambda d: d["doc_id"])
    want, start = [], 0
    for d, ids in zip(docs, library_ids([d["text"] for d in docs])):
        want.append((d["doc_id"], start, len(ids) + 1, crc([*ids, 2])))
        start += len(ids) + 1
    got = sorted(map(tuple, QUERIES["op6_huffman_ids"](spark, SF).collect()))
    assert got == want


def test_odd_rows(spark, odd, nothing):
    got = huffman.round_trip(odd, PATH, 2).collect()
    want = [(d, (*ids, 2)) for (d, _, _), ids in zip(ODD, library_ids([t for _, t, _ in ODD]))]
    found = [(r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got]
    assert sorted(found, key=str) == sorted(want, key=str)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((r.doc_id for r in got), key=lambda d: (d is not None, d or 0))
    assert [r.start for r in ordered] == list(np.cumsum([0] + [r.n_tokens for r in ordered])[:-1])
    assert huffman.round_trip(nothing, PATH, 2).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10_000), min_size=1, max_size=60), st.integers(6, 12))
def test_lengths_are_a_complete_limited_code(counts, limit):
    lengths = huffman.code_lengths(np.array(counts), limit)
    assert lengths.max() <= limit
    assert (2.0**-lengths).sum() == (1 if len(counts) > 1 else 0.5)
    # More frequent ids never have longer codes.
    order = np.argsort(counts, kind="stable")
    c, l = np.array(counts)[order], lengths[order]
    assert all(l[i] >= l[j] for i in range(len(c)) for j in range(i + 1, len(c)) if c[i] < c[j])


def test_unlimited_length_costs_what_huffman_costs():
    import heapq

    rng = np.random.default_rng(5)
    counts = rng.zipf(1.5, 200).clip(1, 10**6)
    heap, cost = counts.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    assert (huffman.code_lengths(counts, 40) * counts).sum() == cost


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 70_000), min_size=1, max_size=2000), st.integers(1, 300))
def test_code_round_trip_from_every_checkpoint(ids, every):
    ids = np.array(ids)
    known, counts = np.unique(ids, return_counts=True)
    code = huffman.Code(known, huffman.code_lengths(counts))
    bits, marks = code.encode(ids, every)
    sizes = np.full(len(marks), every)
    sizes[-1] = len(ids) - every * (len(marks) - 1)
    raw = np.frombuffer(bits, np.uint8)
    assert (code.decode(raw, marks, sizes) == ids).all()
    k = len(marks) // 2
    assert (code.decode(raw, marks[k : k + 1], sizes[k : k + 1]) == ids[k * every : k * every + sizes[k]]).all()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB zé'<|>\t\n ́İß1٣,.-_$tsrevml\x01\x1f\x7f漢😀") | st.characters(codec="utf-8"), max_size=30), min_size=1, max_size=6))
def test_encoder_is_the_library(texts):
    import pyarrow as pa

    ids, offsets = tokens.encoder(PATH).encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == library_ids(texts)


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|startoftext|>b", "<|ENDOFTEXT|>", "x <| y |>", "'S 'll don't"])
def test_special_tokens_and_contractions(text):
    import pyarrow as pa

    ids, _ = tokens.encoder(PATH).encode(pa.array([text]))
    assert ids.tolist() == library_ids([text])[0]


def made_up(n, seed):
    """Different words of ASCII and Latin-1 letters, some of them with a digit or a sign."""
    rng = np.random.default_rng(seed)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzäéïöüß"))
    words = {"".join(rng.choice(letters, k)) for k in rng.integers(3, 14, n)}
    return [w + str(i) * (i % 9 == 0) + ">!" * (i % 7 == 0) for i, w in enumerate(sorted(words))]


class Counting:
    """Passes calls on and counts them."""

    def __init__(self, inner, calls):
        self.inner, self.calls = inner, calls

    def __getattr__(self, name):
        self.calls.append(name)
        return getattr(self.inner, name)


def test_new_pieces_go_to_the_library_many_at_once():
    encoder, calls = tokens.Encoder(PATH), []
    texts = [" ".join(made_up(2500, 1)), "don't <b> x"]
    for name in ("model", "plain", "tokenizer"):
        if hasattr(encoder, name):
            setattr(encoder, name, Counting(getattr(encoder, name), calls))
    ids, offsets = encoder.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == library_ids(texts)
    assert len(calls) < 10


@pytest.mark.parametrize("marked", [True, False])
def test_pieces_with_and_without_marked_ends_and_after_forgetting(monkeypatch, marked):
    encoder = tokens.Encoder(PATH)
    assert encoder.closes is not None
    if not marked:
        encoder.closes = None
    monkeypatch.setattr(tokens, "REMEMBERED", 1500)
    for seed in (1, 2, 1, 1):
        texts = [" ".join(made_up(1200, seed)), None, "x" * 5000 + " it's <|endoftext|> 3x", " ".join(made_up(700, seed + 1))]
        ids, offsets = encoder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == library_ids(texts)
        assert len(encoder.begins) == len(encoder.known) + len(encoder.known_whole) + 1


def test_blocks_are_decoded_side_by_side(monkeypatch):
    rng, every = np.random.default_rng(3), 8
    lens = [[5, 1, 40], [64], [1], [3, 3], [200, 7]]
    held = [rng.zipf(1.4, sum(block)).clip(1, 5000) for block in lens]
    known, counts = np.unique(np.concatenate(held), return_counts=True)
    code = huffman.Code(known, huffman.code_lengths(counts))
    rows, first, doc = [], 0, 0
    for block, ids in zip(lens, held):
        bits, marks = code.encode(ids, every)
        rows.append({
            "part": 4, "first": first, "n_ids": len(ids), "doc_ids": list(range(doc, doc + len(block))), "doc_lens": block,
            "bits": bits, "checkpoints": marks,
        })
        first, doc = first + len(ids), doc + len(block)
    names = list(rows[0])
    schema = pa.schema([huffman._BLOCK_ARROW.field(name) for name in names])
    # The first row is cut off, so that no column of the batch begins at 0.
    batch = pa.RecordBatch.from_pylist([rows[0], *rows], schema).slice(1)
    calls, decode = [], huffman.Code.decode
    monkeypatch.setattr(huffman.Code, "decode", lambda *args: calls.append(1) or decode(*args))
    for more, expected in (((), 1), ((100,), 3), ((1,), 5)):
        calls.clear()
        out = pa.Table.from_batches(huffman._read(code, every, *more)(iter([batch])))
        flat_lens = [n for block in lens for n in block]
        assert out["doc_id"].to_pylist() == list(range(doc)) and set(out["part"].to_pylist()) == {4}
        assert out["n_tokens"].to_pylist() == flat_lens
        assert out["first"].to_pylist() == list(np.cumsum([0, *flat_lens])[:-1])
        assert np.frombuffer(b"".join(out["ids"].to_pylist()), "<u4").tolist() == np.concatenate(held).tolist()
        assert len(calls) == expected
