from __future__ import annotations

import hashlib

import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridcast.llm import bpe
from gridcast.llm.queries import QUERIES
from tests.llm.conftest import ODD, SF

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digests(docs):
    t = library()
    ids = [e.ids for e in t.encode_batch([x or "" for _, x in docs], add_special_tokens=False)]
    return sorted(
        ((str(d), len(i), sha(",".join(map(str, i))), sha(t.decode(i, skip_special_tokens=False))) for (d, _), i in zip(docs, ids))
    )


def result(df):
    return sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in df.collect())


def test_query_matches_the_library(spark, documents):
    assert result(QUERIES["op3_backtracking_bpe"](spark, SF)) == digests([(d["doc_id"], d["text"]) for d in documents])


def test_odd_rows_and_round_trip(spark, odd, nothing):
    docs = [(d, t) for d, t, _ in ODD]
    assert result(bpe.round_trip_digests(odd, PATH)) == digests(docs)
    back = bpe.decode(bpe.encode(odd, PATH), PATH).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(d), t or "") for d, t in docs)
    assert bpe.round_trip_digests(nothing, PATH).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aab  \n\t'sdtlremv!?.,é漢😀1٣_-\xa0\x85<|>") | st.characters(codec="utf-8"), max_size=40), min_size=1, max_size=5))
def test_encoding_is_the_librarys(texts):
    ids, offsets = bpe.bpe(PATH).encode(pa.array(texts, pa.string()))
    want = [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == want


def test_one_by_one_is_side_by_side():
    table = bpe.bpe(PATH)
    for piece in (b"internationalisation", b" thththththing", "ünïcödé".encode(), b"aaaaaaaaaaaaaaaaaaaaaaa"):
        side, counts = table._side_by_side(bpe.np.frombuffer(piece, bpe.np.uint8), bpe.np.array([0]), bpe.np.array([len(piece)]))
        assert table.encode_piece(piece) == side.tolist() and counts.tolist() == [len(side)]
