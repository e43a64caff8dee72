from __future__ import annotations

import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridcast.llm import spelling
from gridcast.llm.oracle import ORACLE
from gridcast.llm.queries import QUERIES
from tests.compare import differences, duck
from tests.llm.conftest import ODD, SF

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(docs, slips=31, min_length=7):
    out = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            out[spelling.slip(run, h % len(run)) if h % slips == 0 else run] += 1
    return {w: n for w, n in out.items() if len(w) >= min_length and n >= 2}


def near(a, b):
    """One inserted, deleted or replaced code point apart."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute(words):
    links = {w: {x for x in words if near(w, x)} for w in words}
    best = {w: min(links[w], key=lambda x: (-words[x], x)) for w in words if links[w]}
    form = {w: b for w, b in best.items() if words[b] >= 10 * words[w]}
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(links[w]), words.get(form.get(w)))
    return out


def table(spark, words):
    return spelling.numbered(spark.createDataFrame(list(words.items()), "word string, n long"), "words")


def found(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_query_matches_sql(spark):
    assert differences(QUERIES["op12_search_schemes"](spark, SF), duck(SF), ORACLE["op12_search_schemes"]) == ""


@pytest.mark.parametrize("shard_words", [8000, 6, 1])
def test_variants_match_brute_force(spark, shard_words):
    rng = np.random.default_rng(5)
    # Many words share a half; few letters make many of them near; runs of one letter, long words.
    words = {"abcd" + "".join(rng.choice(list("abé"), rng.integers(3, 6))): int(rng.integers(2, 400)) for _ in range(150)}
    words |= {"".join(rng.choice(list("xy"), 4)) + "wxyz": int(rng.integers(2, 400)) for _ in range(20)}
    words |= {"a" * n: 10 ** (n - 6) for n in range(7, 12)}
    words |= {"z" * 3000 + "q": 2, "z" * 3001 + "q": 40, "lonesome": 3}
    assert found(spelling.variants(table(spark, words), shard_words=shard_words)) == brute(words)


def test_forms_are_followed_to_the_root(spark):
    words = {"abcdefg" + "h" * k: 3 * 10**k for k in range(9)}
    got = found(spelling.variants(table(spark, words)))
    assert got == brute(words) and {r[1] for r in got.values()} == {"abcdefg" + "h" * 8}


def test_vocabulary_matches_brute_force(spark, documents):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    want = counted((d["doc_id"], d["text"]) for d in documents)
    assert {r.word: r.n for r in spelling.vocabulary(df, slips=31).collect()} == want


def test_odd_rows(spark, odd, nothing):
    long = "WordwordÉ×÷ wordwordÉ×÷ " + "b" * 200_000 + " " + "B" * 200_000
    extra = spark.createDataFrame([(11, long, "x", 1, "n", 2), (12, None, "x", 1, "n", 2)], odd.schema)
    got = spelling.vocabulary(odd.union(extra), min_length=3, slips=2)
    docs = [(d, t) for d, t, _ in ODD] + [(11, long)]
    assert {r.word: r.n for r in got.collect()} == counted(docs, slips=2, min_length=3)
    words = spelling.vocabulary(odd, min_length=3, slips=2)
    assert found(spelling.variants(words)) == brute(counted([(d, t) for d, t, _ in ODD], slips=2, min_length=3))
    assert spelling.variants(spelling.vocabulary(nothing)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=9), min_size=1, max_size=25))
def test_index_counts_and_locates_every_pattern(words):
    words = sorted(words)
    index = spelling.BidirectionalIndex([np.array(["abc".index(c) + 1 for c in w]) for w in words], 4)
    text = "".join(f"|{w}" for w in words) * 2
    for pattern in [w[i:j] for w in words[:5] for i in range(len(w)) for j in range(i + 1, len(w) + 1)][:40]:
        half = len(pattern) // 2
        state = np.array([[0, 0, len(text) // 2]])
        for k in list(range(half, len(pattern))):
            state = index.extend(state, True)[:, "abc".index(pattern[k]) + 1]
        for k in range(half - 1, -1, -1):
            state = index.extend(state, False)[:, "abc".index(pattern[k]) + 1]
        lo, _, size = state[0]
        starts = {i for i in range(len(text) // 2) if text[i:].startswith(pattern)}
        assert set(index.places[lo : lo + size].tolist()) == starts


def test_checksums(spark):
    runs = [b"a", b"bcd", "été".encode(), b"x" * 64, b"y" * 65, b"z" * 1000]
    data = np.frombuffer(b"".join(runs), np.uint8)
    sizes = np.array([len(r) for r in runs])
    before = np.array([crc32(f"{k}:".encode()) for k in range(len(runs))], np.uint32)
    got = spelling._checksums(data, np.cumsum(sizes) - sizes, sizes, before)
    assert got.tolist() == [crc32(f"{k}:".encode() + r) for k, r in enumerate(runs)]


def test_counts_are_passed_on_in_parts(monkeypatch):
    monkeypatch.setattr(spelling, "GATHERED", 10)
    texts = [f"word{chr(97 + i % 26)}letters other{chr(97 + i % 7)}words" for i in range(200)]
    batches = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array([t.encode()])], ["doc_id", "text"]) for i, t in enumerate(texts)]
    got = Counter()
    for part in spelling._counted(4, None)(iter(batches)):
        for w, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            got[w.decode()] += n
    assert got == {w: n for w, n in Counter(x for t in texts for x in re.findall("[a-z]+", t)).items() if len(w) >= 4}
