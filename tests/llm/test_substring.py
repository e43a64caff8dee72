from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridcast.llm import substring
from gridcast.llm import text as tx
from gridcast.llm.oracle import ORACLE
from gridcast.llm.queries import QUERIES
from gridcast.params import Limits
from tests.compare import differences, duck
from tests.llm.conftest import ODD, SF

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LAST = 1 << 70


def brute(docs, window):
    """Sorted (doc_id, n_words, n_removed, kept_sha256) of (doc_id, text)."""
    split = [(d, WORD.findall(t or "")) for d, t in docs]
    least = {}
    for d, w in split:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            least[key] = min(least.get(key, LAST), LAST if d is None else d)
    out = []
    for d, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < (LAST if d is None else d):
                gone.update(range(k, k + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def shown(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def test_query_matches_brute_force(spark, documents):
    got = shown(QUERIES["op13_doubled_windows"](spark, SF))
    assert got == brute([(d["doc_id"], d["text"]) for d in documents], 50)
    assert sum(r[2] for r in got) > 10_000


@pytest.mark.parametrize("window,limits", [(2, Limits()), (6, Limits()), (14, Limits()), (6, Limits(broadcast_bytes=0, hot_rows=20))])
def test_planted_passages(spark, window, limits):
    rng = np.random.default_rng(window)
    passage = [f"p{k}" for k in range(40)]
    docs = []
    for i in range(60):
        own = [f"w{x}" for x in rng.integers(0, 4 if i % 5 == 0 else 60, rng.integers(0, 50))]
        a, b = sorted(rng.integers(0, 41, 2))
        at = rng.integers(0, len(own) + 1)
        docs.append((int(rng.integers(0, 50)), "\t ".join(own[:at] + passage[a:b] + own[at:])))
    docs += [(100 + i, "one text that is there many times over, word for word, " * 3) for i in range(30)]
    docs += [(None, docs[3][1]), (None, docs[3][1]), (3, "  ".join(passage)), (3, " ".join(passage[::-1]))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert shown(substring.remove_repeats(df, window, limits)) == brute(docs, window)


def test_odd_rows(spark, odd, nothing):
    docs = [(d, t) for d, t, _ in ODD]
    for window in (2, 6, 50):
        assert shown(substring.remove_repeats(odd, window)) == brute(docs, window)
    assert substring.remove_repeats(nothing).collect() == []
    with pytest.raises(ValueError):
        substring.remove_repeats(odd, 5)


def test_long_texts_are_taken_in_stretches(spark, monkeypatch):
    words = tx.mix(np.arange(1, 2001, dtype=np.uint64))
    firsts = np.array([0, 700, 700, 2000])

    def every():
        found = [(start + at, halves[at], halves[at + 5], least[at]) for start, halves, least, inside in substring._stretches(words, firsts, 10) for at in inside.tolist()]
        return sorted(found)

    whole = every()
    assert len(whole) == (700 - 9) + (1300 - 9)
    for size in (1, 7, 64, 699):
        monkeypatch.setattr(substring, "STRETCH", size)
        assert every() == whole


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=60), st.integers(1, 30))
def test_names_tell_windows_apart(codes, width):
    words = tx.mix(np.array(codes, np.uint64) + np.uint64(5))
    got = substring.names(words, width)
    windows = [tuple(codes[i : i + width]) for i in range(len(codes) - width + 1)]
    assert len(got) == len(windows)
    assert len(set(got.tolist())) == len(set(windows))
    assert len(set(zip(windows, got.tolist()))) == len(set(windows))
    if len(got) >= 3:
        assert substring._least(got, 3).tolist() == [min(got[i : i + 3].tolist()) for i in range(len(got) - 2)]


def test_query_matches_sql(spark):
    assert differences(QUERIES["op13_doubled_windows"](spark, SF), duck(SF), ORACLE["op13_doubled_windows"]) == ""
