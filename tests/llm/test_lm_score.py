from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from gridcast.llm import lm_score
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, targets, form):
    """Both models with dictionaries, counted anew for every document without that document."""
    split = [(d, WORD.findall((t or "").translate(LOW))) for d, t in docs]

    def counted(ws):
        pairs = list(zip([None, *ws], ws))
        return Counter(ws), Counter(a for a, _ in pairs), Counter(pairs)

    own = [counted(ws) for _, ws in split]
    vocabulary = len({w for _, ws in split for w in ws})
    out = []
    for i, (d, ws) in enumerate(split):
        losses = []
        for of_target in (True, False):
            words, befores, pairs = Counter(), Counter(), Counter()
            for j, (e, _) in enumerate(split):
                if j != i and (not of_target or e in targets):
                    for total, part in zip((words, befores, pairs), own[j]):
                        total.update(part)
            every = sum(words.values()) + form.added * vocabulary
            loss = 0.0
            for a, w in zip([None, *ws], ws):
                alone = (words[w] + form.added) / every
                after = (pairs[a, w] + form.added_pair) / (befores[a] + form.added_pair * vocabulary)
                loss -= (1 - form.bigram) * math.log(alone) + form.bigram * math.log(after)
            losses.append(loss / len(ws) if ws else 0.0)
        out.append((str(d), len(ws), *losses))
    return sorted(out)


def result(df):
    got = df.collect()
    assert all(abs(r.score - (r.target_loss - r.background_loss)) < 1e-12 for r in got)
    return sorted((str(r.doc_id), r.n_words, r.target_loss, r.background_loss) for r in got)


def same(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], abs=1e-9)


@pytest.mark.parametrize("often,known,gathered", [(64, 500_000, 1_000_000), (2, 500_000, 50), (10**9, 1, 1_000_000)])
def test_matches_brute_force_without_the_document_itself(spark, monkeypatch, often, known, gathered):
    """Counts known to every task or joined, gathered or passed on, give the same scores."""
    for name, value in (("OFTEN", often), ("KNOWN_KEYS", known), ("GATHERED", gathered)):
        monkeypatch.setattr(lm_score, name, value)
    docs = [(i, " ".join(f"W{k}" for k in range(30) for _ in range(1 + (i % 5 == 0)) if i % (k + 1) == 0)) for i in range(1, 80)]
    docs += [(100 + i, " ".join(f"w{(i * 37 + k * k) % 4000}" for k in range(i))) for i in range(60)]
    docs += [(300 + i, "of the rare pair of words that often comes") for i in range(20)]
    docs += [(300, "of the same number"), (None, "of the"), (7, None), (8, "")]
    targets = {d for d, _ in docs if d is not None and d % 3 == 0}
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    chosen = spark.createDataFrame([(t,) for t in targets] * 2, "doc_id long")
    want = brute(docs, targets, lm_score.Form())
    same(result(lm_score.cross_entropy_difference(df, chosen)), want)


def test_no_document_scores_itself(spark):
    """Being listed as a target does not make a text unlike all targets any better."""
    docs = [(i, " ".join(f"a{(i * 7 + k * k) % 90}" for k in range(60))) for i in range(60)]
    docs += [(100 + i, " ".join(f"b{i}x{k}" for k in range(60))) for i in range(2)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    listed = spark.createDataFrame([(i,) for i in [*range(30), 100]], "doc_id long")
    got = {r.doc_id: r.score for r in lm_score.cross_entropy_difference(df, listed).collect()}
    assert abs(got[100] - got[101]) < 0.2


def test_target_like_texts_score_lower(spark):
    docs = [(i, "red green blue " * 10 if i % 2 else "one two three " * 10) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    chosen = spark.createDataFrame([(i,) for i in range(1, 20, 2)], "doc_id long")
    got = {r.doc_id: r.score for r in lm_score.cross_entropy_difference(df, chosen).collect()}
    assert max(v for k, v in got.items() if k % 2) < 0 < min(v for k, v in got.items() if not k % 2)


def test_odd_rows(spark, odd, nothing):
    some = spark.createDataFrame([(4,), (None,), (77,)], "doc_id long")
    got = lm_score.cross_entropy_difference(odd, some).collect()
    assert len(got) == len(ODD)
    assert all(r.score == 0 for r in got if r.n_words == 0)
    assert lm_score.cross_entropy_difference(nothing, some).collect() == []


def test_no_row_per_key_is_shuffled(spark, monkeypatch):
    """Chunks ask and are answered by rows per bucket; small chunks and buckets give the same scores."""
    docs = [(i, " ".join(f"w{(i * 37 + k * k) % 500}" for k in range(i))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    chosen = spark.createDataFrame([(t,) for t in range(0, 60, 4)], "doc_id long")
    both = lm_score.models(lm_score.flag_targets(df, chosen))
    assert both.counts.count() <= 3
    for name, value in (("OFTEN", 1), ("KNOWN_KEYS", 100), ("GATHERED", 200)):
        monkeypatch.setattr(lm_score, name, value)
    want = brute(docs, set(range(0, 60, 4)), lm_score.Form())
    same(result(lm_score.cross_entropy_difference(df, chosen)), want)
