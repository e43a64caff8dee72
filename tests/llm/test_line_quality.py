from __future__ import annotations

import re
from collections import Counter, defaultdict

from gridcast.llm import line_quality
from gridcast.llm.oracle import ORACLE
from gridcast.llm.queries import QUERIES
from tests.compare import differences, duck
from tests.llm.conftest import ODD, SF

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def counts(text):
    w = WORD.findall(text or "")
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = {g for g, n in Counter(grams).items() if n > 1}
    hit = {i + k for i, g in enumerate(grams) if g in often for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def verdicts(docs, max_docs, max_share, min_left=0.5):
    """Straight from the rule, with exact lines; documents told apart by their least shingle."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def sketch(text):
        # Any fixed order of shingles does; the operator's is by hash.
        w = WORD.findall((text or "").translate(low))
        return tuple(w)

    seen, host = defaultdict(set), defaultdict(set)
    for _, text, source in docs:
        host[source].add(sketch(text))
        for line in (text or "").translate(low).split("\n"):
            if k := tuple(WORD.findall(line)):
                seen[source, k].add(sketch(text))
    out = []
    for _, text, source in docs:
        lost = sum(
            len(k)
            for line in (text or "").translate(low).split("\n")
            if (k := tuple(WORD.findall(line)))
            and len(seen[source, k]) > max(max_docs, max_share * len(host[source]))
        )
        out.append(lost)
    return out


def test_counts_match_brute_force(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op7_line_frequency"](spark, SF).collect()}
    assert len(got) == len(documents)
    for d in documents:
        r = got[d["doc_id"]]
        want = counts(d["text"])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept == (not r.base_failed and r.n_words - r.n_removed_words >= 0.5 * r.n_words)


def test_frequent_lines_match_brute_force(spark):
    # Texts without copies, so that every document has a sketch of its own.
    docs = []
    for i in range(60):
        own = " ".join(f"w{i}x{k}" for k in range(40))
        shared = "Shared  line of five words\nshared line of FIVE words\n" if i % 2 else ""
        rare = "a rare line\n" if i < 4 else ""
        docs.append((i, shared + rare + own, f"h{i % 3}"))
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = {r.doc_id: r.n_removed_words for r in line_quality.line_rules(df, max_docs=3, max_share=0.2).collect()}
    assert [got[i] for i in range(60)] == verdicts(docs, 3, 0.2)
    assert max(got.values()) == 10


def test_depleted_documents_are_rejected_and_copies_are_not(spark):
    line = "a very common line that many documents of the host happen to have " * 6
    docs = [(i, line + "\n" + " ".join(f"v{i}y{k}" for k in range(30)), "h") for i in range(40)]
    whole = " ".join(f"c{k}" for k in range(80)) + "\nlast line here"
    docs += [(100 + i, whole, "h") for i in range(200)]
    # Near copies: a word of each is changed.
    docs += [(400 + i, whole.replace(f"c{i % 80}", f"z{i}"), "h") for i in range(100)]
    docs += [(1000 + i, " ".join(f"u{i}q{k}" for k in range(60)), "h") for i in range(100)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = {r.doc_id: r.kept for r in line_quality.line_rules(df, max_docs=30, max_share=0.05).collect()}
    assert not any(got[i] for i in range(40))
    assert all(v for k, v in got.items() if k >= 100)


def test_different_documents_of_mostly_shared_words_are_depleted(spark):
    # Production limits. Copies and near copies with one word changed still count once.
    docs = []
    for host, n, own, shared in (("a", 40, 30, 78), ("b", 30, 20, 200), ("c", 100, 20, 200)):
        passage = " ".join(f"{host}s{k}" for k in range(shared))
        docs += [(host, passage + "\n" + " ".join(f"{host}{i}o{k}" for k in range(own))) for i in range(n)]
    lines = [" ".join(f"l{j}w{k}" for k in range(20)) for j in range(20)]
    docs += [("d", "\n".join(lines))] * 30
    docs += [("e", "\n".join([*lines[:9], f"e{i} " + lines[9], *lines[10:]])) for i in range(60)]
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "doc_id long, source string, text string")
    got = line_quality.line_rules(df).groupBy("source", "kept").count().collect()
    assert {(r.source, r.kept, r["count"]) for r in got} == {
        ("a", False, 40), ("b", False, 30), ("c", False, 100), ("d", True, 30), ("e", True, 60),
    }


def test_cleaned_texts_lose_only_frequent_lines(spark):
    docs = [(i, f"own {i} {i * i}\nCommon   line\nlast {i}", "h") for i in range(10)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in line_quality.cleaned_texts(df, max_docs=5, max_share=0.1).collect()}
    assert got == {i: f"own {i} {i * i}\nlast {i}" for i in range(10)}


def test_odd_rows(spark, odd, nothing):
    got = line_quality.line_rules(odd).collect()
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == sorted(
        counts(t) for _, t, _ in ODD
    )
    assert len({r.uid for r in got}) == len(ODD)
    assert line_quality.line_rules(nothing).collect() == []
    assert len(line_quality.cleaned_texts(odd).collect()) == len(ODD)


def test_query_matches_sql(spark):
    assert differences(QUERIES["op7_line_frequency"](spark, SF), duck(SF), ORACLE["op7_line_frequency"]) == ""
