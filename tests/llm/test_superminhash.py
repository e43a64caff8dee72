from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from gridcast.llm import components, superminhash
from gridcast.llm.oracle import ORACLE
from gridcast.llm.queries import QUERIES
from tests.compare import differences, duck
from tests.llm.conftest import ODD, SF

WORD = re.compile(r"[^\x20\x09-\x0d]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOW))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def groups(docs, percent=85):
    """Components over all pairs that share a shingle."""
    sets = [shingles(t) for _, t in docs]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    found = components.UnionFind()
    done = set()
    for ids in holders.values():
        for i in ids:
            for j in ids:
                if i < j and (i, j) not in done:
                    done.add((i, j))
                    both = len(sets[i] & sets[j])
                    if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                        found.union(i, j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(docs):
        least[found.find(i)].append(doc)
    out = []
    for i, (doc, _) in enumerate(docs):
        known = [d for d in least[found.find(i)] if d is not None]
        first = min(known, default=None)
        out.append((str(doc), len(sets[i]), first, doc == first))
    return sorted(out, key=str)


def result(df):
    return sorted(((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def copies(seed=1, n=60):
    """A base text, copies with more and more words changed, and texts of their own."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(3000)}" for _ in range(120)]
    docs = []
    for i in range(n):
        words = list(base)
        for _ in range(i % 6):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(words)))
    docs += [(1000 + i, " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(1, 90)))) for i in range(40)]
    rng.shuffle(docs)
    return docs


def test_query_matches_brute_force(spark, documents):
    want = groups([(d["doc_id"], d["text"]) for d in documents])
    assert result(QUERIES["op4_superminhash"](spark, SF)) == want


@pytest.mark.parametrize(("bucket", "group"), [(1024, 4096), (8, 4096), (1024, 8), (8, 8)])
def test_hot_group_of_near_copies(spark, bucket, group):
    docs = copies()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = superminhash.near_duplicates(df, superminhash.Near(bucket=bucket, group=group))
    assert result(got) == groups(docs)


def test_odd_rows(spark, odd, nothing):
    assert result(superminhash.near_duplicates(odd)) == groups([(d, t) for d, t, _ in ODD])
    assert superminhash.near_duplicates(nothing).collect() == []


def plain(element_hashes, slots):
    """The method one element and one step at a time, with the permutation written out."""
    from gridcast.llm import text as tx

    sig = [None] * slots
    for e in element_hashes:
        p = list(range(slots))
        for j in range(slots):
            x = int(tx.mix(np.array([e], np.uint64) + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % 2**64))[0])
            k = j + (((x & 0xFFFFFFFF) * (slots - j)) >> 32)
            p[j], p[k] = p[k], p[j]
            value = (j << 24) | (x >> 40)
            if sig[p[j]] is None or value < sig[p[j]]:
                sig[p[j]] = value
    return sig


@pytest.mark.parametrize("sizes", [[1, 2, 7], [40, 300], [3]])
def test_early_stopping_changes_nothing(sizes):
    rng = np.random.default_rng(7)
    elements = rng.integers(0, 2**63, sum(sizes)).astype(np.uint64)
    texts = np.repeat(np.arange(len(sizes)), sizes)
    got = superminhash.superminhash(elements, texts, len(sizes), 20)
    for i in range(len(sizes)):
        assert got[i].tolist() == plain(elements[texts == i].tolist(), 20)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(30):
        base = rng.integers(0, 2**63, 300).astype(np.uint64)
        a, b = base[:250], base[50:]
        sig = superminhash.superminhash(np.concatenate([a, b]), np.repeat([0, 1], [250, 250]), 2, 125)
        errors.append((sig[0] == sig[1]).mean() - 200 / 300)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_visiting_sets_finds_all_that_are_connected():
    rng = np.random.default_rng(11)
    for _ in range(20):
        base = rng.integers(0, 2**63, 60).astype(np.uint64)
        sets = []
        for _ in range(30):
            own = base.copy()
            changed = rng.choice(60, rng.integers(0, 9), replace=False)
            own[changed] = rng.integers(0, 2**63, len(changed))
            sets.append(np.unique(own))
        want, got = components.UnionFind(), components.UnionFind()
        for x in range(30):
            for y in range(x):
                both = len(np.intersect1d(sets[x], sets[y]))
                if 100 * both >= 85 * (len(sets[x]) + len(sets[y]) - both):
                    want.union(x, y)
        for x, y in superminhash.spanning_links(sets, 85):
            got.union(x, y)
        assert [got.find(x) for x in range(30)] == [want.find(x) for x in range(30)]


@pytest.mark.parametrize("task_edges", [components.BATCH_EDGES, 10])
def test_components_of_long_paths_and_stars(spark, task_edges):
    rng = random.Random(4)
    nodes = list(range(400))
    rng.shuffle(nodes)
    edges = list(zip(nodes[:150], nodes[1:151])) + [(nodes[200], x) for x in nodes[201:300]] + [(nodes[310], nodes[311])]
    df = spark.createDataFrame(edges, "a long, b long").repartition(12)
    got = {r.node: r.root for r in components.components(df, task_edges=task_edges).collect()}
    found = components.UnionFind()
    for a, b in edges:
        found.union(a, b)
    assert got == {x: found.find(x) for e in edges for x in e if found.find(x) != x}


def test_query_matches_sql(spark):
    assert differences(QUERIES["op4_superminhash"](spark, SF), duck(SF), ORACLE["op4_superminhash"]) == ""
