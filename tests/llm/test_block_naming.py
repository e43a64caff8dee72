from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest

from gridcast.llm import block_naming
from gridcast.llm.oracle import ORACLE
from gridcast.llm.queries import QUERIES
from tests.compare import differences, duck
from tests.llm.conftest import ODD, SF


def norm(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text or "")


def check(got, docs):
    groups = defaultdict(list)
    for doc, text in docs:
        groups[norm(text)].append(doc)
    assert len(got) == len(docs)
    by_text = defaultdict(list)
    for r in got:
        by_text[r.text_sha256].append(r)
    for text, ids in groups.items():
        rows = by_text[hashlib.sha256(text.encode()).hexdigest()]
        assert sorted(str(r.doc_id) for r in rows) == sorted(map(str, ids))
        known = [i for i in ids if i is not None]
        assert {r.keep_id for r in rows} == {min(known, default=None)}
        assert {r.group_size for r in rows} == {len(ids)}
        assert [r.doc_id for r in rows if r.kept] == [min(known, default=None)]


def test_query_matches_sql(spark):
    df = QUERIES["op8_block_naming"](spark, SF)
    assert differences(df, duck(SF), ORACLE["op8_block_naming"]) == ""


@pytest.mark.parametrize("chars", [1, 3, 4096])
def test_block_sizes_give_the_same_groups(spark, chars):
    docs = [(i, t) for i, t in enumerate(["abcabc", "abc", "abcabcabc", "ab", "", None, "cab", "abcabc", "abc ", "abc\n", "bcabca"])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    check(block_naming.exact_duplicates(df, block_chars=chars).collect(), docs)


def test_contents_that_share_a_hash_are_told_apart(spark):
    docs = [(i, f"text {i % 37} of some length") for i in range(80)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    check(block_naming.exact_duplicates(df, block_chars=5, hash_bits=3).collect(), docs)


def test_hot_group_of_copies(spark):
    docs = [(i, "the same text again and again" if i % 3 else f"another {i}") for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    check(block_naming.exact_duplicates(df, block_chars=8).collect(), docs)


def test_odd_rows(spark, odd, nothing):
    check(block_naming.exact_duplicates(odd, block_chars=1000).collect(), [(d, t) for d, t, _ in ODD])
    assert block_naming.exact_duplicates(nothing).collect() == []
