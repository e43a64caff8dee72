from __future__ import annotations

import hashlib
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from gridcast.llm import merkle
from gridcast.llm.oracle import ORACLE
from gridcast.llm.queries import QUERIES
from tests.compare import differences, duck
from tests.llm.conftest import SF


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def coded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([H(*last[i : i + 3]) for i in range(0, len(last), 3)])
    return out


def steps(tree, at):
    out = []
    for level in tree[:-1]:
        first = at // 3 * 3
        out.append((level[first:at], level[at + 1 : first + 3]))
        at //= 3
    return out


def brute(rows, again):
    """Sorted (leaf, subroot, root, proof, folded, verified) of (doc_id, source, lang, n_chars, text)."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    for own in by.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, H(*map(coded, r))))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([H(*map(coded, r)) for r in by[s]]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    root, out = top[-1][0], []
    for k, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            path = steps(trees[s], i) + steps(top, k)
            node = H(*map(coded, (*r[:4], again(r))))
            for left, right in path:
                node = H(*left, node, *right)
            proof = H(*[x for left, right in path for x in left + right])
            out.append((trees[s][0][i], trees[s][-1][0], root, proof, node, node == root))
    return sorted(out)


def shown(df):
    return sorted(
        (r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect()
    )


def test_query_matches_sql(spark):
    assert differences(QUERIES["op11_merkle_manifest"](spark, SF), duck(SF), ORACLE["op11_merkle_manifest"]) == ""


@pytest.mark.parametrize("rows_of", [[1], [2, 3, 4], [243, 244, 242], [1000, 1, 729, 730], [1] * 300])
def test_trees_of_any_size(spark, rows_of):
    rows = [
        (100 * k + i, f"s{k:03}" if k else None, "é", i, f"text\n{i}") for k, n in enumerate(rows_of) for i in range(n)
    ]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    lost = F.when(F.col("n_chars") % 3 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    want = brute(rows, lambda r: r[4].replace("\n", "") if r[3] % 3 == 0 else r[4])
    assert shown(merkle.manifest(df, lost)) == want


def test_odd_rows(spark, odd, nothing):
    df = odd.withColumn("lang", F.lit(None).cast("string")).withColumn("n_chars", F.length("text").cast("long"))
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()]
    assert shown(merkle.manifest(df)) == brute(rows, lambda r: r[4])
    assert merkle.manifest(nothing.withColumn("lang", F.lit("")).withColumn("n_chars", F.lit(1))).collect() == []


def test_any_change_of_a_field_is_found(spark):
    rows = [(i, "a", "en", 3, f"t{i}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = merkle.manifest(df, F.when(F.col("doc_id") == 7, F.lit("t7 ")).otherwise(F.col("text"))).collect()
    assert [r.doc_id for r in got if not r.verified] == [7]


def test_checksum_of_a_doc_id_decides_the_query(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op11_merkle_manifest"](spark, SF).collect():
        tampered = crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (text[r.doc_id] or "")
        assert r.verified == (not tampered)
