from __future__ import annotations

import glob
import os

import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.01"


def rows(name: str, sf: str = SF) -> list[dict]:
    path = f"{sf}/{name}.parquet"
    files = sorted(glob.glob(f"{path}/*.parquet")) if os.path.isdir(path) else [path]
    return [r for f in files for r in pq.read_table(f).to_pylist()]


@pytest.fixture(scope="session")
def documents():
    return rows("documents")


# Null texts and ids, empty and blank texts, ties, repeated rows, and a long text.
ODD = [
    (1, None, None),
    (2, "", "a"),
    (3, " \t\n ", "a"),
    (4, "one two three four five six", "a"),
    (4, "one two three four five six", "a"),
    (9, "one  two\tthree four\n five six", "a"),
    (5, "Ünï çödé   x y 'S don't <|endoftext|> <|ENDOFTEXT|> 12.5%", None),
    (6, "long word " * 40_000 + "x" * 30_000, "b"),
    (None, "no id", "b"),
    (None, "no id", "b"),
    (7, None, "b"),
    (8, "one\n\none\ntwo one\ntwo one\n" * 30, "b"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with extra columns named like columns the operators work with."""
    clash = [(*r, k, "x", k) for k, r in enumerate(ODD)]
    return spark.createDataFrame(
        clash, "doc_id long, text string, source string, uid int, name string, n_words int"
    ).repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.filter("doc_id = -1")
