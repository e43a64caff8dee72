"""Every query with SQL agrees with it, value by value, on the smallest test tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from gridcast.plans.queries import QUERIES
from tests.compare import differences, duck

SF = "/root/testdata/sf0.001"
ROWS_ONLY = {"train_score", "train_baseline", "holdout_evaluation", "feature_importance"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert differences(queries()[name](spark, SF), con, oracle_sql()[name]) == ""


def test_only_learning_goes_without_sql():
    # The library's own queries; those of the training-data package are tested with it.
    assert set(QUERIES) - set(oracle_sql()) == ROWS_ONLY
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    rows = entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {
        "driver", "team", "avg_lap_delta", "avg_consistency", "avg_vs_teammate",
    }
    assert [r.avg_lap_delta for r in rows] == sorted(r.avg_lap_delta for r in rows)
