"""Every registered query against its SQL, and the shape of the registry."""

import pytest

from __spark_entry__ import entry
from tallyfold.plans.catalog import ORACLES, QUERIES
from tests.compare import compare, connect

@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["segment", "n", "weighted", "share"]
    assert abs(sum(r["share"] for r in df.collect()) - 1) < 1e-6


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], sf_dir) == []


@pytest.mark.parametrize("name", ["bootstrap_ci", "bootstrap_ci_weighted", "report_intervals"])
def test_intervals_are_ordered(spark, sf_dir, name):
    for row in QUERIES[name](spark, sf_dir).collect():
        assert 0 <= row["lower"] <= row["observed"] + 1e-9 <= row["upper"] + 2e-9 <= 1 + 3e-9
