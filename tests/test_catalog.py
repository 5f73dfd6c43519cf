"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import pytest
from compare import differences, duck

import __spark_entry__ as contract
from quayside.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def tables(sf_dir):
    return duck(sf_dir)


def test_every_query_has_a_counterpart():
    assert set(ORACLES) == set(QUERIES) and set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, tables, sf_dir, name):
    frame = contract.queries()[name](spark, sf_dir)
    assert differences(frame, tables, contract.oracle_sql()[name]) is None


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
