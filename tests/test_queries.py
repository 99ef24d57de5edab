"""Every registered query against its oracle."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_module  # noqa: E402

from pubweave.plans.catalog import QUERIES  # noqa: E402
from pubweave.plans.oracles import ORACLES  # noqa: E402
from tests import oracle_check  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    connection = oracle_check.connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    assert oracle_check.differences(df, oracle, ORACLES[name]) == []


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
