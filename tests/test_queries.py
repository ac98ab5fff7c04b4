"""Every registered query against its oracle, on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry
from check import compare, open_tables
from hiregrain.plans.oracles import ORACLES
from hiregrain.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def database():
    return open_tables(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["collected_date", "source", "posting_count"]
    assert result.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, database, name):
    rows, missing, extra = compare(spark, database, SF_DIR, name)
    assert not missing and not extra
    # A failing hour or a full table may be missing from so little data, but not all rows.
    assert rows > 0
