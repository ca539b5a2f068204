"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

from __spark_entry__ import queries
from flowtable.plans import ORACLES, QUERIES
from tests.compare import compare, duck
from tests.conftest import SF_CHECK


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_CHECK)
    compare(df, con, ORACLES[name])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_small(spark, name):
    df = queries()[name](spark, "/root/testdata/sf0.001")
    df.count()
