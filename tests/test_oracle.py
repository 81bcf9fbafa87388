"""Every registered query against its DuckDB oracle (sf0.001, exact after rounding)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries

from tests.compare import compare, duck
from tests.conftest import SF_SMALL

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(queries())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "xx_re" in df.columns


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    diff = compare(queries()[name](spark, SF_SMALL), con, ORACLE[name])
    assert diff is None, diff


@pytest.mark.parametrize("name", sorted(set(queries()) - set(ORACLE)))
def test_query_without_oracle_runs(spark, name):
    assert queries()[name](spark, SF_SMALL).count() >= 0
