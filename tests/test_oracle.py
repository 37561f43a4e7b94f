"""Every registered query equals its DuckDB statement (sf0.001), and the
driver contract of ``__spark_entry__`` holds."""

import pytest

from conftest import SF_SMALL
from oracle_harness import compare, duck
from varlake.plans.catalog import REGISTRY


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_SMALL, con)
    if REGISTRY[name][1] is None:
        assert r["spark_rows"] >= 0
    else:
        assert r["match"], r


def test_entry_contract(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
