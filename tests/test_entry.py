import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 5
    assert {"passenger_loyalty", "driver_experience_level", "route", "ingest_timestamp"} <= set(df.columns)
    assert len(df.columns) == len(set(df.columns))


def test_every_refinement_query_has_an_oracle():
    assert set(E.QUERIES) == set(E.ORACLES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, n_spark, n_duck, _, detail = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
    assert ok, detail
    assert n_spark == n_duck > 0
