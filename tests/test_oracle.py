"""Every SQL-checkable query equals its DuckDB text (the driver's gate) on the
smallest tables; rows-only queries run and return rows."""

import pytest

import __spark_entry__ as E
from fleetspark.plans import variants
from fleetspark.plans.queries import QUERIES as BASE
from fleetspark.plans.verify import compare, duck

from .conftest import SF_SMALL

SQL = E.oracle_sql()
QUERIES = BASE | variants.QUERIES
NAMES = sorted(set(SQL) & set(QUERIES))


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    r = compare(E.queries()[name](spark, SF_SMALL), SQL[name], con)
    assert r["ok"], r


def test_every_query_has_oracle_or_is_listed_rows_only():
    rows_only = {"embedding", "seq_fuel_pred", "seq_train_mae", "feature_scout", "cv_regression", "scatter_sample",
                 "train_predictions", "test_predictions"}
    library = set(QUERIES)
    assert library == (set(SQL) & library) | rows_only


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "engine_on_hrs" in df.columns
