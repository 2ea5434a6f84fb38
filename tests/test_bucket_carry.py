"""Bucketed ordered passes give the same answer for any bucket width: with
15-minute buckets every shift and many stop runs cross buckets, and the
results must still equal the DuckDB oracle (plain vehicle windows)."""

import pytest

import __spark_entry__ as E
from fleetspark.plans import queries as Q
from fleetspark.plans.verify import compare, duck

from .conftest import SF_SMALL

CHECK = ["time_deltas", "gap_status", "shift_features", "stop_events", "body_edges", "event_marks", "trip_state",
         "trip_features", "sequences"]


@pytest.fixture(scope="module")
def small_buckets(spark):
    Q._CTX.clear()
    ctx = Q.Ctx(spark, SF_SMALL, Q.FIXTURE_PARAMS.with_(bucket_s=900))
    key = (spark.sparkContext.applicationId, id(spark), SF_SMALL)
    Q._CTX[key] = ctx
    yield ctx
    Q._CTX.clear()


@pytest.mark.parametrize("name", CHECK)
def test_small_buckets_match_oracle(spark, small_buckets, name):
    r = compare(E.queries()[name](spark, SF_SMALL), E.oracle_sql()[name], duck(SF_SMALL))
    assert r["ok"], r
