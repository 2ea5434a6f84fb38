"""The documented non-default behaviours run and differ from parity where
they should."""

from pyspark.sql import functions as F

from fleetspark.plans import queries as Q

from .conftest import SF_SMALL


def _trips(spark, **kw):
    Q.reset_contexts()
    c = Q.Ctx(spark, SF_SMALL, Q.FIXTURE_PARAMS.with_(**kw))
    try:
        return c.trips.collect(), c.state.where(F.col("ev_flag").isNotNull()).count()
    finally:
        c.close()


def test_vehicle_scope_marks_fewer_pings(spark):
    fleet_rows, fleet_marked = _trips(spark)
    veh_rows, veh_marked = _trips(spark, event_scope="vehicle")
    assert len(veh_rows) == len(fleet_rows)
    assert 0 < veh_marked <= fleet_marked


def test_mine002_fallback_flag(spark):
    rows, _ = _trips(spark, fallback_mine002=True)
    parity, _ = _trips(spark)
    assert sum(r["is_fallback"] for r in rows) >= sum(r["is_fallback"] for r in parity)
    Q.reset_contexts()
