"""Properties: split distances add up, time budgets are
consistent, state is binary, and the partition count does not change results."""

import math

from pyspark.sql import functions as F

from fleetspark.plans import queries as Q

from .conftest import SF_MID


def test_loaded_plus_empty_is_total(spark):
    c = Q._ctx(spark, SF_MID)
    j = c.trips.join(c.shift, ["dumper_id", "date_dpr", "shift"])
    bad = j.where(F.abs(F.col("loaded_dist_hav_km") + F.col("empty_dist_hav_km") - F.col("total_dist_hav_km")) > 2e-4)
    assert bad.count() == 0


def test_prod_plus_idle_within_engine_on(spark):
    s = Q._ctx(spark, SF_MID).shift
    assert s.where(F.col("prod_hrs") + F.col("idle_hrs") > F.col("engine_on_hrs") + 1e-4).count() == 0
    assert s.where((F.col("engine_on_hrs") > 8) | (F.col("idle_ratio") > 1.0001)).count() == 0


def test_state_is_binary_and_trips_start_loaded(spark):
    st = Q._ctx(spark, SF_MID).state
    assert st.where(~F.col("state").isin(0.0, 1.0)).count() == 0
    assert st.where((F.col("new_trip") == 1) & (F.col("state") != 1)).count() == 0


def _rows(df):
    key = ("dumper_id", "date_dpr", "shift")
    rows = {tuple(r[k] for k in key): tuple(round(v, 4) if isinstance(v, float) else v for v in r)
            for r in df.collect()}
    return [rows[k] for k in sorted(rows, key=str)]


def test_partition_count_does_not_change_results(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    try:
        for n in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            Q.reset_contexts()
            df = Q.QUERIES["trip_features"](spark, SF_MID)
            out.append(_rows(df.select(*sorted(df.columns))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        Q.reset_contexts()
    a, b = out
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            assert u == v or (isinstance(u, float) and isinstance(v, float) and math.isclose(u, v, abs_tol=1e-4)), (x, y)
