"""Hand-made cases (FIXTURES.md §4): a few rows each, expected values worked
out from the reference's rules."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetspark.functions.geo import point_in_polygons
from fleetspark.operators.asof import asof_nearest, close_pairs, closest_loaders, confirmed_loads, nearest_loaders
from fleetspark.operators.clean import clean_haulers
from fleetspark.operators.marks import event_bins, mark_pings
from fleetspark.operators.pings import ping_pass
from fleetspark.operators.sequence import sequence_rows
from fleetspark.params import Params
from fleetspark.sources.telemetry import conform

T0 = dt.datetime(2026, 1, 1, 6, 0, 0)
P = Params(analog_cut_us=0)
COLS = ("vehicle string, ts timestamp, speed double, ignition int, altitude double, angle double, satellites int, "
        "gnss_hdop double, gnss_pdop double, fuel_volume double, analog_input_1 double, mine_anon string, "
        "shift_dpr string, date_dpr date, operator_id bigint, utm_x double, utm_y double, ping_id bigint")


def pings(spark, rows, p=P):
    """rows: dicts with offsets in seconds ('t') and overrides."""
    base = dict(vehicle="Dump1", speed=10.0, ignition=1, altitude=600.0, angle=0.0, satellites=9, gnss_hdop=1.0,
                gnss_pdop=1.0, fuel_volume=100.0, analog_input_1=0.0, mine_anon="mine001", shift_dpr="A",
                date_dpr=T0.date(), operator_id=1, utm_x=500000.0, utm_y=2600000.0)
    out = []
    for i, r in enumerate(rows):
        d = {**base, **r}
        d["ts"] = T0 + dt.timedelta(seconds=d.pop("t"))
        d["ping_id"] = d.pop("pid", i)
        out.append(tuple(d[c.split()[0]] for c in COLS.split(", ")))
    tel = conform(spark.createDataFrame(out, COLS))
    return ping_pass(clean_haulers(tel, p), p)


def by_pid(df, *cols):
    return {r["ping_id"]: tuple(r[c] for c in cols) for r in df.select("ping_id", *cols).collect()}


def test_gps_flag_null_rules(spark):
    d = pings(spark, [dict(t=0, gnss_hdop=None, gnss_pdop=3.0), dict(t=10, gnss_pdop=None),
                      dict(t=20, satellites=None), dict(t=30, gnss_hdop=4.0, gnss_pdop=6.0)])
    assert by_pid(d, "gps_ok") == {0: (1,), 1: (0,), 2: (0,), 3: (1,)}


def test_gap_exactly_300s_and_fuel_drop_exactly_2(spark):
    d = pings(spark, [dict(t=0, fuel_volume=100.0), dict(t=300, fuel_volume=98.0), dict(t=900, fuel_volume=95.0),
                      dict(t=1000, fuel_volume=None), dict(t=1400)])
    got = by_pid(d, "is_gap_300s", "dt_sec", "gap_status")
    assert got[1] == (1, 300.0, "engine_off_stationary")      # delta -2 is not below -2
    assert got[2] == (1, 300.0, "engine_running_blind")       # delta -3
    assert got[3][0] == 0
    assert got[4] == (1, 300.0, "normal")                      # unknown fuel change


def test_heading_wraps_and_clipping_keeps_null(spark):
    d = pings(spark, [dict(t=0, angle=350.0), dict(t=5, angle=10.0), dict(t=10, speed=None, altitude=900.0)])
    got = by_pid(d, "angd_raw", "speed", "altitude")
    assert got[1][0] == 20.0
    assert got[2][1] is None and got[2][2] == 800.0


def test_duplicate_timestamps_ordered_by_ping_id(spark):
    d = pings(spark, [dict(t=0, pid=7, altitude=600.0), dict(t=0, pid=3, altitude=610.0), dict(t=5, pid=1, altitude=620.0)])
    got = by_pid(d, "adiff")
    assert got == {3: (0.0,), 7: (-10.0,), 1: (20.0,)}


def test_body_up_first_row_is_not_an_edge(spark):
    d = pings(spark, [dict(t=0, analog_input_1=1.0), dict(t=10, analog_input_1=0.0), dict(t=20, analog_input_1=1.0),
                      dict(t=40, analog_input_1=0.0)])
    got = by_pid(d, "bu_rise", "bu_fall")
    assert got[0] == (False, False) and got[1] == (False, True) and got[2] == (True, False) and got[3] == (False, True)


def test_asof_ties_and_inclusive_tolerance(spark):
    left = spark.createDataFrame([(1, 2 * 1_000_000_000)], "k int, t2 long")  # mid = 1000 s
    right = spark.createDataFrame(
        [("L1", 990_000_000, 1, 1.0), ("L1", 1_010_000_000, 2, 2.0),          # equal distance -> earlier
         ("L2", 1_120_000_000, 3, 3.0), ("L2", 1_120_000_000, 4, 4.0),        # exactly 120 s after, tie -> first
         ("L3", 880_000_000, 5, 5.0), ("L3", 880_000_000, 6, 6.0),            # exactly 120 s before, tie -> last
         ("L4", 1_120_000_001, 7, 7.0)],                                       # beyond tolerance
        "g string, t long, pid long, v double")
    out = asof_nearest(left, ["k"], "t2", right, "g", "t", "pid", 120_000_000, ["v"])
    got = {r["g"]: r["v"] for r in out.collect()}
    assert got == {"L1": 1.0, "L2": 3.0, "L3": 6.0}


def test_event_exactly_5s_marks_and_load_wins(spark):
    d = pings(spark, [dict(t=0), dict(t=100), dict(t=200)])
    t0 = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
    ev = spark.createDataFrame([("dump", t0 + 105_000_000), ("load", t0 + 95_000_000), ("dump", t0 + 205_000_001)],
                               "kind string, ts_us long")
    m = mark_pings(d, event_bins(ev, P), P, bins_rows=3)
    assert by_pid(m, "ev_flag") == {0: (None,), 1: (1.0,), 2: (None,)}


def test_point_in_polygon_edges_vertices_holes_multi(spark):
    square = [[(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], [(4, 4), (6, 4), (6, 6), (4, 6), (4, 4)]]
    far = [[(20, 20), (30, 20), (25, 30), (20, 20)]]
    polys = [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in poly] for poly in (square, far)]
    pts = [(10.0, 5.0, True), (0.0, 0.0, True), (5.0, 5.0, False), (4.0, 5.0, True), (2.0, 2.0, True),
           (25.0, 25.0, True), (11.0, 5.0, False), (25.0, 31.0, False)]
    df = spark.createDataFrame([(x, y, e, polys) for x, y, e in pts],
                               "px double, py double, expected boolean, polygons array<array<array<struct<x:double,y:double>>>>")
    res = df.select("expected", point_in_polygons("px", "py", "polygons").alias("got")).collect()
    assert all(r["expected"] == r["got"] for r in res), res


@pytest.mark.parametrize("n", [9, 13, 37])
def test_sequence_subsample_matches_numpy_linspace(spark, n):
    d = pings(spark, [dict(t=5 * i, speed=float(i)) for i in range(n)])
    rows = sequence_rows(d, P, max_len=8).orderBy("pos").collect()
    expect = np.linspace(0, n - 1, 8, dtype=int)
    assert [r["pos"] for r in rows] == list(range(8))
    assert [round(r["speed"] * 60) for r in rows] == list(expect)


def test_short_shift_dropped(spark):
    d = pings(spark, [dict(t=5 * i) for i in range(4)])
    assert sequence_rows(d, P).count() == 0


def test_close_pairs_hold_every_loader_that_can_confirm(spark):
    """Pairs over cell and bin borders, null positions, and a loader that is near only at another time."""
    rng = np.random.default_rng(5)
    c = "vehicle string, date_dpr date, shift_dpr string, run_us long, run_pid long, start_us long, start_pid long, end_us long, dur_sec double, mid2_us long, d_utm_x double, d_utm_y double, d_alt double"
    stops = [("Dump1", T0.date(), "A", i, i, t, i, t + 60_000_001, 60.0, 2 * t + 60_000_001, float(x), float(y), 600.0)
             for i, (t, x, y) in enumerate(zip(rng.integers(0, 10**9, 60).tolist(), rng.integers(0, 300, 60), rng.integers(-150, 150, 60)))]
    stops.append((*stops[0][:3], 99, 99, *stops[0][5:10], None, None, None))
    cands = spark.createDataFrame(stops, c)
    pid = iter(range(10**6))
    loaders = spark.createDataFrame(
        [(f"Exc{k}", t, next(pid), float(x), float(y), 600.0) for k in range(6)
         for t, x, y in zip(rng.integers(0, 10**9, 40).tolist(), rng.integers(0, 300, 40), rng.integers(-150, 150, 40))]
        + [("Exc9", 5, next(pid), None, None, None)], "l_id string, ts_us long, ping_id long, l_x double, l_y double, l_alt double")
    cols = ["run_us", "l_id", "l_ts_us", "d2d"]
    every = nearest_loaders(cands, loaders, P).where(F.col("d2d") <= P.loader_max_dist_m).select(*cols)
    pairs = close_pairs(cands, loaders, P)
    few = nearest_loaders(pairs, loaders, P).where(F.col("d2d") <= P.loader_max_dist_m).select(*cols)
    assert every.count() > 20 and sorted(every.collect()) == sorted(few.collect())
    assert pairs.count() < nearest_loaders(cands, loaders, P).count()


@pytest.mark.parametrize("scope", ["fleet", "vehicle"])
def test_marks_equal_a_scan_of_all_events(spark, scope):
    p = P.with_(event_scope=scope)
    rng = np.random.default_rng(3)
    ev = [(k, int(t), v) for k in ("load", "dump") for v in ("Dump1", "Dump2") for t in rng.integers(0, 200, 12) * 1_000_000]
    pg = [(v, i, int(t)) for v in ("Dump1", "Dump2") for i, t in enumerate(rng.integers(-20, 420, 150) * 500_000)]
    bins = event_bins(spark.createDataFrame(ev, "kind string, ts_us long, vehicle string"), p)
    near = lambda kind, v, t: any(k == kind and abs(e - t) <= 5_000_000 and (scope == "fleet" or w == v) for k, e, w in ev)
    want = {(v, i): 1.0 if near("load", v, t) else 0.0 if near("dump", v, t) else None for v, i, t in pg}
    for rows in (None, 3):  # shuffled and broadcast
        got = mark_pings(spark.createDataFrame(pg, "vehicle string, ping_id long, ts_us long"), bins, p, bins_rows=rows)
        assert {(r.vehicle, r.ping_id): r.ev_flag for r in got.collect()} == want


def redfearn(lon, lat, lon0=87.0):
    """UTM by the classic power series in the meridian arc, another way than the library's."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)
    phi, dl = np.radians(lat), np.radians(lon - lon0)
    s, c, t = np.sin(phi), np.cos(phi), np.tan(phi)
    nu, rho = a / np.sqrt(1 - e2 * s * s), a * (1 - e2) / (1 - e2 * s * s) ** 1.5
    psi = nu / rho
    # the meridian arc by numerical integration
    x = np.linspace(0, phi, 20_001)
    m = np.trapezoid(a * (1 - e2) / (1 - e2 * np.sin(x) ** 2) ** 1.5, x)
    e = nu * dl * c * (1 + dl**2 * c**2 / 6 * (psi - t**2) + dl**4 * c**4 / 120 * (4 * psi**3 * (1 - 6 * t**2) + psi**2 * (1 + 8 * t**2) - 2 * psi * t**2 + t**4))
    n = m + nu * s * dl**2 * c / 2 * (1 + dl**2 * c**2 / 12 * (4 * psi**2 + psi - t**2)
                                      + dl**4 * c**4 / 360 * (8 * psi**4 * (11 - 24 * t**2) - 28 * psi**3 * (1 - 6 * t**2) + psi**2 * (1 - 32 * t**2) - 2 * psi * t**2 + t**4))
    return 500_000 + k0 * e, k0 * n


def test_projection_against_another_series(spark):
    from fleetspark.functions.geo import utm_expr
    points = [(87.0, 23.5), (85.02, 23.51), (88.9, 23.6), (86.0, 0.0), (84.1, 60.0)]
    df = spark.createDataFrame(points, "lon double, lat double")
    x, y = utm_expr(F.col("lon"), F.col("lat"))
    got = {(r.lon, r.lat): (r.x, r.y) for r in df.select("lon", "lat", x.alias("x"), y.alias("y")).collect()}
    for p in points:
        assert got[p] == pytest.approx(redfearn(*p), abs=2e-3)


def test_close_pairs_follow_the_stops_where_loaders_stand_apart(spark):
    """Ten times the stops and loaders give ten times the pairs, not a hundred times."""
    def pairs(n: int) -> int:
        stops = spark.range(n * 20).selectExpr(
            "concat('Dump', id) vehicle", "date'2026-01-01' date_dpr", "'A' shift_dpr", "id * 200000000 start_us", "id * 200000000 + 60000000 end_us",
            "id start_pid", "id run_us", "id run_pid", f"500000D + (id % {n}) * 400 d_utm_x", "2600000D d_utm_y", "600D d_alt", "'mine001' mine_anon", "60D dur_sec",
            "id * 400000000 + 60000000 mid2_us")
        loaders = spark.range(n).crossJoin(spark.range(n * 20).withColumnRenamed("id", "k")).selectExpr(
            "concat('Exc', id) l_id", "k * 200000000 + 30000000 ts_us", "k ping_id", "500000D + id * 400 l_x", "2600000D l_y", "600D l_alt")
        found = close_pairs(stops, loaders, P)
        assert nearest_loaders(found, loaders, P).count() == n * 20
        return found.count()
    assert pairs(30) == 10 * pairs(3)


def _crowd(spark, n: int):
    """``n`` stops and ``n`` loaders at one place and time, every fourth stop part of the run before."""
    stops = spark.range(n).selectExpr(
        "'Dump1' vehicle", "date'2026-01-01' date_dpr", "concat('S', id) shift_dpr", "if(id < 8, null, id - id % 4) run_us", "id - id % 4 run_pid", "id * 1000 start_us",
        "id start_pid", "id * 1000 + 60000000 end_us", "60D dur_sec", "id * 2000 + 60000000 mid2_us", "500000D + id % 7 d_utm_x", "2600000D + id % 5 d_utm_y", "600D d_alt")
    loaders = spark.range(n).crossJoin(spark.range(3).withColumnRenamed("id", "k")).selectExpr(
        "concat('Exc', id) l_id", "k * 30000000 ts_us", "id * 10 + k ping_id", "500000D + (id + k) % 90 l_x", "2600000D + id * k % 80 l_y", "600D + id % 20 l_alt")
    return stops, loaders


def test_closest_loaders_confirm_what_all_pairs_do(spark):
    stops, loaders = _crowd(spark, 60)
    loaders = loaders.unionByName(loaders.where("ping_id % 3 = 0").selectExpr("l_id", "ts_us", "ping_id + 100000 ping_id", "l_x + 1 l_x", "l_y", "l_alt"))
    want = confirmed_loads(nearest_loaders(stops, loaders, P), P)
    got = confirmed_loads(closest_loaders(stops, loaders, P), P).select(*want.columns)
    assert got.count() > 10 and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def _shuffled(df) -> int:
    """Rows through the exchanges of the plan that ran."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        elif name != "ReusedExchange":
            if name == "Exchange":
                total += node.metrics().apply("shuffleRecordsWritten").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


@pytest.mark.parametrize("join", [lambda s, l: confirmed_loads(closest_loaders(s, l, P), P), lambda s, l: nearest_loaders(s, l, P).groupBy().count()], ids=["loads", "all pairs"])
def test_pairs_of_stops_and_loaders_are_not_shuffled(spark, join):
    """Four times the stops and loaders at one place: four times the rows shuffled, not sixteen times."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few, many = (_shuffled(join(*_crowd(spark, n))) for n in (100, 400))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert 0 < many < 6 * few, (few, many)
