"""Queries that run the operators on files and under other parameters than the
fixture's: readers over written files, the test split's rules, short
sequences, absent sensors, vehicle-scoped marks, lon/lat zones.

The files are written by Spark from the same views as the fixture, read
back through the readers, and deleted once the result is checkpointed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nulls import r4, round_np
from ..operators.assemble import duplicate_labels, fuel_labels
from ..operators.dumps import geofence_events, zones_have_altitude
from ..operators.pings import ping_pass
from ..operators.reports import daily_series, daily_summary, summary, vehicle_ranking
from ..operators.sequence import sequence_rows
from ..operators.shift import ping_measures, shift_features
from ..operators.stops import dump_candidates
from ..operators.trips import marked_pings, trip_events
from ..params import SEQ_FEATURES, TARGET
from ..session import ensure_checkpoint_dir
from ..sources.dims import fleet_classes, read_fleet, read_fuel_summary, read_id_mapping, read_zones
from ..sources.fixtures import ZONES_LON_LAT
from ..sources.sinks import read_table, remove, switch_version, write_csv, write_table, write_version
from ..sources.telemetry import read_telemetry
from .oracle import K, PINGS, q, swap
from .queries import _ctx


def _through_files(spark: SparkSession, work: Callable[[str], DataFrame]) -> DataFrame:
    """The result of ``work`` on a fresh folder, which is deleted afterwards."""
    folder = f"{ensure_checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"
    out = work(folder).checkpoint(eager=True)
    remove(spark, folder)
    return out


def q_telemetry_files(spark, sf_dir):
    """One folder with files of three device generations, whose
    columns and types differ."""
    t = _ctx(spark, sf_dir).inp.telemetry.drop("ts_us")
    generation = F.col("ping_id") % 3

    def work(folder: str) -> DataFrame:
        old = t.where(generation == 0).drop("disthav", "total_trip").withColumn("altitude", F.col("altitude").cast("int"))
        mid = t.where(generation == 1).withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn("operator_id", F.col("operator_id").cast("double"))
        new = t.where(generation == 2).withColumn("date_dpr", F.date_format("date_dpr", "yyyy-MM-dd")).withColumn("vehicle", F.concat(F.lit(" "), "vehicle"))
        for part in (old, mid, new):
            part.drop("ping_id").write.mode("append").parquet(f"{folder}/telemetry")
        got = read_telemetry(spark, f"{folder}/telemetry")
        return got.groupBy("vehicle", "date_dpr", "shift_dpr").agg(
            F.count(F.lit(1)).alias("n_pings"), F.count_distinct("ping_id").alias("n_ids"), F.count("disthav").alias("n_disthav"),
            r4(F.sum("disthav")).alias("disthav"), F.sum("altitude").alias("altitude"), F.sum("operator_id").alias("operators"),
            F.count("total_trip").alias("n_trips"), F.min("ts_us").alias("first_us"), F.max("ts_us").alias("last_us"))

    return _through_files(spark, work)


def q_fleet_files(spark, sf_dir):
    """The fleet CSV with a padded upper-case header."""
    fleet = _ctx(spark, sf_dir).inp.fleet

    def work(folder: str) -> DataFrame:
        write_csv(fleet.toDF(*[f" {c.upper()} " for c in fleet.columns]), f"{folder}/fleet")
        return fleet_classes(read_fleet(spark, f"{folder}/fleet"))

    return _through_files(spark, work)


def q_fuel_files(spark, sf_dir):
    """Monthly CSVs whose columns stand in another order, one month missing."""
    s = _ctx(spark, sf_dir).inp.fuel_summary

    def work(folder: str) -> DataFrame:
        first = F.col("date") < F.lit("2026-01-02").cast("date")
        write_csv(s.where(first), f"{folder}/jan")
        write_csv(s.where(~first).select(*reversed(s.columns)), f"{folder}/feb")
        return fuel_labels(read_fuel_summary(spark, [f"{folder}/{m}" for m in ("jan", "feb", "mar")]))

    return _through_files(spark, work)


def q_mapping_files(spark, sf_dir):
    """The mapping as a sorted CSV of several files; the second
    mapping does not exist and adds nothing."""
    m = _ctx(spark, sf_dir).inp.id_mapping

    def work(folder: str) -> DataFrame:
        write_csv(m, f"{folder}/mapping", ["id"], rows_per_file=7)
        return read_id_mapping(spark, f"{folder}/mapping").unionByName(read_id_mapping(spark, f"{folder}/absent"))

    return _through_files(spark, work)


def q_geofence_lonlat(spark, sf_dir):
    """Zones in degrees, read from a GeoJSON file and projected."""
    c = _ctx(spark, sf_dir)

    def work(folder: str) -> DataFrame:
        spark.createDataFrame([(ZONES_LON_LAT,)], "value string").write.text(f"{folder}/zones")
        zones = read_zones(spark, f"{folder}/zones", "file")
        g = geofence_events(dump_candidates(c.events.stops, c.p), c.fleet_cls, zones, c.p, filter_altitude=zones_have_altitude(zones))
        return g.select("vehicle", "date_dpr", "shift_dpr", "start_us", "end_us", "zone_id")

    return _through_files(spark, work)


def q_column_upsert(spark, sf_dir):
    """Labels as a versioned table; a column is added to it in place,
    and a version that was written but never switched to is not seen."""
    labels = _ctx(spark, sf_dir).labels

    def work(folder: str) -> DataFrame:
        root = f"{folder}/labels"
        write_table(labels, root)
        added = read_table(spark, root).withColumn("litres_per_hour", r4(F.try_divide(F.col(TARGET), F.nullif(F.col("runhrs"), F.lit(0.0)))))
        switch_version(spark, root, write_version(added, root))
        write_version(read_table(spark, root).limit(1), root)
        return read_table(spark, root).select(*[x.strip() for x in K.split(",")], TARGET, "litres_per_hour")

    return _through_files(spark, work)


def q_test_pings(spark, sf_dir):
    """C1, C2 by the rules of the test split: the first interval is 5 s, no gap is classified."""
    c = _ctx(spark, sf_dir)
    t = ping_pass(c.clean, c.p, is_train=False)
    return t.select("vehicle", "ping_id", round_np("actual_dt_sec", 6).alias("actual_dt_sec"), "is_gap_300s", round_np("dt_sec", 6).alias("dt_sec"),
                    (F.col("fuel_delta").isNull() & F.col("gap_status").isNull()).alias("unclassified"))


def q_sequences_short(spark, sf_dir):
    """L2 where shifts are longer than a sequence may be."""
    c = _ctx(spark, sf_dir)
    r = sequence_rows(c.pings, c.p, max_len=8)
    return r.select("vehicle", "date_dpr", F.col("shift_dpr").alias("shift"), "pos", "seq_len", *[round_np(x, 6).alias(x) for x in SEQ_FEATURES])


def q_daily_series_thin(spark, sf_dir):
    """Fewer points than days."""
    return daily_series(_ctx(spark, sf_dir).daily, max_points=1)


def q_event_marks_vehicle(spark, sf_dir):
    """F4 with events that mark only their own vehicle."""
    c = _ctx(spark, sf_dir)
    p = c.p.with_(event_scope="vehicle")
    ev = trip_events(c.pings, c.loaders, c.fleet_cls, c.inp.zones, p)
    return marked_pings(ping_measures(c.pings, p), ev, p).select("vehicle", "ping_id", "ev_flag")


_ABSENT = ["disthav", "cumdist", "total_trip", "fuel_volume", "analog_input_1", "prod_hr_dpr", "km_dpr"]
_BARE = ("engine_on_hrs, prod_hrs, idle_hrs, n_gaps, n_blind_gaps, total_dist_spd_km, total_dist_hav_km, dist_steep_hav_km, uphill_dist_hav_km, "
         "mean_gradient_pct, max_gradient_pct, stopgo_intensity, operator_id, rain_loss, dense_fog")


def q_shift_bare(spark, sf_dir):
    """E8, D5, D7 without the optional sensors, with the two weather ones."""
    c = _ctx(spark, sf_dir)
    bare = c.clean.drop(*_ABSENT).withColumn("rain_loss", F.when(F.col("satellites") % 3 == 0, F.col("satellites").cast("double"))).withColumn(
        "dense_fog", F.when(F.col("ignition") == 0, F.col("angle")))
    s = shift_features(ping_pass(bare, c.p), c.p)
    missing = [x for x in ("cumdist_range", "total_trip") if x in s.columns]
    return s.select(*[x.strip() for x in (K + ", " + _BARE).split(",")], F.lit(len(missing)).alias("n_other_columns"))


def q_duplicate_labels(spark, sf_dir):
    """labels of which some come twice, with another fuel level."""
    labels = _ctx(spark, sf_dir).labels
    again = labels.where("had_refill = 1").withColumn(TARGET, F.col(TARGET) + 1)
    return duplicate_labels(labels.unionByName(again)).select("dumper_id", "date_dpr", "shift", "n_labels", "min_fuel_L", "max_fuel_L")


def q_summary(spark, sf_dir):
    """N7 on the rate models: their errors on the train labels stand in for the scores."""
    c = _ctx(spark, sf_dir)
    rmse = lambda m: c.delta.agg(F.lit(m).alias("model"), F.lit("oof").alias("fold"),
                                 round_np(F.sqrt(F.avg((F.col(f"pred_{m}") - F.col(TARGET)) ** 2)), 4).alias("rmse"))
    return summary(rmse("route").unionByName(rmse("full")), daily_summary(c.daily), vehicle_ranking(c.delta))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "telemetry_files": q_telemetry_files, "fleet_files": q_fleet_files, "fuel_files": q_fuel_files, "mapping_files": q_mapping_files,
    "geofence_lonlat": q_geofence_lonlat, "column_upsert": q_column_upsert, "test_pings": q_test_pings, "sequences_short": q_sequences_short,
    "daily_series_thin": q_daily_series_thin, "event_marks_vehicle": q_event_marks_vehicle, "shift_bare": q_shift_bare,
    "duplicate_labels": q_duplicate_labels, "summary": q_summary,
}

_SHORT = {"<= 600": "<= 8", "> 600": "> 8", "range(0, 600)": "range(0, 8)", "k.k = 599": "k.k = 7", "k.k < 599": "k.k < 7", "(f.n - 1) / 599": "(f.n - 1) / 7"}
_NO_SENSORS = {
    "CASE WHEN gps AND coalesce(disthav > 0, false) THEN disthav / 1000 ELSE 0 END AS d_hav":
        "CASE WHEN nrm AND ign AND fast AND gps THEN speed * dt_sec / 3600 ELSE 0 END AS d_hav",
    "coalesce(d_hav * 1000 > 5, false)": "coalesce(speed * dt_sec / 3.6 > 5, false)",
    "adiff / (d_hav * 1000) * 100": "adiff / (speed * dt_sec / 3.6) * 100",
    "cast(sum(sharp) AS bigint) AS n_sharp_turns,":
        "cast(sum(sharp) AS bigint) AS n_sharp_turns,\n    first(CASE WHEN satellites % 3 = 0 THEN cast(satellites AS double) END ORDER BY ts_us, ping_id) "
        "FILTER (WHERE satellites % 3 = 0) AS rain_loss,\n    first(angle ORDER BY ts_us, ping_id) FILTER (WHERE ignition = 0) AS dense_fog,",
    "    cumdist_range, total_trip, prod_hr_dpr, km_dpr\n  FROM sh2": "    cumdist_range, total_trip, prod_hr_dpr, km_dpr, rain_loss, dense_fog\n  FROM sh2",
}
_NO_FUEL = {PINGS[PINGS.index("    CASE WHEN actual_dt_sec >= 300 AND fuel_volume - prev_fuel >= -2"):PINGS.index("AS gap_status")]: "    'normal' "}

SQL: dict[str, str] = {
    "telemetry_files": q("""
SELECT vehicle, date_dpr, shift_dpr, count(*) AS n_pings, count(*) AS n_ids, count(d) AS n_disthav, round_even(sum(d), 4) AS disthav,
  sum(altitude) AS altitude, sum(operator_id) AS operators, count(CASE WHEN ping_id % 3 <> 0 THEN total_trip END) AS n_trips,
  min(ts_us) AS first_us, max(ts_us) AS last_us
FROM (SELECT *, CASE WHEN ping_id % 3 <> 0 THEN disthav END AS d FROM telemetry) GROUP BY vehicle, date_dpr, shift_dpr"""),
    "fleet_files": q("SELECT * FROM fleet_cls"),
    "fuel_files": q("SELECT * FROM labels"),
    "mapping_files": q("SELECT * FROM id_mapping"),
    "geofence_lonlat": q("SELECT vehicle, date_dpr, shift_dpr, start_us, end_us, zone_id FROM geo_ev"),
    "column_upsert": q(f"SELECT {K}, fuel_consumed_L, round_even(fuel_consumed_L / nullif(runhrs, 0), 4) AS litres_per_hour FROM labels"),
    "test_pings": q("""
SELECT vehicle, ping_id, round_even(a, 6) AS actual_dt_sec, CASE WHEN a >= 300 THEN 1 ELSE 0 END AS is_gap_300s,
  round_even(least(a, 300.0), 6) AS dt_sec, true AS unclassified
FROM (SELECT *, CASE WHEN prev_ts IS NULL THEN 5.0 ELSE actual_dt_sec END AS a FROM p1)"""),
    "sequences_short": swap(q("SELECT vehicle, date_dpr, shift_dpr AS shift, pos, least(n, 8) AS seq_len, "
                              + ", ".join(f"round_even({c}, 6) AS {c}" for c in SEQ_FEATURES) + " FROM seqr"), _SHORT),
    "daily_series_thin": q("""
SELECT date_dpr, actual, predicted FROM (
  SELECT date_dpr, round_even(sum(actual_daily_L), 4) AS actual, round_even(sum(pred_daily_L), 4) AS predicted,
    row_number() OVER (ORDER BY date_dpr) AS rn, count(*) OVER () AS n
  FROM daily GROUP BY date_dpr) t
WHERE (rn - 1) % n = 0"""),
    "event_marks_vehicle": q("""
SELECT vehicle, ping_id, CASE
    WHEN EXISTS (SELECT 1 FROM conf e WHERE e.vehicle = p.vehicle AND e.end_us BETWEEN p.ts_us - 5000000 AND p.ts_us + 5000000)
      THEN cast(1 AS double)
    WHEN EXISTS (SELECT 1 FROM analog_ev e WHERE e.vehicle = p.vehicle AND e.fall_us BETWEEN p.ts_us - 5000000 AND p.ts_us + 5000000)
      OR EXISTS (SELECT 1 FROM geo_ev e WHERE e.vehicle = p.vehicle AND e.end_us BETWEEN p.ts_us - 5000000 AND p.ts_us + 5000000)
      THEN cast(0 AS double) END AS ev_flag
FROM pm4 p"""),
    "shift_bare": swap(q(f"SELECT {K}, {_BARE}, 0 AS n_other_columns FROM shiftf"), _NO_SENSORS | _NO_FUEL),
    "duplicate_labels": q(f"SELECT {K}, 2 AS n_labels, fuel_consumed_L AS min_fuel_L, fuel_consumed_L + 1 AS max_fuel_L FROM labels WHERE had_refill = 1"),
    "summary": q("""
SELECT rmse_route, rmse_full, round_even(rmse_route - rmse_full, 4) AS rmse_delta,
  round_even(100 * (rmse_route - rmse_full) / nullif(rmse_route, 0), 1) AS improvement_pct, daily_corr, daily_mape, least_efficient, most_efficient
FROM (SELECT round_even(sqrt(avg((pred_route - fuel_consumed_L) ** 2)), 4) AS rmse_route,
             round_even(sqrt(avg((pred_full - fuel_consumed_L) ** 2)), 4) AS rmse_full FROM delta),
     (SELECT round_even(corr(pred_daily_L, actual_daily_L), 4) AS daily_corr, round_even(avg(pct_error), 4) AS daily_mape FROM daily),
     (SELECT string_agg(dumper_id, ',' ORDER BY rh) FILTER (WHERE rh <= 3) AS least_efficient,
             string_agg(dumper_id, ',' ORDER BY rl DESC) FILTER (WHERE rl <= 3) AS most_efficient FROM vrank)"""),
}
