"""Readers of differing files, rows known by their place, zones in degrees,
versioned tables and sorted reports."""

import glob
import os
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fleetspark.operators.dumps import geofence_events
from fleetspark.sources.dims import read_csv, read_id_mapping, zones_from_geojson_text
from fleetspark.sources.fixtures import ZONES_GEOJSON, ZONES_LON_LAT, load_inputs
from fleetspark.sources.sinks import current_version, read_table, switch_version, write_csv, write_table, write_version
from fleetspark.sources.telemetry import in_file_order, file_numbers, read_telemetry, schema_groups

from .conftest import SF_SMALL


@pytest.fixture()
def telemetry(spark):
    return load_inputs(spark, SF_SMALL).telemetry.drop("ts_us")


@pytest.fixture()
def mixed(spark, telemetry, tmp_path):
    """Files of three generations in one folder."""
    old = telemetry.where("ping_id % 3 = 0").drop("disthav").withColumn("altitude", F.col("altitude").cast("int"))
    mid = telemetry.where("ping_id % 3 = 1").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    new = telemetry.where("ping_id % 3 = 2")
    for part in (old, mid, new):
        part.drop("ping_id").repartition(2).write.mode("append").parquet(f"{tmp_path}/tel")
    return f"{tmp_path}/tel"


@pytest.mark.parametrize("pattern", ["", "/*.parquet"])
def test_a_folder_and_a_glob_of_differing_files(spark, telemetry, mixed, pattern):
    got = read_telemetry(spark, mixed + pattern)
    assert set(telemetry.columns) <= set(got.columns)
    assert got.count() == telemetry.count() == got.select("ping_id").distinct().count()
    want = telemetry.withColumn("disthav", F.when(F.col("ping_id") % 3 != 0, F.col("disthav")))
    cols = sorted(set(telemetry.columns) - {"ping_id"})
    assert got.select(cols).exceptAll(want.select(cols)).isEmpty() and want.select(cols).exceptAll(got.select(cols)).isEmpty()


def test_files_that_agree_are_one_group(spark, mixed, tmp_path):
    assert len(schema_groups(spark, mixed)) == 3
    spark.range(3).selectExpr("'v' vehicle", "1D speed").write.parquet(f"{tmp_path}/same")
    spark.range(3).selectExpr("'v' vehicle", "1D disthav").write.mode("append").parquet(f"{tmp_path}/same")
    groups = schema_groups(spark, f"{tmp_path}/same")
    assert len(groups) == 1 and set(groups[0][0].names) == {"vehicle", "speed", "disthav"}


def test_ties_follow_the_files_and_equal_pings_differ(spark, tmp_path):
    row = ["'Dump1' vehicle", "timestamp'2026-01-01 06:00:00' ts"]
    for name, speeds in (("b", (5, 5, 1)), ("a", (9, 2))):
        spark.createDataFrame([(float(s),) for s in speeds], "speed double").coalesce(1).selectExpr(*row, "speed").write.parquet(f"{tmp_path}/{name}")
    got = read_telemetry(spark, [f"{tmp_path}/b", f"{tmp_path}/a"])
    assert [r.speed for r in got.orderBy("ts_us", "ping_id").collect()] == [5.0, 5.0, 1.0, 9.0, 2.0]
    assert got.select("ping_id").distinct().count() == 5


def test_a_consumer_of_two_columns_reads_two_columns(spark, mixed):
    plan = read_telemetry(spark, mixed).select("vehicle", "speed", "ts_us", "ping_id")._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    telemetry_scans = [s for s in scans if "speed" in s]
    assert len(telemetry_scans) == 3
    for s in telemetry_scans:
        assert {c.split(":")[0] for c in s.split(",")} == {"vehicle", "speed", "ts", "_tmp_metadata_row_index"}


def test_an_unlisted_file_is_an_error(spark, tmp_path):
    spark.range(2).selectExpr("'v' vehicle").write.parquet(f"{tmp_path}/x")
    spark.range(2).selectExpr("'v' vehicle").write.parquet(f"{tmp_path}/y")
    with pytest.raises(Exception, match="file not listed"):
        in_file_order(spark.read.parquet(f"{tmp_path}/x"), file_numbers(spark, [f"{tmp_path}/y"])).select("ping_id").collect()


def zones(spark, text, crs="file"):
    return zones_from_geojson_text(spark.createDataFrame([(text,)], "value string"), zones_crs=crs)


def test_zones_in_degrees_equal_those_in_metres(spark):
    rows = [(z.zone_id, [[[(p.x, p.y) for p in ring] for ring in poly] for poly in z.polygons]) for z in zones(spark, ZONES_LON_LAT).orderBy("zone_id").collect()]
    want = [(z.zone_id, [[[(p.x, p.y) for p in ring] for ring in poly] for poly in z.polygons])
            for z in zones(spark, ZONES_GEOJSON, "EPSG:32645").orderBy("zone_id").collect()]
    for (i, a), (j, b) in zip(rows, want, strict=True):
        assert i == j
        for p, q in zip(a[0][0], b[0][0], strict=True):
            assert p == pytest.approx(q, abs=5e-4)


@pytest.mark.parametrize("name,crs", [("urn:ogc:def:crs:EPSG::32645", "file"), (None, "EPSG:32645")])
def test_zones_in_metres_stay(spark, name, crs):
    text = ZONES_GEOJSON if name is None else ZONES_GEOJSON.replace('"features"', f'"crs": {{"type": "name", "properties": {{"name": "{name}"}}}}, "features"', 1)
    assert zones(spark, text, crs).first().polygons[0][0][0].x == 500050


@pytest.mark.parametrize("text,crs,message", [
    (ZONES_GEOJSON, "file", "declare zones_crs"),
    (ZONES_LON_LAT.replace('"features"', '"crs": {"properties": {"name": "EPSG:3857"}}, "features"', 1), "file", "unknown crs of the zone file")])
def test_zones_of_no_known_system_are_an_error(spark, text, crs, message):
    with pytest.raises(Exception, match=message):
        zones(spark, text, crs).collect()


def test_an_unknown_declared_system_is_an_error(spark):
    with pytest.raises(ValueError, match="zones_crs"):
        zones(spark, ZONES_LON_LAT, "EPSG:9999")


def test_zones_meet_a_stop_in_either_system(spark):
    stop = spark.createDataFrame([("Dump2", "mine001", 500100.0, 2600080.0, 650.0), ("Dump2", "mine001", 500160.0, 2600160.0, 650.0)],
                                 "vehicle string, mine_anon string, d_utm_x double, d_utm_y double, d_alt double")
    cls = spark.createDataFrame([("Dump2", False, True, False)], "vehicle string, is_analog boolean, is_geo boolean, is_m2 boolean")
    from fleetspark.params import Params
    a, b = ({(r.zone_id, r.d_utm_x) for r in geofence_events(stop, cls, z, Params()).collect()}
            for z in (zones(spark, ZONES_LON_LAT), zones(spark, ZONES_GEOJSON, "EPSG:32645")))
    assert a == b and (0, 500100.0) in a and not any(x == 500160.0 for _, x in a)


@pytest.mark.parametrize("path", [None, "/no/such/mapping.csv"])
def test_the_id_mapping_may_be_absent(spark, path):
    m = read_id_mapping(spark, path)
    assert m.columns == ["id", "vehicle", "date", "shift"] and m.isEmpty()


def test_a_crash_before_the_switch_leaves_the_old_version(spark, tmp_path):
    root = f"{tmp_path}/t"
    write_table(spark.range(5).withColumn("a", F.lit(1)), root)
    added = read_table(spark, root).withColumn("b", F.lit(2))

    with pytest.raises(RuntimeError):
        version = write_version(added, root)
        raise RuntimeError("the driver dies here")
    assert read_table(spark, root).columns == ["id", "a"] and read_table(spark, root).count() == 5
    switch_version(spark, root, version)
    assert read_table(spark, root).columns == ["id", "a", "b"]
    assert [f"{root}/{x}" for x in os.listdir(root) if x.startswith("_version")] == [current_version(spark, root)]
    with pytest.raises(FileNotFoundError):
        read_table(spark, f"{tmp_path}/none")


def test_a_sorted_report_of_several_files(spark, tmp_path):
    write_csv(spark.range(5000).repartition(7), f"{tmp_path}/r", ["id"], rows_per_file=400)
    files = sorted(glob.glob(f"{tmp_path}/r/*.csv"))
    assert len(files) >= 13
    rows = [int(x) for f in files for x in open(f).read().split()[1:]]
    assert rows == list(range(5000))


def test_many_small_csv_files_are_written_side_by_side_and_not_listed_one_by_one(spark, tmp_path):
    path = f"{tmp_path}/r"
    write_csv(spark.range(420).selectExpr("419 - id as id", "concat('Dump', id) as ` Vehicle`"), path, ["id"], rows_per_file=7)
    files = sorted(Path(path).glob("part-*.csv"))
    rows = [f.read_text().splitlines() for f in files]
    assert [int(x.split(",")[0]) for r in rows for x in r[1:]] == list(range(420)) and max(map(len, rows)) <= 8
    assert len({f.name.split("-")[1] for f in files}) >= 4 and len(files) > 40
    sc = spark.sparkContext
    sc.setJobGroup("headers", "read_csv")
    try:
        got = read_csv(spark, path)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    t = sc.statusTracker()
    stages = [t.getStageInfo(s) for j in t.getJobIdsForGroup("headers") for s in t.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) <= 8
    assert got.columns == ["id", "vehicle"] and got.count() == 420


def test_csv_header_after_blank_lines_and_without_rows(spark, tmp_path):
    for name, text in {"a": '\n  \n"Vehicle, no", DATE \nDump1,2026-01-01\n', "b": "", "c": "x,x\n"}.items():
        (tmp_path / name).write_text(text)
        want = spark.read.option("header", True).csv(str(tmp_path / name))
        got = read_csv(spark, str(tmp_path / name))
        assert got.columns == [c.strip().lower() for c in want.columns] and got.collect() == want.collect()
