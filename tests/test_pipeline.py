"""The six stages over files: write the fixture inputs the way the reference
receives them (telemetry Parquet, fleet/fuel/id CSV, zones GeoJSON), run the
pipeline, and check the stage outputs against the query registry."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from fleetspark.plans import queries as Q
from fleetspark.plans.pipeline import Paths, run_pipeline
from fleetspark.sources.fixtures import ZONES_GEOJSON, load_inputs
from fleetspark.sources.sinks import read_table

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def run(spark):
    d = tempfile.mkdtemp(prefix="fs-pipe-")
    inp = load_inputs(spark, SF_SMALL)
    tel = inp.telemetry.drop("ts_us")
    test_keys = inp.id_mapping.select(F.col("vehicle"), F.col("date").alias("date_dpr"), F.col("shift").alias("shift_dpr"))
    tel.write.parquet(f"{d}/telemetry_all.parquet")
    inp.fleet.write.option("header", True).csv(f"{d}/fleet.csv")
    inp.fuel_summary.write.option("header", True).csv(f"{d}/smry_jan.csv")
    inp.id_mapping.write.option("header", True).csv(f"{d}/id_mapping.csv")
    with open(f"{d}/zones.geojson", "w") as f:
        f.write(ZONES_GEOJSON)
    paths = Paths(train_telemetry=[f"{d}/telemetry_all.parquet"], test_telemetry=[f"{d}/telemetry_all.parquet"],
                  fleet=f"{d}/fleet.csv", fuel_summaries=[f"{d}/smry_jan.csv", f"{d}/smry_missing.csv"],
                  id_mapping=f"{d}/id_mapping.csv", zones=f"{d}/zones.geojson", out=f"{d}/out")
    run_pipeline(spark, paths, Q.FIXTURE_PARAMS)
    return spark, paths, d


def test_stage_tables_written(run):
    spark, paths, d = run
    for name in ("train_pings", "train_loaders", "train_features", "train_trip_features"):
        assert spark.read.parquet(f"{paths.out}/{name}").count() > 0, name
    for tag in ("train", "test"):
        final = read_table(spark, f"{paths.out}/{tag}_final")
        assert final.count() > 0 and {"seq_h00", "seq_h15", "seq_fuel_pred"} <= set(final.columns) and "has_embedding" not in final.columns


def test_coverage_is_what_the_tables_hold(run):
    spark, paths, _ = run
    got = {(r.table, r.metric): float(r.value) for r in spark.read.option("header", True).csv(f"{paths.out}/coverage_report").collect()}
    assert got["train_pings", "dump_pings"] == spark.read.parquet(f"{paths.out}/train_pings").count()
    assert got["test_pings", "loader_pings"] == spark.read.parquet(f"{paths.out}/test_loaders").count()
    final, emb = read_table(spark, f"{paths.out}/train_final"), spark.read.parquet(f"{paths.out}/train_seq_features")
    keys = emb.select(F.col("vehicle").alias("dumper_id"), "date_dpr", F.col("shift_dpr").alias("shift"))
    matched = final.join(keys, ["dumper_id", "date_dpr", "shift"], "left_semi").count()
    assert got["embedding", "train_embedded_pct"] == pytest.approx(100 * matched / final.count(), abs=1e-4)
    assert got["final", "fuel_rows"] == final.where("fuel_consumed_L is not null").count()


def test_file_pipeline_equals_query_registry(run):
    spark, paths, _ = run
    got = spark.read.parquet(f"{paths.out}/train_features")
    want = Q.QUERIES["shift_features"](spark, SF_SMALL)
    cols = sorted(want.columns)
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    assert want.select(cols).exceptAll(got.select(cols)).count() == 0
    trips = spark.read.parquet(f"{paths.out}/train_trip_features").drop("is_fallback")
    want_t = Q.QUERIES["trip_features"](spark, SF_SMALL)
    cols = sorted(want_t.columns)
    assert trips.select(cols).exceptAll(want_t.select(cols)).count() == 0


def test_model_stage_keeps_the_keys(run):
    spark, paths, _ = run
    keys = ["dumper_id", "date_dpr", "shift"]
    for tag in ("train", "test"):
        final, pred = read_table(spark, f"{paths.out}/{tag}_final"), spark.read.parquet(f"{paths.out}/{tag}_predictions")
        final = final.where("dumper_id like 'Dump%'" + (" and fuel_consumed_L is not null" if tag == "train" else "")).select(keys)
        assert [pred.schema[k].dataType for k in keys] == [final.schema[k].dataType for k in keys]
        assert pred.count() == final.count()
        assert final.exceptAll(pred.select(keys)).isEmpty()
    assert spark.read.option("header", True).csv(f"{paths.out}/summary").count() == 1
    ids = spark.read.option("header", True).csv(paths.id_mapping).count()
    for name in ("submission_full_model", "submission_route_benchmark"):
        got = spark.read.option("header", True).csv(f"{paths.out}/{name}")
        assert got.count() == ids and got.select(got.columns[-1]).distinct().count() > 1


def test_readers_unite_files_by_name(spark):
    from fleetspark.sources.dims import read_csv
    from fleetspark.sources.telemetry import read_telemetry
    d = tempfile.mkdtemp(prefix="fs-read-")
    for name, text in (("a.csv", "Vehicle, initlev\nv1,20\n"), ("b.csv", "initlev,vehicle,lph\n30,v2,1\n")):
        with open(f"{d}/{name}", "w") as f:
            f.write(text)
    got = {(r.vehicle, r.initlev, r.lph) for r in read_csv(spark, [f"{d}/a.csv", f"{d}/b.csv"]).collect()}
    assert got == {("v1", "20", None), ("v2", "30", "1")}
    spark.sql("select 'v1' vehicle, cast(1 as float) speed, 3 satellites").write.parquet(f"{d}/t1")
    spark.sql("select 'v2' vehicle, 2D speed, 4L satellites, 5D disthav").write.parquet(f"{d}/t2")
    t = read_telemetry(spark, [f"{d}/t1", f"{d}/t2"])
    assert {(r.vehicle, r.speed, r.satellites, r.disthav) for r in t.collect()} == {("v1", 1.0, 3, None), ("v2", 2.0, 4, 5.0)}


def test_global_numbers_without_exchange_reuse(spark):
    from fleetspark.functions.ranking import global_row_number
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        n = 300_000
        rn = global_row_number(spark.range(n).select(F.xxhash64("id").alias("x")), ["x"])
        assert rn.agg(F.count("rn"), F.countDistinct("rn"), F.min("rn"), F.max("rn")).first() == (n, n, 1, n)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
