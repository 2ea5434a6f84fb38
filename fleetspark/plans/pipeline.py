"""The reference's six stages as Spark jobs over files:
preprocess -> features -> trips -> assemble -> sequences -> model.

Every stage reads what the stages before it wrote, so a lost executor only
replays the stage it was in, and no stage carries the lineage of the ones
before it.  The ping tables are laid out by vehicle and time bucket once; the
feature, trip and sequence passes over them need no exchange of their own.  The
final tables are versioned: the sequence stage adds its columns to them as a new
version, and a crash leaves the old version or the new one.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.assemble import (EMBEDDED, agreement_report, assemble_test, assemble_train, coverage_report, duplicate_labels, fuel_labels,
                                  join_key, missing_report, observe)
from ..operators.clean import clean_haulers, clean_loaders
from ..operators.model import both_models, both_predictions, model_rows
from ..operators.pings import ping_pass
from ..operators.reports import (daily_consistency, daily_series, daily_summary, efficiency_delta, scatter_sample,
                                 submission, summary, vehicle_ranking)
from ..operators.sequence import attach_labels, embed, fuel_head, merge_embedding, sequence_rows
from ..operators.shift import shift_features
from ..operators.trips import trip_features
from ..params import DPR_COLS, Params
from ..session import ensure_checkpoint_dir
from ..sources.dims import fleet_classes, read_fleet, read_fuel_summary, read_id_mapping, read_zones
from ..sources.sinks import read_bucketed, read_table, write_bucketed, write_csv, write_parquet, write_table
from ..sources.telemetry import input_bytes, read_telemetry


@dataclass
class Paths:
    train_telemetry: list
    test_telemetry: list
    fleet: str
    fuel_summaries: list
    id_mapping: str | None
    zones: str | None
    out: str


def _p(paths: Paths, name: str) -> str:
    return f"{paths.out.rstrip('/')}/{name}"


#: The layout of the ping tables: the windows of all later passes run inside a (vehicle, bucket).
PING_KEYS, PING_ORDER = ["vehicle", "_bkt"], ["ts_us", "ping_id"]


def ping_layout(spark: SparkSession, paths: Paths, tag: str, p: Params) -> dict:
    """Where and how a split's pings lie: about ``ping_bucket_bytes`` of input a file."""
    files = paths.train_telemetry if tag == "train" else paths.test_telemetry
    buckets = min(100_000, max(p.min_ping_buckets, -(-input_bytes(spark, files) // p.ping_bucket_bytes)))
    path = _p(paths, f"{tag}_pings")
    return {"path": path, "name": f"pings_{hashlib.md5(path.encode()).hexdigest()}", "keys": PING_KEYS, "sort": PING_ORDER, "buckets": buckets}


def read_pings(spark: SparkSession, paths: Paths, tag: str, p: Params) -> DataFrame:
    return read_bucketed(spark, **ping_layout(spark, paths, tag, p))


def _note(spark: SparkSession, paths: Paths, seen: list[Observation], stage: str) -> None:
    """Keep what a stage observed; the coverage report reads it, not the tables."""
    write_parquet(coverage_report(spark, seen), _p(paths, f"coverage/{stage}"))


def preprocess(spark: SparkSession, paths: Paths, p: Params) -> None:
    """Stage 1: cleaning and the ordered ping pass, loaders alongside."""
    for tag, files, train in (("train", paths.train_telemetry, True), ("test", paths.test_telemetry, False)):
        tel = read_telemetry(spark, files)
        pings, seen_p = observe(ping_pass(clean_haulers(tel, p), p, is_train=train), "pings")
        write_bucketed(pings, **ping_layout(spark, paths, tag, p))
        loaders, seen_l = observe(clean_loaders(tel, p), "loaders")
        write_parquet(loaders, _p(paths, f"{tag}_loaders"))
        _note(spark, paths, [seen_p, seen_l], f"{tag}_pings")


def features(spark: SparkSession, paths: Paths, p: Params) -> None:
    for tag in ("train", "test"):
        sf = shift_features(read_pings(spark, paths, tag, p), p, with_dpr=(tag == "train"))
        write_parquet(sf, _p(paths, f"{tag}_features_dpr" if tag == "train" else f"{tag}_features"))
    tr = spark.read.parquet(_p(paths, "train_features_dpr"))
    write_parquet(tr.drop(*[c for c in DPR_COLS if c in tr.columns]), _p(paths, "train_features"))
    write_csv(agreement_report(tr), _p(paths, "agreement_report"), ["calc", "ref"])


def trips(spark: SparkSession, paths: Paths, p: Params) -> None:
    cls = fleet_classes(read_fleet(spark, paths.fleet))
    zones = read_zones(spark, paths.zones, p.zones_crs) if paths.zones else None
    for tag in ("train", "test"):
        t = trip_features(read_pings(spark, paths, tag, p), spark.read.parquet(_p(paths, f"{tag}_loaders")),
                          cls, zones, spark.read.parquet(_p(paths, f"{tag}_features")), p)
        write_parquet(t, _p(paths, f"{tag}_trip_features"))


def assemble(spark: SparkSession, paths: Paths, p: Params) -> None:
    labels = fuel_labels(read_fuel_summary(spark, paths.fuel_summaries))
    mapping = read_id_mapping(spark, paths.id_mapping)
    tr, seen_tr = observe(assemble_train(spark.read.parquet(_p(paths, "train_features")),
                                         spark.read.parquet(_p(paths, "train_trip_features")), labels), "final_train")
    te, seen_te = observe(assemble_test(spark.read.parquet(_p(paths, "test_features")),
                                        spark.read.parquet(_p(paths, "test_trip_features")), mapping), "final_test")
    write_table(tr, _p(paths, "train_final"))
    write_table(te, _p(paths, "test_final"))
    _note(spark, paths, [seen_tr, seen_te], "final")
    write_csv(missing_report(read_table(spark, _p(paths, "test_final"))), _p(paths, "test_missing"), ["column_name"])
    write_csv(duplicate_labels(labels), _p(paths, "duplicate_labels"), ["dumper_id", "date_dpr", "shift"])


def sequences(spark: SparkSession, paths: Paths, p: Params) -> None:
    """Stage 5: embeddings and the sequence fuel estimate become columns of the
    final tables (A9: a new version, then one switch)."""
    labels = fuel_labels(read_fuel_summary(spark, paths.fuel_summaries))
    rows = {t: sequence_rows(read_pings(spark, paths, t, p), p) for t in ("train", "test")}
    keys = rows["train"].select("vehicle", "date_dpr", "shift_dpr").distinct()
    ensure_checkpoint_dir(spark)
    seq_labels = attach_labels(keys, labels).checkpoint(eager=True)
    emb_tr, emb_te = embed(rows["train"], rows["test"], p)
    pr_tr, pr_te = fuel_head(emb_tr, emb_te, seq_labels, p)
    seen = []
    for t, emb, pr in (("train", emb_tr, pr_tr), ("test", emb_te, pr_te)):
        write_parquet(join_key(emb, pr, "left", ["vehicle", "date_dpr", "shift_dpr"]), _p(paths, f"{t}_seq_features"))
        final = read_table(spark, _p(paths, f"{t}_final"))
        merged, s = observe(merge_embedding(final, spark.read.parquet(_p(paths, f"{t}_seq_features")), EMBEDDED), f"{t}_embedding")
        write_table(merged.drop(EMBEDDED), _p(paths, f"{t}_final"))
        seen.append(s)
    _note(spark, paths, seen, "embedding")
    cover = spark.read.parquet(*[_p(paths, f"coverage/{x}") for x in ("train_pings", "test_pings", "final", "embedding")])
    write_csv(cover.withColumn("table", F.element_at(F.split("_metadata.file_path", "/"), -2)).select("table", "metric", "value"),
              _p(paths, "coverage_report"), ["table", "metric"])


def model(spark: SparkSession, paths: Paths, p: Params) -> None:
    """Stage 6: route and full models, submissions and reports."""
    tr, te = model_rows(read_table(spark, _p(paths, "train_final")), read_table(spark, _p(paths, "test_final")))
    models = both_models(tr, te, p)
    (oof_r, test_r, s_r), (oof_f, test_f, s_f) = models["route"], models["full"]
    write_parquet(both_predictions(oof_r, oof_f), _p(paths, "train_predictions"))
    write_parquet(both_predictions(test_r, test_f), _p(paths, "test_predictions"))
    write_parquet(s_r.unionByName(s_f), _p(paths, "cv_scores"))
    train_pred = spark.read.parquet(_p(paths, "train_predictions"))
    test_pred = spark.read.parquet(_p(paths, "test_predictions"))
    mapping = read_id_mapping(spark, paths.id_mapping)
    write_csv(submission(mapping, test_pred, tr, "pred_full"), _p(paths, "submission_full_model"), ["id"])
    write_csv(submission(mapping, test_pred, tr, "pred_route"), _p(paths, "submission_route_benchmark"), ["id"])
    delta = efficiency_delta(tr, train_pred)
    write_csv(delta, _p(paths, "efficiency_delta"), ["dumper_id", "date_dpr", "shift"])
    labels = fuel_labels(read_fuel_summary(spark, paths.fuel_summaries))
    daily = daily_consistency(labels, train_pred)
    write_csv(daily, _p(paths, "daily_consistency"), ["dumper_id", "date_dpr"])
    ranking = vehicle_ranking(delta)
    write_csv(scatter_sample(delta, p.seed), _p(paths, "chart_scatter"), ["dumper_id", "date_dpr", "shift"])
    write_csv(ranking, _p(paths, "chart_vehicle_ranking"), ["rank_high", "rank_low"])
    write_csv(daily_series(daily), _p(paths, "chart_daily_series"), ["date_dpr"])
    write_csv(summary(spark.read.parquet(_p(paths, "cv_scores")), daily_summary(daily), ranking), _p(paths, "summary"))


STAGES = {"preprocess": preprocess, "features": features, "trips": trips, "assemble": assemble,
          "sequences": sequences, "model": model}


def run_pipeline(spark: SparkSession, paths: Paths, p: Params = Params(), stages: list[str] | None = None) -> None:
    """Run all stages (or the named ones) in order."""
    for name in stages or list(STAGES):
        STAGES[name](spark, paths, p)
