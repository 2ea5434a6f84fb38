"""Final feature assembly: labels (B9, B10), shift ⟕ trip ⟕ label / id
(F5–F8), interaction features (I1–I8), and the coverage / missing-value /
agreement reports (E19–E21)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.nulls import div_or_null, fill0, r4
from ..functions.order_stats import medians
from ..params import TARGET

KEY = ["dumper_id", "date_dpr", "shift"]


def join_key(left: DataFrame, right: DataFrame, how: str = "left", keys=KEY) -> DataFrame:
    """Equi-join on the shift key, NULL-safe on every key column (pandas
    merges NaT with NaT)."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def fuel_labels(summary: DataFrame) -> DataFrame:
    """Fuel consumed = max(0, initlev + arefill - endlev) (NULL
    operand -> NULL), rounded to 4; refill flag; infinite lph -> NULL."""
    raw = F.col("initlev") + F.col("arefill") - F.col("endlev")
    lph = F.col("lph")
    return summary.select(
        F.col("vehicle").alias("dumper_id"), F.col("date").alias("date_dpr"), F.trim(F.col("shift")).alias("shift"),
        r4(F.when(raw.isNotNull(), F.greatest(raw, F.lit(0.0)))).alias(TARGET),
        F.coalesce(F.col("arefill") > 0, F.lit(False)).cast("int").alias("had_refill"),
        "runhrs",
        F.when(~F.isnan(lph) & ~lph.isin(float("inf"), float("-inf")), lph).alias("lph"),
        "initlev", "endlev",
    )


def duplicate_labels(labels: DataFrame) -> DataFrame:
    """shift keys with more than one label row, which would multiply the
    shift's training rows; one row per key with the number of labels and how far
    they lie apart."""
    g = labels.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_labels"), F.min(TARGET).alias("min_fuel_L"), F.max(TARGET).alias("max_fuel_L"))
    return g.where(F.col("n_labels") > 1)


def split_by_mapping(shift_feats: DataFrame, id_mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Shifts listed in the submission mapping form the test split, the rest
    the train split (semi/anti joins on the shift key)."""
    m = id_mapping.select(F.col("vehicle").alias("dumper_id"), F.col("date").alias("date_dpr"),
                          F.trim(F.col("shift")).alias("shift")).distinct()
    return join_key(shift_feats, m, "left_anti"), join_key(shift_feats, m, "left_semi")


def add_interactions(df: DataFrame) -> DataFrame:
    """I1–I8 (rounded to 4)."""
    eps = 1e-6
    c = df.columns
    ld = F.col("loaded_dist_hav_km") if "loaded_dist_hav_km" in c else F.lit(None).cast("double")
    em = F.col("empty_dist_hav_km") if "empty_dist_hav_km" in c else F.lit(None).cast("double")
    spd_l = F.col("avg_speed_loaded") if "avg_speed_loaded" in c else F.lit(0.0)
    spd_e = F.col("avg_speed_empty") if "avg_speed_empty" in c else F.lit(eps)
    ld_gr = F.col("mean_uphill_grad") if "mean_uphill_grad" in c else F.lit(eps)
    tph = F.col("trips_per_hour") if "trips_per_hour" in c else F.lit(0.0)
    trips = F.nullif(F.col("calc_trips"), F.lit(0))
    ref_d = F.nullif(F.col("total_dist_hav_km"), F.lit(0.0))
    return df.select(
        "*",
        r4(F.col("mean_gradient_pct") * F.col("total_dist_hav_km")).alias("gradient_work_hav"),
        r4(F.col("mean_gradient_pct") * F.col("total_dist_spd_km")).alias("gradient_work_spd"),
        r4(fill0(ld * F.col("net_lift_m"))).alias("loaded_lift_proxy"),
        r4(fill0(F.try_divide(ref_d, trips))).alias("dist_per_trip"),
        r4(fill0(F.try_divide(ld, trips))).alias("loaded_km_per_trip"),
        r4(fill0(F.abs(ld - em))).alias("haul_imbalance"),
        r4(fill0(F.try_divide(F.col("gross_elev_m"), trips))).alias("elev_per_trip"),
        r4(spd_l / (spd_e + eps)).alias("speed_efficiency"),
        r4(spd_l / (F.abs(ld_gr) + eps)).alias("loaded_kmh_per_grad"),
        r4(fill0(tph * F.coalesce(ld, F.lit(0.0)))).alias("cycle_efficiency"),
        F.col("stopgo_intensity").alias("stoppage_density"),
    )


def assemble_train(shift_train: DataFrame, trips: DataFrame, labels: DataFrame) -> DataFrame:
    """F5 + F7 + I: train shifts with trip features, labels and interactions.
    ``total_trip`` (E14) is already the shift's first non-null value."""
    t = join_key(shift_train, trips.drop("is_fallback") if "is_fallback" in trips.columns else trips)
    t = join_key(t, labels)
    return add_interactions(t)


def assemble_test(shift_test: DataFrame, trips: DataFrame, id_mapping: DataFrame) -> DataFrame:
    """F5 + I + F8: test shifts with trip features, interactions and ids."""
    t = join_key(shift_test, trips.drop("is_fallback") if "is_fallback" in trips.columns else trips)
    t = add_interactions(t)
    m = id_mapping.select("id", F.col("vehicle").alias("dumper_id"), F.col("date").alias("date_dpr"),
                          F.trim(F.col("shift")).alias("shift"))
    return join_key(t, m)


def missing_report(df: DataFrame) -> DataFrame:
    """NULL count of every column, only columns with some NULLs; one
    aggregate pass, then the single row is unpivoted."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = counts.unpivot([], df.columns, "column_name", "n_missing")
    return long.where(F.col("n_missing") > 0)


#: Marks the final rows that have an embedding of their own (others are filled with 0).
EMBEDDED = "has_embedding"

#: What is counted of each stage table while it is written.
COVERAGE = {
    "pings": {"dump_pings": lambda: F.count(F.lit(1)), "gps_ok_pct": lambda: r4(F.avg("gps_ok") * 100)},
    "loaders": {"loader_pings": lambda: F.count(F.lit(1))},
    "final_train": {"train_shifts": lambda: F.count(F.lit(1)), "fuel_rows": lambda: F.count(TARGET)},
    "final_test": {"test_shifts": lambda: F.count(F.lit(1)), "id_mapped": lambda: F.count("id")},
    "train_embedding": {"train_embedded_pct": lambda: _embedded_pct()},
    "test_embedding": {"test_embedded_pct": lambda: _embedded_pct()},
}


def _embedded_pct() -> Column:
    return r4(F.coalesce(F.avg(F.col(EMBEDDED).cast("double")), F.lit(0.0)) * 100)


def observe(df: DataFrame, table: str) -> tuple[DataFrame, Observation]:
    """``df`` with the metrics of ``table`` attached: whatever action writes it
    also yields them, without a pass of its own."""
    seen = Observation(f"{table}-{uuid.uuid4().hex}")
    return df.observe(seen, *[e().cast("double").alias(n) for n, e in COVERAGE[table].items()]), seen


def coverage_rows(seen: Observation) -> list[tuple[str, float]]:
    """``(metric, value)`` of a table that was written; a handful of numbers."""
    return [(k, v) for k, v in seen.get.items()]


def coverage_report(spark: SparkSession, seen: list[Observation]) -> DataFrame:
    """Label, id and embedding coverage, GPS share and row counts as
    ``(metric, value)`` rows, from what was observed."""
    return spark.createDataFrame([r for s in seen for r in coverage_rows(s)], "metric string, value double")


AGREEMENT_PAIRS = [("prod_hrs", "prod_hr_dpr"), ("idle_hrs", "idle_hr_dpr"), ("maint_hrs", "maint_hr_dpr"),
                   ("total_dist_hav_km", "km_dpr"), ("total_dist_spd_km", "km_dpr"),
                   ("total_dist_hav_km", "cumdist_range")]


def agreement_report(shift_dpr: DataFrame) -> DataFrame:
    """Calculated vs reported values, one row per available pair, over
    rows where both are non-null and either is positive: n, Pearson
    correlation, MAE, median bias, share within 10 % / 20 %.  All pairs are
    read in one pass; the medians are picked by a distributed rank search."""
    pairs = [(c, r) for c, r in AGREEMENT_PAIRS if c in shift_dpr.columns and r in shift_dpr.columns]
    if not pairs:
        return shift_dpr.sparkSession.createDataFrame(
            [], "calc string, ref string, n bigint, corr double, mae double, bias double, within_10_pct double, within_20_pct double")
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("calc"), F.lit(r).alias("ref"), F.col(c).cast("double").alias("c"),
                                        F.col(r).cast("double").alias("r")) for c, r in pairs]))
    c, r = F.col("c"), F.col("r")
    v = shift_dpr.select(each.alias("_p")).select("_p.*").where(c.isNotNull() & r.isNotNull() & ((r > 0) | (c > 0)))
    v = v.withColumn("d", c - r)
    pe = F.abs(F.try_divide(F.col("d"), F.nullif(r, F.lit(0.0)))) * 100
    within = lambda most: r4(F.avg(F.coalesce(pe <= most, F.lit(False)).cast("double")) * 100)
    out = v.groupBy("calc", "ref").agg(F.count(F.lit(1)).alias("n"), r4(F.corr(c, r)).alias("corr"), r4(F.avg(F.abs("d"))).alias("mae"),
                                       within(10).alias("within_10_pct"), within(20).alias("within_20_pct"))
    bias = medians(v, ["calc", "ref"], "d").select("calc", "ref", r4("median").alias("bias"))
    every = shift_dpr.sparkSession.createDataFrame(pairs, "calc string, ref string")
    out = every.join(out, ["calc", "ref"], "left").join(bias, ["calc", "ref"], "left").fillna(0, "n")
    return out.select("calc", "ref", "n", "corr", "mae", "bias", "within_10_pct", "within_20_pct")
