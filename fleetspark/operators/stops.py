"""Stop events (C7 + E10) and the candidate filters of trip detection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import first_non_null
from ..params import Params

STOP_KEY = ["vehicle", "date_dpr", "shift_dpr", "run_us", "run_pid"]


def stop_events(pings: DataFrame, p: Params) -> DataFrame:
    """One row per stop run and shift: start/end, exact medians of the
    position and altitude, first mine, duration and twice the midpoint
    (``mid2_us``; the midpoint itself can fall on half a microsecond)."""
    s = (pings.where(F.col("is_stp"))
         .withColumn("run_us", F.col("stop_run.ts_us")).withColumn("run_pid", F.col("stop_run.ping_id"))
         .groupBy(*STOP_KEY)
         .agg(F.min("ts_us").alias("start_us"), F.max("ts_us").alias("end_us"),
              F.min_by("ping_id", F.struct("ts_us", "ping_id")).alias("start_pid"),
              F.median("utm_x").alias("d_utm_x"), F.median("utm_y").alias("d_utm_y"),
              F.median("altitude").alias("d_alt"),
              first_non_null("mine_anon", "ts_us", "ping_id").alias("mine_anon")))
    return (s.withColumn("dur_sec", (F.col("end_us") - F.col("start_us")) / F.lit(1_000_000.0))
            .withColumn("mid2_us", F.col("start_us") + F.col("end_us")))


def load_candidates(stops: DataFrame, p: Params) -> DataFrame:
    lo, hi = p.load_dur_s
    return stops.where(F.col("dur_sec").between(lo, hi))


def dump_candidates(stops: DataFrame, p: Params) -> DataFrame:
    lo, hi = p.dump_dur_s
    return stops.where(F.col("dur_sec").between(lo, hi))
