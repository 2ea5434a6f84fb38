"""One ordered pass over hauler pings: every per-ping operator that looks at
the previous ping of the vehicle (C1–C8), computed once and reused by the
shift, trip and sequence stages (the reference recomputes them per module).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import flag, seconds_between
from ..params import Params
from .sequential import ordered_pass

KEY = ["vehicle", "date_dpr", "shift_dpr"]


def is_stop_row(p: Params) -> Column:
    """C7 predicate: speed < 3.5 and ignition on (NULL -> false)."""
    return flag((F.col("speed") < p.stop_speed) & (F.col("ignition") == 1))


def body_up(p: Params) -> Column:
    return (F.coalesce(F.col("analog_input_1"), F.lit(0.0)) > p.body_up_threshold).cast("int")


def ping_pass(clean: DataFrame, p: Params, is_train: bool = True) -> DataFrame:
    """Cleaned hauler pings -> pings with C1–C8 columns.

    C1 ``actual_dt_sec``/``is_gap_300s``/``dt_sec``; C2 ``fuel_delta``/``gap_status``
    (train only); C3 ``adiff``; C4 ``angd``; C5 ``ign_on_edge``; C6 ``stop_edge``;
    C7 ``is_stp``/``stop_run``; C8 ``bu_rise``/``bu_fall``.
    """
    has_fuel = "fuel_volume" in clean.columns
    has_analog = "analog_input_1" in clean.columns
    d = clean.withColumn("is_stp", is_stop_row(p))
    if has_analog:
        d = d.withColumn("_bu", body_up(p))
    lags = ["altitude", "angle", "ignition", "speed", "is_stp"]
    lags += ["fuel_volume"] if has_fuel else []
    lags += ["_bu"] if has_analog else []
    # A stop run is identified by the last non-stop row before it; two stop
    # rows share a run exactly when no non-stop row lies between them
    d = ordered_pass(d, "vehicle", p.bucket_s, lags,
                     running_last={"stop_run": F.when(~F.col("is_stp"), F.struct("ts_us", "ping_id"))})

    first_dt = p.first_dt_train if is_train else p.first_dt_test
    actual = F.coalesce(seconds_between("ts_us", "prev_ts_us"), F.lit(float(first_dt)))
    gap = actual >= p.gap_s
    cols = {
        "actual_dt_sec": actual,
        "is_gap_300s": gap.cast("int"),
        "dt_sec": F.least(actual, F.lit(p.gap_s)),
    }
    if is_train and has_fuel:
        fd = F.when(gap, F.col("fuel_volume") - F.col("prev_fuel_volume"))
        cols["fuel_delta"] = fd
        cols["gap_status"] = (F.when(gap & (fd >= p.blind_fuel_drop), "engine_off_stationary")
                              .when(gap & (fd < p.blind_fuel_drop), "engine_running_blind").otherwise("normal"))
    else:
        cols["fuel_delta"] = F.lit(None).cast("double")
        cols["gap_status"] = F.lit("normal") if is_train else F.lit(None).cast("string")
    # Altitude change, NULL -> 0, forced 0 on gap rows (crosses shifts)
    cols["adiff"] = F.when(gap, F.lit(0.0)).otherwise(F.coalesce(F.col("altitude") - F.col("prev_altitude"), F.lit(0.0)))
    # C4: heading change folded to [0, 180]; kept only on moving GPS rows later
    raw = F.abs(F.col("angle") - F.col("prev_angle"))
    cols["angd_raw"] = F.when(raw > 180, F.lit(360.0) - raw).otherwise(raw)
    # C5 / C6 edges (previous NULL counts as 0)
    cols["ign_on_edge"] = flag((F.col("ignition") == 1) & (F.coalesce(F.col("prev_ignition"), F.lit(0)) == 0))
    cols["stop_edge"] = flag((F.col("speed") < p.moving_speed)
                             & (F.coalesce(F.col("prev_speed"), F.lit(0.0)) >= p.moving_speed))
    # C8 body-up edges; the first row at/after the analog cut is never an edge
    if has_analog:
        edge_ok = (F.col("ts_us") >= p.analog_cut_us) & flag(F.col("prev_ts_us") >= p.analog_cut_us)
        cols["bu_rise"] = edge_ok & (F.col("_bu") - F.col("prev__bu") == 1)
        cols["bu_fall"] = edge_ok & (F.col("_bu") - F.col("prev__bu") == -1)
    else:
        cols["bu_rise"] = F.lit(False)
        cols["bu_fall"] = F.lit(False)
    d = d.withColumns(cols)
    drop = [c for c in d.columns if c.startswith("prev_") and c not in ("prev_angle",)] + ["_bu"]
    return d.drop(*[c for c in drop if c in d.columns])
