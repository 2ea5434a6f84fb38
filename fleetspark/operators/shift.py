"""Shift features: ping measures (D1–D9) -> one aggregate on the shift key
(E1–E9, the reference's ~9 group-bys and merges) -> derived columns (G1–G6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import clip, div_or_null, fill0, first_in_order, first_non_null, flag, r2, r4
from ..params import DPR_COLS, Params

KEY = ["vehicle", "date_dpr", "shift_dpr"]
ORDER = ("ts_us", "ping_id")
HOUR_COLS = [("engine_on_s", "engine_on_hrs"), ("engine_off_s", "engine_off_hrs"), ("prod_s", "prod_hrs"),
             ("idle_s", "idle_hrs"), ("maint_s", "maint_hrs"), ("blind_s", "blind_gap_hrs")]
DIST_COLS = ["total_dist_spd_km", "total_dist_hav_km", "dist_steep_spd_km", "dist_steep_hav_km",
             "uphill_dist_hav_km", "downhill_dist_hav_km"]


def ping_measures(d: DataFrame, p: Params) -> DataFrame:
    """D1–D9 on the output of ``ping_pass`` (two projections)."""
    has_dh = "disthav" in d.columns
    gap = F.col("is_gap_300s") == 1
    normal = ~gap
    blind = flag(F.col("gap_status") == "engine_running_blind")
    offst = flag(F.col("gap_status") == "engine_off_stationary")
    ign = flag(F.col("ignition") == 1)
    fast = flag(F.col("speed") >= p.moving_speed)
    slow = flag(F.col("speed") < p.moving_speed)
    gps = F.col("gps_ok") == 1
    dt = F.col("actual_dt_sec")  # D1: equal to the gap/normal choice of the reference
    tb = lambda cond: F.when(cond, dt).otherwise(F.lit(0.0))
    off_like = (normal & ~ign) | offst
    moving_gps = normal & ign & fast & gps
    d_spd = F.when(moving_gps, F.col("speed") * F.col("dt_sec") / 3600).otherwise(0.0)
    if has_dh:
        d_hav = F.when(gps & flag(F.col("disthav") > 0), F.col("disthav") / 1000).otherwise(0.0)
    else:
        d_hav = d_spd
    a = F.col("adiff")
    d = d.withColumns({
        "_dt_eon": tb((normal & ign) | blind),
        "_dt_eoff": tb(off_like),
        "_dt_prod": tb((normal & ign & fast) | blind),
        "_dt_idle": tb(normal & ign & slow),
        "_dt_maint": tb(off_like & (dt > p.maint_gap_s)),
        "_dt_blind": tb(blind),
        "moving_gps": moving_gps,
        "_nblind": blind.cast("int"),
        "_noffst": offst.cast("int"),
        "_d_spd": d_spd,
        "_d_hav": d_hav,
        "_lift": F.when(gps & (a > 0), a).otherwise(0.0),
        "_desc": F.when(gps & (a < 0), -a).otherwise(0.0),
        "_gelev": F.when(gps, F.abs(a)).otherwise(0.0),
        "_spd_mask": gps & fast & ign,
    })
    dist_m = F.col("_d_hav") * 1000 if has_dh else F.col("speed") * F.col("dt_sec") / 3.6
    v = F.col("moving_gps") & flag(dist_m > p.grad_min_dist_m)
    g = F.when(v, clip(a / dist_m * 100, -p.grad_clip, p.grad_clip))
    angd = F.when(F.col("moving_gps") & F.col("prev_angle").isNotNull(), F.col("angd_raw"))
    return d.withColumns({
        "_valid_g": v,
        "_grad": g,
        "_gradabs": F.abs(g),
        "_grad_up": F.when(v & (g > 0), g),
        "_grad_dn": F.when(v & (g < 0), -g),
        "_d_steep_spd": F.when(v & flag(g > p.steep_grad), F.col("_d_spd")).otherwise(0.0),
        "_d_steep_hav": F.when(v & flag(g > p.steep_grad), F.col("_d_hav")).otherwise(0.0),
        "_d_up_hav": F.when(v & flag(g > 0), F.col("_d_hav")).otherwise(0.0),
        "_d_dn_hav": F.when(v & flag(g < 0), F.col("_d_hav")).otherwise(0.0),
        "_angd": angd,
        "_sharp_turn": flag(angd > p.sharp_turn_deg).cast("int"),
    })


def shift_aggregate(d: DataFrame, p: Params, with_dpr: bool = False) -> DataFrame:
    """E1–E9 as one hash aggregate on the shift key."""
    order = [F.col(c) for c in ORDER]
    s = lambda c: F.sum(c)
    spd = F.when(F.col("_spd_mask"), F.col("speed"))
    alt = F.when(F.col("gps_ok") == 1, F.col("altitude"))
    aggs = [
        s("_dt_eon").alias("engine_on_s"), s("_dt_eoff").alias("engine_off_s"), s("_dt_prod").alias("prod_s"),
        s("_dt_idle").alias("idle_s"), s("_dt_maint").alias("maint_s"), s("_dt_blind").alias("blind_s"),
        s(F.col("ign_on_edge").cast("int")).alias("n_ign_cycles"), s(F.col("stop_edge").cast("int")).alias("n_stops"),
        s("is_gap_300s").alias("n_gaps"), s("_nblind").alias("n_blind_gaps"), s("_noffst").alias("n_off_stat"),
        s("_sharp_turn").alias("n_sharp_turns"),
        F.count("ts_us").alias("row_count"),
        F.avg("gps_ok").alias("gps_ok_pct"),
        first_in_order("operator_id").alias("operator_id"),
        *[s(f"_{c}").alias(n) for c, n in [("d_spd", "total_dist_spd_km"), ("d_hav", "total_dist_hav_km"),
                                           ("d_steep_spd", "dist_steep_spd_km"), ("d_steep_hav", "dist_steep_hav_km"),
                                           ("d_up_hav", "uphill_dist_hav_km"), ("d_dn_hav", "downhill_dist_hav_km"),
                                           ("lift", "net_lift_m"), ("desc", "net_descent_m"), ("gelev", "gross_elev_m")]],
        F.avg("_grad").alias("mean_gradient_pct"), F.max("_gradabs").alias("max_gradient_pct"),
        F.stddev_samp("_grad").alias("std_grad"),
        F.avg("_grad_up").alias("mean_uphill_grad"), F.avg("_grad_dn").alias("mean_downhill_grad"),
        F.avg("_angd").alias("mean_angle_change"), F.stddev_samp("_angd").alias("std_angle_change"),
        F.sum("_angd").alias("total_turning_deg"),
        F.avg(spd).alias("mean_speed"), F.max(spd).alias("max_speed"), F.stddev_samp(spd).alias("std_speed"),
        F.stddev_samp(alt).alias("alt_std"),
    ]
    if "cumdist" in d.columns:
        aggs.append(clip(F.max("cumdist") - F.min("cumdist"), lo=0.0).alias("cumdist_range"))
    for c in ("total_trip", "rain_loss", "dense_fog"):
        if c in d.columns:
            aggs.append(first_in_order(c).alias(c))
    if with_dpr:
        aggs += [first_in_order(c).alias(c) for c in DPR_COLS if c in d.columns]
    main = d.groupBy(*KEY).agg(*aggs)
    # the only string "first": a narrow aggregate of its own, so the wide one
    # above stays a hash aggregate; joined back on the (shift-level) key
    mine = d.where(F.col("mine_anon").isNotNull()).groupBy(*KEY).agg(F.min_by("mine_anon", "_ord").alias("mine_id"))
    return main.join(mine, [main[k].eqNullSafe(mine[k]) for k in KEY], "left").select(main["*"], mine["mine_id"])


def derive_shift_features(a: DataFrame, p: Params) -> DataFrame:
    """G1–G6 on the aggregate; renames the key to (dumper_id, date_dpr, shift).
    Rounding follows the reference's order (G2 and G5 use rounded inputs)."""
    cols = {hr: F.least(r4(F.col(raw) / 3600.0), F.lit(p.shift_cap_hrs)) for raw, hr in HOUR_COLS}
    cols.update({c: r4(fill0(c)) for c in DIST_COLS})
    cols.update({c: r2(c) for c in ("net_lift_m", "net_descent_m", "gross_elev_m")})
    cols.update({c: r4(fill0(c)) for c in ("alt_std", "mean_gradient_pct", "max_gradient_pct", "std_grad",
                                            "mean_uphill_grad", "mean_downhill_grad", "mean_angle_change",
                                            "std_angle_change", "total_turning_deg", "mean_speed", "max_speed",
                                            "std_speed")})
    cols["n_sharp_turns"] = F.coalesce(F.col("n_sharp_turns"), F.lit(0)).cast("int")
    cols["gps_ok_pct"] = r2(F.col("gps_ok_pct") * 100)
    cols["n_stops"] = F.greatest(F.col("n_stops"), F.lit(0)).cast("int")
    a = a.withColumns(cols)
    tot_on = F.col("prod_hrs") + F.col("idle_hrs")
    over = tot_on > F.col("engine_on_hrs")
    scale = F.col("engine_on_hrs") / tot_on
    a = a.withColumns({
        "prod_hrs": F.when(over, r4(F.col("prod_hrs") * scale)).otherwise(F.col("prod_hrs")),
        "idle_hrs": F.when(over, r4(F.col("idle_hrs") * scale)).otherwise(F.col("idle_hrs")),
    })
    ref = F.nullif(F.col("total_dist_hav_km"), F.lit(0.0))
    a = a.withColumns({
        "idle_ratio": r4(fill0(div_or_null("idle_hrs", "engine_on_hrs"))),
        "stopgo_intensity": r4(fill0(F.try_divide(F.col("n_stops"), ref))),
        "stoppage_per_hour": r4(fill0(div_or_null("n_stops", "engine_on_hrs"))),
        "dist_per_stop": r4(fill0(F.try_divide(ref, F.nullif(F.col("n_stops"), F.lit(0))))),
        "elev_per_dist": r4(fill0(F.try_divide(F.col("gross_elev_m"), ref))),
    })
    a = a.withColumnsRenamed({"vehicle": "dumper_id", "shift_dpr": "shift"}).drop(*[raw for raw, _ in HOUR_COLS])
    return fill_operator(a)


def fill_operator(a: DataFrame) -> DataFrame:
    """E15 + G6: own operator -> the vehicle's most frequent operator over its
    shifts (ties -> smallest) -> -1.  Shifts are counted per vehicle and
    operator first, so no task holds a vehicle's history."""
    n = a.where(F.col("operator_id").isNotNull()).groupBy("dumper_id", "operator_id").agg(F.count(F.lit(1)).alias("_n"))
    mode = n.groupBy(F.col("dumper_id").alias("_v")).agg(F.max_by("operator_id", F.struct("_n", -F.col("operator_id"))).alias("_mode"))
    a = a.join(mode, a["dumper_id"].eqNullSafe(mode["_v"]), "left")
    return a.withColumn("operator_id", F.coalesce(F.col("operator_id"), F.col("_mode"), F.lit(-1)).cast("int")).drop("_v", "_mode")


def shift_features(pings: DataFrame, p: Params, with_dpr: bool = False) -> DataFrame:
    return derive_shift_features(shift_aggregate(ping_measures(pings, p), p, with_dpr), p)
