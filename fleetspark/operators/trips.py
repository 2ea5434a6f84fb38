"""Trip detection: events -> marks -> loaded/empty state -> trip features
(C9–C11, D10, E11–E13, H1–H4)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import first_non_null, flag, r4, safe_div
from ..params import Params
from .asof import closest_loaders, confirmed_loads
from .dumps import body_up_events, geofence_events, zones_have_altitude
from .marks import event_bins, mark_pings
from .sequential import shift_scoped_fill
from .shift import ping_measures
from .stops import dump_candidates, load_candidates, stop_events

KEY = ["vehicle", "date_dpr", "shift_dpr"]


class TripEvents:
    """Stops, confirmed loads and dump events.  Each is a small table read by
    several consumers (marks, loading metadata, reports), so each is
    materialised once to the checkpoint folder, on first use, instead of
    being replayed."""

    def __init__(self, pings: DataFrame, loaders: DataFrame, fleet_cls: DataFrame, zones: DataFrame | None,
                 p: Params):
        self._pings, self._loaders, self._cls, self._zones, self.p = pings, loaders, fleet_cls, zones, p

    @cached_property
    def stops(self) -> DataFrame:
        return stop_events(self._pings, self.p).checkpoint(eager=True)

    @cached_property
    def loads(self) -> DataFrame:
        near = closest_loaders(load_candidates(self.stops, self.p), self._loaders, self.p)
        return confirmed_loads(near, self.p).checkpoint(eager=True)

    @cached_property
    def analog(self) -> DataFrame:
        return body_up_events(self._pings, self._cls, self.p).checkpoint(eager=True)

    @cached_property
    def geofence(self) -> DataFrame:
        dc = dump_candidates(self.stops, self.p)
        if self._zones is None:
            return dc.limit(0).withColumn("zone_id", F.lit(None).cast("int"))
        geo = geofence_events(dc, self._cls, self._zones, self.p, filter_altitude=zones_have_altitude(self._zones))
        return geo.checkpoint(eager=True)

    @cached_property
    def events(self) -> DataFrame:
        """kind, ts_us (and vehicle for event_scope='vehicle'): the mark sources."""
        cols = ["kind", "ts_us"] + (["vehicle"] if self.p.event_scope == "vehicle" else [])
        return (self.loads.select(F.lit("load").alias("kind"), F.col("end_us").alias("ts_us"), "vehicle")
                .unionByName(self.analog.select(F.lit("dump").alias("kind"), F.col("fall_us").alias("ts_us"), "vehicle"))
                .unionByName(self.geofence.select(F.lit("dump").alias("kind"), F.col("end_us").alias("ts_us"), "vehicle"))
                .select(*cols).distinct())


def trip_events(pings: DataFrame, loaders: DataFrame, fleet_cls: DataFrame, zones: DataFrame | None,
                p: Params) -> TripEvents:
    return TripEvents(pings, loaders, fleet_cls, zones, p)


def marked_pings(pings: DataFrame, ev: TripEvents, p: Params) -> DataFrame:
    """F4 with a size-checked broadcast: the bin table is checkpointed to the
    shared checkpoint folder (cuts the event lineage and makes the count
    cheap), then broadcast only under ``max_broadcast_bytes``."""
    bins = event_bins(ev.events, p).checkpoint(eager=True)
    return mark_pings(pings, bins, p, bins_rows=bins.count())


def trip_state(marked: DataFrame) -> DataFrame:
    """C9 forward fill of ``ev_flag`` inside the shift (leading NULL -> empty),
    C10 trip start = loaded after not loaded."""
    d = shift_scoped_fill(marked, ["date_dpr", "shift_dpr"], "vehicle", "ev_flag", "state", "prev_state")
    d = d.withColumn("is_load", F.col("state") == 1)
    return d.withColumn("new_trip", ((F.col("state") == 1) & (F.col("prev_state") == 0)).cast("int"))


def trip_aggregate(st: DataFrame, p: Params) -> DataFrame:
    """D10 split measures + E11 per shift."""
    il = F.col("is_load")
    a = F.col("adiff")
    mv2 = flag((F.col("ignition") == 1) & (F.col("speed") >= p.moving_speed))
    ld_v = F.when(il & mv2, F.col("speed"))
    em_v = F.when(~il & mv2, F.col("speed"))
    z = lambda c: F.coalesce(F.sum(c), F.lit(0.0))
    return st.groupBy(*KEY).agg(
        F.sum("new_trip").alias("calc_trips"),
        F.sum(F.when(il, F.col("_d_spd")).otherwise(0.0)).alias("_ld_spd"),
        F.sum(F.when(~il, F.col("_d_spd")).otherwise(0.0)).alias("_em_spd"),
        F.sum(F.when(il, F.col("_d_hav")).otherwise(0.0)).alias("_ld_hav"),
        F.sum(F.when(~il, F.col("_d_hav")).otherwise(0.0)).alias("_em_hav"),
        F.sum(F.when(il & (a > 0), a).otherwise(0.0)).alias("loaded_climb_m"),
        F.sum(F.when(~il & (a > 0), a).otherwise(0.0)).alias("empty_climb_m"),
        F.sum(F.when(il & (a < 0), -a).otherwise(0.0)).alias("loaded_desc_m"),
        z(ld_v).alias("_ld_sv"), F.count(ld_v).alias("_ld_sc"),
        z(em_v).alias("_em_sv"), F.count(em_v).alias("_em_sc"),
    )


def loading_meta(loads: DataFrame) -> DataFrame:
    """Mean load duration and distinct loaders per shift."""
    return loads.groupBy(*KEY).agg(F.avg("dur_sec").alias("avg_loading_time_sec"),
                                   F.count_distinct("l_id").alias("n_unique_loaders"))


def cycle_times(st: DataFrame) -> DataFrame:
    """C11 + E13 on trip-start rows only (a small subset, so the shift window
    runs on them alone)."""
    tr = st.where(F.col("new_trip") == 1).select(*KEY, "ts_us", "ping_id")
    w = Window.partitionBy(*KEY).orderBy("ts_us", "ping_id")
    tr = tr.withColumn("ct", (F.col("ts_us") - F.lag("ts_us").over(w)) / F.lit(1_000_000.0))
    return tr.groupBy(*KEY).agg(F.avg("ct").alias("avg_cycle_sec"), F.stddev_samp("ct").alias("std_cycle_sec"))


def derive_trip_features(agg: DataFrame, lmeta: DataFrame, cyc: DataFrame) -> DataFrame:
    """H1–H3."""
    t = agg.join(lmeta, KEY, "left").join(cyc, KEY, "left")
    t = t.select(
        "*",
        r4("_ld_spd").alias("loaded_dist_spd_km"), r4("_em_spd").alias("empty_dist_spd_km"),
        r4("_ld_hav").alias("loaded_dist_hav_km"), r4("_em_hav").alias("empty_dist_hav_km"),
        r4(safe_div(F.col("_ld_hav"), F.col("_ld_hav") + F.col("_em_hav"))).alias("loaded_ratio_hav"),
        r4(safe_div(F.col("_ld_spd"), F.col("_ld_spd") + F.col("_em_spd"))).alias("loaded_ratio_spd"),
        r4(safe_div("_ld_sv", "_ld_sc")).alias("avg_speed_loaded"),
        r4(safe_div("_em_sv", "_em_sc")).alias("avg_speed_empty"),
    )
    t = t.withColumn("speed_ratio_l_e", r4(safe_div("avg_speed_loaded", "avg_speed_empty")))
    t = t.withColumn("trips_per_hour", r4(safe_div(F.col("calc_trips"),
                                                   F.col("avg_cycle_sec") * F.col("calc_trips") / 3600)))
    return t


def apply_fallback(t: DataFrame, shift_feats: DataFrame, fleet_cls: DataFrame, p: Params) -> DataFrame:
    """H4: shifts of vehicles outside every fleet class (and, with
    ``fallback_mine002``, of mine002) split total distance 50/50; climb,
    descent and loading metadata become NULL."""
    # the shift's first mine id is the shift features' mine_id (same pings, same rule)
    tot = shift_feats.select(F.col("dumper_id").alias("vehicle"), "date_dpr", F.col("shift").alias("shift_dpr"),
                             "total_dist_hav_km", "total_dist_spd_km", F.col("mine_id").alias("mine_anon"))
    t = t.join(tot, KEY, "left")
    cls = fleet_cls.select("vehicle", (F.col("is_analog") | F.col("is_geo") | F.col("is_m2")).alias("_known"))
    t = t.join(cls, "vehicle", "left")
    if p.fallback_mine002:
        mine_term = flag(F.col("mine_anon") == "mine002")
    else:
        # reference parity: the shift's mine id is looked up among mine002 *vehicle* ids
        m2 = fleet_cls.where("is_m2").select(F.col("vehicle").alias("mine_anon"), F.lit(True).alias("_mine_m2"))
        t = t.join(m2, "mine_anon", "left")
        mine_term = flag(F.col("_mine_m2"))
    fb = mine_term | ~flag(F.col("_known"))
    t = t.withColumn("_fb", fb)
    half = lambda c: F.col(c) * 0.5
    out = {
        "loaded_dist_hav_km": half("total_dist_hav_km"), "empty_dist_hav_km": half("total_dist_hav_km"),
        "loaded_dist_spd_km": half("total_dist_spd_km"), "empty_dist_spd_km": half("total_dist_spd_km"),
        "loaded_ratio_hav": F.lit(0.5), "loaded_ratio_spd": F.lit(0.5),
    }
    for c, v in out.items():
        t = t.withColumn(c, F.when(F.col("_fb"), v).otherwise(F.col(c)))
    for c in ("loaded_climb_m", "empty_climb_m", "loaded_desc_m", "avg_loading_time_sec"):
        t = t.withColumn(c, F.when(~F.col("_fb"), r4(c)))
    t = t.withColumn("n_unique_loaders", F.when(~F.col("_fb"), F.col("n_unique_loaders")))
    return t


TRIP_COLS = ["calc_trips", "loaded_climb_m", "empty_climb_m", "loaded_desc_m", "avg_loading_time_sec",
             "n_unique_loaders", "avg_cycle_sec", "std_cycle_sec", "loaded_dist_spd_km", "empty_dist_spd_km",
             "loaded_dist_hav_km", "empty_dist_hav_km", "loaded_ratio_hav", "loaded_ratio_spd", "avg_speed_loaded",
             "avg_speed_empty", "speed_ratio_l_e", "trips_per_hour"]


def finish_trip_features(t: DataFrame) -> DataFrame:
    t = t.withColumn("avg_cycle_sec", r4("avg_cycle_sec")).withColumn("std_cycle_sec", r4("std_cycle_sec"))
    return t.select(F.col("vehicle").alias("dumper_id"), "date_dpr", F.col("shift_dpr").alias("shift"),
                    *TRIP_COLS, F.col("_fb").alias("is_fallback"))


def trip_features(pings: DataFrame, loaders: DataFrame, fleet_cls: DataFrame, zones: DataFrame | None,
                  shift_feats: DataFrame, p: Params, ev: TripEvents | None = None) -> DataFrame:
    ev = ev or trip_events(pings, loaders, fleet_cls, zones, p)
    st = trip_state(marked_pings(ping_measures(pings, p), ev, p))
    t = derive_trip_features(trip_aggregate(st, p), loading_meta(ev.loads), cycle_times(st))
    return finish_trip_features(apply_fallback(t, shift_feats, fleet_cls, p))
