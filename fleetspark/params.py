"""Tunable constants of the telemetry pipeline.

Defaults reproduce the reference pipeline's behaviour; every threshold is a
field so a user can change it without touching operator code.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# Fixed values that must equal the reference for identical results.
SHIFT_CAP_HRS = 8.0
GPS_PDOP_LIM = 6.0
GPS_HDOP_LIM = 4.0
GPS_SAT_MIN = 5
SPEED_MAX = 60.0
ALT_MIN = 500.0
ALT_MAX = 800.0
ANALOG_CUT_US = 1_771_286_400_000_000  # 2026-02-17 00:00:00 UTC
DUMP_BODY_THR = 0.5
DPR_COLS = ("prod_hr_dpr", "idle_hr_dpr", "maint_hr_dpr", "km_dpr", "tonnage", "bd_hr_dpr", "hmr_dpr")
LOADER_PREFIXES = ("Exc", "WHL", "BHL")
DUMP_PREFIX = "Dump"
SEQ_FEATURES = ("speed", "altitude", "ignition", "gps_ok", "log_dt", "is_moving", "adiff_norm", "spd_x_dt")
CAT_FEATURES = ("dumper_id", "shift", "mine_id", "operator_id")
TARGET = "fuel_consumed_L"


@dataclass(frozen=True)
class Params:
    # cleaning
    shift_cap_hrs: float = SHIFT_CAP_HRS
    hdop_max: float = GPS_HDOP_LIM
    pdop_max: float = GPS_PDOP_LIM
    min_satellites: int = GPS_SAT_MIN
    speed_max: float = SPEED_MAX
    alt_min: float = ALT_MIN
    alt_max: float = ALT_MAX
    # time deltas and gaps
    gap_s: float = 300.0
    first_dt_train: float = 0.0
    first_dt_test: float = 5.0
    blind_fuel_drop: float = -2.0
    # shift features
    moving_speed: float = 2.0
    maint_gap_s: float = 900.0
    grad_min_dist_m: float = 5.0
    grad_clip: float = 50.0
    steep_grad: float = 5.0
    sharp_turn_deg: float = 45.0
    # trips
    stop_speed: float = 3.5
    load_dur_s: tuple = (45.0, 1200.0)
    dump_dur_s: tuple = (15.0, 600.0)
    body_up_dur_s: tuple = (10.0, 600.0)
    analog_cut_us: int = ANALOG_CUT_US
    body_up_threshold: float = DUMP_BODY_THR
    asof_tolerance_s: int = 120
    loader_max_dist_m: float = 50.0
    loader_max_dz_m: float = 15.0
    zone_alt_tol_m: float = 20.0
    # coordinates of the zone file: its own crs member ("file"), or a declared one
    zones_crs: str = "file"
    mark_tolerance_s: int = 5
    # "fleet": an event marks pings of every vehicle (reference behaviour);
    # "vehicle": only pings of the vehicle that produced the event.
    event_scope: str = "fleet"
    # False reproduces the reference mask (mine id tested against vehicle ids);
    # True applies the documented intent (mine002 shifts fall back to 50/50).
    fallback_mine002: bool = False
    # sequences / model
    seq_max_len: int = 600
    seq_min_len: int = 5
    embed_dim: int = 16
    scout_top_k: int = 20
    scout_rounds: int = 150
    folds: int = 5
    seed: int = 42
    # execution: width of the time bucket that bounds one ordered window task
    # (a vehicle's pings are split into buckets; the row before a bucket is
    # carried over, so results do not depend on the width).
    bucket_s: int = 86_400
    # the stage's ping table: input bytes per file, and files at least
    ping_bucket_bytes: int = 256 << 20
    min_ping_buckets: int = 8
    # largest event-bin table, in bytes, broadcast to the ping scan for proximity marks
    max_broadcast_bytes: int = 64 << 20
    # grid cell (metres) used to equi-join stop points with zone polygons
    zone_cell_m: float = 500.0

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULT = Params()
