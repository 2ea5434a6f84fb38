"""DuckDB SQL for every registered query (the correctness oracle).

The SQL is written independently of the Spark plans: plain vehicle windows
instead of bucketed ones, a global running sum for stop blocks (as the
reference does), range joins instead of binned equi-joins, and literal
polygon inequalities instead of ray casting.  CTEs are chained; DuckDB skips
the ones a query does not reference.
"""

from __future__ import annotations

from ..functions.geo import utm_sql
from ..sources.fixtures import DAY2_US, EPOCH_2024_US, EPOCH_2026_US, FIXTURE_ANALOG_CUT_US

D = "cast({} as double)"

FIXTURE = f"""
b AS (
  SELECT event_id, user_id, event_type, cast(round(value * 100) AS bigint) AS v,
         {EPOCH_2026_US} + (epoch_us(ts) - {EPOCH_2024_US}) // 200 AS ts_us
  FROM events),
telemetry AS (
  SELECT event_id AS ping_id,
    concat(CASE WHEN user_id % 5 = 4 THEN 'Exc' ELSE 'Dump' END, cast(user_id AS varchar)) AS vehicle,
    CASE WHEN user_id % 2 = 0 THEN 'mine001' ELSE 'mine002' END AS mine_anon,
    ts_us,
    CASE WHEN ts_us < {DAY2_US} THEN DATE '2026-01-01' ELSE DATE '2026-01-02' END AS date_dpr,
    CASE WHEN ((ts_us - {EPOCH_2026_US}) // 3600000000) % 2 = 0 THEN 'A' ELSE 'B' END AS shift_dpr,
    CASE WHEN v % 17 = 0 THEN NULL WHEN v % 5 < 2 THEN cast(0 AS double) ELSE cast(v % 7000 AS double) / 100 END AS speed,
    CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS ignition,
    cast(480 + v % 340 AS double) AS altitude,
    cast(v % 360 AS double) AS angle,
    85 + cast(v % 1000 AS double) / 10000 AS longitude,
    cast(235000 + v % 777 AS double) / 10000 AS latitude,
    cast(500000 + v % 211 AS double) AS utm_x, cast(2600000 + v % 173 AS double) AS utm_y,
    3 + v % 12 AS satellites,
    CASE WHEN v % 19 = 0 THEN NULL ELSE cast(v % 45 AS double) / 10 END AS gnss_hdop,
    CASE WHEN v % 23 = 0 THEN NULL ELSE cast(v % 65 AS double) / 10 END AS gnss_pdop,
    CASE WHEN v % 29 = 0 THEN NULL ELSE cast(100 + v % 11 AS double) END AS fuel_volume,
    CASE WHEN v % 13 = 0 THEN NULL ELSE cast(v % 900 AS double) END AS disthav,
    cast(v AS double) / 100 AS cumdist,
    CASE WHEN v % 37 = 0 THEN NULL ELSE cast(v % 50 AS double) END AS total_trip,
    CASE WHEN v % 31 = 0 THEN NULL ELSE v % 6 END AS operator_id,
    CASE WHEN v % 3 = 0 THEN cast(1 AS double) ELSE cast(0 AS double) END AS analog_input_1,
    cast(user_id % 7 AS double) / 2 AS prod_hr_dpr,
    cast(user_id % 40 AS double) AS km_dpr
  FROM b),
fleet AS (
  SELECT DISTINCT vehicle,
    CASE WHEN vehicle LIKE 'Dump%' THEN 'Dump Truck' ELSE 'Excavator' END AS fleet, mine_anon,
    CASE WHEN cast(substr(vehicle, CASE WHEN vehicle LIKE 'Dump%' THEN 5 ELSE 4 END) AS int) % 3 = 0 THEN 1 END AS dump_switch
  FROM telemetry
  WHERE cast(substr(vehicle, CASE WHEN vehicle LIKE 'Dump%' THEN 5 ELSE 4 END) AS int) % 7 <> 6),
fuel_summary AS (
  SELECT vehicle, date_dpr AS date, shift_dpr AS shift,
    cast(300 + n AS double) AS initlev,
    CASE WHEN n % 3 = 0 THEN cast(200 AS double) ELSE cast(0 AS double) END AS arefill,
    cast(280 + (n % 7) * 10 AS double) AS endlev,
    cast(n AS double) / 10 AS runhrs,
    CASE WHEN n % 5 = 0 THEN cast('Infinity' AS double) ELSE cast(n AS double) / 4 END AS lph
  FROM (SELECT vehicle, date_dpr, shift_dpr, count(*) AS n FROM telemetry WHERE vehicle LIKE 'Dump%'
        GROUP BY vehicle, date_dpr, shift_dpr) s
  WHERE n % 11 <> 0),
id_mapping AS (
  SELECT cast(row_number() OVER (ORDER BY vehicle) AS bigint) AS id, vehicle, date_dpr AS date, shift_dpr AS shift
  FROM (SELECT DISTINCT vehicle, date_dpr, shift_dpr FROM telemetry WHERE vehicle LIKE 'Dump%'
        AND date_dpr = DATE '2026-01-02' AND shift_dpr = 'B') s),
fleet_cls AS (
  SELECT vehicle,
    bool_or(coalesce(dump_switch = 1, false)) AS is_analog,
    bool_or(coalesce(lower(fleet) LIKE '%dump%' AND mine_anon = 'mine001' AND dump_switch IS NULL, false)) AS is_geo,
    bool_or(coalesce(mine_anon = 'mine002', false)) AS is_m2
  FROM fleet GROUP BY vehicle)"""

CLEAN = """
hauler AS (
  SELECT * REPLACE (
      CASE WHEN speed IS NULL THEN NULL ELSE least(greatest(speed, 0.0), 60.0) END AS speed,
      CASE WHEN altitude IS NULL THEN NULL ELSE least(greatest(altitude, 500.0), 800.0) END AS altitude),
    CASE WHEN satellites >= 5 AND coalesce(gnss_hdop, gnss_pdop) <= 4.0 AND gnss_pdop <= 6.0 THEN 1 ELSE 0 END AS gps_ok
  FROM telemetry WHERE vehicle LIKE 'Dump%'),
loader AS (
  SELECT vehicle AS l_id, ts_us, ping_id, utm_x AS l_x, utm_y AS l_y, altitude AS l_alt
  FROM telemetry WHERE vehicle LIKE 'Exc%' OR vehicle LIKE 'WHL%' OR vehicle LIKE 'BHL%')"""

PINGS = f"""
w AS (
  SELECT *,
    coalesce(speed < 3.5 AND ignition = 1, false) AS is_stp,
    lag(ts_us) OVER wv AS prev_ts, lag(altitude) OVER wv AS prev_alt, lag(angle) OVER wv AS prev_angle,
    lag(ignition) OVER wv AS prev_ign, lag(speed) OVER wv AS prev_speed, lag(fuel_volume) OVER wv AS prev_fuel,
    lag(coalesce(speed < 3.5 AND ignition = 1, false)) OVER wv AS prev_stp,
    lag(CASE WHEN coalesce(analog_input_1, 0) > 0.5 THEN 1 ELSE 0 END) OVER wv AS prev_bu
  FROM hauler WINDOW wv AS (PARTITION BY vehicle ORDER BY ts_us, ping_id)),
p0 AS (
  SELECT *,
    coalesce(cast(ts_us - prev_ts AS double) / 1000000.0, 0.0) AS actual_dt_sec,
    CASE WHEN coalesce(analog_input_1, 0) > 0.5 THEN 1 ELSE 0 END AS bu,
    sum(CASE WHEN is_stp IS DISTINCT FROM prev_stp THEN 1 ELSE 0 END)
      OVER (wv ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop_blk
  FROM w WINDOW wv AS (PARTITION BY vehicle ORDER BY ts_us, ping_id)),
p1 AS (
  SELECT *,
    CASE WHEN actual_dt_sec >= 300 THEN 1 ELSE 0 END AS is_gap_300s,
    least(actual_dt_sec, 300.0) AS dt_sec,
    CASE WHEN actual_dt_sec >= 300 THEN fuel_volume - prev_fuel END AS fuel_delta,
    CASE WHEN actual_dt_sec >= 300 AND fuel_volume - prev_fuel >= -2 THEN 'engine_off_stationary'
         WHEN actual_dt_sec >= 300 AND fuel_volume - prev_fuel < -2 THEN 'engine_running_blind'
         ELSE 'normal' END AS gap_status,
    CASE WHEN actual_dt_sec >= 300 THEN 0.0 ELSE coalesce(altitude - prev_alt, 0.0) END AS adiff,
    CASE WHEN abs(angle - prev_angle) > 180 THEN 360 - abs(angle - prev_angle) ELSE abs(angle - prev_angle) END AS angd_raw,
    coalesce(ignition = 1 AND coalesce(prev_ign, 0) = 0, false) AS ign_on_edge,
    coalesce(speed < 2 AND coalesce(prev_speed, 0) >= 2, false) AS stop_edge,
    coalesce(ts_us >= {{cut}} AND prev_ts >= {{cut}} AND bu - prev_bu = 1, false) AS bu_rise,
    coalesce(ts_us >= {{cut}} AND prev_ts >= {{cut}} AND bu - prev_bu = -1, false) AS bu_fall
  FROM p0)"""

MEASURES = """
pm AS (
  SELECT *,
    is_gap_300s = 0 AS nrm,
    coalesce(gap_status = 'engine_running_blind', false) AS blind,
    coalesce(gap_status = 'engine_off_stationary', false) AS offst,
    coalesce(ignition = 1, false) AS ign,
    coalesce(speed >= 2, false) AS fast,
    coalesce(speed < 2, false) AS slow,
    gps_ok = 1 AS gps
  FROM p1),
pm2 AS (
  SELECT *,
    CASE WHEN (nrm AND ign) OR blind THEN actual_dt_sec ELSE 0 END AS dt_eon,
    CASE WHEN (nrm AND NOT ign) OR offst THEN actual_dt_sec ELSE 0 END AS dt_eoff,
    CASE WHEN (nrm AND ign AND fast) OR blind THEN actual_dt_sec ELSE 0 END AS dt_prod,
    CASE WHEN nrm AND ign AND slow THEN actual_dt_sec ELSE 0 END AS dt_idle,
    CASE WHEN ((nrm AND NOT ign) OR offst) AND actual_dt_sec > 900 THEN actual_dt_sec ELSE 0 END AS dt_maint,
    CASE WHEN blind THEN actual_dt_sec ELSE 0 END AS dt_blind,
    nrm AND ign AND fast AND gps AS moving_gps,
    CASE WHEN gps AND coalesce(disthav > 0, false) THEN disthav / 1000 ELSE 0 END AS d_hav
  FROM pm),
pm3 AS (
  SELECT *,
    CASE WHEN moving_gps THEN speed * dt_sec / 3600 ELSE 0 END AS d_spd,
    CASE WHEN gps AND adiff > 0 THEN adiff ELSE 0 END AS lift,
    CASE WHEN gps AND adiff < 0 THEN -adiff ELSE 0 END AS dsc,
    CASE WHEN gps THEN abs(adiff) ELSE 0 END AS gelev,
    moving_gps AND coalesce(d_hav * 1000 > 5, false) AS valid_g,
    CASE WHEN moving_gps AND coalesce(d_hav * 1000 > 5, false)
         THEN least(greatest(adiff / (d_hav * 1000) * 100, -50.0), 50.0) END AS grad,
    CASE WHEN moving_gps AND prev_angle IS NOT NULL THEN angd_raw END AS angd,
    gps AND fast AND ign AS spd_mask
  FROM pm2),
pm4 AS (
  SELECT *,
    abs(grad) AS gradabs,
    CASE WHEN valid_g AND grad > 0 THEN grad END AS grad_up,
    CASE WHEN valid_g AND grad < 0 THEN -grad END AS grad_dn,
    CASE WHEN valid_g AND coalesce(grad > 5, false) THEN d_spd ELSE 0 END AS d_steep_spd,
    CASE WHEN valid_g AND coalesce(grad > 5, false) THEN d_hav ELSE 0 END AS d_steep_hav,
    CASE WHEN valid_g AND coalesce(grad > 0, false) THEN d_hav ELSE 0 END AS d_up_hav,
    CASE WHEN valid_g AND coalesce(grad < 0, false) THEN d_hav ELSE 0 END AS d_dn_hav,
    CASE WHEN coalesce(angd > 45, false) THEN 1 ELSE 0 END AS sharp
  FROM pm3)"""

SHIFT = """
sagg AS (
  SELECT vehicle, date_dpr, shift_dpr,
    sum(dt_eon) AS engine_on_s, sum(dt_eoff) AS engine_off_s, sum(dt_prod) AS prod_s, sum(dt_idle) AS idle_s,
    sum(dt_maint) AS maint_s, sum(dt_blind) AS blind_s,
    cast(sum(CASE WHEN ign_on_edge THEN 1 ELSE 0 END) AS bigint) AS n_ign_cycles,
    cast(sum(CASE WHEN stop_edge THEN 1 ELSE 0 END) AS bigint) AS n_stops,
    cast(sum(is_gap_300s) AS bigint) AS n_gaps,
    cast(sum(CASE WHEN blind THEN 1 ELSE 0 END) AS bigint) AS n_blind_gaps,
    cast(sum(CASE WHEN offst THEN 1 ELSE 0 END) AS bigint) AS n_off_stat,
    cast(sum(sharp) AS bigint) AS n_sharp_turns,
    count(ts_us) AS row_count,
    avg(gps_ok) AS gps_ok_pct,
    first(mine_anon ORDER BY ts_us, ping_id) FILTER (WHERE mine_anon IS NOT NULL) AS mine_id,
    first(operator_id ORDER BY ts_us, ping_id) FILTER (WHERE operator_id IS NOT NULL) AS operator_id,
    sum(d_spd) AS total_dist_spd_km, sum(d_hav) AS total_dist_hav_km,
    sum(d_steep_spd) AS dist_steep_spd_km, sum(d_steep_hav) AS dist_steep_hav_km,
    sum(d_up_hav) AS uphill_dist_hav_km, sum(d_dn_hav) AS downhill_dist_hav_km,
    sum(lift) AS net_lift_m, sum(dsc) AS net_descent_m, sum(gelev) AS gross_elev_m,
    avg(grad) AS mean_gradient_pct, max(gradabs) AS max_gradient_pct, stddev_samp(grad) AS std_grad,
    avg(grad_up) AS mean_uphill_grad, avg(grad_dn) AS mean_downhill_grad,
    avg(angd) AS mean_angle_change, stddev_samp(angd) AS std_angle_change, sum(angd) AS total_turning_deg,
    avg(CASE WHEN spd_mask THEN speed END) AS mean_speed, max(CASE WHEN spd_mask THEN speed END) AS max_speed,
    stddev_samp(CASE WHEN spd_mask THEN speed END) AS std_speed,
    stddev_samp(CASE WHEN gps THEN altitude END) AS alt_std,
    CASE WHEN max(cumdist) IS NULL THEN NULL ELSE greatest(max(cumdist) - min(cumdist), 0.0) END AS cumdist_range,
    first(total_trip ORDER BY ts_us, ping_id) FILTER (WHERE total_trip IS NOT NULL) AS total_trip,
    first(prod_hr_dpr ORDER BY ts_us, ping_id) FILTER (WHERE prod_hr_dpr IS NOT NULL) AS prod_hr_dpr,
    first(km_dpr ORDER BY ts_us, ping_id) FILTER (WHERE km_dpr IS NOT NULL) AS km_dpr
  FROM pm4 GROUP BY vehicle, date_dpr, shift_dpr),
sh1 AS (
  SELECT *,
    least(round_even(engine_on_s / 3600.0, 4), 8.0) AS engine_on_hrs,
    least(round_even(engine_off_s / 3600.0, 4), 8.0) AS engine_off_hrs,
    least(round_even(prod_s / 3600.0, 4), 8.0) AS prod_hrs0,
    least(round_even(idle_s / 3600.0, 4), 8.0) AS idle_hrs0,
    least(round_even(maint_s / 3600.0, 4), 8.0) AS maint_hrs,
    least(round_even(blind_s / 3600.0, 4), 8.0) AS blind_gap_hrs
  FROM sagg),
sh2 AS (
  SELECT *,
    CASE WHEN prod_hrs0 + idle_hrs0 > engine_on_hrs
         THEN round_even(prod_hrs0 * (engine_on_hrs / (prod_hrs0 + idle_hrs0)), 4) ELSE prod_hrs0 END AS prod_hrs,
    CASE WHEN prod_hrs0 + idle_hrs0 > engine_on_hrs
         THEN round_even(idle_hrs0 * (engine_on_hrs / (prod_hrs0 + idle_hrs0)), 4) ELSE idle_hrs0 END AS idle_hrs
  FROM sh1),
sh3 AS (
  SELECT vehicle AS dumper_id, date_dpr, shift_dpr AS shift,
    n_ign_cycles, cast(greatest(n_stops, 0) AS integer) AS n_stops, n_gaps, n_blind_gaps, n_off_stat,
    cast(coalesce(n_sharp_turns, 0) AS integer) AS n_sharp_turns, row_count,
    round_even(gps_ok_pct * 100, 2) AS gps_ok_pct, mine_id, operator_id AS op_own,
    engine_on_hrs, engine_off_hrs, prod_hrs, idle_hrs, maint_hrs, blind_gap_hrs,
    round_even(coalesce(idle_hrs / nullif(engine_on_hrs, 0), 0.0), 4) AS idle_ratio,
    round_even(coalesce(total_dist_spd_km, 0.0), 4) AS total_dist_spd_km,
    round_even(coalesce(total_dist_hav_km, 0.0), 4) AS total_dist_hav_km,
    round_even(coalesce(dist_steep_spd_km, 0.0), 4) AS dist_steep_spd_km,
    round_even(coalesce(dist_steep_hav_km, 0.0), 4) AS dist_steep_hav_km,
    round_even(coalesce(uphill_dist_hav_km, 0.0), 4) AS uphill_dist_hav_km,
    round_even(coalesce(downhill_dist_hav_km, 0.0), 4) AS downhill_dist_hav_km,
    round_even(net_lift_m, 2) AS net_lift_m, round_even(net_descent_m, 2) AS net_descent_m,
    round_even(gross_elev_m, 2) AS gross_elev_m,
    round_even(coalesce(alt_std, 0.0), 4) AS alt_std,
    round_even(coalesce(mean_gradient_pct, 0.0), 4) AS mean_gradient_pct,
    round_even(coalesce(max_gradient_pct, 0.0), 4) AS max_gradient_pct,
    round_even(coalesce(std_grad, 0.0), 4) AS std_grad,
    round_even(coalesce(mean_uphill_grad, 0.0), 4) AS mean_uphill_grad,
    round_even(coalesce(mean_downhill_grad, 0.0), 4) AS mean_downhill_grad,
    round_even(coalesce(mean_angle_change, 0.0), 4) AS mean_angle_change,
    round_even(coalesce(std_angle_change, 0.0), 4) AS std_angle_change,
    round_even(coalesce(total_turning_deg, 0.0), 4) AS total_turning_deg,
    round_even(coalesce(mean_speed, 0.0), 4) AS mean_speed,
    round_even(coalesce(max_speed, 0.0), 4) AS max_speed,
    round_even(coalesce(std_speed, 0.0), 4) AS std_speed,
    cumdist_range, total_trip, prod_hr_dpr, km_dpr
  FROM sh2),
sh4 AS (
  SELECT *,
    round_even(coalesce(n_stops / nullif(total_dist_hav_km, 0), 0.0), 4) AS stopgo_intensity,
    round_even(coalesce(n_stops / nullif(engine_on_hrs, 0), 0.0), 4) AS stoppage_per_hour,
    round_even(coalesce(nullif(total_dist_hav_km, 0) / nullif(n_stops, 0), 0.0), 4) AS dist_per_stop,
    round_even(coalesce(gross_elev_m / nullif(total_dist_hav_km, 0), 0.0), 4) AS elev_per_dist
  FROM sh3),
opmode AS (
  SELECT dumper_id, op_own AS op_mode FROM (
    SELECT dumper_id, op_own, row_number() OVER (PARTITION BY dumper_id ORDER BY count(*) DESC, op_own) AS rn
    FROM sh4 WHERE op_own IS NOT NULL GROUP BY dumper_id, op_own) t WHERE rn = 1),
shiftdpr AS (
  SELECT s.* EXCLUDE (op_own), cast(coalesce(s.op_own, m.op_mode, -1) AS integer) AS operator_id
  FROM sh4 s LEFT JOIN opmode m USING (dumper_id)),
shiftf AS (SELECT * EXCLUDE (prod_hr_dpr, km_dpr) FROM shiftdpr)"""


def ctes(cut: int = FIXTURE_ANALOG_CUT_US) -> str:
    blocks = [FIXTURE, CLEAN, PINGS.replace("{cut}", str(cut)), MEASURES, SHIFT] + EXTRA
    return "WITH " + ",".join(b.strip() for b in blocks)


TRIPS = """
stops AS (
  SELECT vehicle, date_dpr, shift_dpr, stop_blk, min(ts_us) AS start_us, max(ts_us) AS end_us,
    median(utm_x) AS d_utm_x, median(utm_y) AS d_utm_y, median(altitude) AS d_alt,
    first(mine_anon ORDER BY ts_us, ping_id) FILTER (WHERE mine_anon IS NOT NULL) AS mine_anon
  FROM p1 WHERE is_stp GROUP BY vehicle, date_dpr, shift_dpr, stop_blk),
stops2 AS (SELECT *, cast(end_us - start_us AS double) / 1000000.0 AS dur_sec, start_us + end_us AS mid2 FROM stops),
lcand AS (SELECT * FROM stops2 WHERE dur_sec BETWEEN 45 AND 1200),
lpair AS (
  SELECT c.*, l.l_id, l.ts_us AS l_ts_us, l.l_x, l.l_y, l.l_alt,
    row_number() OVER (PARTITION BY c.vehicle, c.stop_blk, c.date_dpr, c.shift_dpr, l.l_id
                       ORDER BY abs(2 * l.ts_us - c.mid2), l.ts_us,
                                CASE WHEN 2 * l.ts_us <= c.mid2 THEN -l.ping_id ELSE l.ping_id END) AS rn
  FROM lcand c JOIN loader l ON 2 * l.ts_us >= c.mid2 - 240000000 AND 2 * l.ts_us <= c.mid2 + 240000000),
lnear AS (
  SELECT * EXCLUDE (rn), sqrt((d_utm_x - l_x) * (d_utm_x - l_x) + (d_utm_y - l_y) * (d_utm_y - l_y)) AS d2d,
    abs(d_alt - l_alt) AS dz
  FROM lpair WHERE rn = 1),
ltop AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vehicle, stop_blk ORDER BY d2d NULLS LAST, l_id, start_us) AS rk
                 FROM lnear) t WHERE rk = 1),
conf AS (SELECT * FROM ltop WHERE d2d <= 50 AND dz <= 15),
edges AS (
  SELECT vehicle, ts_us, bu_rise, lead(ts_us) OVER (PARTITION BY vehicle ORDER BY ts_us, ping_id) AS next_ts
  FROM p1 WHERE bu_rise OR bu_fall),
analog_ev AS (
  SELECT e.vehicle, e.ts_us AS rise_us, e.next_ts AS fall_us, cast(e.next_ts - e.ts_us AS double) / 1000000.0 AS dur_sec
  FROM edges e JOIN fleet_cls f ON f.vehicle = e.vehicle AND f.is_analog
  WHERE e.bu_rise AND e.next_ts IS NOT NULL
    AND cast(e.next_ts - e.ts_us AS double) / 1000000.0 BETWEEN 10 AND 600),
dcand AS (SELECT * FROM stops2 WHERE dur_sec BETWEEN 15 AND 600),
gcand AS (
  SELECT d.* FROM dcand d LEFT JOIN fleet_cls f ON f.vehicle = d.vehicle
  WHERE coalesce(f.is_geo, false) OR (d.mine_anon = 'mine001' AND NOT coalesce(f.is_analog, false))),
zhits AS (
  SELECT g.*, 0 AS zone_id, 650.0 AS median_altitude FROM gcand g
  WHERE d_utm_x BETWEEN 500050 AND 500150 AND d_utm_y BETWEEN 2600040 AND 2600120
  UNION ALL
  SELECT g.*, 1 AS zone_id, 640.0 AS median_altitude FROM gcand g
  WHERE d_utm_x >= 500000 AND d_utm_y >= 2600000 AND 170 * (d_utm_x - 500000) + 200 * (d_utm_y - 2600000) <= 34000),
geo_ev AS (SELECT * FROM zhits WHERE abs(d_alt - median_altitude) <= 20),
load_ev AS (SELECT DISTINCT end_us AS ev_us FROM conf),
dump_ev AS (SELECT fall_us AS ev_us FROM analog_ev UNION SELECT end_us FROM geo_ev),
marked AS (
  SELECT p.*,
    EXISTS (SELECT 1 FROM load_ev e WHERE e.ev_us BETWEEN p.ts_us - 5000000 AND p.ts_us + 5000000) AS load_mark,
    EXISTS (SELECT 1 FROM dump_ev e WHERE e.ev_us BETWEEN p.ts_us - 5000000 AND p.ts_us + 5000000) AS dump_mark
  FROM pm4 p),
st0 AS (SELECT *, CASE WHEN load_mark THEN cast(1 AS double) WHEN dump_mark THEN cast(0 AS double) END AS ev_flag FROM marked),
st1 AS (
  SELECT *, coalesce(last_value(ev_flag IGNORE NULLS) OVER (PARTITION BY vehicle, date_dpr, shift_dpr ORDER BY ts_us, ping_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), cast(0 AS double)) AS state
  FROM st0),
st2 AS (
  SELECT *, CASE WHEN state = 1 AND coalesce(lag(state) OVER (PARTITION BY vehicle, date_dpr, shift_dpr
                                                              ORDER BY ts_us, ping_id), 0) = 0 THEN 1 ELSE 0 END AS new_trip,
    state = 1 AS is_load, coalesce(ignition = 1 AND speed >= 2, false) AS mv2
  FROM st1),
tagg AS (
  SELECT vehicle, date_dpr, shift_dpr,
    cast(sum(new_trip) AS bigint) AS calc_trips,
    sum(CASE WHEN is_load THEN d_spd ELSE 0 END) AS ld_spd, sum(CASE WHEN NOT is_load THEN d_spd ELSE 0 END) AS em_spd,
    sum(CASE WHEN is_load THEN d_hav ELSE 0 END) AS ld_hav, sum(CASE WHEN NOT is_load THEN d_hav ELSE 0 END) AS em_hav,
    sum(CASE WHEN is_load AND adiff > 0 THEN adiff ELSE 0 END) AS loaded_climb_m,
    sum(CASE WHEN NOT is_load AND adiff > 0 THEN adiff ELSE 0 END) AS empty_climb_m,
    sum(CASE WHEN is_load AND adiff < 0 THEN -adiff ELSE 0 END) AS loaded_desc_m,
    coalesce(sum(CASE WHEN is_load AND mv2 THEN speed END), 0) AS ld_sv, count(CASE WHEN is_load AND mv2 THEN speed END) AS ld_sc,
    coalesce(sum(CASE WHEN NOT is_load AND mv2 THEN speed END), 0) AS em_sv,
    count(CASE WHEN NOT is_load AND mv2 THEN speed END) AS em_sc,
    first(mine_anon ORDER BY ts_us, ping_id) FILTER (WHERE mine_anon IS NOT NULL) AS mine_anon
  FROM st2 GROUP BY vehicle, date_dpr, shift_dpr),
lmeta AS (
  SELECT vehicle, date_dpr, shift_dpr, avg(dur_sec) AS avg_loading_time_sec, count(DISTINCT l_id) AS n_unique_loaders
  FROM conf GROUP BY vehicle, date_dpr, shift_dpr),
cyc0 AS (
  SELECT vehicle, date_dpr, shift_dpr,
    cast(ts_us - lag(ts_us) OVER (PARTITION BY vehicle, date_dpr, shift_dpr ORDER BY ts_us, ping_id) AS double) / 1000000.0 AS ct
  FROM st2 WHERE new_trip = 1),
cyc AS (SELECT vehicle, date_dpr, shift_dpr, avg(ct) AS avg_cycle_sec, stddev_samp(ct) AS std_cycle_sec
        FROM cyc0 GROUP BY vehicle, date_dpr, shift_dpr),
trip1 AS (
  SELECT t.*, l.avg_loading_time_sec, l.n_unique_loaders, c.avg_cycle_sec, c.std_cycle_sec,
    round_even(ld_spd, 4) AS loaded_dist_spd_km0, round_even(em_spd, 4) AS empty_dist_spd_km0,
    round_even(ld_hav, 4) AS loaded_dist_hav_km0, round_even(em_hav, 4) AS empty_dist_hav_km0,
    round_even(CASE WHEN ld_hav + em_hav = 0 THEN 0 ELSE ld_hav / (ld_hav + em_hav) END, 4) AS loaded_ratio_hav0,
    round_even(CASE WHEN ld_spd + em_spd = 0 THEN 0 ELSE ld_spd / (ld_spd + em_spd) END, 4) AS loaded_ratio_spd0,
    round_even(CASE WHEN ld_sc = 0 THEN 0 ELSE ld_sv / ld_sc END, 4) AS avg_speed_loaded,
    round_even(CASE WHEN em_sc = 0 THEN 0 ELSE em_sv / em_sc END, 4) AS avg_speed_empty,
    round_even(CASE WHEN c.avg_cycle_sec * calc_trips / 3600 = 0 THEN 0
                    ELSE calc_trips / (c.avg_cycle_sec * calc_trips / 3600) END, 4) AS trips_per_hour
  FROM tagg t LEFT JOIN lmeta l USING (vehicle, date_dpr, shift_dpr) LEFT JOIN cyc c USING (vehicle, date_dpr, shift_dpr)),
trip2 AS (
  SELECT t.*, round_even(CASE WHEN avg_speed_empty = 0 THEN 0 ELSE avg_speed_loaded / avg_speed_empty END, 4) AS speed_ratio_l_e,
    s.total_dist_hav_km, s.total_dist_spd_km,
    coalesce(m.vehicle IS NOT NULL, false) OR NOT coalesce(f.is_analog OR f.is_geo OR f.is_m2, false) AS fb
  FROM trip1 t
  LEFT JOIN shiftf s ON s.dumper_id = t.vehicle AND s.date_dpr = t.date_dpr AND s.shift = t.shift_dpr
  LEFT JOIN fleet_cls f ON f.vehicle = t.vehicle
  LEFT JOIN (SELECT vehicle FROM fleet_cls WHERE is_m2) m ON m.vehicle = t.mine_anon),
tripf AS (
  SELECT vehicle AS dumper_id, date_dpr, shift_dpr AS shift, calc_trips,
    CASE WHEN NOT fb THEN round_even(loaded_climb_m, 4) END AS loaded_climb_m,
    CASE WHEN NOT fb THEN round_even(empty_climb_m, 4) END AS empty_climb_m,
    CASE WHEN NOT fb THEN round_even(loaded_desc_m, 4) END AS loaded_desc_m,
    CASE WHEN NOT fb THEN round_even(avg_loading_time_sec, 4) END AS avg_loading_time_sec,
    CASE WHEN NOT fb THEN n_unique_loaders END AS n_unique_loaders,
    round_even(avg_cycle_sec, 4) AS avg_cycle_sec, round_even(std_cycle_sec, 4) AS std_cycle_sec,
    CASE WHEN fb THEN total_dist_spd_km * 0.5 ELSE loaded_dist_spd_km0 END AS loaded_dist_spd_km,
    CASE WHEN fb THEN total_dist_spd_km * 0.5 ELSE empty_dist_spd_km0 END AS empty_dist_spd_km,
    CASE WHEN fb THEN total_dist_hav_km * 0.5 ELSE loaded_dist_hav_km0 END AS loaded_dist_hav_km,
    CASE WHEN fb THEN total_dist_hav_km * 0.5 ELSE empty_dist_hav_km0 END AS empty_dist_hav_km,
    CASE WHEN fb THEN 0.5 ELSE loaded_ratio_hav0 END AS loaded_ratio_hav,
    CASE WHEN fb THEN 0.5 ELSE loaded_ratio_spd0 END AS loaded_ratio_spd,
    avg_speed_loaded, avg_speed_empty, speed_ratio_l_e, trips_per_hour, fb AS is_fallback
  FROM trip2)"""

INTER = """
    round_even(mean_gradient_pct * total_dist_hav_km, 4) AS gradient_work_hav,
    round_even(mean_gradient_pct * total_dist_spd_km, 4) AS gradient_work_spd,
    round_even(coalesce(loaded_dist_hav_km * net_lift_m, 0), 4) AS loaded_lift_proxy,
    round_even(coalesce(nullif(total_dist_hav_km, 0) / nullif(calc_trips, 0), 0), 4) AS dist_per_trip,
    round_even(coalesce(loaded_dist_hav_km / nullif(calc_trips, 0), 0), 4) AS loaded_km_per_trip,
    round_even(coalesce(abs(loaded_dist_hav_km - empty_dist_hav_km), 0), 4) AS haul_imbalance,
    round_even(coalesce(gross_elev_m / nullif(calc_trips, 0), 0), 4) AS elev_per_trip,
    round_even(avg_speed_loaded / (avg_speed_empty + 1e-6), 4) AS speed_efficiency,
    round_even(avg_speed_loaded / (abs(mean_uphill_grad) + 1e-6), 4) AS loaded_kmh_per_grad,
    round_even(coalesce(trips_per_hour * coalesce(loaded_dist_hav_km, 0), 0), 4) AS cycle_efficiency,
    stopgo_intensity AS stoppage_density"""

ASSEMBLE = f"""
labels AS (
  SELECT vehicle AS dumper_id, date AS date_dpr, trim(shift) AS shift,
    round_even(CASE WHEN initlev + arefill - endlev IS NULL THEN NULL
                    ELSE greatest(initlev + arefill - endlev, 0.0) END, 4) AS fuel_consumed_L,
    CASE WHEN coalesce(arefill > 0, false) THEN 1 ELSE 0 END AS had_refill, runhrs,
    CASE WHEN isinf(lph) OR isnan(lph) THEN NULL ELSE lph END AS lph, initlev, endlev
  FROM fuel_summary),
testkeys AS (SELECT DISTINCT vehicle AS dumper_id, date AS date_dpr, trim(shift) AS shift FROM id_mapping),
shift_train AS (
  SELECT s.* FROM shiftf s WHERE NOT EXISTS (SELECT 1 FROM testkeys k WHERE k.dumper_id IS NOT DISTINCT FROM s.dumper_id
    AND k.date_dpr IS NOT DISTINCT FROM s.date_dpr AND k.shift IS NOT DISTINCT FROM s.shift)),
shift_test AS (
  SELECT s.* FROM shiftf s WHERE EXISTS (SELECT 1 FROM testkeys k WHERE k.dumper_id IS NOT DISTINCT FROM s.dumper_id
    AND k.date_dpr IS NOT DISTINCT FROM s.date_dpr AND k.shift IS NOT DISTINCT FROM s.shift)),
ftrain0 AS (
  SELECT s.*, t.* EXCLUDE (dumper_id, date_dpr, shift, is_fallback), l.* EXCLUDE (dumper_id, date_dpr, shift)
  FROM shift_train s
  LEFT JOIN tripf t ON t.dumper_id IS NOT DISTINCT FROM s.dumper_id AND t.date_dpr IS NOT DISTINCT FROM s.date_dpr
                   AND t.shift IS NOT DISTINCT FROM s.shift
  LEFT JOIN labels l ON l.dumper_id IS NOT DISTINCT FROM s.dumper_id AND l.date_dpr IS NOT DISTINCT FROM s.date_dpr
                    AND l.shift IS NOT DISTINCT FROM s.shift),
final_train AS (SELECT *, {{INTER}} FROM ftrain0),
ftest0 AS (
  SELECT s.*, t.* EXCLUDE (dumper_id, date_dpr, shift, is_fallback)
  FROM shift_test s
  LEFT JOIN tripf t ON t.dumper_id IS NOT DISTINCT FROM s.dumper_id AND t.date_dpr IS NOT DISTINCT FROM s.date_dpr
                   AND t.shift IS NOT DISTINCT FROM s.shift),
final_test AS (
  SELECT f.*, m.id FROM (SELECT *, {{INTER}} FROM ftest0) f
  LEFT JOIN (SELECT id, vehicle, date, trim(shift) AS shift FROM id_mapping) m
    ON m.vehicle IS NOT DISTINCT FROM f.dumper_id AND m.date IS NOT DISTINCT FROM f.date_dpr
   AND m.shift IS NOT DISTINCT FROM f.shift)""".replace("{INTER}", INTER)

REPORTS = """
agree AS (
  SELECT * FROM (VALUES ('prod_hrs', 'prod_hr_dpr'), ('total_dist_hav_km', 'km_dpr'), ('total_dist_spd_km', 'km_dpr'),
                        ('total_dist_hav_km', 'cumdist_range')) v(calc, ref)),
agree_long AS (
  SELECT 'prod_hrs' AS calc, 'prod_hr_dpr' AS ref, prod_hrs AS c, prod_hr_dpr AS r FROM shiftdpr
  UNION ALL SELECT 'total_dist_hav_km', 'km_dpr', total_dist_hav_km, km_dpr FROM shiftdpr
  UNION ALL SELECT 'total_dist_spd_km', 'km_dpr', total_dist_spd_km, km_dpr FROM shiftdpr
  UNION ALL SELECT 'total_dist_hav_km', 'cumdist_range', total_dist_hav_km, cumdist_range FROM shiftdpr),
agreement AS (
  SELECT calc, ref, count(*) AS n, round_even(corr(c, r), 4) AS corr, round_even(avg(abs(c - r)), 4) AS mae,
    round_even(median(c - r), 4) AS bias,
    round_even(avg(CASE WHEN coalesce(abs((c - r) / nullif(r, 0)) * 100 <= 10, false) THEN 1.0 ELSE 0.0 END) * 100, 4) AS within_10_pct,
    round_even(avg(CASE WHEN coalesce(abs((c - r) / nullif(r, 0)) * 100 <= 20, false) THEN 1.0 ELSE 0.0 END) * 100, 4) AS within_20_pct
  FROM agree_long WHERE c IS NOT NULL AND r IS NOT NULL AND (r > 0 OR c > 0) GROUP BY calc, ref),
miss0 AS (SELECT count(*) - count(COLUMNS(*)) FROM final_test),
missing AS (UNPIVOT miss0 ON COLUMNS(*) INTO NAME column_name VALUE n_missing)"""

MODEL = """
seqf AS (
  SELECT vehicle, date_dpr, shift_dpr, ts_us, ping_id,
    speed / 60.0 AS speed, (altitude - 500) / 300.0 AS altitude, cast(ignition AS double) AS ignition,
    cast(gps_ok AS double) AS gps_ok, ln(1 + dt_sec) AS log_dt,
    CASE WHEN coalesce(speed >= 2 AND ignition = 1, false) THEN 1.0 ELSE 0.0 END AS is_moving,
    adiff / 10.0 AS adiff_norm, speed * dt_sec / 3600 AS spd_x_dt,
    row_number() OVER (PARTITION BY vehicle, date_dpr, shift_dpr ORDER BY ts_us, ping_id) - 1 AS r,
    count(*) OVER (PARTITION BY vehicle, date_dpr, shift_dpr) AS n
  FROM p1),
seqk AS (SELECT range AS k FROM range(0, 600)),
seqr AS (
  SELECT f.*, f.r AS pos FROM seqf f WHERE f.n >= 5 AND f.n <= 600
  UNION ALL
  SELECT f.*, k.k AS pos FROM seqf f JOIN seqk k
    ON f.n > 600 AND ((k.k = 599 AND f.r = f.n - 1) OR (k.k < 599 AND floor(k.k * ((f.n - 1) / 599)) = f.r))),
seq_train_keys AS (
  SELECT DISTINCT vehicle, date_dpr, shift_dpr FROM seqr s
  WHERE NOT EXISTS (SELECT 1 FROM testkeys k WHERE k.dumper_id = s.vehicle AND k.date_dpr IS NOT DISTINCT FROM s.date_dpr
                    AND k.shift IS NOT DISTINCT FROM trim(s.shift_dpr))),
seq_labels AS (
  SELECT s.*, l.fuel_consumed_L AS label FROM seq_train_keys s
  LEFT JOIN labels l ON l.dumper_id IS NOT DISTINCT FROM s.vehicle AND l.date_dpr IS NOT DISTINCT FROM s.date_dpr
                    AND l.shift IS NOT DISTINCT FROM trim(s.shift_dpr)),
mtrain AS (SELECT * FROM final_train WHERE coalesce(dumper_id LIKE 'Dump%', false) AND fuel_consumed_L IS NOT NULL),
mtest AS (SELECT * FROM final_test WHERE coalesce(dumper_id LIKE 'Dump%', false)),
mnum AS (SELECT dumper_id AS _d, date_dpr AS _t, shift AS _s,
           COLUMNS(* EXCLUDE (dumper_id, date_dpr, shift, mine_id, operator_id, fuel_consumed_L, had_refill, runhrs,
                              lph, initlev, endlev))::DOUBLE FROM mtrain),
mlong AS (FROM mnum UNPIVOT INCLUDE NULLS (v FOR feature IN (COLUMNS(* EXCLUDE (_d, _t, _s))))),
mmed AS (SELECT feature, median(v) AS median FROM mlong GROUP BY feature),
mscale AS (
  SELECT l.feature,
    cast(sum(cast(coalesce(l.v, m.median, 0) AS decimal(38, 10))) AS double) / count(*) AS mean,
    stddev_pop(coalesce(l.v, m.median, 0)) AS std
  FROM mlong l JOIN mmed m USING (feature) GROUP BY l.feature),
cat_src AS (SELECT dumper_id, shift, mine_id, operator_id FROM mtrain UNION ALL
            SELECT dumper_id, shift, mine_id, operator_id FROM mtest),
cat_vals AS (
  SELECT DISTINCT 'dumper_id' AS feature, coalesce(cast(dumper_id AS varchar), 'Missing') AS value FROM cat_src
  UNION SELECT DISTINCT 'shift', coalesce(cast(shift AS varchar), 'Missing') FROM cat_src
  UNION SELECT DISTINCT 'mine_id', coalesce(cast(mine_id AS varchar), 'Missing') FROM cat_src
  UNION SELECT DISTINCT 'operator_id', coalesce(cast(operator_id AS varchar), 'Missing') FROM cat_src),
rate_lab AS (SELECT * FROM mtrain WHERE fuel_consumed_L IS NOT NULL AND engine_on_hrs > 0),
fleet_rate AS (SELECT sum(fuel_consumed_L) / sum(engine_on_hrs) AS fr FROM rate_lab),
veh_rate AS (SELECT dumper_id, sum(fuel_consumed_L) / sum(engine_on_hrs) AS vr FROM rate_lab GROUP BY dumper_id),
pred_train AS (
  SELECT t.dumper_id, t.date_dpr, t.shift, round_even(t.engine_on_hrs * f.fr, 4) AS pred_route,
    round_even(t.engine_on_hrs * coalesce(v.vr, f.fr), 4) AS pred_full
  FROM mtrain t CROSS JOIN fleet_rate f LEFT JOIN veh_rate v USING (dumper_id)),
pred_test AS (
  SELECT t.dumper_id, t.date_dpr, t.shift, round_even(t.engine_on_hrs * f.fr, 4) AS pred_route,
    round_even(t.engine_on_hrs * coalesce(v.vr, f.fr), 4) AS pred_full
  FROM mtest t CROSS JOIN fleet_rate f LEFT JOIN veh_rate v USING (dumper_id)),
delta AS (
  SELECT t.dumper_id, t.date_dpr, t.shift, t.fuel_consumed_L, p.pred_route, p.pred_full,
    round_even(p.pred_full - p.pred_route, 4) AS efficiency_delta
  FROM mtrain t JOIN pred_train p USING (dumper_id, date_dpr, shift)),
daily AS (
  SELECT a.dumper_id, a.date_dpr, round_even(a.actual, 4) AS actual_daily_L, round_even(p.pred, 4) AS pred_daily_L,
    round_even(abs(p.pred - a.actual), 4) AS abs_error,
    round_even(abs(p.pred - a.actual) / (a.actual + 1e-6) * 100, 4) AS pct_error
  FROM (SELECT dumper_id, date_dpr, sum(fuel_consumed_L) AS actual FROM labels GROUP BY dumper_id, date_dpr) a
  JOIN (SELECT dumper_id, date_dpr, sum(pred_full) AS pred FROM pred_train GROUP BY dumper_id, date_dpr) p
    USING (dumper_id, date_dpr)),
vrank AS (
  SELECT dumper_id, mean_delta,
    row_number() OVER (ORDER BY mean_delta DESC, dumper_id) AS rh,
    row_number() OVER (ORDER BY mean_delta, dumper_id DESC) AS rl
  FROM (SELECT dumper_id, avg(efficiency_delta) AS mean_delta FROM delta GROUP BY dumper_id) v)"""

EXTRA: list[str] = [TRIPS, ASSEMBLE, REPORTS, MODEL]


def q(select: str) -> str:
    return ctes() + "\n" + select


def swap(sql: str, other: dict[str, str]) -> str:
    """``sql`` with some of its pieces replaced; each must occur."""
    for old, new in other.items():
        if old not in sql:
            raise ValueError(f"not in the text: {old}")
        sql = sql.replace(old, new)
    return sql


K = "dumper_id, date_dpr, shift"

SQL: dict[str, str] = {
    "vehicle_split": q("""
SELECT CASE WHEN vehicle LIKE 'Dump%' THEN 'hauler'
            WHEN vehicle LIKE 'Exc%' OR vehicle LIKE 'WHL%' OR vehicle LIKE 'BHL%' THEN 'loader' END AS vehicle_class,
       count(*) AS n_pings, count(DISTINCT vehicle) AS n_vehicles
FROM telemetry GROUP BY 1"""),
    "gps_quality": q("SELECT vehicle, ping_id, ts_us, gps_ok, speed, altitude FROM hauler"),
    "utm_projection": q("SELECT vehicle, ping_id, round_even({e}, 2) AS utm_e, round_even({n}, 2) AS utm_n FROM telemetry"
                        .format(e=utm_sql("longitude", "latitude")[0], n=utm_sql("longitude", "latitude")[1])),
    "time_deltas": q("SELECT vehicle, ping_id, ts_us, round_even(actual_dt_sec, 6) AS actual_dt_sec, is_gap_300s, "
                     "round_even(dt_sec, 6) AS dt_sec FROM p1"),
    "gap_status": q("SELECT vehicle, ping_id, round_even(fuel_delta, 4) AS fuel_delta, gap_status FROM p1"),
    "time_budget": q(f"SELECT {K}, engine_on_hrs, engine_off_hrs, prod_hrs, idle_hrs, maint_hrs, blind_gap_hrs, "
                     "idle_ratio, n_gaps, n_blind_gaps, n_off_stat, n_ign_cycles FROM shiftf"),
    "dual_distance": q(f"SELECT {K}, total_dist_spd_km, total_dist_hav_km, dist_steep_spd_km, dist_steep_hav_km, "
                       "uphill_dist_hav_km, downhill_dist_hav_km FROM shiftf"),
    "elevation": q(f"SELECT {K}, net_lift_m, net_descent_m, gross_elev_m, alt_std FROM shiftf"),
    "gradient": q(f"SELECT {K}, mean_gradient_pct, max_gradient_pct, std_grad, mean_uphill_grad, mean_downhill_grad "
                  "FROM shiftf"),
    "heading": q(f"SELECT {K}, mean_angle_change, std_angle_change, total_turning_deg, n_sharp_turns FROM shiftf"),
    "speed_profile": q(f"SELECT {K}, mean_speed, max_speed, std_speed FROM shiftf"),
    "stop_density": q(f"SELECT {K}, n_stops, stopgo_intensity, stoppage_per_hour, dist_per_stop, elev_per_dist "
                      "FROM shiftf"),
    "operator_fill": q(f"SELECT {K}, mine_id, operator_id FROM shiftf"),
    "shift_features": q("SELECT * FROM shiftf"),
    "stop_events": q("SELECT vehicle, date_dpr, shift_dpr, start_us, end_us, round_even(dur_sec, 6) AS dur_sec, "
                     "round_even(d_utm_x, 4) AS d_utm_x, round_even(d_utm_y, 4) AS d_utm_y, round_even(d_alt, 4) AS d_alt, "
                     "mine_anon FROM stops2"),
    "loader_asof": q("SELECT vehicle, start_us, l_id, l_ts_us, round_even(d2d, 4) AS d2d, round_even(dz, 4) AS dz FROM lnear"),
    "loading_events": q("SELECT vehicle, date_dpr, shift_dpr, start_us, end_us, l_id, l_ts_us, round_even(d2d, 4) AS d2d, "
                        "round_even(dz, 4) AS dz FROM conf"),
    "body_edges": q("SELECT vehicle, rise_us, fall_us, round_even(dur_sec, 6) AS dur_sec FROM analog_ev"),
    "geofence_dumps": q("SELECT vehicle, date_dpr, shift_dpr, start_us, end_us, zone_id FROM geo_ev"),
    "event_marks": q("SELECT vehicle, ping_id, ev_flag FROM st0"),
    "trip_state": q("SELECT vehicle, ping_id, state, new_trip FROM st2"),
    "trip_features": q("SELECT * EXCLUDE (is_fallback) FROM tripf"),
    "fallback_split": q(f"SELECT {K}, is_fallback, loaded_dist_hav_km, empty_dist_hav_km, loaded_ratio_hav, "
                        "loaded_ratio_spd FROM tripf"),
    "fuel_labels": q("SELECT * FROM labels"),
    "final_train": q("SELECT * FROM final_train"),
    "final_test": q("SELECT * FROM final_test"),
    "id_mapping": q(f"SELECT {K}, id FROM final_test"),
    "missing_report": q("SELECT column_name, n_missing FROM missing WHERE n_missing > 0"),
    "agreement_report": q("SELECT * FROM agreement"),
    "sequences": q("SELECT vehicle, date_dpr, shift_dpr AS shift, pos, least(n, 600) AS seq_len, "
                   + ", ".join(f"round_even({c}, 6) AS {c}" for c in ("speed", "altitude", "ignition", "gps_ok", "log_dt",
                                                                       "is_moving", "adiff_norm", "spd_x_dt"))
                   + " FROM seqr"),
    "label_stats": q("SELECT count(*) AS n_labelled, round_even(avg(label), 4) AS fuel_mean, "
                     "round_even(stddev_pop(label), 4) AS fuel_std FROM seq_labels WHERE label > 0"),
    "median_impute": q("SELECT feature, round_even(median, 6) AS median FROM mmed"),
    "standardise": q("SELECT feature, round_even(mean, 6) AS mean, "
                     "round_even(CASE WHEN std = 0 THEN 1.0 ELSE std END, 6) AS std FROM mscale"),
    "label_encode": q("SELECT feature, value, cast(dense_rank() OVER (PARTITION BY feature ORDER BY value) - 1 AS integer) "
                      "AS code FROM cat_vals"),
    "cv_folds": q("SELECT cast(f AS integer) AS fold, n // 5 + CASE WHEN f < n % 5 THEN 1 ELSE 0 END AS n_rows "
                  "FROM range(5) r(f), (SELECT count(*) AS n FROM mtrain) WHERE f < n"),
    "final_embedding": q("""
SELECT f.*, coalesce(round_even(e.h0, 4), 0.0) AS seq_h00, coalesce(e.h1, 0.0) AS seq_h01 FROM (
  SELECT 'train' AS split, dumper_id, date_dpr, shift FROM final_train
  UNION ALL SELECT 'test', dumper_id, date_dpr, shift FROM final_test) f
LEFT JOIN (SELECT vehicle, date_dpr, shift_dpr, avg(speed) AS h0, cast(least(max(n), 600) AS double) AS h1 FROM seqr GROUP BY ALL) e
  ON e.vehicle IS NOT DISTINCT FROM f.dumper_id AND e.date_dpr IS NOT DISTINCT FROM f.date_dpr AND e.shift_dpr IS NOT DISTINCT FROM f.shift"""),
    "efficiency_delta": q("SELECT * FROM delta"),
    "daily_consistency": q("SELECT * FROM daily"),
    "daily_summary": q("SELECT count(*) AS n_days, round_even(corr(pred_daily_L, actual_daily_L), 4) AS corr, "
                       "round_even(avg(abs_error), 4) AS mae, round_even(avg(pct_error), 4) AS mape FROM daily"),
    "vehicle_ranking": q("SELECT dumper_id, round_even(mean_delta, 4) AS mean_delta, "
                         "CASE WHEN rh <= 15 THEN rh END AS rank_high, CASE WHEN rl <= 15 THEN rl END AS rank_low, "
                         "CASE WHEN mean_delta > 0 THEN 'above_route' ELSE 'at_or_below_route' END AS sign "
                         "FROM vrank WHERE rh <= 15 OR rl <= 15"),
    "daily_series": q("""
SELECT date_dpr, actual, predicted FROM (
  SELECT date_dpr, round_even(sum(actual_daily_L), 4) AS actual, round_even(sum(pred_daily_L), 4) AS predicted,
    row_number() OVER (ORDER BY date_dpr) AS rn, count(*) OVER () AS n
  FROM daily GROUP BY date_dpr) t
WHERE (rn - 1) % (CASE WHEN n > 30 THEN greatest(n // 30, 1) ELSE 1 END) = 0"""),
    "submission": q("""
SELECT m.id, round_even(coalesce(p.pred_full, (SELECT avg(fuel_consumed_L) FROM mtrain)), 4) AS Predicted
FROM id_mapping m LEFT JOIN pred_test p ON p.dumper_id = m.vehicle AND p.date_dpr = m.date AND p.shift = trim(m.shift)
ORDER BY m.id"""),
    "coverage": q("""
SELECT 'train_shifts' AS metric, cast(count(*) AS double) AS value FROM final_train
UNION ALL SELECT 'fuel_rows', cast(count(fuel_consumed_L) AS double) FROM final_train
UNION ALL SELECT 'test_shifts', cast(count(*) AS double) FROM final_test
UNION ALL SELECT 'id_mapped', cast(count(id) AS double) FROM final_test
UNION ALL SELECT 'dump_pings', cast(count(*) AS double) FROM hauler
UNION ALL SELECT 'gps_ok_pct', round_even(avg(gps_ok) * 100, 4) FROM hauler
UNION ALL SELECT 'loader_pings', cast(count(*) AS double) FROM loader"""),
}
