"""Test inputs derived from the driver's ``events`` table (FIXTURES.md §2).

The reference ships no data, so every input of the pipeline is derived by
Spark from ``events``: work grows with that table.  The DuckDB text of the
same views lives in ``plans/oracle.py``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranking import global_row_number
from .dims import conform_fuel_summary, zones_from_geojson_text
from .telemetry import conform

# Fixed values of the fixture definition (FIXTURES.md §2).
EPOCH_2024_US = 1_704_067_200_000_000
EPOCH_2026_US = 1_767_225_600_000_000
DAY2_US = 1_767_232_800_000_000
FIXTURE_ANALOG_CUT_US = 1_767_229_200_000_000
ZONES_GEOJSON = (
    '{"type": "FeatureCollection", "features": ['
    '{"type": "Feature", "properties": {"name": "Z1", "median_altitude": 650}, "geometry": {"type": "Polygon", '
    '"coordinates": [[[500050, 2600040], [500150, 2600040], [500150, 2600120], [500050, 2600120], [500050, 2600040]]]}}, '
    '{"type": "Feature", "properties": {"name": "Z2", "median_altitude": 640}, "geometry": {"type": "Polygon", '
    '"coordinates": [[[500000, 2600000], [500200, 2600000], [500000, 2600170], [500000, 2600000]]]}}]}'
)

#: The same zones in degrees, each grown by two parts in a million about its middle (0.2 mm), so that stops on an edge stay on the zone.
ZONES_LON_LAT = (
    '{"type": "FeatureCollection", "features": ['
    '{"type": "Feature", "properties": {"name": "Z1", "median_altitude": 650}, "geometry": {"type": "Polygon", "coordinates": '
    '[[[87.00048975315, 23.51055602801], [87.00146926337, 23.51055602185], [87.00146927138, 23.51127865208], '
    '[87.00048975582, 23.51127865824], [87.00048975315, 23.51055602801]]]}}, '
    '{"type": "Feature", "properties": {"name": "Z2", "median_altitude": 640}, "geometry": {"type": "Polygon", "coordinates": '
    '[[[86.99999999869, 23.51019471407], [87.00195901378, 23.51019470175], [86.99999999869, 23.51173030329], '
    '[86.99999999869, 23.51019471407]]]}}]}'
)


def telemetry_from_events(events: DataFrame) -> DataFrame:
    b = events.selectExpr(
        "event_id", "user_id", "event_type",
        "cast(round(value * 100) as bigint) as v",
        # epoch microseconds of the naive timestamp read as UTC, independent of
        # the session time zone
        f"{EPOCH_2026_US} + (timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts) - {EPOCH_2024_US})"
        " div 200 as ts_us",
    )
    raw = b.selectExpr(
        "event_id as ping_id",
        "concat(case when user_id % 5 = 4 then 'Exc' else 'Dump' end, cast(user_id as string)) as vehicle",
        "case when user_id % 2 = 0 then 'mine001' else 'mine002' end as mine_anon",
        "timestamp_micros(ts_us) as ts",
        f"case when ts_us < {DAY2_US} then date'2026-01-01' else date'2026-01-02' end as date_dpr",
        f"case when ((ts_us - {EPOCH_2026_US}) div 3600000000) % 2 = 0 then 'A' else 'B' end as shift_dpr",
        "case when v % 17 = 0 then null when v % 5 < 2 then cast(0 as double) "
        "else cast(v % 7000 as double) / 100 end as speed",
        "case when event_type = 'error' then 0 else 1 end as ignition",
        "cast(480 + v % 340 as double) as altitude",
        "cast(v % 360 as double) as angle",
        "85 + cast(v % 1000 as double) / 10000 as longitude",
        "cast(235000 + v % 777 as double) / 10000 as latitude",
        "cast(500000 + v % 211 as double) as utm_x",
        "cast(2600000 + v % 173 as double) as utm_y",
        "3 + v % 12 as satellites",
        "case when v % 19 = 0 then null else cast(v % 45 as double) / 10 end as gnss_hdop",
        "case when v % 23 = 0 then null else cast(v % 65 as double) / 10 end as gnss_pdop",
        "case when v % 29 = 0 then null else cast(100 + v % 11 as double) end as fuel_volume",
        "case when v % 13 = 0 then null else cast(v % 900 as double) end as disthav",
        "cast(v as double) / 100 as cumdist",
        "case when v % 37 = 0 then null else cast(v % 50 as double) end as total_trip",
        "case when v % 31 = 0 then null else v % 6 end as operator_id",
        "case when v % 3 = 0 then cast(1 as double) else cast(0 as double) end as analog_input_1",
        "cast(user_id % 7 as double) / 2 as prod_hr_dpr",
        "cast(user_id % 40 as double) as km_dpr",
    )
    return conform(raw)


def fleet_from_telemetry(tel: DataFrame) -> DataFrame:
    num = "cast(substr(vehicle, case when vehicle like 'Dump%' then 5 else 4 end) as int)"
    return (tel.where(f"{num} % 7 <> 6")
            .selectExpr("vehicle",
                        "case when vehicle like 'Dump%' then 'Dump Truck' else 'Excavator' end as fleet",
                        "mine_anon",
                        f"case when {num} % 3 = 0 then 1 end as dump_switch")
            .distinct())


def fuel_summary_from_telemetry(tel: DataFrame) -> DataFrame:
    s = (tel.where(F.col("vehicle").startswith("Dump"))
         .groupBy("vehicle", "date_dpr", "shift_dpr").agg(F.count(F.lit(1)).alias("n"))
         .where("n % 11 <> 0"))
    raw = s.selectExpr(
        "vehicle", "date_dpr as date", "shift_dpr as shift",
        "cast(300 + n as double) as initlev",
        "case when n % 3 = 0 then cast(200 as double) else cast(0 as double) end as arefill",
        "cast(280 + (n % 7) * 10 as double) as endlev",
        "cast(n as double) / 10 as runhrs",
        "case when n % 5 = 0 then cast('Infinity' as double) else cast(n as double) / 4 end as lph",
    )
    return conform_fuel_summary(raw)


def id_mapping_from_telemetry(tel: DataFrame) -> DataFrame:
    keys = (tel.where(F.col("vehicle").startswith("Dump") & (F.col("date_dpr") == F.lit("2026-01-02").cast("date"))
                      & (F.col("shift_dpr") == "B"))
            .select("vehicle", F.col("date_dpr").alias("date"), F.col("shift_dpr").alias("shift")).distinct())
    # row_number() over (order by vehicle): numbered by a distributed sort,
    # not a single-partition window
    ranked = global_row_number(keys, ["vehicle"], name="id")
    return ranked.select("id", "vehicle", "date", "shift")


def zones_literal(spark: SparkSession) -> DataFrame:
    return zones_from_geojson_text(spark.createDataFrame([(ZONES_GEOJSON,)], "value string"), zones_crs="EPSG:32645")


@dataclass
class Inputs:
    telemetry: DataFrame
    fleet: DataFrame
    fuel_summary: DataFrame
    id_mapping: DataFrame
    zones: DataFrame


def load_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    tel = telemetry_from_events(events)
    return Inputs(
        telemetry=tel,
        fleet=fleet_from_telemetry(tel),
        fuel_summary=fuel_summary_from_telemetry(tel),
        id_mapping=id_mapping_from_telemetry(tel),
        zones=zones_literal(spark),
    )
