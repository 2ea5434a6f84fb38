"""Dump detection: body-up edge pairing (C8) and the zone geofence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import point_in_polygons
from ..params import Params


def body_up_events(pings: DataFrame, fleet_cls: DataFrame, p: Params) -> DataFrame:
    """Each rise of the body sensor paired with the next fall of the same
    vehicle (edges alternate, so the next edge after a rise is its fall); the
    event is the fall time when 10 s <= duration <= 600 s.  Only vehicles of
    the analog class.  The window runs on the edge rows alone and inside a time
    bucket; the last edge of a bucket takes the first one of the next bucket
    that has any."""
    e = pings.where(F.col("bu_rise") | F.col("bu_fall")).select("vehicle", "_bkt", "ts_us", "ping_id", "bu_rise")
    first = e.groupBy(F.col("vehicle").alias("_v"), F.col("_bkt").alias("_b")).agg(F.min("ts_us").alias("_first"))
    after = first.withColumn("_after", F.lead("_first").over(Window.partitionBy("_v").orderBy("_b"))).drop("_first")
    w = Window.partitionBy("vehicle", "_bkt").orderBy("ts_us", "ping_id")
    e = e.withColumn("_next", F.lead("ts_us").over(w))
    e = e.join(after, (e["vehicle"] == after["_v"]) & (e["_bkt"] == after["_b"]), "left")
    e = e.withColumn("fall_us", F.coalesce("_next", "_after"))
    e = e.where(F.col("bu_rise") & F.col("fall_us").isNotNull())
    e = e.select("vehicle", F.col("ts_us").alias("rise_us"), "fall_us",
                 ((F.col("fall_us") - F.col("ts_us")) / F.lit(1_000_000.0)).alias("dur_sec"))
    lo, hi = p.body_up_dur_s
    e = e.where(F.col("dur_sec").between(lo, hi))
    analog = fleet_cls.where("is_analog").select("vehicle")
    return e.join(analog, "vehicle", "left_semi")


def zone_cells(zones: DataFrame, cell_m: float) -> DataFrame:
    """Zones exploded to the grid cells their bounding box covers, so the
    point test is an equi-join on the cell rather than a nested loop."""
    pts = F.flatten(F.flatten(F.col("polygons")))
    xs = F.transform(pts, lambda q: q["x"])
    ys = F.transform(pts, lambda q: q["y"])
    cell = F.lit(float(cell_m))
    z = zones.select("zone_id", "polygons", "median_altitude",
                     F.floor(F.array_min(xs) / cell).alias("x0"), F.floor(F.array_max(xs) / cell).alias("x1"),
                     F.floor(F.array_min(ys) / cell).alias("y0"), F.floor(F.array_max(ys) / cell).alias("y1"))
    z = z.withColumn("cx", F.explode(F.sequence("x0", "x1"))).withColumn("cy", F.explode(F.sequence("y0", "y1")))
    return z.drop("x0", "x1", "y0", "y1")


def geofence_events(dump_cands: DataFrame, fleet_cls: DataFrame, zones: DataFrame, p: Params,
                    filter_altitude: bool = True) -> DataFrame:
    """dump candidates of geofence vehicles (geo class, or mine001 and not
    analog) whose median point intersects a zone (boundary included) and,
    when zones carry ``median_altitude``, whose altitude is within 20 m."""
    c = dump_cands.join(fleet_cls.select("vehicle", "is_geo", "is_analog"), "vehicle", "left")
    c = c.where(F.coalesce(F.col("is_geo"), F.lit(False))
                | ((F.col("mine_anon") == "mine001") & ~F.coalesce(F.col("is_analog"), F.lit(False))))
    cell = F.lit(float(p.zone_cell_m))
    c = c.withColumn("cx", F.floor(F.col("d_utm_x") / cell)).withColumn("cy", F.floor(F.col("d_utm_y") / cell))
    j = c.join(zone_cells(zones, p.zone_cell_m), ["cx", "cy"])
    j = j.where(point_in_polygons("d_utm_x", "d_utm_y", "polygons"))
    if filter_altitude:
        j = j.where(F.abs(F.col("d_alt") - F.col("median_altitude")) <= p.zone_alt_tol_m)
    return j.drop("cx", "cy", "polygons", "is_geo", "is_analog")


def zones_have_altitude(zones: DataFrame) -> bool:
    """The reference filters on altitude only when the zone file has the
    column; decided once per plan on the (small) zone table."""
    return zones.where(F.col("median_altitude").isNotNull()).limit(1).count() > 0
