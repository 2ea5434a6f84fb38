"""Ping cleaning: class split (B1), GPS quality (B2), clipping (B3),
UTM projection (B4).  All row-wise, so they stay inside the scan stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import utm_expr
from ..functions.nulls import clip, flag
from ..params import DUMP_PREFIX, LOADER_PREFIXES, Params


def is_hauler(vehicle: str = "vehicle") -> Column:
    return flag(F.col(vehicle).startswith(DUMP_PREFIX))


def is_loader(vehicle: str = "vehicle") -> Column:
    c = F.lit(False)
    for p in LOADER_PREFIXES:
        c = c | flag(F.col(vehicle).startswith(p))
    return c


def vehicle_class(vehicle: str = "vehicle") -> Column:
    """B1 router: 'hauler', 'loader' or NULL (dropped)."""
    return F.when(is_hauler(vehicle), "hauler").when(is_loader(vehicle), "loader")


def gps_ok(p: Params) -> Column:
    """B2: satellites >= 5, coalesce(hdop, pdop) <= 4, pdop <= 6; any NULL -> 0."""
    eff = F.coalesce(F.col("gnss_hdop"), F.col("gnss_pdop"))
    ok = (F.col("satellites") >= p.min_satellites) & (eff <= p.hdop_max) & (F.col("gnss_pdop") <= p.pdop_max)
    return flag(ok).cast("int")


def with_utm(df: DataFrame, project: str = "auto") -> DataFrame:
    """Project lon/lat to UTM 45N unless the input already carries
    ``utm_x``/``utm_y`` (``project='auto'``)."""
    if project == "never" or (project == "auto" and {"utm_x", "utm_y"} <= set(df.columns)):
        return df
    x, y = utm_expr(F.col("longitude"), F.col("latitude"))
    return df.withColumn("utm_x", x).withColumn("utm_y", y)


def clean_haulers(tel: DataFrame, p: Params, project: str = "auto") -> DataFrame:
    """Hauler pings with ``gps_ok``, clipped speed/altitude and UTM."""
    d = tel.where(is_hauler())
    d = d.withColumn("gps_ok", gps_ok(p))
    d = d.withColumn("speed", clip("speed", 0.0, p.speed_max))
    d = d.withColumn("altitude", clip("altitude", p.alt_min, p.alt_max))
    return with_utm(d, project)


def clean_loaders(tel: DataFrame, p: Params, project: str = "auto") -> DataFrame:
    """Loader pings: projected only (altitude is not clipped)."""
    d = tel.where(is_loader())
    d = with_utm(d, project)
    return d.select(F.col("vehicle").alias("l_id"), "ts_us", "ping_id",
                    F.col("utm_x").alias("l_x"), F.col("utm_y").alias("l_y"), F.col("altitude").alias("l_alt"))
