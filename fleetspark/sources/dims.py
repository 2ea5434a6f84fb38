"""Dimension and label sources: fleet CSV, fuel summaries, id mapping, zones.

All are small relative to the ping table; they are read with Spark readers so
that the same code runs against a shared file system on a cluster.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import utm_expr
from ..functions.nulls import nan_to_null

# --- file helpers -----------------------------------------------------------


def existing_paths(spark: SparkSession, paths) -> list[str]:
    """Keep only paths that exist (A3: a missing monthly file is tolerated)."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    keep = []
    for p in paths:
        jp = jvm.org.apache.hadoop.fs.Path(p)
        if jp.getFileSystem(hconf).exists(jp):
            keep.append(p)
    return keep


def normalise_header(df: DataFrame) -> DataFrame:
    """``columns.str.strip().str.lower()``."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def read_headed(spark: SparkSession, path: str) -> DataFrame:
    """One CSV path whose first line with text names the columns.  Spark's own
    look for the header lists every file below the path on its own, however
    many; here it sees that line only."""
    first = spark.read.text(path).where(F.trim("value") != "").select("value").take(1)
    csv = spark.read.option("header", True)
    return csv.schema(csv.csv(spark.sparkContext.parallelize([first[0]["value"]], 1)).schema).csv(path) if first else csv.csv(path)


def read_csv(spark: SparkSession, paths) -> DataFrame:
    if isinstance(paths, str):
        paths = [paths]
    # one read per file: a header names the columns of its own file only
    files = [normalise_header(read_headed(spark, p)) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), files)


# --- fleet ------------------------------------------------------------------


def fleet_classes(fleet: DataFrame) -> DataFrame:
    """One row per vehicle with the three class flags used by trip
    detection (analog body sensor, geofence, mine002)."""
    f = fleet.select(
        F.trim(F.col("vehicle").cast("string")).alias("vehicle"),
        F.col("fleet").cast("string").alias("fleet"),
        F.trim(F.col("mine_anon").cast("string")).alias("mine_anon"),
        F.col("dump_switch").cast("double").alias("dump_switch"),
    )
    return f.groupBy("vehicle").agg(
        F.max(F.coalesce(F.col("dump_switch") == 1, F.lit(False))).alias("is_analog"),
        F.max(F.coalesce(F.lower("fleet").contains("dump") & (F.col("mine_anon") == "mine001")
                         & F.col("dump_switch").isNull(), F.lit(False))).alias("is_geo"),
        F.max(F.coalesce(F.col("mine_anon") == "mine002", F.lit(False))).alias("is_m2"),
    )


def read_fleet(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path)


# --- fuel summaries ---------------------------------------------------------


def read_fuel_summary(spark: SparkSession, paths) -> DataFrame:
    """A3: every monthly summary that exists, header normalised, typed."""
    paths = existing_paths(spark, [paths] if isinstance(paths, str) else paths)
    if not paths:
        raise FileNotFoundError("no fuel summary file found")
    df = read_csv(spark, paths)
    return conform_fuel_summary(df)


def conform_fuel_summary(df: DataFrame) -> DataFrame:
    return df.select(
        F.trim(F.col("vehicle").cast("string")).alias("vehicle"),
        F.to_date(F.col("date").cast("string")).alias("date"),
        F.col("shift").cast("string").alias("shift"),
        *[nan_to_null(F.col(c).cast("double")).alias(c) for c in ("initlev", "arefill", "endlev", "runhrs")],
        F.col("lph").cast("double").alias("lph"),
    )


# --- id mapping ---------------------------------------------------------------


def read_id_mapping(spark: SparkSession, path: str | None) -> DataFrame:
    """A5: the submission ids; a mapping that is not there is an empty one, so
    test shifts keep a NULL id."""
    if not path or not existing_paths(spark, [path]):
        return spark.createDataFrame([], "id bigint, vehicle string, date date, shift string")
    df = read_csv(spark, path)
    return df.select(
        F.col("id").cast("bigint").alias("id"),
        F.trim(F.col("vehicle").cast("string")).alias("vehicle"),
        F.to_date(F.col("date").cast("string")).alias("date"),
        F.col("shift").cast("string").alias("shift"),
    )


# --- zones (GeoJSON) ----------------------------------------------------------

_FEATURES = "struct<crs: struct<properties: struct<name: string>>, features: array<struct<properties: map<string,string>, " \
            "geometry: struct<type: string, coordinates: string>>>>"

#: Zone coordinates are lon/lat degrees, or metres of the zone that stops are projected to.
LON_LAT = ("EPSG:4326", "urn:ogc:def:crs:EPSG::4326", "OGC:CRS84", "urn:ogc:def:crs:OGC:1.3:CRS84", "CRS84", "WGS84")
UTM_45N = ("EPSG:32645", "urn:ogc:def:crs:EPSG::32645")


def zones_from_geojson_text(text_df: DataFrame, text_col: str = "value", zones_crs: str = "file") -> DataFrame:
    """GeoJSON FeatureCollection text -> one row per zone with
    ``polygons array<array<array<struct<x,y>>>>`` (polygon, ring, point) in
    UTM 45N metres, Polygon and MultiPolygon both normalised, and
    ``median_altitude``.

    ``zones_crs`` declares the coordinates; ``file`` takes the file's own
    ``crs`` member, and lon/lat where it has none (RFC 7946).  Lon/lat rings are
    projected like the pings.  A reference system that is not known and
    coordinates that cannot be degrees raise an error instead of giving zones
    that no stop can meet."""
    if zones_crs != "file" and zones_crs not in LON_LAT + UTM_45N:
        raise ValueError(f"unknown zones_crs {zones_crs!r}: {', '.join(LON_LAT + UTM_45N)} or 'file'")
    fc = text_df.select(F.from_json(F.col(text_col), _FEATURES).alias("fc"))
    crs = F.coalesce("fc.crs.properties.name", F.lit(LON_LAT[0])) if zones_crs == "file" else F.lit(zones_crs)
    feats = fc.select(crs.alias("crs"), F.posexplode("fc.features").alias("zone_id", "f"))
    poly = F.from_json(F.col("f.geometry.coordinates"), "array<array<array<double>>>")
    multi = F.from_json(F.col("f.geometry.coordinates"), "array<array<array<array<double>>>>")
    as_polys = F.when(F.col("f.geometry.type") == "Polygon", F.array(poly)).otherwise(multi)

    def place(pt):
        east, north = utm_expr(pt[0], pt[1])
        wrong = F.concat(F.lit("zone coordinates are no degrees, declare zones_crs: "), pt[0].cast("string"), F.lit(", "), pt[1].cast("string"))
        unknown = F.concat(F.lit("unknown crs of the zone file: "), F.col("crs"))
        degrees = (F.abs(pt[0]) <= 180) & (F.abs(pt[1]) <= 90)
        as_is = F.struct(pt[0].alias("x"), pt[1].alias("y"))
        projected = F.when(degrees, F.struct(east.alias("x"), north.alias("y"))).otherwise(F.raise_error(wrong).cast("struct<x:double,y:double>"))
        return F.when(F.col("crs").isin(*UTM_45N), as_is).when(F.col("crs").isin(*LON_LAT), projected).otherwise(
            F.raise_error(unknown).cast("struct<x:double,y:double>"))

    to_xy = lambda polys: F.transform(polys, lambda p: F.transform(p, lambda r: F.transform(r, place)))
    return feats.select(
        F.col("zone_id").cast("int").alias("zone_id"),
        to_xy(as_polys).alias("polygons"),
        F.col("f.properties").getItem("median_altitude").cast("double").alias("median_altitude"),
    )


def read_zones(spark: SparkSession, path: str, zones_crs: str = "file") -> DataFrame:
    text = spark.read.option("wholetext", True).text(path)
    return zones_from_geojson_text(text, zones_crs=zones_crs)
