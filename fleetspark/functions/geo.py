"""Geometry as native column expressions (whole-stage codegen, no UDF).

* ``utm_expr``: WGS84 lon/lat -> UTM easting/northing with the Krüger
  n-series of the transverse Mercator projection (4th order; well below a
  millimetre inside a zone).
* ``point_in_polygons``: even-odd ray casting over every ring, boundary
  included (``intersects`` of a point with a polygon), holes and
  MultiPolygons supported.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84 ellipsoid and the UTM scale/offsets.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_ZONE_45N_LON0 = 87.0


def _series(n: float):
    a_hat = WGS84_A / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64)
    alpha = (
        n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16 + 41 * n ** 4 / 180,
        13 * n ** 2 / 48 - 3 * n ** 3 / 5 + 557 * n ** 4 / 1440,
        61 * n ** 3 / 240 - 103 * n ** 4 / 140,
        49561 * n ** 4 / 161280,
    )
    return a_hat, alpha


def utm_constants(lon0: float = UTM_ZONE_45N_LON0):
    n = WGS84_F / (2 - WGS84_F)
    a_hat, alpha = _series(n)
    e = 2 * math.sqrt(n) / (1 + n)
    return dict(lon0=lon0, k0a=UTM_K0 * a_hat, alpha=alpha, e=e)


def utm_expr(lon: Column, lat: Column, lon0: float = UTM_ZONE_45N_LON0, false_northing: float = 0.0):
    """Returns (easting, northing) columns."""
    k = utm_constants(lon0)
    phi = F.radians(lat)
    dlam = F.radians(lon - F.lit(lon0))
    sphi = F.sin(phi)
    t = F.sinh(F.atanh(sphi) - F.lit(k["e"]) * F.atanh(F.lit(k["e"]) * sphi))
    xi = F.atan2(t, F.cos(dlam))
    eta = F.atanh(F.sin(dlam) / F.sqrt(F.lit(1.0) + t * t))
    east = eta
    north = xi
    for j, a in enumerate(k["alpha"], start=1):
        east = east + F.lit(a) * F.cos(F.lit(2.0 * j) * xi) * F.sinh(F.lit(2.0 * j) * eta)
        north = north + F.lit(a) * F.sin(F.lit(2.0 * j) * xi) * F.cosh(F.lit(2.0 * j) * eta)
    return (F.lit(UTM_FALSE_EASTING) + F.lit(k["k0a"]) * east,
            F.lit(false_northing) + F.lit(k["k0a"]) * north)


def utm_sql(lon: str, lat: str, lon0: float = UTM_ZONE_45N_LON0) -> tuple[str, str]:
    """The same projection as SQL text (used by the DuckDB oracle)."""
    k = utm_constants(lon0)
    e = repr(k["e"])
    phi = f"radians({lat})"
    dlam = f"radians({lon} - {lon0!r})"
    t = f"sinh(atanh(sin({phi})) - {e} * atanh({e} * sin({phi})))"
    xi = f"atan2({t}, cos({dlam}))"
    eta = f"atanh(sin({dlam}) / sqrt(1.0 + ({t}) * ({t})))"
    east, north = eta, xi
    for j, a in enumerate(k["alpha"], start=1):
        east += f" + {a!r} * cos({2.0 * j!r} * {xi}) * sinh({2.0 * j!r} * {eta})"
        north += f" + {a!r} * sin({2.0 * j!r} * {xi}) * cosh({2.0 * j!r} * {eta})"
    return (f"({UTM_FALSE_EASTING!r} + {k['k0a']!r} * ({east}))", f"({k['k0a']!r} * ({north}))")


def point_in_polygons(px: str, py: str, polygons: str) -> Column:
    """True when point (px, py) lies in or on any polygon of ``polygons``
    (``array<array<array<struct<x,y>>>>``: polygon, ring, closed point list)."""
    edges = "sequence(0, size(r) - 2)"
    a, b = "r[i]", "r[i + 1]"
    cross = f"(({b}.x - {a}.x) * ({py} - {a}.y) - ({b}.y - {a}.y) * ({px} - {a}.x))"
    on_edge = (f"{cross} = 0 AND {px} BETWEEN least({a}.x, {b}.x) AND greatest({a}.x, {b}.x) "
               f"AND {py} BETWEEN least({a}.y, {b}.y) AND greatest({a}.y, {b}.y)")
    # ray to +x crosses edge a-b: the edge straddles py and the point lies left of it
    crosses = (f"(({a}.y > {py}) <> ({b}.y > {py})) AND "
               f"(({px} - {a}.x) * ({b}.y - {a}.y) - ({b}.x - {a}.x) * ({py} - {a}.y)) * ({b}.y - {a}.y) < 0")
    expr = (
        f"exists({polygons}, p -> "
        f"exists(p, r -> exists({edges}, i -> {on_edge})) OR "
        f"aggregate(p, 0, (acc, r) -> acc + size(filter({edges}, i -> {crosses}))) % 2 = 1)"
    )
    return F.expr(expr)
