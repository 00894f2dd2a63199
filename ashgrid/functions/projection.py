"""Map projections as column expressions (RAS-8): coordinates of a raster's own
reference system to longitude and latitude and back.

Supported EPSG codes: none or 4326 (longitude, latitude), 3857 (spherical
Mercator), 32601..32660 and 32701..32760 (UTM north and south on WGS 84, by
Krueger's series to the fourth order) and 3005 (Albers equal area on GRS 80, one
cone).  The code is a column, so one expression serves tiles of many systems;
everything stays in generated JVM code.  An unsupported code gives null."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: ellipsoids (semi-major axis, flattening) and the systems' parameters.
WGS84 = (6378137.0, 1 / 298.257223563)
GRS80 = (6378137.0, 1 / 298.257222101)
UTM_SCALE, UTM_EAST, UTM_SOUTH = 0.9996, 500_000.0, 10_000_000.0
ALBERS_3005 = {"lat1": 50.0, "lat2": 58.5, "lat0": 45.0, "lon0": -126.0, "east": 1_000_000.0, "north": 0.0}

# Krueger's series in the third flattening
N3 = WGS84[1] / (2 - WGS84[1])
RECTIFYING = WGS84[0] / (1 + N3) * (1 + N3**2 / 4 + N3**4 / 64)
ALPHA = (N3 / 2 - 2 * N3**2 / 3 + 5 * N3**3 / 16 + 41 * N3**4 / 180,
         13 * N3**2 / 48 - 3 * N3**3 / 5 + 557 * N3**4 / 1440,
         61 * N3**3 / 240 - 103 * N3**4 / 140,
         49561 * N3**4 / 161280)
BETA = (N3 / 2 - 2 * N3**2 / 3 + 37 * N3**3 / 96 - N3**4 / 360,
        N3**2 / 48 + N3**3 / 15 - 437 * N3**4 / 1440,
        17 * N3**3 / 480 - 37 * N3**4 / 840,
        4397 * N3**4 / 161280)
DELTA = (2 * N3 - 2 * N3**2 / 3 - 2 * N3**3 + 116 * N3**4 / 45,
         7 * N3**2 / 3 - 8 * N3**3 / 5 - 227 * N3**4 / 45,
         56 * N3**3 / 15 - 136 * N3**4 / 35,
         4279 * N3**4 / 630)


def _code(epsg: Column) -> Column:
    return F.coalesce(epsg.cast("int"), F.lit(4326))


def is_utm(epsg: Column) -> Column:
    e = _code(epsg)
    return e.between(32601, 32660) | e.between(32701, 32760)


def supported(epsg: Column) -> Column:
    """RAS-8: true where both directions below are defined."""
    return _code(epsg).isin(4326, 3857, 3005) | is_utm(epsg)


def is_lonlat(epsg: Column) -> Column:
    return _code(epsg) == 4326


def _meridian(epsg: Column) -> Column:
    return F.radians((_code(epsg) % 100) * 6.0 - 183.0)


def _false_north(epsg: Column) -> Column:
    return F.when(_code(epsg) > 32700, UTM_SOUTH).otherwise(0.0)


def _utm_inverse(epsg: Column, x: Column, y: Column) -> tuple[Column, Column]:
    xi = (y - _false_north(epsg)) / (UTM_SCALE * RECTIFYING)
    eta = (x - UTM_EAST) / (UTM_SCALE * RECTIFYING)
    xi1, eta1 = xi, eta
    for j, b in enumerate(BETA, 1):
        xi1 = xi1 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta1 = eta1 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    lat = chi
    for j, d in enumerate(DELTA, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return F.degrees(_meridian(epsg) + F.atan2(F.sinh(eta1), F.cos(xi1))), F.degrees(lat)


def _utm_forward(epsg: Column, lon: Column, lat: Column) -> tuple[Column, Column]:
    k = 2 * math.sqrt(N3) / (1 + N3)  # the first eccentricity
    s, dl = F.sin(F.radians(lat)), F.radians(lon) - _meridian(epsg)
    t = F.sinh(F.atanh(s) - k * F.atanh(k * s))
    xi1, eta1 = F.atan2(t, F.cos(dl)), F.atanh(F.sin(dl) / F.sqrt(1 + t * t))
    xi, eta = xi1, eta1
    for j, a in enumerate(ALPHA, 1):
        xi = xi + a * F.sin(2 * j * xi1) * F.cosh(2 * j * eta1)
        eta = eta + a * F.cos(2 * j * xi1) * F.sinh(2 * j * eta1)
    return UTM_EAST + UTM_SCALE * RECTIFYING * eta, _false_north(epsg) + UTM_SCALE * RECTIFYING * xi


def _albers_constants() -> dict[str, float]:
    a, f = GRS80
    e2 = f * (2 - f)
    e = math.sqrt(e2)

    def q(lat: float) -> float:
        s = math.sin(lat)
        return (1 - e2) * (s / (1 - e2 * s * s) + math.atanh(e * s) / e)

    def m(lat: float) -> float:
        return math.cos(lat) / math.sqrt(1 - e2 * math.sin(lat) ** 2)

    p = ALBERS_3005
    lat1, lat2, lat0 = (math.radians(p[k]) for k in ("lat1", "lat2", "lat0"))
    n = (m(lat1) ** 2 - m(lat2) ** 2) / (q(lat2) - q(lat1))
    c = m(lat1) ** 2 + n * q(lat1)
    return {"a": a, "e2": e2, "e": e, "n": n, "c": c, "rho0": a * math.sqrt(c - n * q(lat0)) / n, "qp": q(math.pi / 2),
            "lon0": math.radians(p["lon0"]), "east": p["east"], "north": p["north"]}


ALBERS = _albers_constants()


def _albers_forward(lon: Column, lat: Column) -> tuple[Column, Column]:
    k = ALBERS
    s = F.sin(F.radians(lat))
    q = (1 - k["e2"]) * (s / (1 - k["e2"] * s * s) + F.atanh(k["e"] * s) / k["e"])
    rho = k["a"] * F.sqrt(k["c"] - k["n"] * q) / k["n"]
    theta = k["n"] * (F.radians(lon) - k["lon0"])
    return k["east"] + rho * F.sin(theta), k["north"] + k["rho0"] - rho * F.cos(theta)


def _albers_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    k, e2 = ALBERS, ALBERS["e2"]
    dx, dy = x - k["east"], k["rho0"] - (y - k["north"])
    rho = F.sqrt(dx * dx + dy * dy)
    q = (k["c"] - rho * rho * (k["n"] / k["a"]) ** 2) / k["n"]
    b = F.asin(q / k["qp"])
    lat = (b + (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040) * F.sin(2 * b)
           + (23 * e2**2 / 360 + 251 * e2**3 / 3780) * F.sin(4 * b) + (761 * e2**3 / 45360) * F.sin(6 * b))
    return F.degrees(k["lon0"] + F.atan2(dx, dy) / k["n"]), F.degrees(lat)


def _pick(epsg: Column, lonlat, mercator, albers, utm) -> tuple[Column, Column]:
    e = _code(epsg)
    return tuple(F.when(e == 4326, lonlat[i]).when(e == 3857, mercator[i]).when(e == 3005, albers[i]).when(is_utm(epsg), utm[i])
                 for i in (0, 1))


def to_lonlat(epsg: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """(lon, lat) in degrees of the point (x, y) in the system ``epsg``."""
    r = WGS84[0]
    mercator = (F.degrees(x / r), F.degrees(2 * F.atan(F.exp(y / r)) - math.pi / 2))
    return _pick(epsg, (x, y), mercator, _albers_inverse(x, y), _utm_inverse(epsg, x, y))


def from_lonlat(epsg: Column, lon: Column, lat: Column) -> tuple[Column, Column]:
    """(x, y) in the system ``epsg`` of a point in degrees."""
    r = WGS84[0]
    mercator = (F.radians(lon) * r, F.atanh(F.sin(F.radians(lat))) * r)
    return _pick(epsg, (lon, lat), mercator, _albers_forward(lon, lat), _utm_forward(epsg, lon, lat))
