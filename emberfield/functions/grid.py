"""Grid snapping, bounds, distances, regions and map projections as column expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Box:
    """Inclusive latitude/longitude box."""

    south: float
    north: float
    west: float
    east: float


# The state boxes used by the batch loader and by the incident loader.
STATE_BOX = Box(-39.20, -33.98, 141.00, 150.00)
REGISTRY_BOX = Box(-39.2, -34.0, 140.96, 150.0)

# Named region centres (name, latitude, longitude), first wins ties.
REGION_CENTRES = [
    ("Melbourne", -37.8, 145.1),
    ("Geelong", -38.2, 144.4),
    ("Bendigo", -36.8, 144.3),
    ("Ballarat", -37.6, 143.9),
    ("Wodonga", -36.1, 147.0),
    ("Warrnambool", -38.3, 141.6),
]

# Named localities (name, latitude, longitude), first wins ties.
LOCALITIES = [
    ("East Gippsland", -37.55, 148.20),
    ("Wellington (Gippsland)", -38.10, 147.00),
    ("Latrobe Valley", -38.23, 146.55),
    ("Grampians", -37.25, 142.45),
    ("Ararat", -37.28, 142.93),
    ("Horsham / Wimmera", -36.72, 142.20),
    ("NE Victoria / Alpine", -36.75, 146.85),
    ("Wangaratta", -36.36, 146.32),
    ("Central Highlands", -37.90, 143.10),
    ("Ballarat", -37.56, 143.85),
    ("Bendigo / Loddon", -36.76, 144.28),
    ("Mildura / Mallee", -34.19, 142.16),
    ("Geelong / Barwon", -38.15, 144.36),
    ("Melbourne Metro", -37.81, 144.96),
    ("Yarra Ranges", -37.75, 145.60),
    ("South Gippsland", -38.55, 145.80),
    ("Goulburn Valley", -36.38, 145.40),
    ("Otway Ranges", -38.65, 143.50),
]

EARTH_KM = 6371.0
DEGREE_KM = 111.32


# -- snapping ---------------------------------------------------------------

def cell_index(x: Column, size: float) -> Column:
    """Integer index of the nearest grid line, halves to even; the safe join key."""
    return F.rint(x / F.lit(size)).cast("bigint")


def snap_round(x: Column, size: float = 0.1) -> Column:
    return F.rint(x / F.lit(size)) * F.lit(size)


def snap_round4(x: Column, size: float = 0.1) -> Column:
    return F.round(snap_round(x, size), 4)


def snap_floor_center(x: Column, size: float = 0.05) -> Column:
    return F.round(F.floor(x / F.lit(size)) * F.lit(size) + F.lit(size / 2), 5)


def snap_2dp(x: Column) -> Column:
    return F.rint(x * F.lit(100.0)) / F.lit(100.0)


def in_bounds(lat: Column, lon: Column, box: Box = STATE_BOX) -> Column:
    inside = lat.between(box.south, box.north) & lon.between(box.west, box.east)
    return F.coalesce(inside, F.lit(False))


# -- distances and regions --------------------------------------------------

def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_KM) -> Column:
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    h = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * radius) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def equirect_km(lat: Column, lon: Column, lat2: Column, lon2: Column) -> Column:
    """Flat distance with longitude shrunk at ``lat`` (the query point)."""
    dy = (lat2 - lat) * F.lit(DEGREE_KM)
    dx = (lon2 - lon) * F.lit(DEGREE_KM) * F.cos(F.radians(lat))
    return F.sqrt(dy * dy + dx * dx)


def euclid_degrees(lat: Column, lon: Column, lat2: Column, lon2: Column) -> Column:
    return F.sqrt(F.pow(lat - lat2, 2) + F.pow(lon - lon2, 2))


def _nearest_name(lat: Column, lon: Column, places, distance) -> Column:
    ranked = F.array(*[
        F.struct(distance(lat, lon, F.lit(la), F.lit(lo)).alias("d"), F.lit(i).alias("i"), F.lit(n).alias("name"))
        for i, (n, la, lo) in enumerate(places)
    ])
    known = lat.isNotNull() & lon.isNotNull()
    return F.when(known, F.array_min(ranked).getField("name"))


def region_nearest_euclid(lat: Column, lon: Column) -> Column:
    return _nearest_name(lat, lon, REGION_CENTRES, euclid_degrees)


def region_nearest_haversine(lat: Column, lon: Column) -> Column:
    return _nearest_name(lat, lon, LOCALITIES, haversine_km)


# -- projections ------------------------------------------------------------

_MERCATOR_R = 6378137.0


def mercator_x(lon: Column) -> Column:
    return F.radians(lon) * F.lit(_MERCATOR_R)


def mercator_y(lat: Column) -> Column:
    return F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * F.lit(_MERCATOR_R)


def mercator_lon(x: Column) -> Column:
    return F.degrees(x / F.lit(_MERCATOR_R))


def mercator_lat(y: Column) -> Column:
    return F.degrees(F.atan(F.exp(y / F.lit(_MERCATOR_R))) * 2 - F.lit(math.pi / 2))


# GRS80 ellipsoid
_A = 6378137.0
_FL = 1 / 298.257222101
_E2 = _FL * (2 - _FL)
_E = math.sqrt(_E2)
_N = _FL / (2 - _FL)
_RECT = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = [
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16,
    13 * _N**2 / 48 - 3 * _N**3 / 5,
    61 * _N**3 / 240,
]




def mga_zone55(lat: Column, lon: Column) -> tuple[Column, Column]:
    """EPSG:7855 easting and northing (transverse Mercator, third-order series)."""
    phi, lam = F.radians(lat), F.radians(lon - F.lit(147.0))
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - F.lit(_E) * F.atanh(F.lit(_E) * s))
    xi0 = F.atan2(t, F.cos(lam))
    eta0 = F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    xi, eta = xi0, eta0
    for j, a in enumerate(_ALPHA, start=1):
        xi = xi + F.lit(a) * F.sin(xi0 * (2 * j)) * F.cosh(eta0 * (2 * j))
        eta = eta + F.lit(a) * F.cos(xi0 * (2 * j)) * F.sinh(eta0 * (2 * j))
    k = F.lit(0.9996 * _RECT)
    return F.lit(500000.0) + k * eta, F.lit(10000000.0) + k * xi


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - _E2 * math.sin(phi) ** 2)


def _t(phi: float) -> float:
    s = math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - _E * s) / (1 + _E * s)) ** (_E / 2)


_P1, _P2, _P0 = math.radians(-36.0), math.radians(-38.0), math.radians(-37.0)
_LN = (math.log(_m(_P1)) - math.log(_m(_P2))) / (math.log(_t(_P1)) - math.log(_t(_P2)))
_LF = _m(_P1) / (_LN * _t(_P1) ** _LN)
_RHO0 = _A * _LF * _t(_P0) ** _LN


def vicgrid(lat: Column, lon: Column) -> tuple[Column, Column]:
    """EPSG:7899 easting and northing (Lambert conformal conic, two standard parallels)."""
    phi = F.radians(lat)
    es = F.lit(_E) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - es) / (1 + es), F.lit(_E / 2))
    # n is negative in the southern hemisphere, so rho carries its sign
    rho = F.lit(_A * _LF) * F.pow(t, F.lit(_LN))
    theta = F.radians(lon - F.lit(145.0)) * F.lit(_LN)
    return F.lit(2500000.0) + rho * F.sin(theta), F.lit(2500000.0 + _RHO0) - rho * F.cos(theta)


def vicgrid_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    """Latitude and longitude of EPSG:7899 coordinates (five fixed-point steps)."""
    dx, dy = x - F.lit(2500000.0), F.lit(2500000.0 + _RHO0) - y
    sign = -1.0 if _LN < 0 else 1.0
    rho = F.sqrt(dx * dx + dy * dy) * F.lit(sign)
    theta = F.atan2(dx * F.lit(sign), dy * F.lit(sign))
    t = F.pow(rho / F.lit(_A * _LF), F.lit(1 / _LN))
    phi = F.lit(math.pi / 2) - F.atan(t) * 2
    for _ in range(5):
        es = F.lit(_E) * F.sin(phi)
        phi = F.lit(math.pi / 2) - F.atan(t * F.pow((1 - es) / (1 + es), F.lit(_E / 2))) * 2
    return F.degrees(phi), F.lit(145.0) + F.degrees(theta / F.lit(_LN))


# -- cells ------------------------------------------------------------------

def metric_cell(x: Column, origin: float | Column, size: float) -> Column:
    base = F.lit(origin) if isinstance(origin, (int, float)) else origin
    return F.floor((x - base) / F.lit(float(size))).cast("bigint")


def cell_number(cell_x: Column, cell_y: Column) -> Column:
    return cell_y * F.lit(1000000) + cell_x


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box_ring(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Closed five-point ring, counter-clockwise from the south-west corner."""
    return F.array(point(west, south), point(east, south), point(east, north), point(west, north), point(west, south))


def cell_polygon(lat: Column, lon: Column, half: float = 0.025) -> Column:
    h = F.lit(half)
    return F.array(box_ring(lon - h, lat - h, lon + h, lat + h))
