"""Positions between reference systems: EPSG 4326, 3857 and the UTM zones, by one set of formulas for columns and arrays.

UTM follows the Krueger series to the third order of the flattening, below a millimetre within a zone.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

RADIUS = 6378137.0
_F, _K0 = 1 / 298.257223563, 0.9996
_N = _F / (2 - _F)
_A = RADIUS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64) * _K0
_ALPHA = [_N / 2 - 2 / 3 * _N**2 + 5 / 16 * _N**3, 13 / 48 * _N**2 - 3 / 5 * _N**3, 61 / 240 * _N**3]
_BETA = [_N / 2 - 2 / 3 * _N**2 + 37 / 96 * _N**3, _N**2 / 48 + _N**3 / 15, 17 / 480 * _N**3]
_DELTA = [2 * _N - 2 / 3 * _N**2 - 2 * _N**3, 7 / 3 * _N**2 - 8 / 5 * _N**3, 56 / 15 * _N**3]
_E = 2 * math.sqrt(_N) / (1 + _N)


class _Arrays:
    """numpy's functions under the names that pyspark.sql.functions gives them."""

    sin, cos, sinh, cosh, tan, exp, log, sqrt, degrees, radians = np.sin, np.cos, np.sinh, np.cosh, np.tan, np.exp, np.log, np.sqrt, np.degrees, np.radians
    atan, asin, atan2, atanh = np.arctan, np.arcsin, np.arctan2, np.arctanh


def utm_to_wgs84(m, x, y, zone, north):
    """Longitude and latitude in degrees; m has the functions, north is 0 or the southern zones' 10,000 km."""
    xi, eta = (y - north) / _A, (x - 500000.0) / _A
    xi1, eta1 = xi, eta
    for j, b in enumerate(_BETA, 1):
        xi1 = xi1 - b * m.sin(2 * j * xi) * m.cosh(2 * j * eta)
        eta1 = eta1 - b * m.cos(2 * j * xi) * m.sinh(2 * j * eta)
    chi = m.asin(m.sin(xi1) / m.cosh(eta1))
    lat = chi
    for j, d in enumerate(_DELTA, 1):
        lat = lat + d * m.sin(2 * j * chi)
    return zone * 6 - 183 + m.degrees(m.atan2(m.sinh(eta1), m.cos(xi1))), m.degrees(lat)


def wgs84_to_utm(m, lon, lat, zone, north):
    """Easting and northing of a longitude and latitude in degrees."""
    s, away = m.sin(m.radians(lat)), m.radians(lon - (zone * 6 - 183))
    t = m.sinh(m.atanh(s) - _E * m.atanh(_E * s))
    xi1, eta1 = m.atan2(t, m.cos(away)), m.atanh(m.sin(away) / m.sqrt(1 + t * t))
    xi, eta = xi1, eta1
    for j, a in enumerate(_ALPHA, 1):
        xi = xi + a * m.sin(2 * j * xi1) * m.cosh(2 * j * eta1)
        eta = eta + a * m.cos(2 * j * xi1) * m.sinh(2 * j * eta1)
    return 500000.0 + _A * eta, north + _A * xi


def mercator_to_wgs84(m, x, y):
    return m.degrees(x / RADIUS), m.degrees(2.0 * m.atan(m.exp(y / RADIUS)) - math.pi / 2)


def wgs84_to_mercator(m, lon, lat):
    return m.radians(lon) * RADIUS, m.log(m.tan(m.radians(lat) / 2 + math.pi / 4)) * RADIUS


def _utm(epsg: Column) -> tuple[Column, Column, Column]:
    """Whether the system is a UTM zone, its number and its false northing."""
    return F.floor(epsg / 100).isin(326, 327) & (epsg % 100).between(1, 60), epsg % 100, F.when(F.floor(epsg / 100) == 327, 1e7).otherwise(0.0)


def _chosen(epsg: Column, same, mercator, utm, names: tuple[str, str]) -> Column:
    unknown = F.raise_error(F.concat(F.lit("reference system not supported: "), epsg.cast("string"))).cast("double")
    pick = lambda k: F.when(epsg == 4326, same[k]).when(epsg == 3857, mercator[k]).when(_utm(epsg)[0], utm[k]).otherwise(unknown)
    return F.struct(pick(0).alias(names[0]), pick(1).alias(names[1]))


def to_wgs84(x: Column, y: Column, epsg: Column) -> Column:
    """struct(lon, lat) from EPSG 4326, 3857 or a UTM zone; others are an error."""
    return _chosen(epsg, (x, y), mercator_to_wgs84(F, x, y), utm_to_wgs84(F, x, y, *_utm(epsg)[1:]), ("lon", "lat"))


def from_wgs84(lon: Column, lat: Column, epsg: Column) -> Column:
    """struct(x, y) in EPSG 4326, 3857 or a UTM zone; others are an error."""
    return _chosen(epsg, (lon, lat), wgs84_to_mercator(F, lon, lat), wgs84_to_utm(F, lon, lat, *_utm(epsg)[1:]), ("x", "y"))


def arrays_between(x: np.ndarray, y: np.ndarray, source: int, target: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of one system in another; unchanged if both are the same."""
    if source == target:
        return x, y
    utm = lambda e: (e % 100, 1e7 if e // 100 == 327 else 0.0)
    known = lambda e: e in (4326, 3857) or e // 100 in (326, 327) and 1 <= e % 100 <= 60
    if not known(source) or not known(target):
        raise ValueError(f"reference system not supported: {target if known(source) else source}")
    lon, lat = (x, y) if source == 4326 else mercator_to_wgs84(_Arrays, x, y) if source == 3857 else utm_to_wgs84(_Arrays, x, y, *utm(source))
    return (lon, lat) if target == 4326 else wgs84_to_mercator(_Arrays, lon, lat) if target == 3857 else wgs84_to_utm(_Arrays, lon, lat, *utm(target))
