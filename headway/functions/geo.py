"""Distances between points in degrees, and the Estonian projected grid."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Series for the length of one degree on WGS84, in metres.
LAT_DEGREE_SERIES = (111132.954, -559.822, 1.175)  # constant, cos 2phi, cos 4phi
LON_DEGREE_SERIES = (111412.84, -93.5)  # cos phi, cos 3phi

# Fixed value: sphere radius in metres.
SPHERE_RADIUS = 6370986.0

# WGS84 ellipsoid.
WGS84_AXIS = 6378137.0
WGS84_FLATTENING = 1 / 298.257223563

# L-EST97 (EPSG:3301), Lambert conformal conic on GRS80.
LEST97_AXIS = 6378137.0
LEST97_FLATTENING = 1 / 298.257222101
LEST97_PARALLELS = (58.0, 59 + 20 / 60)
LEST97_ORIGIN = (57 + 31 / 60 + 3.19415 / 3600, 24.0)
LEST97_FALSE_NORTHING = 6375000.0
LEST97_FALSE_EASTING = 500000.0

# Radians: far below a millimetre on the globe.
SETTLED = 1e-13
HALVINGS = 60


# ---- planar, from the length of a degree ------------------------------------


def planar_metres(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Pythagoras over degree differences scaled to metres at the mean latitude."""
    mean = F.radians((lat1 + lat2) / F.lit(2.0))
    c0, c2, c4 = LAT_DEGREE_SERIES
    per_lat = F.lit(c0) + F.lit(c2) * F.cos(mean * 2.0) + F.lit(c4) * F.cos(mean * 4.0)
    c1, c3 = LON_DEGREE_SERIES
    per_lon = F.lit(c1) * F.cos(mean) + F.lit(c3) * F.cos(mean * 3.0)
    return F.hypot((lat1 - lat2) * per_lat, (lon1 - lon2) * per_lon)


# ---- sphere -----------------------------------------------------------------


def sphere_metres(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the haversine formula."""
    half_lat = F.sin(F.radians(lat1 - lat2) / F.lit(2.0))
    half_lon = F.sin(F.radians(lon1 - lon2) / F.lit(2.0))
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * (
        half_lon * half_lon
    )
    # rounding can lift opposite points above one; `least` would turn null into one
    bounded = F.when(chord > 1.0, F.lit(1.0)).otherwise(chord)
    return F.lit(2 * SPHERE_RADIUS) * F.asin(F.sqrt(bounded))


# ---- projected --------------------------------------------------------------


def _conformal_t(phi: float, ecc: float) -> float:
    slip = ((1 - ecc * math.sin(phi)) / (1 + ecc * math.sin(phi))) ** (ecc / 2)
    return math.tan(math.pi / 4 - phi / 2) / slip


def _cone() -> tuple[float, float, float, float]:
    """Eccentricity, cone constant, scaled axis and radius at the origin."""
    ecc = math.sqrt(LEST97_FLATTENING * (2 - LEST97_FLATTENING))
    phis = [math.radians(p) for p in LEST97_PARALLELS]
    widths = [math.cos(p) / math.sqrt(1 - (ecc * math.sin(p)) ** 2) for p in phis]
    ts = [_conformal_t(p, ecc) for p in phis]
    n = math.log(widths[0] / widths[1]) / math.log(ts[0] / ts[1])
    scaled = LEST97_AXIS * widths[0] / (n * ts[0] ** n)
    rho0 = scaled * _conformal_t(math.radians(LEST97_ORIGIN[0]), ecc) ** n
    return ecc, n, scaled, rho0


def project_lest97(lat: Column, lon: Column) -> tuple[Column, Column]:
    """(northing, easting) in metres for WGS84 degrees."""
    ecc, n, scaled, rho0 = _cone()
    wave = F.sin(F.radians(lat)) * F.lit(ecc)
    slip = F.pow((F.lit(1.0) - wave) / (F.lit(1.0) + wave), F.lit(ecc / 2))
    t = F.tan(F.lit(math.pi / 4) - F.radians(lat) / F.lit(2.0)) / slip
    rho = F.lit(scaled) * F.pow(t, F.lit(n))
    theta = F.radians(lon - F.lit(LEST97_ORIGIN[1])) * F.lit(n)
    northing = F.lit(LEST97_FALSE_NORTHING + rho0) - rho * F.cos(theta)
    easting = F.lit(LEST97_FALSE_EASTING) + rho * F.sin(theta)
    return northing, easting


def grid_metres(n1: Column, e1: Column, n2: Column, e2: Column) -> Column:
    """Straight-line distance between projected points."""
    return F.hypot(n1 - n2, e1 - e2)


# ---- ellipsoid --------------------------------------------------------------


def _geodesic(
    lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray
) -> np.ndarray:
    """Vincenty's inverse formula over arrays, repeated until each pair has settled.

    The formula swings about between nearly opposite points; pairs that do not
    settle go to `_opposite`, which always does.
    """
    flat = WGS84_FLATTENING
    polar = WGS84_AXIS * (1 - flat)
    u1 = np.arctan((1 - flat) * np.tan(np.radians(lat1)))
    u2 = np.arctan((1 - flat) * np.tan(np.radians(lat2)))
    sin1, cos1, sin2, cos2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    span = np.radians(lon1 - lon2)
    span = np.where(span > np.pi, span - 2 * np.pi, np.where(span < -np.pi, span + 2 * np.pi, span))
    lam, change = span, np.full(np.shape(span), np.inf)
    while True:
        before, last = lam, change
        sin_lam, cos_lam = np.sin(lam), np.cos(lam)
        sin_arc = np.hypot(cos2 * sin_lam, cos1 * sin2 - sin1 * cos2 * cos_lam)
        cos_arc = sin1 * sin2 + cos1 * cos2 * cos_lam
        arc = np.arctan2(sin_arc, cos_arc)
        # the same point twice has no arc, and so no azimuth
        azimuth = cos1 * cos2 * sin_lam / np.where(sin_arc == 0, np.inf, sin_arc)
        cos_sq = 1 - azimuth * azimuth
        # along the equator the middle term vanishes
        middle = np.where(
            cos_sq == 0, 0, cos_arc - 2 * sin1 * sin2 / np.where(cos_sq == 0, 1, cos_sq)
        )
        c = flat / 16 * cos_sq * (4 + flat * (4 - 3 * cos_sq))
        wave = middle + c * cos_arc * (2 * middle * middle - 1)
        lam = span + (1 - c) * flat * azimuth * (arc + c * sin_arc * wave)
        change = np.abs(lam - before)
        # beyond half a turn, or no longer nearing: the formula does not hold there
        lost = (np.abs(lam) > np.pi) | ((change >= last) & (change > SETTLED))
        lam = np.where(lost, np.nan, lam)
        if not (change > SETTLED)[~np.isnan(lam)].any():
            break
    usq = cos_sq * (WGS84_AXIS**2 - polar**2) / polar**2
    a = 1 + usq / 16384 * (4096 + usq * (-768 + usq * (320 - 175 * usq)))
    b = usq / 1024 * (256 + usq * (-128 + usq * (74 - 47 * usq)))
    twice = 2 * middle * middle - 1
    ends = (4 * sin_arc * sin_arc - 3) * (2 * twice - 1)
    shift = b * sin_arc * (middle + b / 4 * (cos_arc * twice - b / 6 * middle * ends))
    length = polar * a * (arc - shift)
    rest = np.isnan(lam) & ~np.isnan(span + u1 + u2)
    if rest.any():
        length = np.where(rest, 0.0, length)
        length[rest] = _opposite(u1[rest], u2[rest], span[rest])
    return length


def _opposite(u1: np.ndarray, u2: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Geodesic lengths from reduced latitudes by halving the azimuth at the start.

    With the start on the southern and farther latitude, the longitude that a
    geodesic reaches on the other latitude grows with its azimuth from north to
    south, so the azimuth that reaches `span` is bracketed. Both integrals are
    smooth and taken by Gauss's rule.
    """
    far = np.abs(u1) >= np.abs(u2)
    start, end = np.where(far, u1, u2), np.where(far, u2, u1)
    flip = np.where(start > 0, -1.0, 1.0)
    start, end, span = -np.abs(start), flip * end, np.abs(span)
    flat = WGS84_FLATTENING
    polar = WGS84_AXIS * (1 - flat)
    ratio = (WGS84_AXIS**2 - polar**2) / polar**2
    nodes, weights = np.polynomial.legendre.leggauss(32)

    def reach(azimuth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sin_a, cos_a = np.sin(azimuth), np.cos(azimuth)
        sin_0 = sin_a * np.cos(start)
        cos_e = np.sqrt(np.maximum((cos_a * np.cos(start)) ** 2 + np.cos(end) ** 2 - np.cos(start) ** 2, 0))
        first = np.arctan2(np.sin(start), cos_a * np.cos(start))
        last = np.arctan2(np.sin(end), cos_e)
        turn_1 = np.arctan2(sin_0 * np.sin(start), cos_a * np.cos(start))
        turn_2 = np.arctan2(sin_0 * np.sin(end), cos_e)
        half = (last - first) / 2
        arcs = (first + last)[:, None] / 2 + half[:, None] * nodes
        root = np.sqrt(1 + (ratio * (1 - sin_0**2))[:, None] * np.sin(arcs) ** 2)
        lag = half * ((2 - flat) / (1 + (1 - flat) * root) @ weights)
        return turn_2 - turn_1 - flat * sin_0 * lag, polar * half * (root @ weights)

    low, high = np.zeros_like(span), np.full_like(span, np.pi)
    for _ in range(HALVINGS):
        middle = (low + high) / 2
        short = reach(middle)[0] < span
        low, high = np.where(short, middle, low), np.where(short, high, middle)
    return reach((low + high) / 2)[1]


def _lengths(lat1: pa.Array, lon1: pa.Array, lat2: pa.Array, lon2: pa.Array) -> pa.Array:
    ends = [end.to_numpy(zero_copy_only=False) for end in (lat1, lon1, lat2, lon2)]
    # nulls arrive as NaN and leave as nulls
    return pa.array(_geodesic(*ends), pa.float64(), from_pandas=True)


def spheroid_metres(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Length of the WGS84 geodesic between two points.

    The one formula that runs on Arrow batches rather than in generated code: as
    columns it needs a method too large for the JVM to compile once it is
    combined with other columns, and then runs ten times slower than this
    """
    return F.arrow_udf(_lengths, "double")(lat1, lon1, lat2, lon2)
