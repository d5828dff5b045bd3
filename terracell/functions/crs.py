"""Coordinate reference systems as column arithmetic.

Allowed: geographic degrees (EPSG:4326, EPSG:4269), the equal-area conic for
the conterminous US (EPSG:5070) and web Mercator (EPSG:3857). Formulas follow
J. P. Snyder, Map Projections: A Working Manual (1987), equations 3-12, 3-16,
3-18, 14-3 to 14-9 and 7-1 to 7-5.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from .rings import Point

GEOGRAPHIC = ("EPSG:4326", "EPSG:4269", "WGS84")
ALLOWED = GEOGRAPHIC + ("EPSG:5070", "EPSG:3857")

# GRS80 ellipsoid and the parallels and origin of EPSG:5070.
SEMI_MAJOR = 6378137.0
INVERSE_FLATTENING = 298.257222101
PARALLEL_1, PARALLEL_2, ORIGIN_LAT, ORIGIN_LON = 29.5, 45.5, 23.0, -96.0

_F = 1 / INVERSE_FLATTENING
E2 = 2 * _F - _F * _F
E1 = math.sqrt(E2)


def crs_code(name: Column) -> Column:
    """One spelling of a reference system: upper case, URNs and WGS 84 as EPSG codes; NULL stays."""
    text = F.upper(F.trim(name))
    short = F.regexp_replace(text, r"^URN:OGC:DEF:CRS:(EPSG):[^:]*:", "$1:")
    return F.when(short.isin("WGS84", "WGS 84", "CRS84", "OGC:CRS84", "URN:OGC:DEF:CRS:OGC:1.3:CRS84"), "EPSG:4326").otherwise(short)


def _authalic(sin_phi: float) -> float:
    return (1 - E2) * (
        sin_phi / (1 - E2 * sin_phi**2)
        - math.log((1 - E1 * sin_phi) / (1 + E1 * sin_phi)) / (2 * E1)
    )


def _scale(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - E2 * math.sin(phi) ** 2)


_P1, _P2, _P0 = (math.radians(d) for d in (PARALLEL_1, PARALLEL_2, ORIGIN_LAT))
CONE_N = (_scale(_P1) ** 2 - _scale(_P2) ** 2) / (_authalic(math.sin(_P2)) - _authalic(math.sin(_P1)))
CONE_C = _scale(_P1) ** 2 + CONE_N * _authalic(math.sin(_P1))
RHO_0 = SEMI_MAJOR * math.sqrt(CONE_C - CONE_N * _authalic(math.sin(_P0))) / CONE_N


def _albers_forward(lon: Column, lat: Column) -> Point:
    s = F.sin(F.radians(lat))
    q = (s / (1 - s * s * E2) - F.ln((1 - s * E1) / (1 + s * E1)) / (2 * E1)) * (1 - E2)
    rho = F.sqrt(F.lit(CONE_C) - q * CONE_N) * (SEMI_MAJOR / CONE_N)
    theta = F.radians(lon - ORIGIN_LON) * CONE_N
    return rho * F.sin(theta), F.lit(RHO_0) - rho * F.cos(theta)


def _albers_inverse(x: Column, y: Column) -> Point:
    dy = F.lit(RHO_0) - y
    rho = F.sqrt(x * x + dy * dy)
    theta = F.atan2(x, dy)
    q = (F.lit(CONE_C) - F.pow(rho * (CONE_N / SEMI_MAJOR), F.lit(2.0))) / CONE_N
    beta = F.asin(q / _authalic(1.0))
    phi = (
        beta
        + F.sin(beta * 2) * (E2 / 3 + 31 * E2**2 / 180 + 517 * E2**3 / 5040)
        + F.sin(beta * 4) * (23 * E2**2 / 360 + 251 * E2**3 / 3780)
        + F.sin(beta * 6) * (761 * E2**3 / 45360)
    )
    s = F.sin(phi)
    w = 1 - s * s * E2
    fix = q / (1 - E2) - s / w + F.ln((1 - s * E1) / (1 + s * E1)) / (2 * E1)
    phi = phi + w * w / (F.cos(phi) * 2) * fix
    return F.degrees(theta / CONE_N) + ORIGIN_LON, F.degrees(phi)


def _mercator_forward(lon: Column, lat: Column) -> Point:
    return (
        F.radians(lon) * SEMI_MAJOR,
        F.ln(F.tan(F.radians(lat) / 2 + math.pi / 4)) * SEMI_MAJOR,
    )


def _mercator_inverse(x: Column, y: Column) -> Point:
    return F.degrees(x / SEMI_MAJOR), F.degrees(F.atan(F.exp(y / SEMI_MAJOR)) * 2 - math.pi / 2)


def canonical(crs: str) -> str:
    name = crs.strip().upper()
    if name not in ALLOWED:
        raise ValueError(f"unsupported CRS {crs!r}; allowed: {', '.join(ALLOWED)}")
    return name


def same_crs(crs: Column, expected: str) -> Column:
    """Whether a reference system is the expected one under any of its names; false for a missing one."""
    name = F.upper(F.trim(crs))
    return F.coalesce(F.when(name == "WGS84", "EPSG:4326").otherwise(name) == canonical(expected), F.lit(False))


def is_geographic(crs: Column) -> Column:
    """True where a raster needs no reprojection of a degree box."""
    return F.upper(F.trim(crs)).isin("EPSG:4326", "WGS84")


def reproject(x: Column, y: Column, source: str, target: str) -> Point:
    src, dst = canonical(source), canonical(target)
    if src == dst or (src in GEOGRAPHIC and dst in GEOGRAPHIC):
        return x, y
    if src == "EPSG:5070":
        x, y = _albers_inverse(x, y)
    elif src == "EPSG:3857":
        x, y = _mercator_inverse(x, y)
    if dst == "EPSG:5070":
        return _albers_forward(x, y)
    if dst == "EPSG:3857":
        return _mercator_forward(x, y)
    return x, y
