"""Planar and geodetic arithmetic as column expressions: grid cells, distances, UTM, rings and boxes.

Coordinates in metres and in degrees are never mixed: UTM columns are x, y, geographic ones lat, lon. Rings are
array<struct<x,y>> without a repeated last vertex.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS 84 and the transverse Mercator grid of UTM.
A, INV_F, K0, FALSE_EASTING = 6378137.0, 298.257223563, 0.9996, 500000.0
N_THIRD = 1 / (2 * INV_F - 1)


def _series() -> tuple[float, list[float], list[float], list[float]]:
    """Rectifying radius, and Krueger's alpha, beta and delta coefficients to the third order of the third flattening."""
    n = N_THIRD
    radius = A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    beta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    delta = [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]
    return radius, alpha, beta, delta


def wgs84_to_utm(lat: Column, lon: Column, zone: int = 34) -> tuple[Column, Column]:
    """(x, y) in metres of the northern zone."""
    radius, alpha, _, _ = _series()
    e = 2 * math.sqrt(N_THIRD) / (1 + N_THIRD)
    phi, lam = F.radians(lat), F.radians(lon - F.lit(6.0 * zone - 183.0))
    t = F.sinh(F.atanh(F.sin(phi)) - F.lit(e) * F.atanh(F.lit(e) * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east = reduce(lambda s, j: s + F.lit(alpha[j - 1]) * F.cos(2 * j * xi) * F.sinh(2 * j * eta), (1, 2, 3), eta)
    north = reduce(lambda s, j: s + F.lit(alpha[j - 1]) * F.sin(2 * j * xi) * F.cosh(2 * j * eta), (1, 2, 3), xi)
    return F.lit(FALSE_EASTING) + F.lit(K0 * radius) * east, F.lit(K0 * radius) * north


def utm_to_wgs84(x: Column, y: Column, zone: int = 34) -> tuple[Column, Column]:
    """(lat, lon) in degrees of a point of the northern zone."""
    radius, _, beta, delta = _series()
    xi0, eta0 = y / F.lit(K0 * radius), (x - F.lit(FALSE_EASTING)) / F.lit(K0 * radius)
    xi = reduce(lambda s, j: s - F.lit(beta[j - 1]) * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0), (1, 2, 3), xi0)
    eta = reduce(lambda s, j: s - F.lit(beta[j - 1]) * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0), (1, 2, 3), eta0)
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    phi = reduce(lambda s, j: s + F.lit(delta[j - 1]) * F.sin(2 * j * chi), (1, 2, 3), chi)
    return F.degrees(phi), F.lit(6.0 * zone - 183.0) + F.degrees(F.atan2(F.sinh(eta), F.cos(xi)))


def cell(x: Column, size: float) -> Column:
    return F.floor(x / F.lit(float(size)))


def around(cx: Column, cy: Column) -> Column:
    """array<struct<cx,cy>> of a grid cell and its eight neighbours, to be exploded before an equi join."""
    return F.array(*[F.struct((cx + i).alias("cx"), (cy + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])


def next_vertex(ring: Column) -> Column:
    return F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))


def signed_area(ring: Column) -> Column:
    """Shoelace area, positive for counter-clockwise rings."""
    cross = F.zip_with(ring, next_vertex(ring), lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    return F.aggregate(cross, F.lit(0.0), lambda s, x: s + x) / 2


def in_ring(px: Column, py: Column, ring: Column) -> Column:
    """Ray casting; points on an edge fall to one side by the half-open rule."""
    hits = F.zip_with(
        ring, next_vertex(ring),
        lambda a, b: ((a["y"] > py) != (b["y"] > py)) & (px < (b["x"] - a["x"]) * (py - a["y"]) / (b["y"] - a["y"]) + a["x"]),
    )
    return F.size(F.filter(hits, lambda h: F.coalesce(h, F.lit(False)))) % 2 == 1


def box_overlap(lo1: Column, hi1: Column, lo2: Column, hi2: Column) -> Column:
    return F.greatest(F.least(hi1, hi2) - F.greatest(lo1, lo2), F.lit(0.0))


def wkt_point(wkt: Column) -> tuple[Column, Column]:
    pattern = r"POINT\s*\(\s*([0-9.]+)\s+([0-9.]+)\s*\)"
    part = lambda k: F.nullif(F.regexp_extract(wkt, pattern, k), F.lit("")).cast("double")
    return part(1), part(2)
