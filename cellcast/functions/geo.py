"""WGS84 to UTM metres and back, and polygon centroids, as native column arithmetic.

Kruger series in the third flattening n up to n^3 (Karney 2011); well below a millimetre inside a zone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# WGS84 ellipsoid and UTM scale.
SEMI_MAJOR, FLATTENING, SCALE, FALSE_EASTING, FALSE_NORTHING = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0, 10000000.0

_n = FLATTENING / (2 - FLATTENING)
RECTIFYING = SEMI_MAJOR / (1 + _n) * (1 + _n**2 / 4 + _n**4 / 64) * SCALE
ALPHA = [_n / 2 - 2 * _n**2 / 3 + 5 * _n**3 / 16, 13 * _n**2 / 48 - 3 * _n**3 / 5, 61 * _n**3 / 240]
BETA = [_n / 2 - 2 * _n**2 / 3 + 37 * _n**3 / 96, _n**2 / 48 + _n**3 / 15, 17 * _n**3 / 480]
DELTA = [2 * _n - 2 * _n**2 / 3 - 2 * _n**3, 7 * _n**2 / 3 - 8 * _n**3 / 5, 56 * _n**3 / 15]
ECCENTRICITY = 2 * math.sqrt(_n) / (1 + _n)


def _total(terms: list[Column]) -> Column:
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def utm_zone(lon: Column) -> Column:
    """Zone number 1..60; longitude 180 belongs to the last zone."""
    return F.least(F.floor((lon + 180) / 6) + 1, F.lit(60)).cast("int")


def zone_meridian(zone: Column) -> Column:
    return zone * F.lit(6.0) - 183.0


Layers = list[dict[str, Column]]


def utm_layers(lon: str, lat: str, meridian: Column, south: Column) -> Layers:
    """Columns to add one layer after another; the last one gives x and y in metres.

    Layers keep the shared sub-terms of the series as columns instead of repeating them in every use.
    """
    sin_lat = F.sin(F.radians(lat))
    t, turn, xi, eta = (F.col(c) for c in ("_t", "_turn", "_xi", "_eta"))
    orders = list(enumerate(ALPHA, 1))
    east = eta + _total([F.cos(2.0 * j * xi) * F.sinh(2.0 * j * eta) * a for j, a in orders])
    north = xi + _total([F.sin(2.0 * j * xi) * F.cosh(2.0 * j * eta) * a for j, a in orders])
    return [
        {
            "_t": F.sinh(F.atanh(sin_lat) - F.lit(ECCENTRICITY) * F.atanh(F.lit(ECCENTRICITY) * sin_lat)),
            "_turn": F.radians(F.col(lon) - meridian),
        },
        {"_xi": F.atan2(t, F.cos(turn)), "_eta": F.atanh(F.sin(turn) / F.sqrt(t * t + 1.0))},
        {
            "x": east * RECTIFYING + FALSE_EASTING,
            "y": north * RECTIFYING + F.when(south, FALSE_NORTHING).otherwise(0.0),
        },
    ]


def wgs84_layers(points: dict[str, tuple[str, str]], meridian: Column, south: Column) -> Layers:
    """Layers for several named UTM points at once; each point ends as columns lon_<name>, lat_<name>."""
    first, second, third, last = {}, {}, {}, {}
    orders = list(enumerate(BETA, 1))
    for k, (x, y) in points.items():
        xi, eta, xi1, eta1, chi = (F.col(f"{c}_{k}") for c in ("_xi", "_eta", "_xi1", "_eta1", "_chi"))
        first[f"_xi_{k}"] = (F.col(y) - F.when(south, FALSE_NORTHING).otherwise(0.0)) / RECTIFYING
        first[f"_eta_{k}"] = (F.col(x) - FALSE_EASTING) / RECTIFYING
        second[f"_xi1_{k}"] = xi - _total([F.sin(2.0 * j * xi) * F.cosh(2.0 * j * eta) * b for j, b in orders])
        second[f"_eta1_{k}"] = eta - _total([F.cos(2.0 * j * xi) * F.sinh(2.0 * j * eta) * b for j, b in orders])
        third[f"_chi_{k}"] = F.asin(F.sin(xi1) / F.cosh(eta1))
        last[f"lon_{k}"] = F.degrees(F.atan(F.sinh(eta1) / F.cos(xi1))) + meridian
        last[f"lat_{k}"] = F.degrees(chi + _total([F.sin(2.0 * j * chi) * d for j, d in enumerate(DELTA, 1)]))
    return [first, second, third, last]


def ring_centroid(ring: Column) -> tuple[Column, Column]:
    """Longitude and latitude of the area centroid of a closed ring of (lon, lat) points.

    Worked out relative to the first vertex, which keeps the digits that small cells far from the
    origin would otherwise lose.
    """
    lon0, lat0 = ring[0]["lon"], ring[0]["lat"]
    edges = F.transform(
        F.sequence(F.lit(1), F.size(ring) - 1),
        lambda i: F.struct(
            (F.get(ring, i - 1)["lon"] - lon0).alias("x0"), (F.get(ring, i - 1)["lat"] - lat0).alias("y0"),
            (F.get(ring, i)["lon"] - lon0).alias("x1"), (F.get(ring, i)["lat"] - lat0).alias("y1"),
        ),
    )

    def cross(e: Column) -> Column:
        return e["x0"] * e["y1"] - e["x1"] * e["y0"]

    def total(term) -> Column:
        return F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + term(e))

    area3 = total(cross) * 3.0
    return (
        lon0 + total(lambda e: (e["x0"] + e["x1"]) * cross(e)) / area3,
        lat0 + total(lambda e: (e["y0"] + e["y1"]) * cross(e)) / area3,
    )
