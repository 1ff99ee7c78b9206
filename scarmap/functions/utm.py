"""UTM metres of the images' tiles as column expressions, by the Krüger series on WGS 84.

The series in the third flattening n are cut after n^4, which leaves under a micrometre within a
zone and its neighbours.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS 84, and the scale and false origin of UTM.
A, FLATTENING, K0, FALSE_EAST, FALSE_NORTH = 6378137.0, 1 / 298.257223563, 0.9996, 500_000.0, 10_000_000.0
N = FLATTENING / (2 - FLATTENING)
E = math.sqrt(FLATTENING * (2 - FLATTENING))
#: Radius of the sphere on which meridians have the ellipsoid's length, scaled.
RADIUS = K0 * A / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
# The series' coefficients, from the conformal sphere to the plane and back.
FORWARD = (
    N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16 + 41 * N**4 / 180,
    13 * N**2 / 48 - 3 * N**3 / 5 + 557 * N**4 / 1440,
    61 * N**3 / 240 - 103 * N**4 / 140,
    49561 * N**4 / 161280,
)
BACKWARD = (
    N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96 - N**4 / 360,
    N**2 / 48 + N**3 / 15 - 437 * N**4 / 1440,
    17 * N**3 / 480 - 37 * N**4 / 840,
    4397 * N**4 / 161280,
)


def zone_of(lon: Column) -> Column:
    """The number of the zone of a longitude in degrees, without the exceptions of the far north."""
    return (F.pmod(F.floor((lon + 180) / 6), F.lit(60)) + 1).cast("int")


def _meridian(zone: Column) -> Column:
    return zone * 6 - 183


def _sums(series: tuple[float, ...], xi: Column, eta: Column, a, b) -> Column:
    return sum((F.lit(c) * a(F.lit(2.0 * j) * xi) * b(F.lit(2.0 * j) * eta) for j, c in enumerate(series, 1)), F.lit(0.0))


def utm(lat: Column, lon: Column, zone: Column, south: Column | None = None) -> tuple[Column, Column]:
    """East and north in metres, in ``zone``, of a latitude and longitude in degrees; ``south`` says
    whether norths count from the false origin (by default where the latitude is below 0). Nulls stay."""
    phi, lam = F.radians(lat), F.radians(lon - _meridian(zone))
    t = F.sinh(F.atanh(F.sin(phi)) - F.lit(E) * F.atanh(F.lit(E) * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.asinh(F.sin(lam) / F.sqrt(t * t + F.cos(lam) * F.cos(lam)))
    east = F.lit(FALSE_EAST) + F.lit(RADIUS) * (eta + _sums(FORWARD, xi, eta, F.cos, F.sinh))
    north = F.lit(RADIUS) * (xi + _sums(FORWARD, xi, eta, F.sin, F.cosh))
    return east, north + F.when(lat < 0 if south is None else south, FALSE_NORTH).otherwise(0.0)


def from_utm(east: Column, north: Column, zone: Column, south: Column, rounds: int = 5) -> tuple[Column, Column]:
    """Latitude and longitude in degrees of metres in ``zone``. The latitude is a fixed point of which
    each round gains two digits or more."""
    xi = (north - F.when(south, FALSE_NORTH).otherwise(0.0)) / RADIUS
    eta = (east - FALSE_EAST) / RADIUS
    x, e = xi - _sums(BACKWARD, xi, eta, F.sin, F.cosh), eta - _sums(BACKWARD, xi, eta, F.cos, F.sinh)
    conformal = F.asinh(F.sin(x) / F.sqrt(F.sinh(e) * F.sinh(e) + F.cos(x) * F.cos(x)))
    sine = F.tanh(conformal)
    for _ in range(rounds):
        sine = F.tanh(conformal + F.lit(E) * F.atanh(F.lit(E) * sine))
    return F.degrees(F.asin(sine)), F.degrees(F.atan2(F.sinh(e), F.cos(x))) + _meridian(zone)


def pixel_area_m2(east: Column, north: Column, zone: Column, south: Column, pixel_m: float = 20.0) -> Column:
    """The area on the ellipsoid of a pixel around a place: that of the plane divided by the square of
    the scale there, which UTM keeps within 1 in 1,000 of 0.9996. The scale follows from the distance
    to the central meridian and the radii of curvature at the latitude."""
    lat, _ = from_utm(east, north, zone, south)
    sine = F.sin(F.radians(lat))
    w = 1 - F.lit(E * E) * sine * sine
    across, along = F.lit(A) / F.sqrt(w), F.lit(A * (1 - E * E)) / (w * F.sqrt(w))
    d = (east - FALSE_EAST) / K0
    q = d * d / (across * along)
    scale = F.lit(K0) * (1 + q / 2 + q * q / 24)
    return F.lit(pixel_m * pixel_m) / (scale * scale)
