"""Geometry as arithmetic on plain coordinates.

The grid CRS is EPSG:25830 (transverse Mercator, zone 30, GRS80); geographic coordinates are degrees.
The projection is the Krueger series to fourth order in the third flattening.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# GRS80 ellipsoid and UTM zone 30.
GRS80_A = 6378137.0
GRS80_F = 1.0 / 298.257222101
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_LON0_DEG = -3.0

_N = GRS80_F / (2.0 - GRS80_F)
_E = math.sqrt(GRS80_F * (2.0 - GRS80_F))
_RADIUS = GRS80_A / (1.0 + _N) * (1.0 + _N**2 / 4.0 + _N**4 / 64.0)
# Krueger series coefficients.
_FORWARD = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
_INVERSE = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
_LATITUDE = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)


def lonlat_to_xy(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to grid metres."""
    phi = F.radians(lat)
    lam = F.radians(lon - UTM_LON0_DEG)
    sin_phi = F.sin(phi)
    t = F.sinh(F.atanh(sin_phi) - _E * F.atanh(_E * sin_phi))
    xi = F.atan2(t, F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(1.0 + t * t))
    x = eta
    y = xi
    for j, a in enumerate(_FORWARD, start=1):
        x = x + a * F.cos(2.0 * j * xi) * F.sinh(2.0 * j * eta)
        y = y + a * F.sin(2.0 * j * xi) * F.cosh(2.0 * j * eta)
    return UTM_FALSE_EASTING + UTM_K0 * _RADIUS * x, UTM_K0 * _RADIUS * y


def xy_to_lonlat(x: Column, y: Column) -> tuple[Column, Column]:
    """Grid metres to degrees."""
    xi = y / (UTM_K0 * _RADIUS)
    eta = (x - UTM_FALSE_EASTING) / (UTM_K0 * _RADIUS)
    xi1 = xi
    eta1 = eta
    for j, b in enumerate(_INVERSE, start=1):
        xi1 = xi1 - b * F.sin(2.0 * j * xi) * F.cosh(2.0 * j * eta)
        eta1 = eta1 - b * F.cos(2.0 * j * xi) * F.sinh(2.0 * j * eta)
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    lat = chi
    for j, d in enumerate(_LATITUDE, start=1):
        lat = lat + d * F.sin(2.0 * j * chi)
    lon = F.atan2(F.sinh(eta1), F.cos(xi1))
    return UTM_LON0_DEG + F.degrees(lon), F.degrees(lat)


def in_box(x: Column, y: Column, box: tuple[float, float, float, float]) -> Column:
    """Closed box given as xmin, xmax, ymin, ymax."""
    return x.between(box[0], box[1]) & y.between(box[2], box[3])


def within_buffered_box(
    x: Column, y: Column, xmin: Column, xmax: Column, ymin: Column, ymax: Column, distance: float
) -> Column:
    """Point within ``distance`` of a box; the buffer has round corners."""
    dx = F.greatest(xmin - x, F.lit(0.0), x - xmax)
    dy = F.greatest(ymin - y, F.lit(0.0), y - ymax)
    return dx * dx + dy * dy <= distance * distance


def point_wkt(x: Column, y: Column, decimals: int = 1) -> Column:
    fmt = f"%.{decimals}f"
    return F.format_string(f"POINT ({fmt} {fmt})", x, y)


def box_wkt(xmin: Column, ymin: Column, xmax: Column, ymax: Column, decimals: int = 1) -> Column:
    p = f"%.{decimals}f %.{decimals}f"
    return F.format_string(
        f"POLYGON (({p}, {p}, {p}, {p}, {p}))", xmin, ymin, xmax, ymin, xmax, ymax, xmin, ymax, xmin, ymin
    )


def _double_hex(v: Column) -> Column:
    """The 16 hex digits, lowest byte first, of a finite normal double; NULL of what is not finite."""
    v = F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)
    size = F.abs(v)
    guess = F.floor(F.log2(size)).cast("int")
    # log2 may round across a power of two; put the exponent right on either side.
    e = (
        F.when(F.pow(F.lit(2.0), guess) > size, guess - 1)
        .when(F.pow(F.lit(2.0), guess + 1) <= size, guess + 1)
        .otherwise(guess)
    )
    fraction = ((size / F.pow(F.lit(2.0), e) - 1.0) * float(2**52)).cast("bigint")
    bits = F.shiftleft((e + 1023).cast("bigint"), 52) + fraction
    signed = F.when(v < 0, bits.bitwiseOR(F.lit(-(2**63)))).otherwise(bits)
    text = F.lpad(F.hex(F.when(v == 0, F.lit(0).cast("bigint")).otherwise(signed)), 16, "0")
    return F.concat(*[F.substring(text, 15 - 2 * k, 2) for k in range(8)])


def point_wkb_hex(x: Column, y: Column) -> Column:
    """Little-endian WKB of a point as upper-case hex, without leaving the JVM."""
    return F.concat(F.lit("0101000000"), _double_hex(x), _double_hex(y))


# Geohash alphabet.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def geohash(lon: Column, lat: Column, precision: int) -> Column:
    """Geohash text: bits of longitude and latitude interleaved, five to a character."""
    bits = 5 * precision
    lon_bits = (bits + 1) // 2
    lat_bits = bits // 2
    u = F.least(F.floor((lon + 180.0) / 360.0 * 2.0**lon_bits), F.lit(2**lon_bits - 1))
    v = F.least(F.floor((lat + 90.0) / 180.0 * 2.0**lat_bits), F.lit(2**lat_bits - 1))
    chars = []
    for c in range(precision):
        value = F.lit(0)
        for b in range(5):
            k = 5 * c + b
            source, left = (u, lon_bits - 1 - k // 2) if k % 2 == 0 else (v, lat_bits - 1 - k // 2)
            value = value * 2 + F.shiftright(source, left).bitwiseAND(F.lit(1))
        chars.append(F.substring(F.lit(GEOHASH_ALPHABET), (value + 1).cast("int"), F.lit(1)))
    return F.concat(*chars)
