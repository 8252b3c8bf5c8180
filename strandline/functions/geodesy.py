"""Coordinates on the ellipsoid: projections, bearings, geohashes and degree notations."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.functions.numbers import let

#: GRS80.
A, FLAT = 6378137.0, 1 / 298.257222101
E2 = FLAT * (2 - FLAT)
E1 = math.sqrt(E2)
#: Australian Albers: standard parallels, origin (degrees).
PARALLELS, ORIGIN = (-18.0, -36.0), (0.0, 132.0)
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"


def _q(sin: float) -> float:
    return (1 - E2) * (sin / (1 - E2 * sin * sin) - math.log((1 - E1 * sin) / (1 + E1 * sin)) / (2 * E1))


def albers_constants(parallels=PARALLELS, origin=ORIGIN) -> tuple[float, float, float]:
    """n, C and rho0 of an equal-area conic projection of the ellipsoid."""
    s1, s2 = (math.sin(math.radians(p)) for p in parallels)
    m1, m2 = (math.cos(math.radians(p)) / math.sqrt(1 - E2 * s * s) for p, s in zip(parallels, (s1, s2), strict=True))
    n = (m1 * m1 - m2 * m2) / (_q(s2) - _q(s1))
    c = m1 * m1 + n * _q(s1)
    return n, c, A * math.sqrt(c - n * _q(math.sin(math.radians(origin[0])))) / n


def albers(lon: Column, lat: Column, parallels=PARALLELS, origin=ORIGIN) -> Column:
    """Degrees to metres, as ``struct<x, y>``."""
    n, c, rho0 = albers_constants(parallels, origin)
    sin = F.sin(F.radians(lat))
    q = (1 - E2) * (sin / (1 - E2 * sin * sin) - F.ln((1 - E1 * sin) / (1 + E1 * sin)) / (2 * E1))
    rho = A * F.sqrt(c - n * q) / n
    theta = n * F.radians(lon - origin[1])
    return F.struct((rho * F.sin(theta)).alias("x"), (rho0 - rho * F.cos(theta)).alias("y"))


def albers_inverse(x: Column, y: Column, parallels=PARALLELS, origin=ORIGIN) -> Column:
    """Metres to degrees, as ``struct<lon, lat>``; the latitude from the authalic one by series (to some millimetres)."""
    n, c, rho0 = albers_constants(parallels, origin)
    side = 1 if n > 0 else -1
    rho = F.hypot(x, rho0 - y)
    theta = F.atan2(side * x, side * (rho0 - y))
    q = (c - F.pow(rho * n / A, F.lit(2.0))) / n
    beta = F.asin(q / _q(1.0))
    e4, e6 = E2 * E2, E2**3
    lat = (
        beta
        + (E2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta)
        + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta)
        + 761 * e6 / 45360 * F.sin(6 * beta)
    )
    return F.struct((origin[1] + F.degrees(theta) / n).alias("lon"), F.degrees(lat).alias("lat"))


def transverse_mercator(lon: Column, lat: Column, meridian, scale: float = 0.9996, east: float = 500000.0, north: float = 1e7) -> Column:
    """Degrees to a transverse Mercator grid such as UTM south, by the usual series; metres, as ``struct<x, y>``."""
    ep2, e4, e6 = E2 / (1 - E2), E2 * E2, E2**3
    phi = F.radians(lat)

    def place(v: Column) -> Column:
        nu, t, c, a, m = (v[k] for k in ("nu", "t", "c", "a", "m"))
        a2 = a * a
        x = a * (1 + (1 - t + c) * a2 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * a2 * a2 / 120)
        y = a2 * (0.5 + (5 - t + 9 * c + 4 * c * c) * a2 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * a2 * a2 / 720)
        return F.struct((east + scale * nu * x).alias("x"), (north + scale * (m + nu * F.sqrt(t) * F.signum(m) * y)).alias("y"))

    m = A * (
        (1 - E2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * phi
        - (3 * E2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * F.sin(2 * phi)
        + (15 * e4 / 256 + 45 * e6 / 1024) * F.sin(4 * phi)
        - 35 * e6 / 3072 * F.sin(6 * phi)
    )
    parts = F.struct(
        (A / F.sqrt(1 - E2 * F.pow(F.sin(phi), F.lit(2.0)))).alias("nu"),
        F.pow(F.tan(phi), F.lit(2.0)).alias("t"),
        (ep2 * F.pow(F.cos(phi), F.lit(2.0))).alias("c"),
        (F.cos(phi) * F.radians(lon - meridian)).alias("a"),
        m.alias("m"),
    )
    return let(parts, place)


def transverse_mercator_inverse(x: Column, y: Column, meridian, scale: float = 0.9996, east: float = 500000.0, north: float = 1e7) -> Column:
    """Metres of a transverse Mercator grid to degrees, as ``struct<lon, lat>``; the usual series (to some millimetres in a zone)."""
    ep2 = E2 / (1 - E2)
    e1 = (1 - math.sqrt(1 - E2)) / (1 + math.sqrt(1 - E2))

    def foot(mu: Column) -> Column:
        return (
            mu
            + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu)
            + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu)
            + 151 * e1**3 / 96 * F.sin(6 * mu)
            + 1097 * e1**4 / 512 * F.sin(8 * mu)
        )

    def parts(phi: Column) -> Column:
        w = 1 - E2 * F.pow(F.sin(phi), F.lit(2.0))
        return F.struct(
            phi.alias("phi"), F.cos(phi).alias("cos"), F.tan(phi).alias("tan"), (ep2 * F.pow(F.cos(phi), F.lit(2.0))).alias("c"),
            (w / (1 - E2)).alias("ratio"), ((x - east) * F.sqrt(w) / (A * scale)).alias("d"),
        )

    def place(v: Column) -> Column:
        d, c, t = v["d"], v["c"], v["tan"] * v["tan"]
        d2 = d * d
        lat = v["phi"] - v["ratio"] * v["tan"] * d2 * (
            0.5
            - (5 + 3 * t + 10 * c - 4 * c * c - 9 * ep2) * d2 / 24
            + (61 + 90 * t + 298 * c + 45 * t * t - 252 * ep2 - 3 * c * c) * d2 * d2 / 720
        )
        lon = d * (1 - (1 + 2 * t + c) * d2 / 6 + (5 - 2 * c + 28 * t - 3 * c * c + 8 * ep2 + 24 * t * t) * d2 * d2 / 120) / v["cos"]
        return F.struct((meridian + F.degrees(lon)).alias("lon"), F.degrees(lat).alias("lat"))

    mu = (y - north) / scale / (A * (1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256))
    return let(let(let(mu, foot), parts), place)


def utm_to_albers(x: Column, y: Column, zone) -> Column:
    """A place in a southern UTM zone (a number or a column) on the Albers plane."""
    return let(transverse_mercator_inverse(x, y, zone * 6 - 183), lambda p: albers(p["lon"], p["lat"]))


def bearing(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Initial bearing in [0, 180): a line's direction without its sense. Reduced latitudes on the sphere."""
    u1, u2 = (F.atan((1 - FLAT) * F.tan(F.radians(v))) for v in (lat1, lat2))
    d = F.radians(lon2 - lon1)
    angle = F.atan2(F.sin(d) * F.cos(u2), F.cos(u1) * F.sin(u2) - F.sin(u1) * F.cos(u2) * F.cos(d))
    return F.pmod(F.degrees(angle), F.lit(180.0))


def geohash(lon: Column, lat: Column, precision: int = 10) -> Column:
    """The geohash of a point: longitude and latitude halvings interleaved, five bits a character."""
    lon_bits, lat_bits = (5 * precision + 1) // 2, 5 * precision // 2

    def cell(v, low, span, bits):
        return F.least(F.lit((1 << bits) - 1), F.floor((v - low) / span * float(1 << bits)).cast("long"))

    x, y = cell(lon, -180.0, 360.0, lon_bits), cell(lat, -90.0, 180.0, lat_bits)
    chars = []
    for k in range(precision):
        value = F.lit(0).cast("long")
        for b in range(5 * k, 5 * k + 5):  # even bits are of the longitude, from the highest
            source, at = (x, lon_bits - 1 - b // 2) if b % 2 == 0 else (y, lat_bits - 1 - b // 2)
            value = value * 2 + F.shiftright(source, at).bitwiseAND(F.lit(1).cast("long"))
        chars.append(F.substring(F.lit(BASE32), (value + 1).cast("int"), F.lit(1)))
    return F.concat(*chars)


def dms_to_degrees(text: Column) -> Column:
    """``d°m's`` as degrees: minutes and seconds are added to positive degrees and taken from all others, zero too."""
    part = F.split(text, "[°'\"]")
    d, m, s = (F.coalesce(F.get(part, k).try_cast("double"), F.lit(0.0)) for k in range(3))
    rest = m / 60 + s / 3600
    return F.when(d > 0, d + rest).otherwise(d - rest)
