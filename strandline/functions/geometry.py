"""Plane geometry on x, y columns and on arrays of ``struct<x, y>``."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def ring_contains(ring: Column, x: Column, y: Column) -> Column:
    """Whether a point lies in a ring (array of points, first repeated last or not), by crossings of a ray to the right."""
    n = F.size(ring)
    sides = F.zip_with(
        ring,
        F.concat(F.slice(ring, 2, n - 1), F.slice(ring, 1, 1)),
        lambda a, b: ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * F.try_divide(y - a["y"], b["y"] - a["y"]) + a["x"]),
    )
    return F.size(F.filter(sides, lambda s: s)) % 2 == 1


def on_segment(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """The point of the segment a-b nearest to p, as ``struct<x, y>``."""
    dx, dy = bx - ax, by - ay
    u = F.coalesce(F.try_divide((px - ax) * dx + (py - ay) * dy, dx * dx + dy * dy), F.lit(0.0))
    u = F.least(F.lit(1.0), F.greatest(F.lit(0.0), u))
    return F.struct((ax + u * dx).alias("x"), (ay + u * dy).alias("y"))


def crossing(a: tuple, b: tuple, c: tuple, d: tuple) -> Column:
    """The point where segments a-b and c-d meet, as ``struct<x, y>``; NULL if they don't, or are parallel.

    Each end is a pair of columns.
    """
    rx, ry, sx, sy = b[0] - a[0], b[1] - a[1], d[0] - c[0], d[1] - c[1]
    cross = rx * sy - ry * sx
    t = F.try_divide((c[0] - a[0]) * sy - (c[1] - a[1]) * sx, cross)
    u = F.try_divide((c[0] - a[0]) * ry - (c[1] - a[1]) * rx, cross)
    return F.when(t.between(0, 1) & u.between(0, 1), F.struct((a[0] + t * rx).alias("x"), (a[1] + t * ry).alias("y")))


def in_disc(dx: Column, dy: Column, radius: float, shape: str = "polygon") -> Column:
    """Strictly within a buffer: the disc, or the 64-sided polygon inscribed in it."""
    if shape == "disc":
        return dx * dx + dy * dy < radius * radius
    d = F.hypot(dx, dy)
    step = math.pi / 32
    return d * F.cos(F.pmod(F.atan2(dy, dx), F.lit(step)) - step / 2) < radius * math.cos(step / 2)


def along(distance: Column, sx: Column, sy: Column, ex: Column, ey: Column) -> Column:
    """The point at a distance along a segment: clamped to it, negative distances from its end."""
    length = F.hypot(ex - sx, ey - sy)
    at = F.least(length, F.greatest(F.lit(0.0), F.when(distance < 0, length + distance).otherwise(distance)))
    u = F.coalesce(F.try_divide(at, length), F.lit(0.0))
    return F.struct((sx + u * (ex - sx)).alias("x"), (sy + u * (ey - sy)).alias("y"))


def ray_end(x: Column, y: Column, distance: Column, bearing: Column) -> Column:
    """The end of a ray of a length and a bearing in degrees from north."""
    turn = F.radians(bearing)
    return F.struct((x + distance * F.sin(turn)).alias("x"), (y + distance * F.cos(turn)).alias("y"))


def azimuth(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Bearing from one point to another in (0, 360]; due north is 360."""
    angle = F.degrees(F.atan2(x2 - x1, y2 - y1))
    return F.when(angle <= 0, angle + 360).otherwise(angle)


def line_is_valid(points: Column) -> Column:
    """A line has at least two different points."""
    return F.size(F.array_distinct(points)) >= 2
