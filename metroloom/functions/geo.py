"""Distances and schematic geometry as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: IUGG mean earth radius in metres.
EARTH_RADIUS_M = 6_371_008.8
#: Fixed values of the drawing surface and its compression.
CANVAS_WIDTH, CANVAS_HEIGHT, MARGIN = 1000, 1500, 60
GAMMA = 0.62


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres (F1); null if a coordinate is null."""
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), F.lit(2.0))
    h = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    # least() skips nulls, so the null of a missing end is kept by the multiplication
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.when(h < 1, F.sqrt(h)).when(h >= 1, F.lit(1.0)))


def mercator(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Web Mercator in radians."""
    return F.radians(lon), F.ln(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2))


def compress(v: Column, centre: Column, radius: Column, largest: Column) -> Column:
    """One coordinate after radial compression about the centre (F8); points at the centre stay."""
    factor = largest * F.pow(radius / largest, F.lit(GAMMA)) / radius
    return F.when((radius < 1e-12) | (largest <= 0), v).otherwise(centre + (v - centre) * factor)


def octilinear(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Points of a run - diagonal - run connector (F10) as array<struct<x,y>>."""
    dx, dy = bx - ax, by - ay
    wide, tall = F.abs(dx), F.abs(dy)
    run = F.abs(wide - tall) / 2
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    a, b = point(ax, ay), point(bx, by)
    level = F.array(a, point(ax + F.signum(dx) * run, ay), point(bx - F.signum(dx) * run, by), b)
    upright = F.array(a, point(ax, ay + F.signum(dy) * run), point(bx, by - F.signum(dy) * run), b)
    direct = (wide < 0.5) | (tall < 0.5) | (F.abs(wide - tall) < 0.5)
    return F.when(direct, F.array(a, b)).when(wide > tall, level).otherwise(upright)


def svg_path(points: Column) -> Column:
    """``Mx y Lx y`` at one decimal."""
    return F.array_join(F.transform(points, lambda p, i: F.concat(F.when(i == 0, F.lit("M")).otherwise(F.lit("L")), F.format_string("%.1f %.1f", p["x"], p["y"]))), " ")


def xml_escape(text: Column) -> Column:
    """Text for SVG."""
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text
