"""Colours: OKLCH to sRGB, hex text, candidate grid, distances."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The public OKLab matrices (LMS' from Lab, linear sRGB from LMS).
LAB_TO_LMS = [(0.3963377774, 0.2158037573), (-0.1055613458, -0.0638541728), (-0.0894841775, -1.291485548)]
LMS_TO_RGB = [(4.0767416621, -3.3077115913, 0.2309699292), (-1.2684380046, 2.6097574011, -0.3413193965), (-0.0041960863, -0.7034186147, 1.707614701)]
#: Fixed value: chromas tried, strongest first.
CHROMAS = (0.20, 0.18, 0.16, 0.14, 0.12)
EPSILON = 1e-4


def oklch_to_rgb(lightness: Column, chroma: Column, hue_degrees: Column) -> Column:
    """array of three 0-255 integers; null if the colour lies outside sRGB."""
    a, b = chroma * F.cos(F.radians(hue_degrees)), chroma * F.sin(F.radians(hue_degrees))
    lms = [F.pow(lightness + ka * a + kb * b, F.lit(3.0)) for ka, kb in LAB_TO_LMS]
    linear = [sum((k * x for k, x in zip(row[1:], lms[1:], strict=True)), row[0] * lms[0]) for row in LMS_TO_RGB]
    inside = linear[0].between(-EPSILON, 1 + EPSILON) & linear[1].between(-EPSILON, 1 + EPSILON) & linear[2].between(-EPSILON, 1 + EPSILON)
    held = [F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)) for c in linear]
    gamma = [F.when(c <= 0.0031308, 12.92 * c).otherwise(1.055 * F.pow(c, F.lit(1 / 2.4)) - 0.055) for c in held]
    return F.when(inside, F.array(*[F.floor(g * 255 + 0.5).cast("int") for g in gamma]))


def to_hex(rgb: Column) -> Column:
    """``#rrggbb`` (F16)."""
    return F.concat(F.lit("#"), *[F.lower(F.lpad(F.hex(rgb[i].cast("bigint")), 2, "0")) for i in range(3)])


def hue_at(lightness: Column, hue: Column) -> Column:
    """The hex of the strongest chroma inside sRGB, null if none is."""
    shown = F.transform(F.array(*map(F.lit, CHROMAS)), lambda c: to_hex(oklch_to_rgb(lightness, c, hue)))
    return F.get(F.filter(shown, lambda x: x.isNotNull()), F.lit(0))


def candidate_grid(spark: SparkSession, hues: int, levels: list[tuple[str, float, float]]) -> DataFrame:
    """hue, level, light, dark of every hue and level that both modes can show."""
    steps = spark.range(hues).select((F.col("id") * (360.0 / hues)).alias("hue"))
    table = spark.createDataFrame(levels, "level string, l_light double, l_dark double")
    grid = steps.crossJoin(F.broadcast(table))  # a configured grid
    shown = grid.select("hue", "level", hue_at(F.col("l_light"), F.col("hue")).alias("light"), hue_at(F.col("l_dark"), F.col("hue")).alias("dark"))
    return shown.filter("light IS NOT NULL AND dark IS NOT NULL")


def oklab(hex_colour: str) -> tuple[float, float, float]:
    """OKLab of a hex colour, for the driver's small searches."""
    rgb = [int(hex_colour[i : i + 2], 16) / 255 for i in (1, 3, 5)]
    lin = [c / 12.92 if c <= 0.04045 else ((c + 0.055) / 1.055) ** 2.4 for c in rgb]
    # the inverse of LMS_TO_RGB by Cramer's rule
    m = LMS_TO_RGB
    det = sum(m[0][i] * (m[1][(i + 1) % 3] * m[2][(i + 2) % 3] - m[1][(i + 2) % 3] * m[2][(i + 1) % 3]) for i in range(3))
    inv = [[(m[(j + 1) % 3][(i + 1) % 3] * m[(j + 2) % 3][(i + 2) % 3] - m[(j + 1) % 3][(i + 2) % 3] * m[(j + 2) % 3][(i + 1) % 3]) / det for j in range(3)] for i in range(3)]
    roots = [math.copysign(abs(v) ** (1 / 3), v) for v in (sum(k * x for k, x in zip(row, lin, strict=True)) for row in inv)]
    lms_to_lab = [(0.2104542553, 0.793617785, -0.0040720468), (1.9779984951, -2.428592205, 0.4505937099), (0.0259040371, 0.7827717662, -0.808675766)]
    return tuple(sum(k * x for k, x in zip(row, roots, strict=True)) for row in lms_to_lab)


def delta_e(a: str, b: str) -> float:
    """Euclidean distance in OKLab times 100, a published measure of difference."""
    return 100 * math.dist(oklab(a), oklab(b))
