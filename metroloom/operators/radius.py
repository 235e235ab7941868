"""Radius and nearest joins by grid cells (J8-J10): an equi-join on cells, then the exact inclusive distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine_m

#: Metres in a degree of latitude, rounded down so that cells are never too small.
METRES_A_DEGREE = 111_000.0
#: How often a search for the nearest halves its cells.
HALVINGS = 7


def row_of(lat: Column, radius_m: float) -> Column:
    """Rows of cells are as high as the radius."""
    return F.floor(lat / (radius_m / METRES_A_DEGREE))


def cells_round(row: Column, radius_m: float) -> Column:
    """Cells of a row round the globe: as wide as the radius at the row's or a neighbour's latitude farthest
    from the equator, so a row near a pole has few and no other row is the wider for it."""
    high = radius_m / METRES_A_DEGREE
    most = F.greatest(F.abs(row - 1), F.abs(row + 2)) * high
    wide = high / F.cos(F.radians(F.least(most, F.lit(89.9))))
    return F.when(most >= 89.9, F.lit(1)).otherwise(F.greatest(F.floor(360 / wide), F.lit(1))).cast("bigint")


def column_of(lon: Column, n: Column) -> Column:
    return F.pmod(F.floor((lon + 180) / (360 / n)), n)


def own_cell(lat: Column, lon: Column, radius_m: float) -> list[Column]:
    row = row_of(lat, radius_m)
    return [row.alias("cy"), column_of(lon, cells_round(row, radius_m)).alias("cx")]


def near_cells(lat: Column, lon: Column, radius_m: float) -> Column:
    """The cells of three rows that can hold a point within the radius; beyond longitude 180 they go on at -180."""

    def cells(y: int) -> Column:
        row = row_of(lat, radius_m) + y
        n = cells_round(row, radius_m)
        x = column_of(lon, n)
        return F.transform(F.array_distinct(F.array(*[F.pmod(x + d, n) for d in (-1, 0, 1)])), lambda c: F.struct(row.alias("cy"), c.alias("cx")))

    return F.explode(F.concat(*[cells(y) for y in (-1, 0, 1)]))


def pairs_within(points: DataFrame, radius_m: float, key: str, lat: str = "lat", lon: str = "lon", equal: tuple[str, ...] = (), keep: bool = False) -> DataFrame:
    """(a, b, distance_m), a < b, of points at most ``radius_m`` apart (inclusive) that agree on ``equal``; ``keep``: with those columns."""
    p = points.select(F.col(key).alias("a"), F.col(lat).alias("alat"), F.col(lon).alias("alon"), *equal, near_cells(F.col(lat), F.col(lon), radius_m).alias("c")).select("*", "c.cy", "c.cx").drop("c")
    q = points.select(F.col(key).alias("b"), F.col(lat).alias("blat"), F.col(lon).alias("blon"), *equal, *own_cell(F.col(lat), F.col(lon), radius_m))
    joined = p.join(q, [*equal, "cy", "cx"]).filter("a < b")
    return joined.withColumn("distance_m", haversine_m(F.col("alat"), F.col("alon"), F.col("blat"), F.col("blon"))).filter(F.col("distance_m") <= radius_m).select(*(equal if keep else ()), "a", "b", "distance_m")


def nearest_within(left: DataFrame, right: DataFrame, cap_m: float, left_key: str, right_key: str, order: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """(left_key, right_key, distance_m) for every left row: its nearest right row within the cap
    (inclusive), the first by ``order`` among equals; nulls where there is none.

    Rows at one place are searched once and stand for each other. Cells are as large as the cap and its halves: some
    right row of a left row's own cells says how far the nearest can be at most, and the search goes over the cells
    of the least size that reaches so far, of the cap where the own cells are empty."""
    sizes = F.array(*[F.lit(cap_m / 2**k) for k in range(HALVINGS + 1)])
    in_cells = lambda df, y, x: df.select("*", F.posexplode(sizes).alias("level", "size")).select("*", *own_cell(F.col(y), F.col(x), F.col("size"))).drop("size")
    distance = haversine_m(F.col("alat"), F.col("alon"), F.col("blat"), F.col("blon"))
    places = left.select(F.col(lat).alias("alat"), F.col(lon).alias("alon")).distinct()
    firsts = right.groupBy(F.col(lat).alias("blat"), F.col(lon).alias("blon")).agg(F.min(F.struct(F.col(order).alias("o"), F.col(right_key).alias("r"))).alias("first"))
    filed = in_cells(firsts, "blat", "blon")
    some = filed.groupBy("level", "cy", "cx").agg(F.min(F.struct("blat", "blon")).alias("some")).select("level", "cy", "cx", "some.*")
    bound = in_cells(places, "alat", "alon").join(some, ["level", "cy", "cx"], "left").groupBy("alat", "alon").agg(F.min(distance).alias("most"))
    level = F.greatest(F.size(F.filter(sizes, lambda s: s >= F.col("most"))) - 1, F.lit(0))
    asked = bound.withColumn("level", level).select("alat", "alon", "level", near_cells(F.col("alat"), F.col("alon"), F.get(sizes, F.col("level"))).alias("c")).select("alat", "alon", "level", "c.cy", "c.cx")
    met = asked.join(filed, ["level", "cy", "cx"]).withColumn("d", distance).filter(F.col("d") <= cap_m)
    best = met.groupBy("alat", "alon").agg(F.min(F.struct("d", "first")).alias("best"))
    rows = left.select(F.col(left_key).alias("l"), F.col(lat).alias("alat"), F.col(lon).alias("alon")).join(best, ["alat", "alon"], "left")
    return rows.select(F.col("l").alias(left_key), F.col("best.first.r").alias(right_key), F.col("best.d").alias("distance_m"))
