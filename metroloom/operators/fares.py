"""Fares (J16, J17, W7): inclusive distance slabs, exact overrides of unordered pairs; integer paise."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def slab_bounds(slabs: DataFrame, keys: list[str]) -> DataFrame:
    """Adds lo_km, the bound of the slab before (W7); a null max_km is unbounded and comes last."""
    order = Window.partitionBy(*keys).orderBy(F.col("max_km").asc_nulls_last())
    return slabs.withColumn("lo_km", F.lag("max_km").over(order))


def slab_fares(trips: DataFrame, slabs: DataFrame, keys: list[str], km: str = "km") -> DataFrame:
    """Trips with fare_paise of the first slab whose max_km is not below km (J16); null beyond all slabs.

    Slab tables are curated (tens of rows): each key's slabs travel as one sorted array, so the join
    is an equi-join on the keys and no trip meets a slab that is not its own."""
    arrays = slabs.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.coalesce("max_km", F.lit(float("inf"))).alias("max_km"), "fare_paise"))).alias("slabs"))
    met = trips.join(F.broadcast(arrays), keys, "left")  # one row a curated table
    first = F.get(F.filter("slabs", lambda s: s["max_km"] >= F.col(km)), F.lit(0))
    return met.withColumn("fare_paise", first["fare_paise"]).drop("slabs")


def pair_fares(trips: DataFrame, overrides: DataFrame, keys: list[str], a: str = "a", b: str = "b") -> DataFrame:
    """Replaces fare_paise where the unordered pair has an exact fare."""
    exact = overrides.select(*keys, F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"), F.col("fare_paise").alias("exact_paise"))
    met = trips.withColumns({"lo": F.least(a, b), "hi": F.greatest(a, b)}).join(exact, [*keys, "lo", "hi"], "left")
    return met.withColumn("fare_paise", F.coalesce("exact_paise", "fare_paise")).drop("exact_paise", "lo", "hi")
