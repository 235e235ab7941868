"""Incremental ingestion of places: a stream of elements, each place taken once by its fingerprint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import normalise
from ..sources.schemas import ELEMENT


def read_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Elements as JSON lines, as files arrive."""
    return spark.readStream.schema(ELEMENT).json(folder)


def fresh_places(elements: DataFrame, stop_words: list[str]) -> DataFrame:
    """Named points, each (norm, cell of about 100 m) once over the life of the stream."""
    lat, lon = F.coalesce("lat", "center.lat"), F.coalesce("lon", "center.lon")
    named = elements.select(F.col("tags")["name"].alias("name"), lat.alias("lat"), lon.alias("lon")).filter("name IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL")
    keyed = named.withColumn("norm", normalise(F.col("name"), stop_words)).withColumn("fingerprint", F.xxhash64("norm", F.round(F.col("lat") * 1000).cast("long"), F.round(F.col("lon") * 1000).cast("long")))
    return keyed.dropDuplicates(["fingerprint"])
