"""Map elements: documents, typed tables and source-side selectors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.chains import last_wins
from . import schemas


def read_document(spark: SparkSession, path: str, schema) -> DataFrame:
    """One JSON document a file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """All elements with their ordinal in the document."""
    doc = read_document(spark, path, schemas.RESPONSE)
    return doc.select(F.posexplode("elements").alias("ord", "e")).select("ord", "e.*")


def split(elements: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """nodes, ways, relations; of repeated ids the last counts."""
    one = last_wins(elements, ["type", "id"], "ord")
    nodes = one.filter("type = 'node'").select("id", "lat", "lon", "tags", "ord")
    ways = one.filter("type = 'way'").select("id", "nodes", "tags", "center", "ord")
    return nodes, ways, one.filter("type = 'relation'").select("id", "members", "tags", "center", "ord")


def has_tag(key: str, value: str | None = None) -> Column:
    """Tag present, or equal to a value."""
    tag = F.col("tags")[key]
    return tag.isNotNull() if value is None else F.coalesce(tag == value, F.lit(False))


def tag_like(key: str, pattern: str) -> Column:
    """Tag matches a pattern without case."""
    return F.coalesce(F.col("tags")[key].rlike(f"(?i){pattern}"), F.lit(False))


def in_box(south: float, west: float, north: float, east: float) -> Column:
    """Own point, or centre, inside a box."""
    lat, lon = F.coalesce("lat", "center.lat"), F.coalesce("lon", "center.lon")
    return F.coalesce(lat.between(south, north) & lon.between(west, east), F.lit(False))


def union_of(parts: list[DataFrame]) -> DataFrame:
    """Union of selections as a set."""
    return reduce(DataFrame.unionByName, parts).dropDuplicates(["type", "id"])


def descend(selected: DataFrame, elements: DataFrame, depth: int = 3) -> DataFrame:
    """Selected elements with all members and nodes under them (S20); nested relations to ``depth``."""
    found = selected
    level = selected
    for _ in range(depth):
        refs = level.select(F.explode_outer("members").alias("m")).select(F.col("m.type").alias("type"), F.col("m.ref").alias("id")).union(level.select(F.lit("node").alias("type"), F.explode("nodes").alias("id")))
        level = elements.join(refs.filter("id IS NOT NULL").distinct(), ["type", "id"], "left_semi")
        found = found.unionByName(level)
    return found.dropDuplicates(["type", "id"])


def centres(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Centre of each way's bounding box."""
    at = ways.select("id", F.explode("nodes").alias("node_id")).join(nodes.select(F.col("id").alias("node_id"), "lat", "lon"), "node_id")
    box = at.groupBy("id").agg(((F.min("lat") + F.max("lat")) / 2).alias("lat"), ((F.min("lon") + F.max("lon")) / 2).alias("lon"))
    return box.select("id", F.struct("lat", "lon").alias("center"))
