"""Curated decision tables as rows (S6, S7): every document read with its schema, keys that begin with ``$`` left out."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import Overrides
from . import schemas
from .elements import read_document


def rows(spark: SparkSession, path: str, field: str, item: T.DataType) -> DataFrame:
    """The items of one array field, with their ordinal."""
    doc = read_document(spark, path, T.StructType().add(field, T.ArrayType(item)))
    return doc.select(F.posexplode(field).alias("ord", "r")).select("ord", "r.*")


def lines(spark: SparkSession, path: str) -> DataFrame:
    t = rows(spark, path, "lines", schemas.CURATED_LINE)
    names = {"relationId": "relation_id", "assertRef": "assert_ref", "assertNameIncludes": "assert_name_includes", "stationOrder": "station_order", "wayTag": "way_tag", "stationTag": "station_tag", "assertStops": "assert_stops", "publishedRouteLengthKm": "published_km", "lengthFloorRatio": "length_floor", "displayName": "display_name", "serviceClass": "service_class"}
    return t.withColumnsRenamed(names)


def operators(spark: SparkSession, path: str) -> DataFrame:
    return rows(spark, path, "operators", schemas.OPERATOR).withColumnsRenamed({"shortName": "short_name", "fareRule": "fare_rule", "statusSince": "status_since", "statusNote": "status_note"})


def slabs(spark: SparkSession, path: str) -> DataFrame:
    """One row a slab: operator, class, confidence, max_km (null: unbounded), fare_paise."""
    return rows(spark, path, "tables", schemas.FARE_TABLE).select("operator", "class", "confidence", F.explode("slabs").alias("s")).select("operator", "class", "confidence", F.col("s.maxKm").alias("max_km"), F.col("s.farePaise").alias("fare_paise"))


def pair_fares(spark: SparkSession, path: str) -> DataFrame:
    """One row a pair: both ends with the table's operator, ready to be resolved."""
    t = rows(spark, path, "tables", schemas.OVERRIDE_TABLE).select("operator", "class", F.explode("pairs").alias("p"))
    return t.select("operator", "class", F.col("p.a").alias("a_name"), F.col("operator").alias("a_operator"), F.col("p.b").alias("b_name"), F.col("operator").alias("b_operator"), F.col("p.farePaise").alias("fare_paise"))


def links(spark: SparkSession, path: str) -> DataFrame:
    """Confirmed walks; rejected ones are documentation and stay out."""
    t = rows(spark, path, "links", schemas.LINK)
    return t.select("ord", F.col("a.name").alias("a_name"), F.col("a.operator").alias("a_operator"), F.col("b.name").alias("b_name"), F.col("b.operator").alias("b_operator"), F.col("distanceM").alias("distance_m"))


def speeds(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Mode profiles and service-class overrides."""

    def table(field: str, key: str) -> DataFrame:
        plain = {k: v for k, v in json.loads(Path(path).read_text())[field].items() if not k.startswith("$")}
        return spark.createDataFrame([(k, float(v["runningSpeedKmph"]), int(v["dwellSeconds"])) for k, v in plain.items()], f"{key} string, speed_kmph double, dwell_s int")

    return table("modes", "mode"), table("serviceClassOverrides", "service_class")


def name_rules(path: str) -> tuple[Overrides, list[tuple[str, float]], list[tuple[str, str, float]]]:
    """Name overrides, guarded names with their spread, forced groups."""
    raw = json.loads(Path(path).read_text())
    guards = [(g["norm"], float(g["maxClusterSpreadM"])) for g in (raw.get("doNotMerge") or {}).get("names", [])]
    forced = [(g["norm"], g["operator"], float(g["maxSpreadM"])) for g in (raw.get("forceMerge") or {}).get("groups", [])]
    return Overrides.from_json(raw), guards, forced
