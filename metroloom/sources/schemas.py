"""Explicit schemas of all documents; nothing is inferred (section 1)."""

from __future__ import annotations

from pyspark.sql import types as T

TAGS = T.MapType(T.StringType(), T.StringType())
POINT = T.StructType().add("lat", "double").add("lon", "double")
MEMBER = T.StructType().add("type", "string").add("ref", "long").add("role", "string")
ELEMENT = T.StructType().add("type", "string").add("id", "long").add("lat", "double").add("lon", "double").add("nodes", T.ArrayType(T.LongType())).add("members", T.ArrayType(MEMBER)).add("tags", TAGS).add("center", POINT)
RESPONSE = T.StructType().add("version", "double").add("generator", "string").add("osm3s", T.StructType().add("timestamp_osm_base", "string")).add("elements", T.ArrayType(ELEMENT))
CACHE_META = T.StructType().add("query", "string").add("endpoint", "string").add("fetchedAt", "string").add("osmTimestamp", "string").add("counts", T.StructType().add("nodes", "long").add("ways", "long").add("relations", "long"))
TAG_FILTER = T.StructType().add("key", "string").add("value", "string")
CURATED_LINE = (
    T.StructType().add("id", "string").add("dataset", "string").add("source", "string").add("relationId", "long").add("assertRef", "string").add("assertNameIncludes", "string").add("stationOrder", T.ArrayType(T.StringType()))
    .add("wayTag", TAG_FILTER).add("stationTag", TAG_FILTER).add("assertStops", "integer").add("publishedRouteLengthKm", "double").add("lengthFloorRatio", "double").add("displayName", "string").add("operator", "string").add("mode", "string").add("serviceClass", "string").add("coverage", "string")
)
OPERATOR = T.StructType().add("id", "string").add("name", "string").add("shortName", "string").add("authority", "string").add("fareRule", "string").add("status", "string").add("statusSince", "string").add("statusNote", "string").add("classes", T.ArrayType(T.StringType()))
SLAB = T.StructType().add("maxKm", "double").add("farePaise", "integer")
FARE_TABLE = T.StructType().add("operator", "string").add("class", "string").add("confidence", "string").add("source", "string").add("verifiedOn", "string").add("slabs", T.ArrayType(SLAB))
PAIR = T.StructType().add("a", "string").add("b", "string").add("farePaise", "integer")
OVERRIDE_TABLE = T.StructType().add("operator", "string").add("class", "string").add("confidence", "string").add("source", "string").add("verifiedOn", "string").add("pairs", T.ArrayType(PAIR))
LINK_END = T.StructType().add("name", "string").add("operator", "string")
LINK = T.StructType().add("a", LINK_END).add("b", LINK_END).add("distanceM", "integer").add("reason", "string")
