"""Profiling and build reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import pad

#: Roles of stops; qualities of segments.
STOP_ROLES = ["stop", "stop_entry_only", "stop_exit_only"]
QUALITIES = ["measured", "measured-snapped", "estimated-gap", "unlocatable"]


def cut(x: Column | str, width: int) -> Column:
    """Report text of a fixed width: cut, then padded."""
    return pad(F.substring(x, 1, width), width)


def is_stop(role: Column) -> Column:
    """P1."""
    return role.isin(STOP_ROLES)


def element_counts(elements: DataFrame) -> DataFrame:
    """A14."""
    return elements.agg(*[F.count_if(F.col("type") == t).alias(f"{t}s") for t in ("node", "way", "relation")])


def route_summary(relations: DataFrame) -> DataFrame:
    """One row a relation with defaults (P2). relations: id, tags, members."""
    tag = lambda *ks: F.coalesce(*[F.col("tags")[k] for k in ks], F.lit("—"))
    stops = F.filter("members", lambda m: is_stop(m["role"]))
    return relations.select("id", tag("ref").alias("ref"), tag("name").alias("name"), tag("from").alias("origin"), tag("to").alias("destination"), tag("network").alias("network"), tag("colour", "color").alias("colour"), F.size(stops).alias("stops"), F.size(F.filter("members", lambda m: m["type"] == "way")).alias("ways"))


def natural_order(ref: str, name: str) -> list[Column]:
    """Numbers by value, then the rest, then the name in locale order (O1)."""
    number = F.try_to_number(F.nullif(F.regexp_extract(ref, r"^\D*(\d{1,18})", 1), F.lit("")), F.lit("999999999999999999"))
    return [F.regexp_extract(ref, r"^(\D*)", 1), number.asc_nulls_first(), F.col(ref), F.collate(name, "UNICODE")]


def stop_names(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Stop names in member order with a placeholder for unnamed ones (P10, P15). members: rel_id, pos, ref, role."""
    named = members.filter(is_stop(F.col("role"))).join(nodes.select(F.col("id").alias("ref"), F.col("tags")["name"].alias("name")), "ref", "left")
    return named.select("rel_id", "pos", F.coalesce("name", F.concat(F.lit("<"), F.col("ref"), F.lit(">"))).alias("name"))


def name_anomaly(name: Column) -> Column:
    """The first rule a name breaks, null for none."""
    return F.when(name.rlike(r"^<.*>$"), "unresolved").when(name.rlike(r"\(.*\)"), "parenthesis").when(name.rlike(r"\[.*\]"), "bracket").when(name.rlike(r"(?i)\b(station|junction|terminus|metro)\b"), "stop word").when(name.rlike(r"[^\x00-\x7F]"), "non-ASCII")


def quality_counts(segments: DataFrame) -> DataFrame:
    """Segments of each quality by line, zero where there are none (A1)."""
    return segments.groupBy("line_id").agg(*[F.count_if(F.col("quality") == q).alias(q.replace("-", "_")) for q in QUALITIES])


def edge_quality(edges: DataFrame) -> DataFrame:
    """A2."""
    return edges.groupBy("quality").agg(F.count("*").alias("edges"))


def extraction(lines: DataFrame, stops: DataFrame, segments: DataFrame) -> DataFrame:
    """R2: a row a line: stops, total length, qualities, against the published length."""
    s = stops.groupBy("line_id").agg(F.count("*").alias("stops"), F.count_distinct("norm").alias("names"), F.max("snap_m").alias("worst_snap_m"))
    m = segments.groupBy("line_id").agg(F.sum("dist_m").alias("total_m"))
    return lines.join(s, "line_id", "left").join(m, "line_id", "left").join(quality_counts(segments), "line_id", "left").withColumn("ratio", F.col("total_m") / (F.col("published_km") * 1000))


def first_rows(df: DataFrame, n: int, *order: Column | str) -> tuple[DataFrame, int]:
    """The first n rows of a listing and how many more there are."""
    return df.orderBy(*order).limit(n), max(0, df.count() - n)


def build_totals(lines: DataFrame, stations: DataFrame, edges: DataFrame, walks: DataFrame, operators: DataFrame, fare_tables: DataFrame) -> DataFrame:
    """One row."""
    one = lambda df, *cols: df.agg(*cols)
    parts = [
        one(lines, F.count("*").alias("lines")),
        one(stations, F.count("*").alias("stations")),
        one(edges, F.count("*").alias("edges")),
        one(walks, F.count("*").alias("walks")),
        one(operators, F.count("*").alias("operators"), F.count_if(F.col("status") == "suspended").alias("suspended")),
        one(fare_tables, F.count("*").alias("fare_tables"), F.count_if(F.col("confidence") == "verified").alias("verified")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(F.broadcast(p))  # single rows
    return out


def dump_stops(relations: DataFrame, nodes: DataFrame, ref: str) -> DataFrame:
    """Stop names in order of every relation with this ref (P15). relations: id, tags, members."""
    own = relations.filter(F.col("tags")["ref"] == ref).select(F.col("id").alias("rel_id"), F.posexplode("members").alias("pos", "m")).select("rel_id", "pos", "m.ref", "m.role")
    return stop_names(own, nodes).orderBy("rel_id", "pos")


def unrouted_stations(nodes: DataFrame) -> DataFrame:
    """Station-like nodes by name, for datasets without routes."""
    kind = F.coalesce(F.col("tags")["railway"], F.col("tags")["public_transport"])
    return nodes.filter(kind.isin("station", "halt", "stop_position")).select("id", F.coalesce(F.col("tags")["name"], F.lit("—")).alias("name"), kind.alias("kind")).orderBy("name", "id")


def unmeasured(segments: DataFrame) -> DataFrame:
    """Segments that were not measured along the track."""
    return segments.filter("quality <> 'measured'").orderBy("line_id", "segment")


def inspection(relations: DataFrame, nodes: DataFrame) -> DataFrame:
    """Routes in natural order with how many of their stops are unresolved or oddly named."""
    members = relations.select(F.col("id").alias("rel_id"), F.posexplode("members").alias("pos", "m")).select("rel_id", "pos", "m.ref", "m.role")
    odd = stop_names(members, nodes).groupBy(F.col("rel_id").alias("id")).agg(F.count_if(name_anomaly(F.col("name")) == "unresolved").alias("unresolved"), F.count_if(name_anomaly(F.col("name")).isNotNull()).alias("anomalies"))
    return route_summary(relations).join(odd, "id", "left").na.fill(0, ["unresolved", "anomalies"]).orderBy(*natural_order("ref", "name"))


def clustering(stations: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row: stations, merged ones, wide ones, candidates of equal and of different names."""
    s = stations.agg(F.count("*").alias("stations"), F.count_if(F.size("line_ids") > 1).alias("merged"), F.count_if(F.col("spread_m") > 200).alias("wide"))
    same = F.col("a_display") == F.col("b_display")
    c = candidates.agg(F.count_if(same).alias("same_name"), F.count_if(~same).alias("different_name"), F.count_if("connects_disjoint_lines").alias("useful"))
    return s.crossJoin(F.broadcast(c))  # single rows
