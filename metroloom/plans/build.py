"""The stages as one lazy plan: extraction, clustering, network; checks are tables beside the results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import Overrides, resolve
from ..operators import chains, checks, cluster, network
from ..operators.reports import is_stop


@dataclass
class Extracted:
    stops: DataFrame
    segments: DataFrame
    checks: DataFrame


def extract(lines: DataFrame, nodes: DataFrame, ways: DataFrame, relations: DataFrame, names: Overrides) -> Extracted:
    """Relation lines (G15): members to stops and chains, order by geometry, names, segments, checks.

    lines: line_id, relation_id, operator, published_km, length_floor."""
    members = lines.join(relations.select(F.col("id").alias("relation_id"), "members"), "relation_id").select("line_id", "operator", F.posexplode("members").alias("pos", "m")).select("line_id", "operator", "pos", "m.*")
    coords = nodes.select(F.col("id").alias("node_id"), "lat", "lon")
    track = chains.cumulative(chains.stitch(members.filter("type = 'way'").select("line_id", "pos", F.col("ref").alias("way_id")), ways.select(F.col("id").alias("way_id"), "nodes")), coords)
    at = members.filter((F.col("type") == "node") & is_stop(F.col("role"))).select("line_id", "operator", F.col("pos").alias("idx"), F.col("ref").alias("node_id"))
    ordered = chains.order_stops(chains.locate(at.join(coords, "node_id", "left"), track))
    named = resolve(nodes.select(F.col("id").alias("node_id"), "tags"), names, node_id="node_id").drop("tags")
    stops = ordered.join(named, "node_id", "left")
    segments = chains.measure(ordered)
    found = checks.union([checks.stop_names(stops), checks.stop_order(ordered), checks.line_lengths(lines.withColumnRenamed("line_id", "id"), segments)])
    return Extracted(stops, segments, found)


def extract_ordered(line_id: str, order: DataFrame, station_nodes: DataFrame, track_ways: DataFrame, coords: DataFrame, published_m: float, assert_stops: int | None = None) -> Extracted:
    """A line given as names in order, without a relation (G14): names against tagged nodes both ways, then calibrated segments.

    order: idx, name; station_nodes: node_id, name, ord, lat, lon (of equal names the last counts);
    track_ways: way_id, nodes, ord."""
    spark = order.sparkSession
    known = chains.last_wins(station_nodes.filter("name IS NOT NULL"), ["name"], "ord")
    diff = chains.reconcile(order.select("name"), known.select("name"), ["name"])
    track = chains.cumulative(chains.stitch(track_ways.select(F.lit(line_id).alias("line_id"), F.col("ord").alias("pos"), "way_id"), track_ways.select("way_id", "nodes")), coords)
    stops = chains.locate(order.join(known.select("name", "node_id", "lat", "lon"), "name").select(F.lit(line_id).alias("line_id"), "idx", "node_id", "name", "lat", "lon"), track)
    segments = chains.measure_calibrated(stops, spark.createDataFrame([(line_id, published_m)], "line_id string, total_m double"))
    factors = segments.groupBy("line_id").agg(F.max("factor").alias("factor"))
    nameless = station_nodes.filter("name IS NULL").select(F.lit(line_id).alias("line_id"), "node_id", F.lit(None).cast("string").alias("display"), F.lit(None).cast("string").alias("name_source"))
    return Extracted(stops, segments, checks.union([checks.station_order(diff, line_id, order, assert_stops), checks.calibration(factors), checks.stop_names(nameless)]))


def stations(stops: DataFrame, forced: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Members with station ids, stations, and forced groups with what they joined."""
    members, applied = cluster.cluster_stops(stops, forced)
    return members, cluster.materialise_stations(members), applied


def assemble(lines: DataFrame, segments: DataFrame, members: DataFrame, station_table: DataFrame, links: DataFrame, modes: DataFrame, classes: DataFrame, families: DataFrame) -> dict[str, DataFrame]:
    """Tables of the routable network, and the faults of its edges."""
    timed = network.speeds(network.line_styles(lines, families), modes, classes)
    edge_rows, faults = network.edges(segments, members, timed)
    rows = network.station_rows(station_table)
    walks = network.interchanges(links, station_table.withColumn("operator", F.col("operators")[0]))
    return {"lines": timed, "stations": rows, "edges": edge_rows, "interchanges": walks, "faults": faults}
