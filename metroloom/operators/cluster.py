"""Entity resolution of line stops into stations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine_m
from ..functions.numbers import half_up
from ..plans.prefix import ranked
from .components import components
from .radius import pairs_within

#: Fixed values, in metres: same station; candidate for a walk.
MERGE_RADIUS_M, INTERCHANGE_RADIUS_M = 250.0, 800.0


def merge_edges(stops: DataFrame) -> DataFrame:
    """Pairs of stops (by ``ord``) with one name and operator at most MERGE_RADIUS_M apart."""
    return pairs_within(stops, MERGE_RADIUS_M, "ord", equal=("norm", "operator")).select("a", "b")


def forced_edges(stops: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs inside curated (norm, operator) groups within the group's own wider radius.

    Pairs within the widest radius come from the grid; each group then keeps those within its own."""
    g = groups.select("norm", "operator", F.col("max_spread_m").cast("double").alias("max_spread_m"))
    widest = g.agg(F.max("max_spread_m")).first()[0] or 0.0  # of a curated table
    inside = stops.join(F.broadcast(g.select("norm", "operator")), ["norm", "operator"], "left_semi")
    near = pairs_within(inside, widest or 1.0, "ord", equal=("norm", "operator"), keep=True)
    return near.join(F.broadcast(g), ["norm", "operator"]).filter("distance_m <= max_spread_m").select("norm", "operator", "a", "b")


def label(stops: DataFrame, edges: DataFrame) -> DataFrame:
    """Adds ``root``: the smallest ord of a stop's component, its own if it has no edge."""
    found = components(edges).select(F.col("node").alias("ord"), "component")
    return stops.join(found, "ord", "left").withColumn("root", F.coalesce("component", "ord")).drop("component")


def cluster_stops(stops: DataFrame, groups: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Stops with ``station_id`` (0-based rank of first members, W6), and what each forced group joined.

    stops: ord, line_id, operator, stop_index, display, short, norm, lat, lon, aliases."""
    edges = merge_edges(stops)
    before = label(stops, edges)
    applied = None
    after = before
    if groups is not None:
        extra = forced_edges(stops, groups)
        after = label(stops, edges.union(extra.select("a", "b")))
        count = lambda df, n: df.join(F.broadcast(groups.select("norm", "operator")), ["norm", "operator"]).groupBy("norm", "operator").agg(F.count_distinct("root").alias(n))  # noqa: E731  curated rows
        applied = groups.join(count(before, "was"), ["norm", "operator"], "left").join(count(after, "now"), ["norm", "operator"], "left").withColumn("unioned", F.coalesce(F.col("was") - F.col("now"), F.lit(0))).drop("was", "now")
    roots = after.select("root").distinct()
    return after.join(ranked(roots, ["root"], "station_id"), "root").drop("root"), applied


def spread(members: DataFrame) -> DataFrame:
    """Largest pairwise distance in each station (A8), 0 for one member.

    Only rows that can end the longest line are paired: with r a row's distance from the station's mean place and
    R the largest r, no pair of the row is longer than r + R, and the longest is at least that from the row
    at R to the row farthest from it."""
    at = lambda a, b: haversine_m(F.col(f"{a}.lat"), F.col(f"{a}.lon"), F.col(f"{b}.lat"), F.col(f"{b}.lon"))
    one = members.select("station_id", "ord", F.struct("lat", "lon").alias("p"))
    mean = one.groupBy("station_id").agg(F.struct(F.avg("p.lat").alias("lat"), F.avg("p.lon").alias("lon")).alias("c"))
    placed = one.join(mean, "station_id").withColumn("r", at("p", "c")).drop("c")
    outer = placed.groupBy("station_id").agg(F.max("r").alias("most"), F.max_by("p", F.struct("r", "ord")).alias("q"))
    placed = placed.join(outer, "station_id").withColumn("d", at("p", "q")).drop("q")
    least = placed.groupBy("station_id").agg(F.max("d").alias("least"))
    ends = placed.join(least, "station_id").filter(F.col("r") + F.col("most") >= F.col("least") - 1e-3).select("station_id", "ord", "p")
    two = ends.select("station_id", F.col("ord").alias("other"), F.col("p").alias("q"))
    far = ends.join(two, "station_id").filter("ord < other").groupBy("station_id").agg(F.max(at("p", "q")).alias("far"))
    return least.join(far, "station_id", "left").select("station_id", F.coalesce("far", F.lit(0.0)).alias("spread_m"))


def distinct_in_order(values: str, order: str = "ord") -> F.Column:
    """Distinct values of a group in the order of first appearance."""
    rows = F.sort_array(F.collect_list(F.struct(order, values)))
    return F.array_distinct(F.transform(rows, lambda r: r[values]))


def materialise_stations(members: DataFrame) -> DataFrame:
    """One row per station (A7): longest display (first among equals), first short, mean place, lists in order."""
    first_short = F.min_by("short", F.when(F.col("short").isNotNull(), F.col("ord")))
    alias_lists = F.sort_array(F.collect_list(F.struct("ord", "aliases")))
    stations = members.groupBy("station_id").agg(
        F.max_by(F.struct("display", "norm"), F.struct(F.length("display"), -F.col("ord"))).alias("best"),
        first_short.alias("short"),
        F.avg("lat").alias("lat"),
        F.avg("lon").alias("lon"),
        F.array_distinct(F.flatten(F.transform(alias_lists, lambda r: r["aliases"]))).alias("aliases"),
        distinct_in_order("line_id").alias("line_ids"),
        distinct_in_order("operator").alias("operators"),
        F.count("*").alias("members"),
    )
    return stations.join(spread(members), "station_id").select("station_id", "best.display", "short", "best.norm", "lat", "lon", "aliases", "line_ids", "operators", "members", "spread_m")


def propose_interchanges(stations: DataFrame) -> DataFrame:
    """Station pairs within INTERCHANGE_RADIUS_M (J9), and whether they share no line (P16); sorted (O2)."""
    near = pairs_within(stations, INTERCHANGE_RADIUS_M, "station_id")
    side = lambda s: stations.select(F.col("station_id").alias(s), F.col("display").alias(f"{s}_display"), F.col("operators")[0].alias(f"{s}_operator"), F.col("line_ids").alias(f"{s}_lines"))
    both = near.join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", "a_display", "b_display", "a_operator", "b_operator", half_up(F.col("distance_m")).alias("distance_m"), "a_lines", "b_lines", (~F.arrays_overlap("a_lines", "b_lines")).alias("connects_disjoint_lines")).orderBy("distance_m", "a", "b")


def merged_stations(stations: DataFrame) -> DataFrame:
    """Stations on more than one line (A20), most lines first (O3)."""
    return stations.filter(F.size("line_ids") > 1).orderBy(F.desc(F.size("line_ids")), "station_id")


def guard_spread(stations: DataFrame, guards: DataFrame) -> DataFrame:
    """Largest spread of the stations of each guarded name, 0 if there is none."""
    found = stations.groupBy("norm").agg(F.max("spread_m").alias("spread"))
    return guards.join(found, "norm", "left").select("norm", "max_spread_m", F.coalesce("spread", F.lit(0.0)).alias("spread_m"))
