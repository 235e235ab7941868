"""Ordered track geometry: stitching, cumulative distance, locating, ordering and measuring stops
(G1, W1-W4, J1, J11, J12, G11-G15, A3, A4, F14). Ordinals are columns; nothing relies on row order."""

from __future__ import annotations

import itertools
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import haversine_m
from ..plans.scratch import dealt
from .radius import near_cells, own_cell

#: How far a stop may lie beside the track (metres); detour over an unmapped gap; bands.
MAX_SNAP_M, GAP_DETOUR = 400.0, 1.08
LENGTH_BAND, LENGTH_FLOOR = 1.02, 0.9


def join_ways(ways: Iterable[list[int]]) -> list[list[int]]:
    """Chains of an ordered run of ways (G1).

    A way joins at the chain's end, then reversed at the end, then at its front, then reversed at the
    front; one that fits nowhere begins a new chain. Ways of fewer than two nodes are left out. A chain grows
    at both ends of a queue, so the work is that of reading the nodes."""
    chains: list[deque[int]] = []
    for way in ways:
        if way is None or len(way) < 2:
            continue
        chain = chains[-1] if chains else None
        if chain is not None and chain[-1] in (way[0], way[-1]):
            chain.extend((way if way[0] == chain[-1] else way[::-1])[1:])
        elif chain is not None and chain[0] in (way[0], way[-1]):
            chain.extendleft((way if way[0] == chain[0] else way[::-1])[1:])
        else:
            chains.append(deque(way))
    return [list(c) for c in chains]


def stitch(members: DataFrame, ways: DataFrame) -> DataFrame:
    """(line_id, chain, pos, node_id) of each line's way members in member order; unknown ways are left out.

    A line's ways pass in order through one task, which holds that line alone."""
    kind = members.schema["line_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = None

        def rows() -> Iterator[tuple]:
            nonlocal lines
            for b in batches:
                lines = b.schema.field(0).type
                yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)

        for line, group in itertools.groupby(rows(), key=lambda r: r[0]):
            for k, chain in enumerate(join_ways(w for _, w in group)):
                n = len(chain)
                yield pa.RecordBatch.from_arrays([pa.array([line] * n, lines), pa.array([k] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(chain, pa.int64())], ["line_id", "chain", "pos", "node_id"])

    known = members.select("line_id", "pos", "way_id").join(ways.select("way_id", F.col("nodes").cast("array<bigint>").alias("nodes")), "way_id")
    return dealt(known, "line_id", order=("pos",)).select("line_id", "nodes").mapInArrow(run, f"line_id {kind}, chain int, pos int, node_id bigint")


def cumulative(chains: DataFrame, nodes: DataFrame) -> DataFrame:
    """Adds lat, lon and cum_m (W1): a node without coordinates adds nothing, the next one measures from the last known."""
    placed = chains.join(nodes.select("node_id", "lat", "lon"), "node_id", "left")
    order = Window.partitionBy("line_id", "chain").orderBy("pos")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    where = F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.struct("lat", "lon"))
    prev = F.last(where, ignorenulls=True).over(before)
    step = placed.withColumn("prev", prev).withColumn("step", F.coalesce(haversine_m(F.col("prev.lat"), F.col("prev.lon"), F.col("lat"), F.col("lon")), F.lit(0.0)))
    return step.withColumn("cum_m", F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("prev", "step")


def locate(stops: DataFrame, chains: DataFrame) -> DataFrame:
    """Adds chain, chain_pos, cum_m, method, snap_m to stops (J11); nulls where a stop cannot be placed.

    A stop on the track takes its first chain and position; otherwise the nearest track node of its
    line within MAX_SNAP_M, the first among equals. stops: line_id, idx, node_id, lat, lon."""
    hit = stops.select("line_id", "idx", "node_id").join(chains.select("line_id", "node_id", "chain", "pos", "cum_m"), ["line_id", "node_id"])
    exact = hit.groupBy("line_id", "idx").agg(F.min(F.struct("chain", "pos", "cum_m")).alias("e"))
    off = stops.join(exact, ["line_id", "idx"], "left_anti").filter("lat IS NOT NULL AND lon IS NOT NULL")
    probes = off.select("line_id", "idx", F.col("lat").alias("slat"), F.col("lon").alias("slon"), near_cells(F.col("lat"), F.col("lon"), MAX_SNAP_M).alias("c")).select("line_id", "idx", "slat", "slon", "c.cy", "c.cx")
    track = chains.filter("lat IS NOT NULL AND lon IS NOT NULL").select("line_id", "chain", "pos", "cum_m", "lat", "lon", *own_cell(F.col("lat"), F.col("lon"), MAX_SNAP_M))
    near = probes.join(track, ["line_id", "cy", "cx"]).withColumn("d", haversine_m(F.col("slat"), F.col("slon"), F.col("lat"), F.col("lon"))).filter(F.col("d") <= MAX_SNAP_M)
    snapped = near.groupBy("line_id", "idx").agg(F.min(F.struct("d", "chain", "pos", "cum_m")).alias("s"))
    both = stops.join(exact, ["line_id", "idx"], "left").join(snapped, ["line_id", "idx"], "left")
    pick = lambda c: F.coalesce(F.col(f"e.{c}"), F.col(f"s.{c}"))
    method = F.when(F.col("e").isNotNull(), "on-chain").when(F.col("s").isNotNull(), "snapped")
    return both.withColumns({"chain": pick("chain"), "chain_pos": pick("pos"), "cum_m": pick("cum_m"), "method": method, "snap_m": F.when(F.col("e").isNotNull(), F.lit(0.0)).otherwise(F.col("s.d"))}).drop("e", "s")


def order_stops(located: DataFrame) -> DataFrame:
    """Stops with geo_idx along the track and what was found.

    Only if all placed stops of a line lie on one chain; otherwise member order stays and
    line_chain is null. Unplaced stops have a null geo_idx on an ordered line. Adds: line_chain,
    chains_with_stops, direction, member_rank (among placed stops), geo_idx, reordered."""
    line = Window.partitionBy("line_id")
    placed = F.col("chain").isNotNull()
    found = F.sort_array(F.collect_set("chain").over(line))
    ends = located.withColumns(
        {
            "chains_with_stops": found,
            "first_pos": F.min_by("chain_pos", F.when(placed, F.col("idx"))).over(line),
            "last_pos": F.max_by("chain_pos", F.when(placed, F.col("idx"))).over(line),
        }
    )
    one = F.size("chains_with_stops") == 1
    ends = ends.withColumns({"line_chain": F.when(one, F.col("chains_with_stops")[0]), "direction": F.when(one & (F.col("last_pos") < F.col("first_pos")), "backward").otherwise("forward")})
    by_member = Window.partitionBy("line_id", placed).orderBy("idx")
    along = F.when(F.col("direction") == "forward", F.col("chain_pos")).otherwise(-F.col("chain_pos"))
    by_track = Window.partitionBy("line_id", placed).orderBy("along", "idx")
    ranked = ends.withColumn("along", along).withColumns({"member_rank": F.when(placed, F.row_number().over(by_member) - 1), "track_rank": F.when(placed, F.row_number().over(by_track) - 1)})
    geo = F.when(F.col("line_chain").isNotNull(), F.col("track_rank")).otherwise(F.col("idx"))
    return ranked.withColumns({"geo_idx": geo, "reordered": F.coalesce(F.col("line_chain").isNotNull() & (F.col("member_rank") != F.col("track_rank")), F.lit(False))}).drop("first_pos", "last_pos", "along", "track_rank")


def consecutive(stops: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """Pairs i, i+1 of each line (W2): the given columns as from_ and to_."""
    w = Window.partitionBy("line_id").orderBy(order)
    ahead = F.lead(F.struct(*columns)).over(w)
    rows = stops.select("line_id", (F.row_number().over(w) - 1).alias("segment"), F.struct(*columns).alias("f"), ahead.alias("t")).filter("t IS NOT NULL")
    return rows.select("line_id", "segment", *[F.col(f"f.{c}").alias(f"from_{c}") for c in columns], *[F.col(f"t.{c}").alias(f"to_{c}") for c in columns])


def measure(stops: DataFrame, order: str = "geo_idx") -> DataFrame:
    """line_id, segment, ends, dist_m, quality of consecutive stops."""
    s = consecutive(stops.filter(F.col(order).isNotNull()), order, ["node_id", "lat", "lon", "chain", "cum_m", "method"])
    chord = haversine_m(F.col("from_lat"), F.col("from_lon"), F.col("to_lat"), F.col("to_lon"))
    lost = F.col("from_chain").isNull() | F.col("to_chain").isNull() | chord.isNull()
    same = F.col("from_chain") == F.col("to_chain")
    snapped = (F.col("from_method") == "snapped") | (F.col("to_method") == "snapped")
    dist = F.when(lost, F.coalesce(chord, F.lit(0.0))).when(same, F.abs(F.col("to_cum_m") - F.col("from_cum_m"))).otherwise(chord * GAP_DETOUR)
    quality = F.when(lost, "unlocatable").when(same & snapped, "measured-snapped").when(same, "measured").otherwise("estimated-gap")
    return s.select("line_id", "segment", "from_node_id", "to_node_id", dist.alias("dist_m"), quality.alias("quality"))


def measure_calibrated(stops: DataFrame, published: DataFrame, order: str = "idx") -> DataFrame:
    """As measure, over several chains (G13): gaps are chords scaled so that a line's total is the published one.

    published: line_id, total_m (null: no scaling). Adds factor (null: nothing was scaled)."""
    s = consecutive(stops, order, ["node_id", "lat", "lon", "chain", "cum_m"])
    chord = haversine_m(F.col("from_lat"), F.col("from_lon"), F.col("to_lat"), F.col("to_lon"))
    same = F.coalesce(F.col("from_chain") == F.col("to_chain"), F.lit(False))
    quality = F.when(chord.isNull(), "unlocatable").when(same, "measured").otherwise("estimated-gap")
    raw = F.when(chord.isNull(), F.lit(0.0)).when(same, F.abs(F.col("to_cum_m") - F.col("from_cum_m"))).otherwise(chord)
    rows = s.select("line_id", "segment", "from_node_id", "to_node_id", raw.alias("raw"), quality.alias("quality")).join(published, "line_id", "left")
    line = Window.partitionBy("line_id")
    total = lambda q: F.coalesce(F.sum(F.when(F.col("quality") == q, F.col("raw"))).over(line), F.lit(0.0))
    factor = F.when(F.col("total_m").isNotNull() & (F.col("estimated_m") > 0), (F.col("total_m") - F.col("measured_m")) / F.col("estimated_m"))
    rows = rows.withColumns({"measured_m": total("measured"), "estimated_m": total("estimated-gap")}).withColumn("factor", factor)
    scaled = F.when((F.col("quality") == "estimated-gap") & (F.col("factor") > 0), F.col("raw") * F.col("factor")).otherwise(F.col("raw"))
    return rows.select("line_id", "segment", "from_node_id", "to_node_id", scaled.alias("dist_m"), "quality", "factor")


def reconcile(wanted: DataFrame, found: DataFrame, on: list[str]) -> DataFrame:
    """Keys of one side only, with ``side`` missing or extra."""
    w, f = wanted.select(*on).distinct(), found.select(*on).distinct()
    return w.join(f, on, "left_anti").withColumn("side", F.lit("missing")).unionByName(f.join(w, on, "left_anti").withColumn("side", F.lit("extra")))


def last_wins(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """Of rows with one key the last by ``order``."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(order)))).filter("_k = 1").drop("_k")


def length_ratio(measured_m: Column, published_km: Column, floor: Column) -> Column:
    """``long``, ``short`` or null against the published length."""
    ratio = measured_m / (published_km * 1000)
    return F.when(ratio > LENGTH_BAND, "long").when(ratio < F.coalesce(floor, F.lit(LENGTH_FLOOR)), "short")
