"""Further queries, each with its SQL: extraction of whole lines with planted faults, rules, reports, the place index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import colour, names
from ..functions.numbers import half_up, pad
from ..operators import chains, checks, cluster, layout, network, places, reports
from ..sources import sinks
from . import build
from .prefix import ranked
from .queries import CUSTOMER_PAIRS, CUSTOMERS, METRES, REACH, SUPPLIERS, cluster_input, customers, edge_table, element_rows, hav, place_sql, query, suppliers, table, walk_table

FAR = 1_000_000
#: Node names of the lines below: some have only a reference, some nothing at all.
RULES = names.Overrides(trailing_words=["Halt"], stop_words=["supplier"], aliases={"Supplier 5": ["Five", "V"]})


# -- lines made of suppliers (track and stops on it) and customers (stops beside it) -------------
def line_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """lines, nodes, ways, relations. Ways join a nation's suppliers in order; every fifth nation's track lacks its middle way."""
    s, c = suppliers(spark, sf_dir), customers(spark, sf_dir)
    i = F.col("id")
    name = F.when(i % 9 == 0, F.lit(None)).when(i % 9 == 1, F.lit("")).otherwise(F.concat(F.lit("Supplier "), i.cast("string"), F.lit(" Halt")))
    ref = F.when(i % 9 == 0, F.concat(F.lit("R"), i.cast("string")))
    tags = F.map_filter(F.create_map(F.lit("name"), name, F.lit("ref"), ref), lambda _, v: v.isNotNull())
    far = F.map_filter(F.create_map(F.lit("name"), F.col("name")), lambda _, v: v.isNotNull())
    nodes = s.select("id", "lat", "lon", tags.alias("tags")).unionByName(c.select((i + FAR).alias("id"), "lat", "lon", far.alias("tags")))
    w = Window.partitionBy("nation").orderBy("id")
    track = s.select("nation", "id", F.row_number().over(w).alias("k"), F.lead("id").over(w).alias("next"), F.count("*").over(Window.partitionBy("nation")).alias("m")).filter("next IS NOT NULL").filter(~((F.col("nation") % 5 == 3) & (F.col("k") == F.floor(F.col("m") / 2))))
    ways = track.select(F.col("id").alias("id"), "nation", "k", F.array("id", "next").alias("nodes"))
    ways = ways.withColumn("nodes", F.when((F.col("k") % 3 == 2) & (F.col("nation") % 5 != 3), F.reverse("nodes")).otherwise(F.col("nodes")))
    stops = s.select("nation", i.alias("ref")).union(c.select("nation", (i + FAR).alias("ref")))
    member = lambda kind, ref, role, order: F.struct(order.alias("o"), F.lit(kind).alias("type"), ref.alias("ref"), F.lit(role).alias("role"))
    r = F.col("ref")
    rows = stops.select("nation", member("node", r, "stop", F.struct(F.lit(0).alias("w"), (r * 7 % 11).cast("bigint").alias("x"), r.alias("y"))).alias("m"))
    rows = rows.union(ways.select("nation", member("way", i, "", F.struct(F.lit(1).alias("w"), F.col("k").cast("bigint").alias("x"), i.alias("y"))).alias("m")))
    relations = rows.groupBy(F.col("nation").cast("bigint").alias("id")).agg(F.sort_array(F.collect_list("m")).alias("m")).select("id", F.transform("m", lambda x: F.struct(x["type"].alias("type"), x["ref"].alias("ref"), x["role"].alias("role"))).alias("members"))
    key = F.col("n_nationkey")
    lines = table(spark, sf_dir, "nation").select(key.alias("line_id"), key.cast("bigint").alias("relation_id"), F.lit("one").alias("operator"), (key * 400.0 + 1).alias("published_km"), F.when(key % 2 == 0, F.lit(0.5)).alias("length_floor"))
    return lines, nodes, ways.select("id", "nodes"), relations


def extracted(spark: SparkSession, sf_dir: str) -> build.Extracted:
    return build.extract(*line_tables(spark, sf_dir), RULES)


#: The same in SQL: where each stop lies, its order and the segments between stops.
LINES_SQL = f"""{SUPPLIERS}, cus AS (SELECT c_custkey AS id, c_nationkey AS nation, c_name AS name, {place_sql("c_custkey", 3000)} FROM customer),
    cnt AS (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY id) - 1 AS k, count(*) OVER (PARTITION BY nation) AS m FROM sup),
    part AS (SELECT *, CASE WHEN nation % 5 = 3 AND m > 1 AND k >= m // 2 THEN 1 ELSE 0 END AS half FROM cnt),
    sized AS (SELECT *, count(*) OVER (PARTITION BY nation, half) AS parts, row_number() OVER (PARTITION BY nation, half ORDER BY id) - 1 AS pos FROM part),
    held AS (SELECT *, dense_rank() OVER (PARTITION BY nation ORDER BY half) - 1 AS chain FROM sized WHERE parts > 1),
    steps AS (SELECT x.*, CASE WHEN p.id IS NULL THEN 0 ELSE {hav("p", "x")} END AS step FROM held x LEFT JOIN held p ON p.nation = x.nation AND p.chain = x.chain AND p.pos = x.pos - 1),
    run AS (SELECT nation, id, lat, lon, chain, pos, sum(step) OVER (PARTITION BY nation, chain ORDER BY pos) AS cum FROM steps),
    raw AS (SELECT nation, id AS node, lat, lon FROM sup UNION ALL SELECT nation, id + {FAR}, lat, lon FROM cus),
    stops AS (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY node * 7 % 11, node) - 1 AS idx FROM raw),
    snap AS (SELECT s.nation, s.node, arg_min(struct_pack(chain := r.chain, pos := r.pos, cum := r.cum), ({hav("s", "r")}, r.chain, r.pos)) AS hit, min({hav("s", "r")}) AS d FROM stops s JOIN run r ON r.nation = s.nation WHERE {hav("s", "r")} <= 400 GROUP BY s.nation, s.node),
    placed AS (SELECT s.*, coalesce(e.chain, n.hit.chain) AS chain, coalesce(e.pos, n.hit.pos) AS pos, coalesce(e.cum, n.hit.cum) AS cum, CASE WHEN e.id IS NOT NULL THEN 'on-chain' WHEN n.node IS NOT NULL THEN 'snapped' END AS method, CASE WHEN e.id IS NOT NULL THEN 0 ELSE n.d END AS snap_m
               FROM stops s LEFT JOIN run e ON e.nation = s.nation AND e.id = s.node LEFT JOIN snap n ON n.nation = s.nation AND n.node = s.node),
    ends AS (SELECT *, count(DISTINCT chain) OVER l AS chains, CASE WHEN arg_max(pos, idx) FILTER (chain IS NOT NULL) OVER l < arg_min(pos, idx) FILTER (chain IS NOT NULL) OVER l THEN -1 ELSE 1 END AS way FROM placed WINDOW l AS (PARTITION BY nation)),
    ranks AS (SELECT *, row_number() OVER (PARTITION BY nation, chain IS NOT NULL ORDER BY idx) - 1 AS member_rank, row_number() OVER (PARTITION BY nation, chain IS NOT NULL ORDER BY pos * way, idx) - 1 AS track_rank FROM ends),
    ordered AS (SELECT *, CASE WHEN chains <> 1 THEN idx WHEN chain IS NOT NULL THEN track_rank END AS geo_idx, chains = 1 AND chain IS NOT NULL AND member_rank <> track_rank AS reordered FROM ranks),
    named AS (SELECT *, CASE WHEN node >= {FAR} THEN 'Customer#' || lpad((node - {FAR})::VARCHAR, 9, '0') WHEN node % 9 = 0 THEN 'R' || node WHEN node % 9 > 1 THEN 'Supplier ' || node END AS display, CASE WHEN node < {FAR} AND node % 9 = 0 THEN 'ref-fallback' WHEN node >= {FAR} OR node % 9 > 1 THEN 'osm-name' END AS name_source FROM ordered),
    seq AS (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY geo_idx) - 1 AS k FROM ordered WHERE geo_idx IS NOT NULL),
    seg AS (SELECT x.nation AS line_id, x.k::INT AS segment, x.node AS from_node_id, y.node AS to_node_id,
            CASE WHEN x.chain IS NULL OR y.chain IS NULL THEN {hav("x", "y")} WHEN x.chain = y.chain THEN abs(y.cum - x.cum) ELSE {hav("x", "y")} * 1.08 END AS d,
            CASE WHEN x.chain IS NULL OR y.chain IS NULL THEN 'unlocatable' WHEN x.chain <> y.chain THEN 'estimated-gap' WHEN 'snapped' IN (x.method, y.method) THEN 'measured-snapped' ELSE 'measured' END AS quality
            FROM seq x JOIN seq y ON y.nation = x.nation AND y.k = x.k + 1)"""


@query(f"WITH {LINES_SQL} SELECT nation AS line_id, node AS node_id, idx::INT AS idx, chain::INT AS chain, pos::INT AS chain_pos, method, {METRES.format('snap_m')} AS snap_m, geo_idx::INT AS geo_idx, reordered, display, name_source FROM named")
def extract_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G15, J1, J11 (on the track, beside it, off it), G11 with one chain and with two, W5, F5."""
    s = extracted(spark, sf_dir).stops
    return s.select("line_id", "node_id", "idx", "chain", "chain_pos", "method", half_up(F.col("snap_m")).alias("snap_m"), F.col("geo_idx").cast("int").alias("geo_idx"), "reordered", "display", "name_source")


@query(f"WITH {LINES_SQL} SELECT line_id, segment, from_node_id, to_node_id, {METRES.format('d')} AS dist_m, quality FROM seg")
def extract_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G12 with all four qualities, W2, G1."""
    return extracted(spark, sf_dir).segments.select("line_id", "segment", "from_node_id", "to_node_id", half_up(F.col("dist_m")).alias("dist_m"), "quality")


@query(f"WITH {LINES_SQL} SELECT line_id, segment, quality, row_number() OVER (ORDER BY line_id, segment) - 1 AS place FROM seg WHERE quality <> 'measured'")
def unmeasured_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11."""
    return ranked(reports.unmeasured(extracted(spark, sf_dir).segments).select("line_id", "segment", "quality"), ["line_id", "segment"], "place")


_EXTRACT_CHECKS = f"""WITH {LINES_SQL}, line AS (SELECT nation, count(*) FILTER (chain IS NULL) AS lost, count(*) FILTER (method = 'snapped') AS snapped, any_value(chains) AS chains, count(*) FILTER (reordered) AS moved FROM ordered GROUP BY nation),
    total AS (SELECT line_id, sum(d) / ((line_id * 400.0::DOUBLE + 1) * 1000) AS ratio FROM seg GROUP BY line_id)
    SELECT 'stop-named' AS rule, 'fatal' AS level, nation::VARCHAR AS subject, count(*) AS n FROM named WHERE display IS NULL OR name_source = 'ref-fallback' GROUP BY nation
    UNION ALL SELECT 'stop-located', 'fatal', nation::VARCHAR, 1 FROM line WHERE lost > 0
    UNION ALL SELECT 'one-chain', 'fatal', nation::VARCHAR, 1 FROM line WHERE lost = 0 AND chains > 1
    UNION ALL SELECT 'stop-snapped', 'warn', nation::VARCHAR, 1 FROM line WHERE snapped > 0
    UNION ALL SELECT 'order-by-geometry', 'warn', nation::VARCHAR, 1 FROM line WHERE moved > 0
    UNION ALL SELECT 'length-band', 'fatal', line_id::VARCHAR, 1 FROM total WHERE ratio > 1.02 OR ratio < CASE WHEN line_id % 2 = 0 THEN 0.5 ELSE 0.9 END"""


@query(_EXTRACT_CHECKS)
def extract_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7-Q10, Q12, Q13."""
    return extracted(spark, sf_dir).checks.groupBy("rule", "level", "subject").agg(F.count("*").alias("n"))


@query(f"""WITH {LINES_SQL}, s AS (SELECT nation, count(*) AS stops, count(DISTINCT regexp_replace(regexp_replace(lower(display), '[^a-z0-9]|\\bsupplier\\b', '', 'g'), ' ', '', 'g')) AS names, max(snap_m) AS worst FROM named GROUP BY nation),
    q AS (SELECT line_id, sum(d) AS total, count(*) FILTER (quality = 'measured') AS measured, count(*) FILTER (quality = 'measured-snapped') AS snapped, count(*) FILTER (quality = 'estimated-gap') AS gaps, count(*) FILTER (quality = 'unlocatable') AS lost FROM seg GROUP BY line_id)
    SELECT n_nationkey AS line_id, stops, names, {METRES.format("worst")} AS worst_snap_m, {METRES.format("total")} AS total_m, measured, snapped AS measured_snapped, gaps AS estimated_gap, lost AS unlocatable FROM nation LEFT JOIN s ON nation = n_nationkey LEFT JOIN q ON line_id = n_nationkey""")
def extraction_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2, A1, A3, A5, A16."""
    e = extracted(spark, sf_dir)
    r = reports.extraction(line_tables(spark, sf_dir)[0], e.stops, e.segments)
    return r.select("line_id", "stops", "names", half_up(F.col("worst_snap_m")).alias("worst_snap_m"), half_up(F.col("total_m")).alias("total_m"), "measured", "measured_snapped", "estimated_gap", "unlocatable")


# -- a line given by names in order (G14) ------------------------------------------------------------
ORDER_SQL = f"""{SUPPLIERS}, node AS (SELECT id, lat, lon, CASE WHEN id % 10 <> 7 THEN 'N' || (id - id % 20 // 19) END AS name FROM sup),
    known AS (SELECT name, arg_max(id, id) AS id, arg_max(lat, id) AS lat, arg_max(lon, id) AS lon FROM node WHERE name IS NOT NULL GROUP BY name),
    wanted AS (SELECT 'N' || s_suppkey AS name, row_number() OVER (ORDER BY s_suppkey) - 1 AS idx FROM supplier WHERE s_suppkey % 10 <> 4)"""


def ordered_line(spark: SparkSession, sf_dir: str) -> build.Extracted:
    """Suppliers by name; the track has a gap after every third one. Of equal names the last counts; some names are missing or extra."""
    i = F.col("id")
    s = suppliers(spark, sf_dir)
    nodes = s.select(i.alias("node_id"), F.when(i % 10 != 7, F.concat(F.lit("N"), (i - F.floor(i % 20 / 19)).cast("string"))).alias("name"), i.alias("ord"), "lat", "lon")
    order = ranked(s.filter(i % 10 != 4).select("id"), ["id"], "idx").select("idx", F.concat(F.lit("N"), i.cast("string")).alias("name"))
    ways = s.filter(i % 3 != 2).select(i.alias("way_id"), F.array(i, i + 1).alias("nodes"), i.alias("ord"))
    return build.extract_ordered("mono", order, nodes, ways, s.select(i.alias("node_id"), "lat", "lon"), 9_000_000.0, 17)


@query(f"""WITH {ORDER_SQL}, found AS (SELECT w.name, w.idx, k.id, k.lat, k.lon, k.id // 3 AS chain FROM wanted w JOIN known k USING (name)),
    cum AS (SELECT a.id, CASE WHEN a.id % 3 > 0 THEN {hav("p", "a")} ELSE 0 END + CASE WHEN a.id % 3 = 2 THEN {hav("q", "p")} ELSE 0 END AS cum FROM sup a LEFT JOIN sup p ON p.id = a.id - 1 LEFT JOIN sup q ON q.id = a.id - 2),
    seq AS (SELECT f.*, c.cum, row_number() OVER (ORDER BY f.idx) - 1 AS k FROM found f JOIN cum c ON c.id = f.id),
    seg AS (SELECT x.k::INT AS segment, x.id AS a, y.id AS b, x.chain = y.chain AS same, CASE WHEN x.chain = y.chain THEN abs(y.cum - x.cum) ELSE {hav("x", "y")} END AS d FROM seq x JOIN seq y ON y.k = x.k + 1),
    f AS (SELECT (9000000 - coalesce(sum(d) FILTER (same), 0)) / sum(d) FILTER (NOT same) AS factor FROM seg)
    SELECT segment, a AS from_node_id, b AS to_node_id, {METRES.format("CASE WHEN NOT same AND factor > 0 THEN d * factor ELSE d END")} AS dist_m, CASE WHEN same THEN 'measured' ELSE 'estimated-gap' END AS quality FROM seg, f""")
def ordered_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G14, G13, A6."""
    return ordered_line(spark, sf_dir).segments.select("segment", "from_node_id", "to_node_id", half_up(F.col("dist_m")).alias("dist_m"), "quality")


@query(f"""WITH {ORDER_SQL} SELECT 'station-order' AS rule, 'fatal' AS level, count(*) AS n FROM wanted FULL JOIN known USING (name) WHERE idx IS NULL OR id IS NULL
    UNION ALL SELECT 'station-count', 'fatal', 1 WHERE (SELECT count(*) FROM wanted) <> 17 UNION ALL SELECT 'calibration', 'fatal', 1 UNION ALL SELECT 'stop-named', 'fatal', count(*) FROM node WHERE name IS NULL""")
def ordered_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q15-Q17."""
    return ordered_line(spark, sf_dir).checks.groupBy("rule", "level").agg(F.count("*").alias("n"))


# -- rules ----------------------------------------------------------------------------------------
@query("""
    WITH l AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 13 = 0 THEN 'lost' ELSE 'rail' END AS dataset, CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN -c_custkey - 1 ELSE c_nationkey::BIGINT END AS rel, c_custkey % 17 = 0 AS curated, c_custkey % 5 AS r5, c_custkey % 3 AS r3, c_nationkey AS nation, c_mktsegment AS seg FROM customer),
    f AS (SELECT * FROM l WHERE dataset = 'rail'), r AS (SELECT * FROM f WHERE NOT curated), m AS (SELECT * FROM r WHERE rel IS NOT NULL AND rel >= 0), n AS (SELECT s_nationkey AS nation, count(*) AS n FROM supplier GROUP BY ALL)
    SELECT 'dataset-fetched' AS rule, id::VARCHAR AS subject FROM l WHERE dataset = 'lost' UNION ALL SELECT 'relation-given', id::VARCHAR FROM r WHERE rel IS NULL UNION ALL SELECT 'relation-present', id::VARCHAR FROM r WHERE rel < 0
    UNION ALL SELECT 'ref-equals', id::VARCHAR FROM m WHERE r5 = 1 UNION ALL SELECT 'name-includes', id::VARCHAR FROM m WHERE r3 = 1 UNION ALL SELECT 'stop-count', id::VARCHAR FROM m WHERE r5 = 2
    UNION ALL SELECT 'curated-config', id::VARCHAR FROM f WHERE curated AND r3 = 0
    UNION ALL SELECT 'stop-is-node', c_custkey::VARCHAR FROM customer WHERE c_custkey % 19 = 1 UNION ALL SELECT 'stop-node-known', c_custkey::VARCHAR FROM customer WHERE c_custkey % 19 = 2
""")
def line_config_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated lines against fetched data, a line a customer."""
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    nation = F.col("c_nationkey").cast("bigint")
    lines = c.select(
        k.alias("id"),
        F.when(k % 13 == 0, "lost").otherwise("rail").alias("dataset"),
        F.when(k % 11 == 0, F.lit(None)).when(k % 7 == 0, -k - 1).otherwise(nation).alias("relation_id"),
        F.when(k % 17 == 0, F.array(F.lit("A"))).alias("station_order"),
        F.when(k % 5 == 1, F.lit("other")).when(k % 5 == 3, nation.cast("string")).alias("assert_ref"),
        F.when(k % 3 == 1, F.lit("no such part")).when(k % 3 == 2, F.lit("ATION_")).alias("assert_name_includes"),
        F.when(k % 5 == 2, F.lit(7)).when(k % 5 == 4, F.lit(1)).alias("assert_stops"),
        F.when(k % 3 != 0, "railway").alias("station_tag"),
        F.lit("rail").alias("way_tag"),
        F.lit(1.0).alias("published_km"),
    )
    relations = table(spark, sf_dir, "nation").select(F.lit("rail").alias("dataset"), F.col("n_nationkey").cast("bigint").alias("id"), F.create_map(F.lit("ref"), F.col("n_nationkey").cast("string"), F.lit("name"), F.col("n_name")).alias("tags"))
    stops = c.select(k.alias("line_id"), F.when(k % 19 == 1, "way").otherwise("node").alias("member_type"), k.alias("node_id"), (k % 19 != 2).alias("known"))
    return checks.line_config(lines, spark.createDataFrame([("rail",)], "name string"), relations, stops).select("rule", "subject")


_STATIONS_SQL = f"""{CUSTOMERS}, {CUSTOMER_PAIRS}, {REACH}, m AS (SELECT c.*, k.root, substr(c.name, 1, 6 + (c.id % 4)::INT) AS display FROM cus c JOIN comp k ON k.id = c.id),
    far AS (SELECT x.root, any_value(x.nation) AS nation, coalesce(max({hav("x", "y")}) FILTER (x.id < y.id), 0) AS d FROM m x JOIN m y ON x.root = y.root GROUP BY x.root)"""


def stations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    forced = spark.createDataFrame([("1", "one", 260.0), ("none", "one", 500.0)], "norm string, operator string, max_spread_m double")
    return build.stations(cluster_input(spark, sf_dir), forced)


@query(f"""WITH RECURSIVE {_STATIONS_SQL}, base AS (SELECT x.id AS a, y.id AS b FROM cus x JOIN cus y ON x.nation = y.nation AND x.id <> y.id WHERE x.nation = 1 AND {hav("x", "y")} <= 260),
    wide(id, o) AS (SELECT id, id FROM cus WHERE nation = 1 UNION SELECT w.id, b.b FROM wide w JOIN base b ON b.a = w.o), one AS (SELECT id, min(o) AS root FROM wide GROUP BY id),
    st AS (SELECT c.id, c.nation, coalesce(o.root, k.root) AS root, c.lat, c.lon FROM cus c JOIN comp k ON k.id = c.id LEFT JOIN one o ON o.id = c.id),
    sp AS (SELECT x.root, any_value(x.nation) AS nation, max({hav("x", "y")}) AS d FROM st x JOIN st y ON x.root = y.root GROUP BY x.root)
    SELECT 'wide-station' AS rule, 'warn' AS level, count(*) AS n FROM sp WHERE d > 200 HAVING count(*) > 0
    UNION ALL SELECT 'do-not-merge', 'fatal', count(*) FROM (SELECT nation, max(d) AS d FROM sp GROUP BY nation) WHERE d > 100 * nation HAVING count(*) > 0
    UNION ALL SELECT 'stale-force-merge', 'warn', 1 + (SELECT CASE WHEN count(DISTINCT k.root) = count(DISTINCT o.root) THEN 1 ELSE 0 END FROM one o JOIN comp k ON k.id = o.id)""")
def station_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters with a forced group that joins something and one that names nobody."""
    _, found, applied = stations(spark, sf_dir)
    key = F.col("n_nationkey")
    guards = table(spark, sf_dir, "nation").select(key.cast("string").alias("norm"), (key * 100.0).alias("max_spread_m"))
    return checks.clusters(found, guards, applied).groupBy("rule", "level").agg(F.count("*").alias("n"))


@query(f"WITH RECURSIVE {_STATIONS_SQL} SELECT min(id) AS first_member, count(DISTINCT segment) AS lines, row_number() OVER (ORDER BY count(DISTINCT segment) DESC, min(id)) - 1 AS place FROM m GROUP BY root HAVING count(DISTINCT segment) > 1")
def merged_station_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most lines first."""
    members, found, _ = build.stations(cluster_input(spark, sf_dir))
    first = members.groupBy("station_id").agg(F.min("ord").alias("first_member"))
    rows = cluster.merged_stations(found).join(first, "station_id").select("first_member", F.size("line_ids").cast("bigint").alias("lines")).withColumn("fewer", -F.col("lines"))
    return ranked(rows, ["fewer", "first_member"], "place").drop("fewer")


@query(f"WITH RECURSIVE {_STATIONS_SQL} SELECT min(id) AS first_member, round(avg(lat), 5) AS lat, round(avg(lon), 5) AS lon, 'one' AS operator, count(DISTINCT segment) AS lines FROM m GROUP BY root")
def station_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6."""
    members, found, _ = build.stations(cluster_input(spark, sf_dir))
    first = members.groupBy("station_id").agg(F.min("ord").alias("first_member"))
    return network.station_rows(found).join(first, "station_id").select("first_member", "lat", "lon", "operator", F.size("line_ids").cast("bigint").alias("lines"))


@query("""
    WITH s AS (SELECT s_nationkey AS line_id, s_suppkey AS id, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS k FROM supplier), g AS (SELECT x.line_id, x.k, CASE WHEN x.id % 13 <> 0 THEN x.id END AS a, CASE WHEN y.id % 7 = 0 THEN x.id WHEN y.id % 13 <> 0 THEN y.id END AS b FROM s x JOIN s y ON y.line_id = x.line_id AND y.k = x.k + 1)
    SELECT 0::INT AS line_id, 0::INT AS segment, 'none' AS fault WHERE false
    UNION ALL SELECT line_id, segment, fault FROM (SELECT c_nationkey AS line_id, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1)::INT AS segment, CASE WHEN c_custkey % 13 = 0 OR lead(c_custkey) OVER w % 13 = 0 THEN 'unmapped' WHEN c_custkey // 4 = lead(c_custkey) OVER w // 4 THEN 'self-loop' END AS fault, lead(c_custkey) OVER w AS nxt FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_custkey)) WHERE fault IS NOT NULL AND nxt IS NOT NULL
""")
def edge_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops without a station, neighbours in one station."""
    c = customers(spark, sf_dir).withColumnRenamed("nation", "line_id")
    w = Window.partitionBy("line_id").orderBy("id")
    members = c.select("line_id", (F.row_number().over(w) - 1).alias("stop_index"), "id").filter(F.col("id") % 13 != 0).select("line_id", "stop_index", F.floor(F.col("id") / 4).alias("station_id"))
    segments = chains.consecutive(c, "id", ["id"]).select("line_id", "segment", F.lit(100.0).alias("dist_m"), F.lit("measured").alias("quality"))
    lines = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("line_id"), F.lit(40.0).alias("speed_kmph"), F.lit(20).alias("dwell_s"))
    return network.edges(segments, members, lines)[1]


@query("""
    SELECT 'place-layer' AS rule, 'warn' AS level, r_name AS subject FROM region WHERE r_regionkey % 2 = 1 UNION ALL SELECT 'layout-override', 'warn', 'S' || (s_suppkey + 1000000) FROM supplier WHERE s_suppkey % 10 = 3
    UNION ALL SELECT 'colour-assigned', 'fatal', n_name FROM nation WHERE n_nationkey % 8 = 1 UNION ALL SELECT 'asset-raw', 'fatal', 'network' UNION ALL SELECT 'asset-gzip', 'warn', 'network'
""")
def release_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers, manual places, colours, sizes of an asset that does not pack."""
    r, n = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    s = suppliers(spark, sf_dir).select(F.col("id").alias("station_id"), F.concat(F.lit("S"), F.col("id").cast("string")).alias("name"), F.lit("one").alias("operator"), "lat", "lon")
    moved = F.concat(F.lit("S"), (F.col("station_id") + F.when(F.col("station_id") % 10 == 3, FAR).otherwise(0)).cast("string"))
    overrides = s.select(moved.alias("name"), "operator", F.lit(1.0).alias("x"), F.lit(2.0).alias("y"))
    unknown = layout.override_positions(s.select("station_id", F.lit(0.0).alias("x"), F.lit(0.0).alias("y")), s, overrides)[1]
    families = n.select(F.col("n_name").alias("family"))
    document = "".join(chr(33 + (i * i * 7919 + i // 93) % 90) for i in range(500_000))
    found = [
        checks.place_layers(r.select(F.col("r_name").alias("name")), r.filter("r_regionkey % 2 = 0").select(F.col("r_name").alias("name"))),
        checks.layout_overrides(unknown),
        checks.colour_assignment(families, n.filter("n_nationkey % 8 <> 1").select(F.col("n_name").alias("family"))),
        checks.asset_size(spark, *(max(a, b) for a, b in zip(sinks.sizes(document), (0, 100_000)))),
    ]
    return checks.union(found).select("rule", "level", "subject")


@query("SELECT s_suppkey AS station_id, CASE WHEN s_suppkey % 10 = 3 THEN 0 ELSE s_suppkey END::DOUBLE AS x FROM supplier")
def layout_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual places win, those of unknown stations change nothing."""
    i = F.col("station_id")
    s = suppliers(spark, sf_dir).select(F.col("id").alias("station_id"), F.concat(F.lit("S"), F.col("id").cast("string")).alias("name"), F.lit("one").alias("operator"))
    overrides = s.select(F.when(i % 10 == 3, "nobody").otherwise(F.col("name")).alias("name"), "operator", i.cast("double").alias("x"), F.lit(2.0).alias("y"))
    return layout.override_positions(s.select("station_id", F.lit(0.0).alias("x"), F.lit(0.0).alias("y")), s, overrides)[0].select("station_id", "x")


# -- reports ----------------------------------------------------------------------------------------
@query("""
    WITH k AS (SELECT s_nationkey AS line, s_suppkey AS id, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS a, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC) AS z FROM supplier),
    walk AS (SELECT DISTINCT unnest([s_suppkey, s_suppkey + 1]) AS id FROM supplier WHERE s_suppkey % 20 = 0), wide AS (SELECT s_suppkey AS id FROM supplier WHERE s_suppkey % 6 = 0)
    SELECT coalesce(c.id, t.id) AS station_id, c.id IS NOT NULL AS interchange, t.id IS NOT NULL AS terminus FROM (SELECT id FROM walk UNION SELECT id FROM wide) c FULL JOIN (SELECT DISTINCT id FROM k WHERE a = 1 OR z = 1) t ON t.id = c.id
""")
def marked_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations of several lines, ends of walks, termini."""
    s, i = suppliers(spark, sf_dir), F.col("id")
    st = s.select(i.alias("station_id"), F.when(i % 6 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a"))).alias("line_ids"))
    walks = s.filter(i % 20 == 0).select(i.alias("a_id"), (i + 1).alias("b_id"))
    order = s.select(F.col("nation").alias("line_id"), F.row_number().over(Window.partitionBy("nation").orderBy("id")).alias("pos"), i.alias("station_id"))
    return layout.marked_stations(st, walks, order)


@query("SELECT p_partkey AS id, rpad(substr(p_name, 1, 8), 8, ' ') || '|' || CASE WHEN length(p_type) < 6 THEN lpad(p_type, 6, ' ') ELSE p_type END || '|' AS line FROM part")
def report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut and padded columns of a report."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.concat(reports.cut("p_name", 8), F.lit("|"), pad(F.col("p_type"), 6, right=True), F.lit("|")).alias("line"))


@query("SELECT (SELECT count(*) FROM (SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25)) AS shown, greatest(0, count(*) - 25) AS more, (SELECT max(o_orderkey) FROM (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 6)) AS largest_of_six FROM orders")
def listing_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The head of a listing and how many more there are."""
    o = table(spark, sf_dir, "orders")
    shown, more = reports.first_rows(o, 25, F.desc("o_totalprice"), "o_orderkey")
    six, _ = reports.first_rows(o, 6, F.desc("o_totalprice"), "o_orderkey")
    return shown.agg(F.count("*").alias("shown")).withColumn("more", F.lit(more).cast("bigint")).crossJoin(six.agg(F.max("o_orderkey").alias("largest_of_six")))  # single rows


@query("SELECT (SELECT count(*) FROM nation) AS lines, (SELECT count(*) FROM supplier) AS stations, (SELECT 2 * sum(greatest(n - 1, 0))::BIGINT FROM (SELECT count(*) AS n FROM supplier GROUP BY s_nationkey)) AS edges, (SELECT count(*) FROM nation WHERE n_nationkey % 5 = 0) AS suspended, (SELECT count(*) FROM region) AS fare_tables, (SELECT count(*) FROM region WHERE r_regionkey < 2) AS verified")
def build_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4, A18."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    ops = n.select(F.when(F.col("n_nationkey") % 5 == 0, "suspended").otherwise("operating").alias("status"))
    fare_tables = r.select(F.when(F.col("r_regionkey") < 2, "verified").otherwise("estimated").alias("confidence"))
    return reports.build_totals(n, suppliers(spark, sf_dir), edge_table(spark, sf_dir), walk_table(spark, sf_dir), ops, fare_tables).select("lines", "stations", "edges", "suspended", "fare_tables", "verified")


@query("SELECT n_nationkey::BIGINT AS rel_id, 1 AS pos, coalesce('S' || s_suppkey, '<' || (n_nationkey * 3 + 1) || '>') AS name FROM nation LEFT JOIN supplier ON s_suppkey = n_nationkey * 3 + 1 WHERE n_regionkey = 2")
def dump_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stops of all relations with one ref."""
    e = element_rows(spark, sf_dir)
    region = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_regionkey").cast("string").alias("r"))
    rel = e.filter("type = 'relation'").join(region, "id").withColumn("tags", F.map_concat("tags", F.create_map(F.lit("ref"), F.col("r"))))
    return reports.dump_stops(rel, e.filter("type = 'node'"), "2").select("rel_id", "pos", "name")


@query("SELECT s_suppkey AS id, CASE WHEN s_suppkey % 4 = 0 THEN '—' ELSE s_name END AS name, CASE s_suppkey % 3 WHEN 0 THEN 'station' ELSE 'halt' END AS kind, row_number() OVER (ORDER BY CASE WHEN s_suppkey % 4 = 0 THEN '—' ELSE s_name END, s_suppkey) - 1 AS place FROM supplier WHERE s_suppkey % 3 < 2")
def unrouted_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations of a dataset without routes, by name."""
    i = F.col("s_suppkey")
    tag = F.create_map(F.lit("name"), F.when(i % 4 != 0, F.col("s_name")), F.when(i % 3 == 0, "railway").otherwise("public_transport"), F.when(i % 3 == 0, "station").when(i % 3 == 1, "halt").otherwise("platform"))
    found = reports.unrouted_stations(table(spark, sf_dir, "supplier").select(i.alias("id"), F.map_filter(tag, lambda _, v: v.isNotNull()).alias("tags")))
    return ranked(found, ["name", "id"], "place")


@query("SELECT n_nationkey::BIGINT AS id, 'L' || (n_nationkey * 3 % 25) AS ref, row_number() OVER (ORDER BY n_nationkey * 3 % 25) - 1 AS place FROM nation")
def natural_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: L2 before L10."""
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("id"), F.concat(F.lit("L"), (F.col("n_nationkey") * 3 % 25).cast("string")).alias("ref"), F.col("n_name").alias("name"))
    return rows.select("id", "ref", (F.row_number().over(Window.orderBy(*reports.natural_order("ref", "name"))) - 1).cast("bigint").alias("place"))  # a row a relation


@query("SELECT s_suppkey AS id, CASE WHEN s_suppkey = 5 THEN 'Five,V' ELSE '' END AS aliases FROM supplier")
def curated_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6."""
    s = suppliers(spark, sf_dir).select("id", F.concat(F.lit("Supplier "), F.col("id").cast("string")).alias("display"))
    return names.aliases_of(s, spark, RULES).select("id", F.array_join("aliases", ",").alias("aliases"))


def _channel(c: Column, shift: int) -> Column:
    return (F.shiftright(c, shift) % 256).cast("int")


@query("SELECT c_custkey AS id, '#' || lower(lpad(hex(c_custkey * 7919 % 16777216), 6, '0')) AS colour FROM customer")
def colour_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F16."""
    c = (F.col("c_custkey") * 7919 % 16777216).cast("int")
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), colour.to_hex(F.array(_channel(c, 16), _channel(c, 8), _channel(c, 0))).alias("colour"))


# -- the place index -----------------------------------------------------------------------------------
_PLACES_SQL = f"""raw AS (SELECT c_custkey AS ord, c_nationkey AS nation, CASE WHEN c_custkey % 10 = 0 THEN 'Tower 5' WHEN c_custkey % 10 <> 1 THEN ' Place ' || (c_custkey // 2) || ' ' END AS raw, c_custkey % 10 <> 2 AS placed, {place_sql("c_custkey // 2", 1000)} FROM customer),
    good AS (SELECT ord, trim(raw) AS name, lat, lon, ord % 3 AS kind FROM raw WHERE raw IS NOT NULL AND raw <> 'Tower 5' AND placed),
    one AS (SELECT name, arg_min(ord, (kind, ord)) AS ord, min(kind) AS kind, any_value(lat) AS lat, any_value(lon) AS lon FROM good GROUP BY name)"""


def collected(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Places two by two at one point under one name; layers by key; names that say nothing, no name, no point."""
    k = F.col("ord")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ord"), F.floor(F.col("c_custkey") / 2).alias("half"))
    lat, lon = F.lit(18.85) + (F.col("half") * 37 % 200) / F.lit(1000.0), F.lit(72.75) + (F.col("half") * 53 % 211) / F.lit(1000.0)
    name = F.when(k % 10 == 0, F.lit("Tower 5")).when(k % 10 != 1, F.concat(F.lit(" Place "), F.col("half").cast("string"), F.lit(" ")))
    way = k % 4 == 1
    there = k % 10 != 2
    rows = c.select(
        "ord",
        F.when(way, "way").otherwise("node").alias("type"),
        F.when(~way & there, lat).alias("lat"),
        F.when(~way & there, lon).alias("lon"),
        F.when(way & there, F.struct(lat.alias("lat"), lon.alias("lon"))).alias("center"),
        F.map_filter(F.create_map(F.lit("name"), name), lambda _, v: v.isNotNull()).alias("tags"),
    )
    parts = [places.collect_layer(rows.filter(k % 3 == kind), kind, ["place"]) for kind in (places.LOCALITY, places.LANDMARK, places.STREET)]
    found, counts = parts[0]
    for p, n in parts[1:]:
        found, counts = found.unionByName(p), counts.unionByName(n)
    return found, counts


@query(f"WITH {_PLACES_SQL} SELECT ord % 3 AS kind, count(*) FILTER (raw <> 'Tower 5' AND placed) AS usable, count(*) FILTER (raw = 'Tower 5') AS unusable_names, count(*) FILTER (raw <> 'Tower 5' AND NOT placed) AS without_point FROM raw WHERE raw IS NOT NULL GROUP BY ord % 3")
def place_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each layer gave."""
    return collected(spark, sf_dir)[1].withColumn("kind", F.col("kind").cast("bigint"))


@query(f"""WITH {_PLACES_SQL}, town AS (SELECT *, row_number() OVER (ORDER BY ord) - 1 AS t FROM one WHERE kind = 0),
    near AS (SELECT o.ord, arg_min(t.t, ({hav("o", "t")}, t.ord)) AS t FROM one o JOIN town t ON {hav("o", "t")} <= 3000 WHERE o.kind <> 0 GROUP BY o.ord)
    SELECT name, round(lat, 5) AS lat, round(lon, 5) AS lon, kind::INT AS kind, coalesce(n.t, -1) AS locality_index FROM one LEFT JOIN near n ON n.ord = one.ord""")
def place_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collected, deduplicated, labelled, in the order they are shipped in."""
    one = places.dedupe(collected(spark, sf_dir)[0])
    return places.index_rows(places.label_localities(one))


@query(f"WITH {_PLACES_SQL} SELECT kind::INT AS kind, count(*) AS places FROM one GROUP BY kind")
def place_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13."""
    return places.counts_by_kind(places.dedupe(collected(spark, sf_dir)[0]))


@query(f"""WITH {_PLACES_SQL} SELECT '["' || name || '",' || kind || ']' AS value FROM one""")
def place_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as the asset has them, without places' digits."""
    one = places.dedupe(collected(spark, sf_dir)[0])
    lines = sinks.positional(one.select("name", "lat", "lon", "kind", F.lit(-1).alias("locality_index")))
    return lines.select(F.regexp_replace("value", r"^(\[\"[^\"]*\",)[^,]*,[^,]*,(\d),-1\]$", "$1$2]").alias("value"))
