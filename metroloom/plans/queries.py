"""Queries over the driver's tables, one or more for each operator, each with its SQL beside it.

The tables have no coordinates: they follow from keys, alike in both engines. Distances leave as whole
metres, for engines differ in a double's last digits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import colour, geo, names, text
from ..functions.numbers import half_up
from ..operators import chains, checks, cluster, components, fares, layout, network, palette, places, radius, reports
from ..sources import elements
from . import journeys
from .prefix import ranked

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Words dropped from matching keys.
STOP_WORDS = ["junction", "jn", "terminus", "railway", "station", "metro", "monorail"]
#: Slabs of two invented operators (operator, upper bound in km, paise), and exact fares of pairs.
SLABS = [("east", 3.0, 1000), ("east", 12.0, 2000), ("east", 27.0, 4000), ("east", None, 6000), ("west", 2.0, 500), ("west", 10.0, 1500), ("west", 40.0, 3500)]
SLAB_SQL = "(VALUES ('east', 3.0::DOUBLE, 1000), ('east', 12.0, 2000), ('east', 27.0, 4000), ('east', NULL, 6000), ('west', 2.0, 500), ('west', 10.0, 1500), ('west', 40.0, 3500)) s(operator, max_km, fare_paise)"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def place(key: str, m: float) -> list[Column]:
    """lat and lon of a key; ``m`` sets how dense points lie."""
    k = F.col(key)
    return [(F.lit(18.85) + ((k * 37) % 200) / F.lit(float(m))).alias("lat"), (F.lit(72.75) + ((k * 53) % 211) / F.lit(float(m))).alias("lon")]


def place_sql(key: str, m: int) -> str:
    return f"18.85::DOUBLE + (({key} * 37) % 200)::DOUBLE / {m}::DOUBLE AS lat, 72.75::DOUBLE + (({key} * 53) % 211)::DOUBLE / {m}::DOUBLE AS lon"


def hav(a: str, b: str) -> str:
    """SQL of the distance between aliases a and b."""
    return f"(2 * 6371008.8::DOUBLE * asin(least(1.0::DOUBLE, sqrt(pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2)))))"


METRES = "floor({} + 0.5)::BIGINT"
SUPPLIERS = f"sup AS (SELECT s_suppkey AS id, s_nationkey AS nation, {place_sql('s_suppkey', 3000)} FROM supplier)"
CUSTOMERS = f"cus AS (SELECT c_custkey AS id, c_nationkey AS nation, c_mktsegment AS segment, c_name AS name, {place_sql('c_custkey', 3000)} FROM customer)"
CUSTOMER_PAIRS = f"pairs AS (SELECT x.id AS a, y.id AS b, {hav('x', 'y')} AS d FROM cus x JOIN cus y ON x.nation = y.nation AND x.id < y.id WHERE {hav('x', 'y')} <= 250)"
REACH = "both_ways AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs), reach(id, other) AS (SELECT id, id FROM cus UNION SELECT r.id, w.b FROM reach r JOIN both_ways w ON w.a = r.other), comp AS (SELECT id, min(other) AS root FROM reach GROUP BY id)"


def suppliers(spark: SparkSession, sf_dir: str, m: float = 3000) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"), *place("s_suppkey", m))


def customers(spark: SparkSession, sf_dir: str, m: float = 3000) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"), *place("c_custkey", m))


def slabs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SLABS, "operator string, max_km double, fare_paise int")


# -- names ----------------------------------------------------------------------------------
_NORM_SQL = r"regexp_replace(regexp_replace(regexp_replace(lower(strip_accents({})), '[^a-z0-9]', ' ', 'g'), '\b(junction|jn|terminus|railway|station|metro|monorail)\b', ' ', 'g'), ' ', '', 'g')"


@query(f"SELECT 'part' AS source, p_partkey AS id, {_NORM_SQL.format('p_name')} AS norm FROM part UNION ALL SELECT 'documents', doc_id, {_NORM_SQL.format('text')} FROM documents")
def name_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 on part names and whole documents."""
    norm = lambda c: names.normalise(F.col(c), STOP_WORDS).alias("norm")
    part = table(spark, sf_dir, "part").select(F.lit("part").alias("source"), F.col("p_partkey").alias("id"), norm("p_name"))
    return part.unionByName(table(spark, sf_dir, "documents").select(F.lit("documents").alias("source"), F.col("doc_id").alias("id"), norm("text")))


NAMES = names.Overrides(node_names={7: "Seven Road", 11: "Eleven"}, parenthetical=["Line 1", "Central"], trailing_words=["Metro"], bracketed=["^Line\\s"], display_names={"Part 12 (local)": ("Twelve", "XII")}, stop_words=STOP_WORDS)


@query(r"""
    WITH raw AS (SELECT p_partkey AS id,
        CASE WHEN p_partkey % 5 <> 0 THEN CASE p_partkey % 4 WHEN 0 THEN p_name || ' (Line 1)' WHEN 1 THEN p_name || ' [Line 2]' WHEN 2 THEN p_name || '  metro' ELSE 'Part ' || p_partkey || ' (local)' END
             WHEN p_partkey % 10 = 5 THEN '' END AS name,
        CASE WHEN p_partkey % 3 = 0 THEN p_name END AS en, CASE WHEN p_partkey % 2 = 0 THEN 'REF' || p_partkey END AS ref FROM part),
    picked AS (SELECT *, CASE id WHEN 7 THEN 'Seven Road' WHEN 11 THEN 'Eleven' ELSE coalesce(nullif(name, ''), en, ref) END AS raw,
        CASE WHEN id IN (7, 11) THEN 'curated' WHEN nullif(name, '') IS NOT NULL THEN 'osm-name' WHEN en IS NOT NULL THEN 'osm-name-en' WHEN ref IS NOT NULL THEN 'ref-fallback' END AS src FROM raw)
    SELECT id, CASE raw WHEN 'Part 12 (local)' THEN 'Twelve' ELSE trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw, '\s*\((Line 1|Central)\)', '', 'g'), '\s*\[Line\s[^\]]*\]', '', 'g'), '(?i)\s+metro$', ''), '\s{2,}', ' ', 'g')) END AS display,
           CASE raw WHEN 'Part 12 (local)' THEN 'curated' ELSE src END AS name_source FROM picked
""")
def name_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2, F4, F5 on nodes made of parts."""
    k, n = F.col("p_partkey"), F.col("p_name")
    decorated = F.when(k % 4 == 0, F.concat(n, F.lit(" (Line 1)"))).when(k % 4 == 1, F.concat(n, F.lit(" [Line 2]"))).when(k % 4 == 2, F.concat(n, F.lit("  metro"))).otherwise(F.concat(F.lit("Part "), k.cast("string"), F.lit(" (local)")))
    name = F.when(k % 5 != 0, decorated).when(k % 10 == 5, F.lit(""))
    tags = F.map_filter(F.create_map(F.lit("name"), name, F.lit("name:en"), F.when(k % 3 == 0, n), F.lit("ref"), F.when(k % 2 == 0, F.concat(F.lit("REF"), k.cast("string")))), lambda _, v: v.isNotNull())
    return names.resolve(table(spark, sf_dir, "part").select(k.alias("id"), tags.alias("tags")), NAMES).select("id", "display", "name_source")


@query(r"""
    WITH n AS (SELECT p_partkey AS id, CASE p_partkey % 6 WHEN 0 THEN 'Tower ' || p_size WHEN 1 THEN 'Bldg no. ' || p_size || 'a' WHEN 2 THEN ' ab ' WHEN 3 THEN p_partkey::VARCHAR WHEN 4 THEN repeat(p_name, 4) ELSE p_name END AS name FROM part)
    SELECT id, length(trim(name)) BETWEEN 3 AND 60 AND regexp_matches(name, '[A-Za-z]') AND NOT regexp_matches(trim(name), '(?i)^(building|bldg|wing|tower|block|plot|shop|gala|room|flat)\s*[-.no#]*\s*\d+[a-z]?$') AS usable FROM n
""")
def name_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3."""
    k, n, s = F.col("p_partkey"), F.col("p_name"), F.col("p_size").cast("string")
    name = F.when(k % 6 == 0, F.concat(F.lit("Tower "), s)).when(k % 6 == 1, F.concat(F.lit("Bldg no. "), s, F.lit("a"))).when(k % 6 == 2, F.lit(" ab ")).when(k % 6 == 3, k.cast("string")).when(k % 6 == 4, F.repeat(n, 4)).otherwise(n)
    return table(spark, sf_dir, "part").select(k.alias("id"), names.is_usable(name).alias("usable"))


@query(r"""
    SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN 'unresolved' WHEN p_partkey % 5 = 1 THEN 'parenthesis' WHEN p_partkey % 5 = 2 THEN 'bracket' WHEN p_partkey % 5 = 3 THEN 'stop word' END AS anomaly FROM part
""")
def name_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9."""
    k, n = F.col("p_partkey"), F.col("p_name")
    name = F.when(k % 5 == 0, F.concat(F.lit("<"), k.cast("string"), F.lit(">"))).when(k % 5 == 1, F.concat(n, F.lit(" (East) [x]"))).when(k % 5 == 2, F.concat(n, F.lit(" [Line 1] station"))).when(k % 5 == 3, F.concat(n, F.lit(" Junction"))).otherwise(n)
    return table(spark, sf_dir, "part").select(k.alias("id"), reports.name_anomaly(name).alias("anomaly"))


# -- sources --------------------------------------------------------------------------------
@query("SELECT event_type, (props::JSON ->> 'k') AS k, count(*) AS n FROM events GROUP BY ALL")
def json_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties as a tag map."""
    tags = table(spark, sf_dir, "events").select("event_type", F.from_json("props", "map<string,string>").alias("tags")).filter(elements.has_tag("k"))
    return tags.groupBy("event_type", F.col("tags")["k"].alias("k")).agg(F.count("*").alias("n"))


def element_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements of all three kinds made of suppliers, customers and orders."""
    node = suppliers(spark, sf_dir).select(F.lit("node").alias("type"), "id", "lat", "lon", F.lit(None).cast("array<bigint>").alias("nodes"), F.lit(None).cast("array<struct<type:string,ref:bigint,role:string>>").alias("members"), F.create_map(F.lit("name"), F.concat(F.lit("S"), F.col("id").cast("string")), F.lit("zone"), F.col("nation").cast("string")).alias("tags"))
    n = F.col("id")
    many = suppliers(spark, sf_dir).agg(F.count("*").alias("m"))
    way = customers(spark, sf_dir).crossJoin(F.broadcast(many)).select(F.lit("way").alias("type"), "id", F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"), F.array(n % F.col("m") + 1, n * 7 % F.col("m") + 1).alias("nodes"), F.lit(None).cast("array<struct<type:string,ref:bigint,role:string>>").alias("members"), F.create_map(F.lit("zone"), F.col("nation").cast("string")).alias("tags"))
    rel = table(spark, sf_dir, "nation").select(F.lit("relation").alias("type"), F.col("n_nationkey").cast("bigint").alias("id"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"), F.lit(None).cast("array<bigint>").alias("nodes"), F.array(F.struct(F.lit("way").alias("type"), (F.col("n_nationkey") + 1).cast("bigint").alias("ref"), F.lit("").alias("role")), F.struct(F.lit("node").alias("type"), (F.col("n_nationkey") * 3 + 1).cast("bigint").alias("ref"), F.lit("stop").alias("role"))).alias("members"), F.create_map(F.lit("name"), F.col("n_name")).alias("tags"))
    return node.unionByName(way).unionByName(rel)


@query(f"WITH {SUPPLIERS} SELECT id FROM sup WHERE (lat BETWEEN 18.86::DOUBLE AND 18.9::DOUBLE AND lon BETWEEN 72.76::DOUBLE AND 72.79::DOUBLE AND nation = 3) OR regexp_matches('S' || id, '(?i)^s1')")
def select_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags, pattern, box, union as a set."""
    e = element_rows(spark, sf_dir).filter("type = 'node'").withColumn("center", F.lit(None).cast("struct<lat:double,lon:double>"))
    boxed = e.filter(elements.in_box(18.86, 72.76, 18.9, 72.79) & elements.has_tag("zone", "3"))
    return elements.union_of([boxed, e.filter(elements.tag_like("name", "^s1"))]).select("id")


@query("""
    WITH m AS (SELECT count(*) AS m FROM supplier), w AS (SELECT c_custkey AS id FROM customer WHERE c_custkey IN (SELECT n_nationkey + 1 FROM nation WHERE n_regionkey = 1)),
    n AS (SELECT s_suppkey AS id FROM supplier WHERE s_suppkey IN (SELECT n_nationkey * 3 + 1 FROM nation WHERE n_regionkey = 1 UNION ALL SELECT id % m + 1 FROM w, m UNION ALL SELECT id * 7 % m + 1 FROM w, m))
    SELECT 'relation' AS type, n_nationkey::BIGINT AS id FROM nation WHERE n_regionkey = 1 UNION ALL SELECT 'way', id FROM w UNION ALL SELECT 'node', id FROM n
""")
def descend_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations of a region with everything under them."""
    e = element_rows(spark, sf_dir)
    region = table(spark, sf_dir, "nation").filter("n_regionkey = 1").select(F.col("n_nationkey").cast("bigint").alias("id"), F.lit("relation").alias("type"))
    return elements.descend(e.join(region, ["type", "id"], "left_semi"), e).select("type", "id")


@query(f"""
    WITH {SUPPLIERS}, ends AS (SELECT c.c_custkey AS id, s.lat, s.lon FROM customer c JOIN (SELECT count(*) AS m FROM supplier) ON true JOIN sup s ON s.id IN (c.c_custkey % m + 1, c.c_custkey * 7 % m + 1))
    SELECT id, floor((min(lat) + max(lat)) / 2 * 1e6 + 0.5)::BIGINT AS lat_e6, floor((min(lon) + max(lon)) / 2 * 1e6 + 0.5)::BIGINT AS lon_e6 FROM ends GROUP BY id
""")
def way_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S21."""
    e = element_rows(spark, sf_dir)
    c = elements.centres(e.filter("type = 'way'"), e.filter("type = 'node'").select("id", "lat", "lon"))
    return c.select("id", half_up(F.col("center.lat") * 1e6).alias("lat_e6"), half_up(F.col("center.lon") * 1e6).alias("lon_e6"))


@query("SELECT (SELECT count(*) FROM supplier) AS nodes, (SELECT count(*) FROM customer) AS ways, (SELECT count(*) FROM nation) AS relations")
def element_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14."""
    return reports.element_counts(element_rows(spark, sf_dir))


@query("SELECT o_custkey AS id, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order FROM orders GROUP BY o_custkey")
def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a customer's orders the last counts."""
    rows = table(spark, sf_dir, "orders").withColumn("at", F.struct("o_orderdate", "o_orderkey"))
    return chains.last_wins(rows, ["o_custkey"], "at").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("last_order"))


# -- geometry -------------------------------------------------------------------------------
@query(f"""
    WITH {CUSTOMERS}, n AS (SELECT *, row_number() OVER w - 1 AS k, lead(id) OVER w AS nid FROM cus WINDOW w AS (PARTITION BY nation ORDER BY id))
    SELECT x.nation AS line_id, x.k::INT AS segment, x.id AS from_id, y.id AS to_id, {METRES.format(hav("x", "y"))} AS dist_m FROM n x JOIN n y ON y.id = x.nid AND y.nation = x.nation
""")
def segment_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours along a nation's customers."""
    s = chains.consecutive(customers(spark, sf_dir).withColumnRenamed("nation", "line_id"), "id", ["id", "lat", "lon"])
    return s.select("line_id", "segment", "from_id", "to_id", half_up(geo.haversine_m(F.col("from_lat"), F.col("from_lon"), F.col("to_lat"), F.col("to_lon"))).alias("dist_m"))


_TRACK_SQL = f"""{SUPPLIERS}, track AS (SELECT x.*, row_number() OVER w - 1 AS pos, CASE WHEN p.id IS NULL THEN 0 ELSE {hav("p", "x")} END AS step
    FROM (SELECT *, lag(id) OVER (PARTITION BY nation ORDER BY id) AS pid FROM sup) x LEFT JOIN sup p ON p.id = x.pid WINDOW w AS (PARTITION BY x.nation ORDER BY x.id)),
    run AS (SELECT nation, id, lat, lon, pos, sum(step) OVER (PARTITION BY nation ORDER BY pos) AS cum FROM track)"""


def track(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nation's suppliers as one chain."""
    s = suppliers(spark, sf_dir)
    pos = (F.row_number().over(Window.partitionBy("nation").orderBy("id")) - 1).alias("pos")
    return chains.cumulative(s.select(F.col("nation").alias("line_id"), F.lit(0).alias("chain"), pos, F.col("id").alias("node_id")), s.select(F.col("id").alias("node_id"), "lat", "lon"))


@query(f"WITH {_TRACK_SQL} SELECT nation AS line_id, id AS node_id, {METRES.format('cum')} AS cum_m FROM run")
def cumulative_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1."""
    return track(spark, sf_dir).select("line_id", "node_id", half_up(F.col("cum_m")).alias("cum_m"))


def line_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = customers(spark, sf_dir)
    idx = (F.row_number().over(Window.partitionBy("nation").orderBy("id")) - 1).alias("idx")
    return chains.locate(c.select(F.col("nation").alias("line_id"), idx, (F.col("id") + 1_000_000).alias("node_id"), "lat", "lon"), track(spark, sf_dir))


_SNAP_SQL = f"""{_TRACK_SQL}, {CUSTOMERS}, near AS (SELECT c.id, c.nation, arg_min(struct_pack(pos := r.pos, cum := r.cum), ({hav("c", "r")}, r.pos)) AS hit, min({hav("c", "r")}) AS d
    FROM cus c JOIN run r ON r.nation = c.nation WHERE {hav("c", "r")} <= 400 GROUP BY c.id, c.nation)"""


@query(f"WITH {_SNAP_SQL} SELECT c.nation AS line_id, c.id + 1000000 AS node_id, n.hit.pos::INT AS chain_pos, {METRES.format('n.d')} AS snap_m FROM cus c LEFT JOIN near n ON n.id = c.id")
def locate_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers snapped to the track of their nation."""
    return line_stops(spark, sf_dir).select("line_id", "node_id", "chain_pos", half_up(F.col("snap_m")).alias("snap_m"))


@query(f"""
    WITH {_SNAP_SQL}, s AS (SELECT c.nation, c.id, c.lat, c.lon, n.hit.cum AS cum, row_number() OVER (PARTITION BY c.nation ORDER BY c.id) - 1 AS k FROM cus c LEFT JOIN near n ON n.id = c.id)
    SELECT x.nation AS line_id, x.k::INT AS segment, {METRES.format(f"CASE WHEN x.cum IS NULL OR y.cum IS NULL THEN {hav('x', 'y')} ELSE abs(y.cum - x.cum) END")} AS dist_m,
           CASE WHEN x.cum IS NULL OR y.cum IS NULL THEN 'unlocatable' ELSE 'measured-snapped' END AS quality
    FROM s x JOIN s y ON y.nation = x.nation AND y.k = x.k + 1
""")
def measure_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G12."""
    return chains.measure(line_stops(spark, sf_dir), "idx").select("line_id", "segment", half_up(F.col("dist_m")).alias("dist_m"), "quality")


@query(f"""
    WITH {_SNAP_SQL}, s AS (SELECT c.nation, c.id, c.lat, c.lon, n.hit.cum AS cum, row_number() OVER (PARTITION BY c.nation ORDER BY c.id) - 1 AS k FROM cus c LEFT JOIN near n ON n.id = c.id),
    raw AS (SELECT x.nation, x.k, x.cum IS NOT NULL AND y.cum IS NOT NULL AS same, CASE WHEN x.cum IS NULL OR y.cum IS NULL THEN {hav("x", "y")} ELSE abs(y.cum - x.cum) END AS d FROM s x JOIN s y ON y.nation = x.nation AND y.k = x.k + 1),
    f AS (SELECT nation, (5000000 - coalesce(sum(d) FILTER (same), 0)) / nullif(sum(d) FILTER (NOT same), 0) AS factor FROM raw GROUP BY nation)
    SELECT r.nation AS line_id, r.k::INT AS segment, {METRES.format("CASE WHEN NOT same AND factor > 0 THEN d * factor ELSE d END")} AS dist_m, CASE WHEN same THEN 'measured' ELSE 'estimated-gap' END AS quality, floor(factor * 1000 + 0.5)::BIGINT AS factor_e3
    FROM raw r JOIN f USING (nation)
""")
def calibrate_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps scaled to a published length of 5000 km."""
    published = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("line_id"), F.lit(5_000_000.0).alias("total_m"))
    m = chains.measure_calibrated(line_stops(spark, sf_dir), published)
    return m.select("line_id", "segment", half_up(F.col("dist_m")).alias("dist_m"), "quality", half_up(F.col("factor") * 1000).alias("factor_e3"))


@query(f"""
    WITH {_SNAP_SQL}, s AS (SELECT c.nation, c.id, n.hit.pos AS pos, row_number() OVER (PARTITION BY c.nation ORDER BY c.id) - 1 AS idx FROM cus c LEFT JOIN near n ON n.id = c.id),
    e AS (SELECT *, CASE WHEN arg_max(pos, idx) FILTER (pos IS NOT NULL) OVER l >= arg_min(pos, idx) FILTER (pos IS NOT NULL) OVER l THEN 1 ELSE -1 END AS way, count(pos) OVER l AS placed FROM s WINDOW l AS (PARTITION BY nation))
    SELECT nation AS line_id, id + 1000000 AS node_id, CASE WHEN placed = 0 THEN idx WHEN pos IS NOT NULL THEN row_number() OVER (PARTITION BY nation, pos IS NOT NULL ORDER BY pos * way, idx) - 1 END::INT AS geo_idx,
           coalesce(pos IS NOT NULL AND row_number() OVER (PARTITION BY nation, pos IS NOT NULL ORDER BY pos * way, idx) <> row_number() OVER (PARTITION BY nation, pos IS NOT NULL ORDER BY idx), false) AS reordered
    FROM e
""")
def order_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G11, W3, W4."""
    return chains.order_stops(line_stops(spark, sf_dir)).select("line_id", "node_id", F.col("geo_idx").cast("int").alias("geo_idx"), "reordered")


@query("SELECT c_nationkey AS line_id, count(*) AS ways, 0 AS chain, (3 * count(*) + 1)::INT AS nodes FROM customer GROUP BY c_nationkey")
def stitch_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: three-node steps, every third one reversed, join to one chain a nation."""
    k = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")) - 1
    ways = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("line_id"), k.alias("pos"), F.col("c_custkey").alias("way_id"))
    there = F.transform(F.sequence(F.col("pos") * 3, F.col("pos") * 3 + 3), lambda x: x.cast("bigint"))
    ways = ways.withColumn("nodes", F.when(F.col("pos") % 3 == 2, F.reverse(there)).otherwise(there))
    found = chains.stitch(ways.select("line_id", "pos", "way_id"), ways.select("way_id", "nodes")).groupBy("line_id", "chain").agg(F.count("*").cast("int").alias("nodes"))
    return ways.groupBy("line_id").agg(F.count("*").alias("ways")).join(found, "line_id").select("line_id", "ways", "chain", "nodes")


@query("""
    WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS by_time, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS by_value FROM events)
    SELECT user_id, event_id, by_time::INT AS by_time, by_value::INT AS by_value FROM r WHERE by_time <> by_value
""")
def reorder_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose rank by value is not that by time."""
    rank = lambda *o: F.row_number().over(Window.partitionBy("user_id").orderBy(*o))
    return table(spark, sf_dir, "events").select("user_id", "event_id", rank("ts", "event_id").alias("by_time"), rank("value", "event_id").alias("by_value")).filter("by_time <> by_value")


@query("""
    WITH t AS (SELECT l_suppkey, sum(l_quantity::DECIMAL(18,2)) AS km, count(*) AS n FROM lineitem GROUP BY l_suppkey)
    SELECT l_suppkey AS line_id, CASE WHEN km / (n * 25.5) > 1.02 THEN 'long' WHEN km / (n * 25.5) < 0.97 THEN 'short' END AS side FROM t
""")
def length_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F14, A3."""
    t = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("line_id")).agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("km"), F.count("*").alias("n"))
    return t.select("line_id", chains.length_ratio(F.col("km") * 1000, F.col("n") * 25.5, F.lit(0.97)).alias("side"))


# -- joins by place -------------------------------------------------------------------------
@query(f"WITH {CUSTOMERS}, {CUSTOMER_PAIRS} SELECT a, b, {METRES.format('d')} AS distance_m FROM pairs")
def haversine_self_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8."""
    return radius.pairs_within(customers(spark, sf_dir), cluster.MERGE_RADIUS_M, "id", equal=("nation",)).select("a", "b", half_up(F.col("distance_m")).alias("distance_m"))


@query(f"WITH {SUPPLIERS}, p AS (SELECT x.id AS a, y.id AS b, {METRES.format(hav('x', 'y'))} AS distance_m FROM sup x JOIN sup y ON x.id < y.id WHERE {hav('x', 'y')} <= 800) SELECT *, row_number() OVER (ORDER BY distance_m, a, b) - 1 AS place FROM p")
def radius_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9, O2."""
    near = radius.pairs_within(suppliers(spark, sf_dir), cluster.INTERCHANGE_RADIUS_M, "id").select("a", "b", half_up(F.col("distance_m")).alias("distance_m"))
    return ranked(near, ["distance_m", "a", "b"], "place")


@query(f"""
    WITH c AS (SELECT c_custkey AS id, {place_sql("c_custkey", 1000)} FROM customer), s AS (SELECT s_suppkey AS id, {place_sql("s_suppkey", 1000)} FROM supplier),
    n AS (SELECT c.id, arg_min(s.id, ({hav("c", "s")}, s.id)) AS locality, min({hav("c", "s")}) AS d FROM c JOIN s ON {hav("c", "s")} <= 3000 GROUP BY c.id)
    SELECT c.id, n.locality, {METRES.format("n.d")} AS distance_m FROM c LEFT JOIN n ON n.id = c.id
""")
def nearest_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J10."""
    towns = suppliers(spark, sf_dir, 1000).select(F.col("id").alias("locality"), F.col("id").alias("o"), "lat", "lon")
    return radius.nearest_within(customers(spark, sf_dir, 1000), towns, places.LOCALITY_MAX_M, "id", "locality", "o").select("id", "locality", half_up(F.col("distance_m")).alias("distance_m"))


# -- graph and clusters ---------------------------------------------------------------------
@query(f"WITH RECURSIVE {CUSTOMERS}, {CUSTOMER_PAIRS}, {REACH} SELECT id, root, (dense_rank() OVER (ORDER BY root) - 1)::BIGINT AS station_id FROM comp")
def components_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2, W6."""
    c = customers(spark, sf_dir)
    found = components.components(radius.pairs_within(c, cluster.MERGE_RADIUS_M, "id", equal=("nation",)))
    roots = c.select("id").join(found.select(F.col("node").alias("id"), "component"), "id", "left").select("id", F.coalesce("component", "id").alias("root"))
    return roots.join(ranked(roots.select("root").distinct(), ["root"], "station_id"), "root").select("id", "root", "station_id")


def cluster_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = customers(spark, sf_dir)
    name = F.col("nation").cast("string")
    return c.select(F.col("id").alias("ord"), F.col("segment").alias("line_id"), F.lit("one").alias("operator"), F.lit(0).alias("stop_index"), F.substring("name", 1, 10).alias("stem"), (F.col("id") % 4).cast("int").alias("cut"), F.lit(None).cast("string").alias("short"), name.alias("norm"), "lat", "lon", F.array(F.col("segment")).alias("aliases")).select("*", F.expr("substring(stem, 1, 6 + cut)").alias("display")).drop("stem", "cut")


@query(f"""
    WITH RECURSIVE {CUSTOMERS}, {CUSTOMER_PAIRS}, {REACH},
    m AS (SELECT c.*, k.root, substr(c.name, 1, 6 + (c.id % 4)::INT) AS display FROM cus c JOIN comp k ON k.id = c.id),
    far AS (SELECT x.root, max({hav("x", "y")}) AS d FROM m x JOIN m y ON x.root = y.root AND x.id < y.id GROUP BY x.root)
    SELECT (dense_rank() OVER (ORDER BY m.root) - 1)::BIGINT AS station_id, arg_max(display, (length(display), -id)) AS display, arg_max(nation, (length(display), -id))::VARCHAR AS norm,
           floor(avg(lat) * 1e6 + 0.5)::BIGINT AS lat_e6, count(*) AS members, count(DISTINCT segment)::INT AS lines, arg_min(segment, id) AS first_line, {METRES.format("coalesce(any_value(far.d), 0)")} AS spread_m
    FROM m LEFT JOIN far ON far.root = m.root GROUP BY m.root
""")
def cluster_materialise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8, G2, A7, A8."""
    members, _ = cluster.cluster_stops(cluster_input(spark, sf_dir))
    s = cluster.materialise_stations(members)
    return s.select("station_id", "display", "norm", half_up(F.col("lat") * 1e6).alias("lat_e6"), "members", F.size("line_ids").alias("lines"), F.col("line_ids")[0].alias("first_line"), half_up(F.col("spread_m")).alias("spread_m"))


@query(f"""
    WITH RECURSIVE {CUSTOMERS}, base AS (SELECT x.id AS a, y.id AS b, x.nation, {hav("x", "y")} AS d FROM cus x JOIN cus y ON x.nation = y.nation AND x.id < y.id),
    e1 AS (SELECT a, b FROM base WHERE d <= 250), e2 AS (SELECT a, b FROM base WHERE d <= 250 OR (nation IN (1, 2) AND d <= 700)),
    w1 AS (SELECT a, b FROM e1 UNION SELECT b, a FROM e1), w2 AS (SELECT a, b FROM e2 UNION SELECT b, a FROM e2),
    r1(id, o) AS (SELECT id, id FROM cus UNION SELECT r.id, w.b FROM r1 r JOIN w1 w ON w.a = r.o), r2(id, o) AS (SELECT id, id FROM cus UNION SELECT r.id, w.b FROM r2 r JOIN w2 w ON w.a = r.o),
    k AS (SELECT c.nation, (SELECT min(o) FROM r1 WHERE r1.id = c.id) AS k1, (SELECT min(o) FROM r2 WHERE r2.id = c.id) AS k2 FROM cus c WHERE nation IN (1, 2))
    SELECT nation::VARCHAR AS norm, count(DISTINCT k1) - count(DISTINCT k2) AS unioned FROM k GROUP BY nation
""")
def force_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a wider radius joins in two named groups."""
    groups = spark.createDataFrame([("1", "one", 700.0), ("2", "one", 700.0)], "norm string, operator string, max_spread_m double")
    return cluster.cluster_stops(cluster_input(spark, sf_dir), groups)[1].select("norm", "unioned")


@query(f"""
    WITH RECURSIVE {SUPPLIERS}, links AS (SELECT x.id AS a, y.id AS b FROM sup x JOIN sup y ON x.id < y.id AND {hav("x", "y")} <= 800), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach(id, other) AS (SELECT id, id FROM sup UNION SELECT r.id, w.b FROM reach r JOIN both_ways w ON w.a = r.other), comp AS (SELECT id, min(other) AS component FROM reach GROUP BY id)
    SELECT s.id AS station_id, any_value(c.component) AS component, count(l.a) AS degree FROM sup s JOIN comp c ON c.id = s.id LEFT JOIN links l ON s.id IN (l.a, l.b) GROUP BY s.id
""")
def connectivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and degrees over the walks between suppliers."""
    s = suppliers(spark, sf_dir).withColumnRenamed("id", "station_id")
    walks = radius.pairs_within(s, 800.0, "station_id").select(F.col("a").alias("a_id"), F.col("b").alias("b_id"))
    none = spark.createDataFrame([], "`from` bigint, `to` bigint")
    return network.connectivity(s, none, walks)


# -- fares ----------------------------------------------------------------------------------
def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_custkey") % 2 == 0, "east").otherwise("west").alias("operator"), (F.floor(F.col("o_totalprice") / 100) / 100).alias("km"), F.pmod(F.col("o_custkey"), F.lit(25)).alias("a"), F.pmod(F.col("o_orderkey"), F.lit(25)).alias("b"))


_TRIPS_SQL = "trips AS (SELECT o_orderkey AS id, CASE WHEN o_custkey % 2 = 0 THEN 'east' ELSE 'west' END AS operator, floor(o_totalprice / 100) / 100::DOUBLE AS km, o_custkey % 25 AS a, o_orderkey % 25 AS b FROM orders)"
_FARE_SQL = f"{_TRIPS_SQL}, s AS (SELECT operator, max_km, fare_paise, lag(max_km) OVER (PARTITION BY operator ORDER BY max_km NULLS LAST) AS lo FROM {SLAB_SQL}), slab AS (SELECT t.*, s.fare_paise FROM trips t LEFT JOIN s ON s.operator = t.operator AND (s.lo IS NULL OR t.km > s.lo) AND (s.max_km IS NULL OR t.km <= s.max_km))"


@query(f"WITH {_FARE_SQL} SELECT id, operator, fare_paise FROM slab")
def slab_fare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J16, W7."""
    return fares.slab_fares(trips(spark, sf_dir), slabs(spark), ["operator"]).select("id", "operator", "fare_paise")


@query(f"SELECT operator, lag(max_km) OVER (PARTITION BY operator ORDER BY max_km NULLS LAST) AS lo_km, max_km, fare_paise FROM {SLAB_SQL}")
def slab_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7."""
    return fares.slab_bounds(slabs(spark), ["operator"]).select("operator", "lo_km", "max_km", "fare_paise")


@query(f"WITH {_FARE_SQL}, x AS (SELECT n_nationkey AS lo, n_nationkey + 1 AS hi, 100 * n_nationkey AS p FROM nation) SELECT id, coalesce(x.p, fare_paise)::INT AS fare_paise FROM slab LEFT JOIN x ON operator = 'east' AND x.lo = least(a, b) AND x.hi = greatest(a, b)")
def override_fare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J17."""
    exact = table(spark, sf_dir, "nation").select(F.lit("east").alias("operator"), (F.col("n_nationkey") + 1).cast("bigint").alias("a"), F.col("n_nationkey").cast("bigint").alias("b"), (F.col("n_nationkey") * 100).alias("fare_paise"))
    return fares.pair_fares(fares.slab_fares(trips(spark, sf_dir), slabs(spark), ["operator"]), exact, ["operator"]).select("id", "fare_paise")


@query(f"""
    WITH s AS (SELECT operator, max_km, fare_paise, lag(max_km) OVER (PARTITION BY operator ORDER BY max_km NULLS LAST) AS lo FROM {SLAB_SQL}),
    legs AS (SELECT user_id, event_type, sum(value::DECIMAL(18,2)) OVER w AS run, lead(event_type) OVER w AS nxt FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    priced AS (SELECT l.user_id, coalesce(CASE WHEN least(event_type, nxt) = 'click' AND greatest(event_type, nxt) = 'view' THEN 750 END, s.fare_paise) AS paise FROM legs l LEFT JOIN s ON s.operator = 'east' AND (s.lo IS NULL OR (l.run / 1000)::DOUBLE > s.lo) AND (s.max_km IS NULL OR (l.run / 1000)::DOUBLE <= s.max_km) WHERE nxt IS NOT NULL)
    SELECT user_id, count(*) AS legs, sum(paise)::BIGINT AS paise FROM priced GROUP BY user_id
""")
def trip_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What trips cost: ordered pairs, running distance, slabs, overrides, totals by user."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    legs = table(spark, sf_dir, "events").select("user_id", F.lit("east").alias("operator"), F.col("event_type").alias("a"), F.lead("event_type").over(w).alias("b"), (F.sum(F.col("value").cast("decimal(18,2)")).over(w.rowsBetween(Window.unboundedPreceding, 0)) / 1000).cast("double").alias("km")).filter("b IS NOT NULL")
    exact = spark.createDataFrame([("east", "view", "click", 750)], "operator string, a string, b string, fare_paise int")
    priced = fares.pair_fares(fares.slab_fares(legs, slabs(spark), ["operator"]), exact, ["operator"])
    return priced.groupBy("user_id").agg(F.count("*").alias("legs"), F.sum("fare_paise").alias("paise"))


# -- network --------------------------------------------------------------------------------
@query("""
    WITH l AS (SELECT n_nationkey AS line_id, CASE n_nationkey % 4 WHEN 0 THEN 'metro' WHEN 1 THEN 'rail' WHEN 2 THEN 'mono' ELSE 'tram' END AS mode, CASE WHEN n_nationkey % 3 = 0 THEN 'fast' ELSE 'slow' END AS service_class FROM nation)
    SELECT line_id, CASE WHEN mode = 'tram' THEN NULL WHEN service_class = 'fast' THEN 55.0::DOUBLE ELSE CASE mode WHEN 'metro' THEN 45.0 WHEN 'rail' THEN 40.0 ELSE 31.0 END END AS speed_kmph, CASE WHEN mode = 'tram' THEN NULL WHEN service_class = 'fast' THEN 30 ELSE 25 END AS dwell_s FROM l
""")
def line_speeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J7."""
    return network.speeds(nation_lines(spark, sf_dir), *speed_tables(spark)).select("line_id", "speed_kmph", "dwell_s")


def nation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    mode = F.element_at(F.array(*map(F.lit, ("metro", "rail", "mono", "tram"))), (k % 4 + 1).cast("int"))
    return table(spark, sf_dir, "nation").select(k.alias("line_id"), mode.alias("mode"), F.when(k % 3 == 0, "fast").otherwise("slow").alias("service_class"))


def speed_tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    modes = spark.createDataFrame([("metro", 45.0, 25), ("rail", 40.0, 25), ("mono", 31.0, 25)], "mode string, speed_kmph double, dwell_s int")
    return modes, spark.createDataFrame([("fast", 55.0, 30)], "service_class string, speed_kmph double, dwell_s int")


@query(f"""
    WITH {SUPPLIERS}, n AS (SELECT *, row_number() OVER w - 1 AS k, lead(id) OVER w AS nid FROM sup WINDOW w AS (PARTITION BY nation ORDER BY id)),
    seg AS (SELECT x.nation AS line_id, x.k AS segment, x.id AS a, y.id AS b, floor({hav("x", "y")} + 0.5) AS m FROM n x JOIN n y ON y.id = x.nid AND y.nation = x.nation),
    t AS (SELECT *, floor(m / ((CASE WHEN line_id % 3 = 0 THEN 55.0::DOUBLE WHEN line_id % 4 = 0 THEN 45.0 WHEN line_id % 4 = 1 THEN 40.0 ELSE 31.0 END) / 3.6::DOUBLE) + CASE WHEN line_id % 3 = 0 THEN 30 ELSE 25 END + 0.5)::BIGINT AS s FROM seg)
    SELECT line_id, segment::INT AS segment, a AS "from", b AS "to", m::BIGINT AS dist_m, CASE WHEN line_id % 4 <> 3 THEN s END AS seconds FROM t UNION ALL SELECT line_id, segment::INT, b, a, m::BIGINT, CASE WHEN line_id % 4 <> 3 THEN s END FROM t
""")
def edge_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two directed edges a segment."""
    return edge_table(spark, sf_dir).select("line_id", "segment", "from", "to", "dist_m", "seconds")


def edge_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = suppliers(spark, sf_dir).withColumnRenamed("nation", "line_id")
    idx = (F.row_number().over(Window.partitionBy("line_id").orderBy("id")) - 1).alias("stop_index")
    members = s.select("line_id", idx, F.col("id").alias("station_id"))
    c = chains.consecutive(s, "id", ["id", "lat", "lon"])
    segments = c.select("line_id", "segment", geo.haversine_m(F.col("from_lat"), F.col("from_lon"), F.col("to_lat"), F.col("to_lon")).alias("dist_m"), F.lit("measured").alias("quality"))
    return network.edges(segments, members, network.speeds(nation_lines(spark, sf_dir), *speed_tables(spark)))[0]


@query("""
    WITH e AS (SELECT s_nationkey AS line_id, s_suppkey AS id, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS k, count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier)
    SELECT line_id, id AS station_id FROM e WHERE n > 1 AND (k = 1 OR k = n)
""")
def line_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A17."""
    return network.endpoints(edge_table(spark, sf_dir)).select("line_id", "station_id")


@query("SELECT s_nationkey AS line_id, (row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1)::INT AS pos, s_suppkey AS station_id FROM supplier QUALIFY count(*) OVER (PARTITION BY s_nationkey) > 1")
def walk_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines walked from an end along their edges."""
    e = edge_table(spark, sf_dir).withColumn("line_id", F.col("line_id").cast("string"))
    return layout.walk_lines(e).select(F.col("line_id").cast("int").alias("line_id"), "pos", "station_id")


@query(f"""
    WITH {SUPPLIERS}, p AS (SELECT x.id AS a, y.id AS b, x.nation = y.nation AS same, floor({hav("x", "y")} + 0.5) AS m FROM sup x JOIN sup y ON x.id < y.id AND {hav("x", "y")} <= 800)
    SELECT a AS a_id, b AS b_id, m::BIGINT AS distance_m, floor(m / 1.2::DOUBLE + 0.5)::BIGINT + CASE WHEN same THEN 120 ELSE 240 END AS seconds FROM p
""")
def interchange_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walks between named stations."""
    return walk_table(spark, sf_dir).select("a_id", "b_id", "distance_m", "seconds")


def walk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = suppliers(spark, sf_dir)
    named = s.select(F.col("id").alias("station_id"), F.concat(F.lit("S"), F.col("id").cast("string")).alias("display"), F.col("nation").cast("string").alias("operator"))
    side = lambda n: named.select(F.col("station_id").alias(n), F.col("display").alias(f"{n}_name"), F.col("operator").alias(f"{n}_operator"))
    near = radius.pairs_within(s, 800.0, "id").select("a", "b", half_up(F.col("distance_m")).alias("distance_m"))
    return network.interchanges(near.join(side("a"), "a").join(side("b"), "b"), named)


@query("""
    WITH f AS (SELECT r_regionkey AS ord, '#l' || r_regionkey AS light, CASE WHEN r_regionkey % 2 = 0 THEN 'dashed' ELSE 'dotted' END AS dash FROM region WHERE r_regionkey < 4)
    SELECT n_nationkey AS line_id, f.light IS NOT NULL AS styled, coalesce(f.light, '#000000') AS light, CASE WHEN f.dash = 'dashed' THEN 'dashed' ELSE 'solid' END AS dash FROM nation LEFT JOIN f ON f.ord = n_regionkey
""")
def line_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations take the colours of their region."""
    n = table(spark, sf_dir, "nation")
    own = n.groupBy("n_regionkey").agg(F.collect_list("n_nationkey").alias("line_ids"))
    r = table(spark, sf_dir, "region").filter("r_regionkey < 4").join(own, F.col("r_regionkey") == F.col("n_regionkey"))
    fam = r.select(F.col("r_regionkey").alias("ord"), F.concat(F.lit("#l"), F.col("r_regionkey").cast("string")).alias("light"), F.lit("#d").alias("dark"), F.when(F.col("r_regionkey") % 2 == 0, "dashed").otherwise("dotted").alias("dash"), "line_ids")
    return network.line_styles(n.select(F.col("n_nationkey").alias("line_id")), fam).select("line_id", "styled", "light", "dash")


@query("SELECT s_suppkey AS station_id FROM supplier WHERE s_nationkey % 5 <> 0")
def routable_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the operators that are suspended."""
    s = suppliers(spark, sf_dir).select(F.col("id").alias("station_id"), F.col("nation").alias("operator"))
    ops = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.when(F.col("n_nationkey") % 5 == 0, "suspended").otherwise("operating").alias("status"))
    return network.routable(s, ops).select("station_id")


@query("SELECT n_nationkey AS operator FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)")
def used_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P13."""
    owned = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("operator"))
    return network.used_only(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("operator")), owned, "operator")


@query("""
    SELECT 'warning' AS level, n_name AS subject FROM nation WHERE n_nationkey % 5 = 0 UNION ALL SELECT 'warning', n_name FROM nation WHERE n_regionkey = 2 UNION ALL SELECT 'info', 'network'
""")
def build_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5."""
    n = table(spark, sf_dir, "nation")
    ops = n.select(F.col("n_name").alias("id"), F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 5 == 0, "suspended").otherwise("operating").alias("status"), F.lit(None).cast("string").alias("status_note"))
    tables = n.select(F.col("n_name").alias("operator"), F.when(F.col("n_regionkey") == 2, "estimated").otherwise("verified").alias("confidence"))
    return network.notices(ops, tables, "times are modelled").select("level", "subject")


# -- reports and checks ---------------------------------------------------------------------
@query("""
    SELECT l_suppkey AS line_id, count(*) FILTER (l_returnflag = 'A') AS measured, count(*) FILTER (l_returnflag = 'R') AS measured_snapped, count(*) FILTER (l_returnflag = 'N') AS estimated_gap, 0::BIGINT AS unlocatable FROM lineitem GROUP BY l_suppkey
""")
def quality_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1."""
    q = F.when(F.col("l_returnflag") == "A", "measured").when(F.col("l_returnflag") == "R", "measured-snapped").when(F.col("l_returnflag") == "N", "estimated-gap")
    return reports.quality_counts(table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("line_id"), q.alias("quality")))


@query("SELECT l_returnflag AS quality, count(*) AS edges FROM lineitem GROUP BY l_returnflag")
def edge_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2."""
    return reports.edge_quality(table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("quality")))


@query("""
    SELECT c_custkey AS id, 'missing' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT DISTINCT o_orderkey, 'extra' FROM orders WHERE o_orderkey NOT IN (SELECT c_custkey FROM customer)
""")
def reconcile_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against all order keys."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    o = table(spark, sf_dir, "orders")
    missing = chains.reconcile(c, o.select(F.col("o_custkey").alias("id")), ["id"]).filter("side = 'missing'")
    return missing.unionByName(chains.reconcile(c, o.select(F.col("o_orderkey").alias("id")), ["id"]).filter("side = 'extra'"))


@query("""
    WITH st AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 11 = 3 THEN 'ghost' ELSE s_nationkey::VARCHAR END AS op, s_nationkey AS line, count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier),
    parts AS (SELECT count(DISTINCT line) AS n FROM st)
    SELECT 'operator-defined' AS rule, 'fatal' AS level, 'ghost' AS subject WHERE EXISTS (SELECT 1 FROM st WHERE op = 'ghost')
    UNION ALL SELECT DISTINCT 'operator-has-fares', 'fatal', op FROM st JOIN nation ON op = n_nationkey::VARCHAR WHERE n_nationkey % 4 <> 0 AND n_nationkey % 7 <> 0 AND n_nationkey % 6 <> 5
    UNION ALL SELECT 'interchange-resolves', 'fatal', 'S1 - S-1' UNION ALL SELECT 'override-resolves', 'fatal', 'S1 - Nowhere' UNION ALL SELECT 'mode-known', 'fatal', n_nationkey::VARCHAR FROM nation WHERE n_nationkey % 4 = 3
    UNION ALL SELECT 'line-styled', 'fatal', n_nationkey::VARCHAR FROM nation WHERE n_regionkey = 4
    UNION ALL SELECT 'isolated', 'fatal', id::VARCHAR FROM st WHERE n = 1 UNION ALL SELECT 'connected', 'fatal', 'network' FROM parts WHERE n > 1
""")
def network_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section 2.11 on a network with planted faults, reach computed over its edges; J5, J13, G5."""
    ghost = F.when(F.col("id") % 11 == 3, "ghost").otherwise(F.col("nation").cast("string"))
    s = suppliers(spark, sf_dir).select(F.col("id").alias("station_id"), F.concat(F.lit("S"), F.col("id").cast("string")).alias("display"), ghost.alias("operator"))
    n = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    ops = n.select(key.cast("string").alias("id"), F.when(key % 6 == 5, "suspended").otherwise("operating").alias("status"))
    own = n.filter("n_regionkey <> 4").groupBy("n_regionkey").agg(F.collect_list(key.cast("string")).alias("line_ids"))
    fam = own.select(F.col("n_regionkey").alias("ord"), F.lit("#1").alias("light"), F.lit("#2").alias("dark"), F.lit("solid").alias("dash"), "line_ids")
    named = nation_lines(spark, sf_dir).withColumn("line_id", F.col("line_id").cast("string"))
    lines = network.line_styles(network.speeds(named, *speed_tables(spark)), fam)
    none = spark.createDataFrame([], "line_id string, segment int, fault string")
    walks = network.interchanges(spark.createDataFrame([("S1", "20", "S-1", "20", 10)], "a_name string, a_operator string, b_name string, b_operator string, distance_m int"), s.withColumn("operator", F.lit("20")))
    slab = n.filter(key % 4 == 0).select(key.cast("string").alias("operator"))
    pairs = n.filter(key % 7 == 0).select(key.cast("string").alias("operator"), F.lit("S1").alias("a_name"), F.lit("x").alias("a_operator"), F.lit("S1").alias("b_name"), F.lit("x").alias("b_operator"))
    astray = spark.createDataFrame([("0", "S1", "x", "Nowhere", "x")], pairs.schema)
    exact = network.resolve_pairs(pairs.union(astray), s.withColumn("operator", F.lit("x")))
    reach = network.connectivity(s, edge_table(spark, sf_dir), spark.createDataFrame([], "a_id bigint, b_id bigint"))
    return checks.network(lines, none, walks, exact, s, ops, slab, reach).select("rule", "level", "subject").distinct()


@query("""
    SELECT n_nationkey::BIGINT AS id, n_nationkey::VARCHAR AS ref, n_name AS name, '—' AS colour, 1 AS stops, 1 AS ways FROM nation
""")
def route_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2."""
    e = element_rows(spark, sf_dir).filter("type = 'relation'").withColumn("tags", F.map_concat("tags", F.create_map(F.lit("ref"), F.col("id").cast("string"))))
    return reports.route_summary(e).select("id", "ref", "name", "colour", "stops", "ways").orderBy(*reports.natural_order("ref", "name"))


@query("SELECT n_nationkey::BIGINT AS rel_id, coalesce('S' || s_suppkey, '<' || (n_nationkey * 3 + 1) || '>') AS name FROM nation LEFT JOIN supplier ON s_suppkey = n_nationkey * 3 + 1")
def stop_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10, P15, P1."""
    e = element_rows(spark, sf_dir)
    members = e.filter("type = 'relation'").select(F.col("id").alias("rel_id"), F.posexplode("members").alias("pos", "m")).select("rel_id", "pos", "m.ref", "m.role")
    return reports.stop_names(members, e.filter("type = 'node'")).select("rel_id", "name")


@query("SELECT o_orderkey AS id, o_totalprice AS price FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The head of a listing (a top-k report)."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price")).orderBy(F.desc("price"), "id").limit(25)


@query("SELECT event_id AS id, strftime(ts, '%Y.%m.%d') AS version, strftime(ts, '%Y-%m-%d') AS day, CASE WHEN event_id % 3 = 0 THEN CAST('inf' AS DOUBLE) ELSE event_id + 0.5::DOUBLE END AS metric FROM events")
def release_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F20, F21."""
    day = text.date_text(F.col("ts"), "-")
    iso = F.when(F.col("event_id") % 2 == 0, F.concat(day, F.date_format("ts", "'T'HH:mm:ss")))
    worst = (F.col("event_id") + F.lit(0.5)).cast("decimal(38,1)").cast("string")  # never with an exponent
    tool = F.when(F.col("event_id") % 3 == 0, F.lit("none")).otherwise(F.concat(F.lit("worst: "), worst, F.lit(" of pairs")))
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), text.version(F.col("ts")).alias("version"), text.day_of(iso, day).alias("day"), text.number_after(tool, "worst").alias("metric"))


@query(f"""
    WITH RECURSIVE {CUSTOMERS}, {CUSTOMER_PAIRS}, {REACH}, m AS (SELECT k.root, any_value(c.nation) AS nation, avg(c.lat) AS lat, avg(c.lon) AS lon, list_sort(list(DISTINCT c.segment)) AS lines, arg_max(substr(c.name, 1, 6 + (c.id % 4)::INT), (6 + (c.id % 4), -c.id)) AS display FROM cus c JOIN comp k ON k.id = c.id GROUP BY k.root),
    far AS (SELECT x.root, max({hav("p", "q")}) AS d FROM comp x JOIN cus p ON p.id = x.id JOIN comp y ON y.root = x.root AND y.id > x.id JOIN cus q ON q.id = y.id GROUP BY x.root),
    near AS (SELECT x.display = y.display AS same, NOT list_has_any(x.lines, y.lines) AS apart FROM m x JOIN m y ON x.root < y.root WHERE {hav("x", "y")} <= 800)
    SELECT (SELECT count(*) FROM m) AS stations, (SELECT count(*) FROM m WHERE len(lines) > 1) AS merged, (SELECT count(*) FROM far WHERE d > 200) AS wide, count(*) FILTER (same) AS same_name, count(*) FILTER (NOT same) AS different_name, count(*) FILTER (apart) AS useful FROM near
""")
def clustering_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3, A20, J9, P16."""
    members, _ = cluster.cluster_stops(cluster_input(spark, sf_dir))
    s = cluster.materialise_stations(members)
    return reports.clustering(s, cluster.propose_interchanges(s))


@query("SELECT n_nationkey::BIGINT AS id, n_name AS name, CASE WHEN s_suppkey IS NULL THEN 1 ELSE 0 END::BIGINT AS unresolved, CASE WHEN s_suppkey IS NULL THEN 1 ELSE 0 END::BIGINT AS anomalies FROM nation LEFT JOIN supplier ON s_suppkey = n_nationkey * 3 + 1")
def dataset_inspection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1, O1."""
    e = element_rows(spark, sf_dir)
    return reports.inspection(e.filter("type = 'relation'"), e.filter("type = 'node'")).select("id", "name", "unresolved", "anomalies")


# -- layout and colours ---------------------------------------------------------------------
_MEDIAN_SQL = "list_sort(list({0}))[(count(*) // 2 + 1)::INT]"


@query(f"""
    WITH {CUSTOMERS}, m AS (SELECT id, radians(lon) AS x, ln(tan(pi() / 4 + radians(lat) / 2)) AS y FROM cus), c AS (SELECT {_MEDIAN_SQL.format("x")} AS cx, {_MEDIAN_SQL.format("y")} AS cy FROM m),
    r AS (SELECT m.*, cx, cy, sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)) AS r FROM m, c), f AS (SELECT max(r) AS far FROM r),
    p AS (SELECT id, CASE WHEN r < 1e-12 THEN x ELSE cx + (x - cx) * far * pow(r / far, 0.62::DOUBLE) / r END AS px, CASE WHEN r < 1e-12 THEN y ELSE cy + (y - cy) * far * pow(r / far, 0.62::DOUBLE) / r END AS py FROM r, f),
    b AS (SELECT min(px) AS x0, max(px) AS x1, min(py) AS y0, max(py) AS y1 FROM p), s AS (SELECT *, least(880 / (x1 - x0), 1380 / (y1 - y0)) AS k FROM b)
    SELECT id AS station_id, floor((60 + (880 - (x1 - x0) * k) / 2 + (px - x0) * k) * 10 + 0.5)::BIGINT AS x_e1, floor((60 + (1380 - (y1 - y0) * k) / 2 + (y1 - py) * k) * 10 + 0.5)::BIGINT AS y_e1 FROM p, s
""")
def upper_median_compress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7-F9, A10-A12."""
    p = layout.project(customers(spark, sf_dir).withColumnRenamed("id", "station_id"))
    return p.select("station_id", half_up(F.col("x") * 10).alias("x_e1"), half_up(F.col("y") * 10).alias("y_e1"))


@query("""
    WITH p AS (SELECT s_nationkey AS line_id, s_suppkey AS id, ((s_suppkey * 37) % 200)::DOUBLE AS x, ((s_suppkey * 53) % 211)::DOUBLE AS y FROM supplier),
    n AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM p WINDOW w AS (PARTITION BY line_id ORDER BY id)),
    c AS (SELECT line_id, CASE WHEN px IS NULL THEN 1 WHEN abs(x - px) < 0.5 OR abs(y - py) < 0.5 OR abs(abs(x - px) - abs(y - py)) < 0.5 THEN 1 ELSE 3 END AS k,
        CASE WHEN px IS NULL THEN 0 ELSE greatest(abs(x - px), abs(y - py)) END AS run FROM n)
    SELECT line_id::VARCHAR AS line_id, sum(k)::INT AS points, sum(run)::BIGINT AS extent FROM c GROUP BY line_id
""")
def octilinear_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lines through suppliers; points, and the longer axis run summed over the connectors."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    pts = s.select(k.alias("station_id"), ((k * 37) % 200).cast("double").alias("x"), ((k * 53) % 211).cast("double").alias("y"))
    order = s.select(F.col("s_nationkey").cast("string").alias("line_id"), (F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey")) - 1).alias("pos"), k.alias("station_id"))
    lines = layout.polylines(order, pts).withColumnRenamed("points", "p")
    # on an octilinear connector the runs and the diagonal add up to its longer axis
    steps = F.transform(F.sequence(F.lit(1), F.size("p") - 1), lambda i: F.greatest(F.abs(F.get("p", i)["x"] - F.get("p", i - 1)["x"]), F.abs(F.get("p", i)["y"] - F.get("p", i - 1)["y"])))
    extent = F.when(F.size("p") > 1, F.aggregate(steps, F.lit(0.0), lambda a, x: a + x)).otherwise(F.lit(0.0))
    return lines.select("line_id", F.size("p").alias("points"), half_up(extent).alias("extent"))


@query("SELECT n_nationkey AS id, 'M' || format('{:.1f} {:.1f}', n_nationkey * 1.5::DOUBLE, n_regionkey * 2.2::DOUBLE) || ' L0.0 1.0' AS path, replace(replace(n_name || ' & <x>', '&', '&amp;'), '<', '&lt;').replace('>', '&gt;') AS label FROM nation")
def svg_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F18, F19."""
    pts = F.array(F.struct((F.col("n_nationkey") * 1.5).alias("x"), (F.col("n_regionkey") * 2.2).alias("y")), F.struct(F.lit(0.0).alias("x"), F.lit(1.0).alias("y")))
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), geo.svg_path(pts).alias("path"), geo.xml_escape(F.concat("n_name", F.lit(" & <x>"))).alias("label"))


@query("SELECT p_size % 3 AS kind, p_name AS name, p_partkey AS ord, row_number() OVER (ORDER BY p_size % 3, p_name, p_partkey) - 1 AS place FROM part")
def place_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By kind, then name in locale order."""
    rows = table(spark, sf_dir, "part").select((F.col("p_size") % 3).alias("kind"), F.col("p_name").alias("name"), F.col("p_partkey").alias("ord")).withColumn("sorted", F.collate("name", "UNICODE"))
    return ranked(rows, ["kind", "sorted", "ord"], "place").drop("sorted")


@query("""
    WITH g AS (SELECT h * 20.0::DOUBLE AS hue, l AS level, (CASE l WHEN 'low' THEN 0.45 WHEN 'mid' THEN 0.55 ELSE 0.65 END)::DOUBLE AS ll, (CASE l WHEN 'low' THEN 0.65 WHEN 'mid' THEN 0.72 ELSE 0.8 END)::DOUBLE AS ld FROM range(18) t(h), (VALUES ('low'), ('mid'), ('high')) v(l)),
    x AS (SELECT hue, level, m, CASE m WHEN 'light' THEN ll ELSE ld END AS l, c::DOUBLE AS c FROM g, (VALUES ('light'), ('dark')) a(m), (VALUES (0.2), (0.18), (0.16), (0.14), (0.12)) b(c)),
    k AS (SELECT *, pow(l + 0.3963377774 * c * cos(radians(hue)) + 0.2158037573 * c * sin(radians(hue)), 3) AS a1, pow(l - 0.1055613458 * c * cos(radians(hue)) - 0.0638541728 * c * sin(radians(hue)), 3) AS a2, pow(l - 0.0894841775 * c * cos(radians(hue)) - 1.291485548 * c * sin(radians(hue)), 3) AS a3 FROM x),
    rgb AS (SELECT *, 4.0767416621 * a1 - 3.3077115913 * a2 + 0.2309699292 * a3 AS r, -1.2684380046 * a1 + 2.6097574011 * a2 - 0.3413193965 * a3 AS g, -0.0041960863 * a1 - 0.7034186147 * a2 + 1.707614701 * a3 AS b FROM k),
    best AS (SELECT hue, level, m, max(c) AS c FROM rgb WHERE least(r, g, b) >= -1e-4 AND greatest(r, g, b) <= 1 + 1e-4 GROUP BY hue, level, m)
    SELECT hue, level, max(c) FILTER (m = 'light') * 100 AS light_chroma, max(c) FILTER (m = 'dark') * 100 AS dark_chroma FROM best GROUP BY hue, level HAVING count(*) = 2
""")
def oklch_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates both modes can show, with the chroma each can hold."""
    levels = [("low", 0.45, 0.65), ("mid", 0.55, 0.72), ("high", 0.65, 0.8)]
    grid = colour.candidate_grid(spark, 18, levels).join(F.broadcast(spark.createDataFrame(levels, "level string, ll double, ld double")), "level")  # three rows
    strongest = lambda c: F.get(F.filter(F.array(*map(F.lit, colour.CHROMAS)), lambda x: colour.oklch_to_rgb(F.col(c), x, F.col("hue")).isNotNull()), F.lit(0)) * 100
    return grid.select("hue", "level", strongest("ll").alias("light_chroma"), strongest("ld").alias("dark_chroma"))


@query("""
    WITH fam AS (SELECT DISTINCT l_suppkey AS station, p_brand AS f FROM lineitem JOIN part ON p_partkey = l_partkey)
    SELECT DISTINCT x.f AS a, y.f AS b FROM fam x JOIN fam y ON x.station = y.station AND x.f < y.f
""")
def meeting_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands that share a supplier, over all suppliers and lines."""
    fam = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("family")).agg(F.collect_list("p_partkey").alias("line_ids"))
    at = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("station_id"), F.col("l_partkey").alias("line_id"))
    return palette.meeting_graph(at, fam, spark.createDataFrame([], "a_id bigint, b_id bigint"))


# -- results that depend on processing order: rows only -------------------------------------------
@query()
def dedupe_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4, A9."""
    return places.dedupe(customers(spark, sf_dir).select(F.col("id").alias("ord"), "name", F.col("segment").alias("norm"), "lat", "lon", (F.col("id") % 3).cast("int").alias("kind")))


@query()
def layout_relax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G7 on the suppliers' layout."""
    return layout.relax(layout.project(suppliers(spark, sf_dir).withColumnRenamed("id", "station_id")))


@query()
def label_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G10, J18, J19."""
    p = layout.project(suppliers(spark, sf_dir).withColumnRenamed("id", "station_id"))
    return layout.place_labels(layout.suppress_repeats(p.select(F.col("station_id").alias("ord"), F.concat(F.lit("Stop "), (F.col("station_id") % 40).cast("string")).alias("text"), "x", "y", (F.col("station_id") % 7).alias("priority"))))


@query()
def colour_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G8, G9, G16 on regions that meet in a ring."""
    grid = [(r["light"], r["dark"]) for r in colour.candidate_grid(spark, 18, [("mid", 0.55, 0.72)]).orderBy("hue").collect()]  # 18 rows at most
    distance = palette.measure_pairs(grid)
    names_ = [r[0] for r in table(spark, sf_dir, "region").select("r_name").orderBy("r_name").collect()]
    meets = {frozenset((a, b)) for a, b in zip(names_, names_[1:] + names_[:1], strict=True)}
    strict = lambda i, j: distance[(i, j)] >= 15
    clique = palette.max_clique(len(grid), strict)
    found = palette.assign(names_, meets, len(grid), strict, distance) or {}
    return spark.createDataFrame([(f, c, *grid[c], len(clique)) for f, c in found.items()], "family string, colour int, light string, dark string, clique int")


@query()
def journeys_from_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fastest journeys over edges and walks from one station."""
    running = edge_table(spark, sf_dir).filter("seconds IS NOT NULL").withColumn("line_id", F.col("line_id").cast("string"))
    return journeys.fastest(running, walk_table(spark, sf_dir), running.agg(F.min("from").alias("source")))
