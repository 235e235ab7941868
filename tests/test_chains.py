import math

from pyspark.sql import functions as F

from metroloom.functions.geo import haversine_m
from metroloom.operators import chains

NODES = [(i, 19 + i * 0.01, 72.0) for i in range(1, 20)]


def hav(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371008.8 * math.asin(min(1, math.sqrt(h)))


def setup(spark, ways, nodes=NODES):
    w = spark.createDataFrame([(i, n) for i, n in ways.items()], "way_id bigint, nodes array<bigint>")
    m = spark.createDataFrame([("L", k, i) for k, i in enumerate(ways)] + [("L", 99, -1)], "line_id string, pos int, way_id bigint")
    n = spark.createDataFrame(nodes, "node_id bigint, lat double, lon double")
    return chains.cumulative(chains.stitch(m, w), n), n


def lists(track):
    out = {}
    for r in track.orderBy("chain", "pos").collect():
        out.setdefault(r["chain"], []).append(r["node_id"])
    return list(out.values())


def test_haversine_of_a_known_pair(spark):
    d = spark.range(1).select(haversine_m(F.lit(18.9316), F.lit(72.8266), F.lit(19.4559), F.lit(72.7933)), haversine_m(F.lit(None).cast("double"), F.lit(1.0), F.lit(1.0), F.lit(1.0))).first()
    assert abs(d[0] - 58404.364) < 0.01 and d[1] is None


def test_stitches_reversed_ways_and_breaks(spark):
    track, _ = setup(spark, {100: [1, 2, 3], 101: [4, 3], 102: [4, 5]})
    assert lists(track) == [[1, 2, 3, 4, 5]]
    cum = [r["cum_m"] for r in track.orderBy("pos").collect()]
    assert cum[0] == 0 and cum == sorted(cum) and abs(cum[-1] - hav((19.01, 72), (19.05, 72))) < 1e-6
    assert lists(setup(spark, {1: [3, 4], 2: [1, 2, 3], 3: [1, 9]})[0]) == [[9, 1, 2, 3, 4]]
    assert lists(setup(spark, {300: [1, 2], 301: [8, 9], 302: [5]})[0]) == [[1, 2], [8, 9]]


def test_a_missing_node_adds_nothing(spark):
    track, _ = setup(spark, {1: [1, 500, 2]})
    cum = [r["cum_m"] for r in track.orderBy("pos").collect()]
    assert cum[1] == 0 and abs(cum[2] - hav((19.01, 72), (19.02, 72))) < 1e-6


def stops(spark, ids, extra=()):
    where = {i: (a, b) for i, a, b in [*NODES, *extra]}
    return spark.createDataFrame([("L", k, i, *where.get(i, (None, None))) for k, i in enumerate(ids)], "line_id string, idx int, node_id bigint, lat double, lon double")


def test_geometry_beats_member_order(spark):
    track, _ = setup(spark, {200: [10, 11, 12, 13]})
    o = chains.order_stops(chains.locate(stops(spark, [10, 12, 11, 13]), track)).orderBy("geo_idx").collect()
    assert [r["node_id"] for r in o] == [10, 11, 12, 13] and sum(r["reordered"] for r in o) == 2 and o[0]["line_chain"] == 0
    back = chains.order_stops(chains.locate(stops(spark, [13, 11, 12, 10]), track)).orderBy("geo_idx").collect()
    assert [r["node_id"] for r in back] == [13, 12, 11, 10] and back[0]["direction"] == "backward"


def test_stops_on_two_chains_are_not_ordered(spark):
    track, _ = setup(spark, {300: [1, 2], 301: [8, 9]})
    o = chains.order_stops(chains.locate(stops(spark, [9, 1, 8]), track)).orderBy("geo_idx").collect()
    assert [r["node_id"] for r in o] == [9, 1, 8] and o[0]["line_chain"] is None and o[0]["chains_with_stops"] == [0, 1]


def test_snapping_and_measuring(spark):
    extra = [(50, 19.02, 72.001), (51, 19.02, 72.5)]
    track, _ = setup(spark, {1: [1, 2, 3], 2: [8, 9]})
    located = chains.locate(stops(spark, [1, 50, 8, 51, 777], extra), track)
    got = {r["node_id"]: (r["method"], r["chain_pos"]) for r in located.collect()}
    assert got == {1: ("on-chain", 0), 50: ("snapped", 1), 8: ("on-chain", 0), 51: (None, None), 777: (None, None)}
    m = chains.measure(located, "idx").orderBy("segment").collect()
    assert [r["quality"] for r in m] == ["measured-snapped", "estimated-gap", "unlocatable", "unlocatable"]
    assert abs(m[0]["dist_m"] - hav((19.01, 72), (19.02, 72))) < 1e-6 and abs(m[1]["dist_m"] - 1.08 * hav((19.02, 72.001), (19.08, 72))) < 1e-6 and m[3]["dist_m"] == 0
    cal = chains.measure_calibrated(located.filter("idx < 3"), spark.createDataFrame([("L", 20000.0)], "line_id string, total_m double")).orderBy("segment").collect()
    assert abs(sum(r["dist_m"] for r in cal) - 20000) < 1e-6 and cal[0]["quality"] == "measured"


def test_reconcile_and_last_wins(spark):
    a, b = spark.createDataFrame([("x",), ("y",)], "name string"), spark.createDataFrame([("y",), ("z",), ("z",)], "name string")
    assert sorted(map(tuple, chains.reconcile(a, b, ["name"]).collect())) == [("x", "missing"), ("z", "extra")]
    rows = spark.createDataFrame([(1, 0, "a"), (1, 1, "b")], "id int, ord int, v string")
    assert chains.last_wins(rows, ["id"], "ord").first()["v"] == "b"
