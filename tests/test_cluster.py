import random

from pyspark.sql import functions as F

from metroloom.operators import cluster, components, radius

from tests.test_chains import hav

SCHEMA = "ord bigint, line_id string, operator string, stop_index int, display string, short string, norm string, lat double, lon double, aliases array<string>"


def stop(k, line, op, name, lat, lon, short=None):
    return (k, line, op, 0, name, short, name.lower(), lat, lon, [name[:3]])


def run(spark, rows, groups=None):
    df = spark.createDataFrame(rows, SCHEMA)
    g = spark.createDataFrame(groups, "norm string, operator string, max_spread_m double") if groups else None
    members, applied = cluster.cluster_stops(df, g)
    return cluster.materialise_stations(members).orderBy("station_id").collect(), applied.collect() if applied is not None else None


def test_two_operators_stay_apart(spark):
    s, _ = run(spark, [stop(0, "M1", "metro", "Millbrook", 19.0858, 72.908), stop(1, "C", "suburban", "Millbrook", 19.0862, 72.9086)])
    assert len(s) == 2


def test_near_stops_of_one_operator_merge(spark):
    s, _ = run(spark, [stop(0, "H", "sub", "Harrow", 19.0544, 72.8402), stop(1, "W", "sub", "Harrow", 19.0546, 72.8404, "HW")])
    assert len(s) == 1 and s[0]["line_ids"] == ["H", "W"] and s[0]["short"] == "HW" and s[0]["operators"] == ["sub"] and s[0]["spread_m"] > 0 and abs(s[0]["lat"] - 19.0545) < 1e-9


def test_far_stops_stay_apart(spark):
    s, _ = run(spark, [stop(0, "W", "sub", "Easterby", 19.3521, 72.8449), stop(1, "M", "sub", "Easterby", 19.00954, 72.84787)])
    assert [r["station_id"] for r in s] == [0, 1]


def test_force_merge_is_scoped(spark):
    rows = [stop(0, "W", "sub", "Larkhill", 19.1367, 72.8493), stop(1, "H", "sub", "Larkhill", 19.1417, 72.8503), stop(2, "M", "metro", "Kingsmere", 19.0234, 72.839), stop(3, "W", "sub", "Kingsmere", 19.0189, 72.8435)]
    assert len(run(spark, rows)[0]) == 4
    s, applied = run(spark, rows, [("larkhill", "sub", 700.0), ("kingsmere", "metro", 900.0)])
    assert len(s) == 3 and {r["norm"]: r["unioned"] for r in applied} == {"larkhill": 1, "kingsmere": 0}


def test_components_against_union_find(spark):
    rng = random.Random(5)
    path = [(i, i + 1) for i in range(300)]
    rng.shuffle(path)
    star = [(1000, 1000 + i) for i in range(1, 200)]
    rest = [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(150)]
    edges = path + star + rest + [(5000, 5000)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = sorted((find(a), find(b)))
        parent[rb] = ra
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_grid_joins_against_brute_force(spark):
    rng = random.Random(3)
    pts = [(i, 18.9 + rng.random() * 0.05, 72.8 + rng.random() * 0.05) for i in range(300)] + [(300, 18.9, 72.8), (301, 18.9, 72.8), (302, -0.0001, 0.0001), (303, 0.0001, -0.0001)]
    df = spark.createDataFrame(pts, "id bigint, lat double, lon double")
    want = {(a[0], b[0]) for a in pts for b in pts if a[0] < b[0] and hav(a[1:], b[1:]) <= 800}
    assert {(r["a"], r["b"]) for r in radius.pairs_within(df, 800.0, "id").collect()} == want
    towns = spark.createDataFrame([(k, k, a, b) for k, a, b in pts[:40]], "t bigint, o bigint, lat double, lon double")
    got = {r["id"]: r["t"] for r in radius.nearest_within(df, towns, 900.0, "id", "t", "o").collect()}
    for k, a, b in pts:
        d, t = min((hav((a, b), x[1:]), x[0]) for x in pts[:40])
        assert got[k] == (t if d <= 900 else None)


def test_interchange_candidates(spark):
    s = spark.createDataFrame([(0, "A", "a", 19.0, 72.0, ["1"], ["x"]), (1, "B", "b", 19.001, 72.0, ["2"], ["y"]), (2, "C", "c", 19.001, 72.001, ["1"], ["x"]), (3, "D", "d", 20.0, 72.0, ["1"], ["x"])], "station_id bigint, display string, norm string, lat double, lon double, line_ids array<string>, operators array<string>")
    got = {(r["a"], r["b"]): r["connects_disjoint_lines"] for r in cluster.propose_interchanges(s).collect()}
    assert got == {(0, 1): True, (0, 2): False, (1, 2): True}
    assert cluster.guard_spread(s.withColumn("spread_m", F.lit(5.0)), spark.createDataFrame([("a", 1.0), ("zz", 1.0)], "norm string, max_spread_m double")).filter("spread_m > max_spread_m").count() == 1


def test_pairs_across_the_date_line_and_near_a_pole(spark):
    rng = random.Random(5)
    at = [(rng.uniform(-0.01, 0.01), (180 + rng.uniform(-0.01, 0.01) + 180) % 360 - 180) for _ in range(60)] + [(89.99 + rng.uniform(0, 0.009), rng.uniform(-180, 180)) for _ in range(40)] + [(66.0, 20.0), (66.0, 20.01)]
    df = spark.createDataFrame([(i, a, o) for i, (a, o) in enumerate(at)], "id bigint, lat double, lon double")
    want = {(i, j) for i in range(len(at)) for j in range(i + 1, len(at)) if hav(at[i], at[j]) <= 700}
    got = [(r["a"], r["b"]) for r in radius.pairs_within(df, 700.0, "id").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    near = {r["l"]: r["r"] for r in radius.nearest_within(df.select(F.col("id").alias("l"), "lat", "lon"), df.select(F.col("id").alias("r"), "lat", "lon", (-F.col("id")).alias("o")), 700.0, "l", "r", "o").collect()}
    assert near == {i: i for i in range(len(at))}


def test_spread_of_long_and_round_stations(spark):
    rng = random.Random(6)
    rows = [(k, i, 19 + rng.uniform(-1, 1) * (0.02 if k % 2 else 0.0005), 72 + rng.uniform(-1, 1) * 0.02) for k in range(6) for i in range(k * 12 + 1)]
    df = spark.createDataFrame(rows, "station_id bigint, ord bigint, lat double, lon double")
    for r in cluster.spread(df).collect():
        own = [x[2:] for x in rows if x[0] == r["station_id"]]
        assert abs(r["spread_m"] - max(hav(a, b) for a in own for b in own)) < 1e-6


def test_components_by_joins_and_by_one_task(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(380)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    one = {tuple(r) for r in components.components(df).collect()}
    assert {tuple(r) for r in components.components(df, few=20).collect()} == one
    assert all(c <= n for n, c in one) and all(dict(one)[a] == dict(one)[b] for a, b in edges)


def most_rows(df):
    """The most rows that a node of the executed plan put out."""
    todo, most = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        made, kind = node.metrics().get("numOutputRows"), node.getClass().getSimpleName()
        most = max(most, made.get().value() if made.isDefined() else 0)
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return most


def test_nearest_of_crowded_places_without_all_pairs(spark):
    """Copies and neighbours within the cap: 3,600 by 3,200 rows, nearly all within each other's cells."""
    rng = random.Random(8)
    near = lambda n, w: [(18.9 + rng.random() * w, 72.8 + rng.random() * w) for _ in range(n)]
    asks, towns = near(800, 0.02) + near(100, 0.2), near(799, 0.018)
    towns.append(asks[0])
    rows = [(i, *asks[i % 900]) for i in range(3600)] + [(3600, None, 72.8), (3601, float("nan"), 72.8)]
    left = spark.createDataFrame(rows, "id bigint, lat double, lon double")
    right = spark.createDataFrame([(k, -k, *towns[k % 800]) for k in range(3200)], "t bigint, o bigint, lat double, lon double")
    found = radius.nearest_within(left, right, 3000.0, "id", "t", "o")
    got = {r["id"]: (r["t"], r["distance_m"]) for r in found.collect()}
    best = [min((hav(a, t), k) for k, t in enumerate(towns)) for a in asks]
    assert len(got) == 3602 and got[3600] == got[3601] == (None, None) and 0 < sum(d > 3000 for d, _ in best) < 100
    for i in range(3600):
        d, k = best[i % 900]
        assert got[i] == (None, None) if d > 3000 else got[i][0] == k + 2400 and abs(got[i][1] - d) < 1e-6
    assert most_rows(found) < 200_000
