"""Every query of the engine against its SQL on DuckDB."""

import heapq
import itertools
import math
import os
from decimal import Decimal

import duckdb
import pytest

from metroloom.plans import audits, queries  # noqa: F401  audits adds to the queries

DATA = os.environ.get("METROLOOM_ORACLE_DATA", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        path = f"{DATA}/{f}"
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return c


def plain(v):
    return float(v) if isinstance(v, Decimal) else v


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, DATA)
    got = df.collect()
    if name not in queries.ORACLES:
        assert got
        return
    r = duck.execute(queries.ORACLES[name])
    columns = [d[0] for d in r.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    want = sorted(repr([plain(row[columns.index(c)]) for c in order]) for row in r.fetchall())
    assert sorted(repr([plain(row[c]) for c in order]) for row in got) == want


def test_whole_tables(spark):
    """Meeting brands and extra keys over all rows, by brute force."""
    read = lambda name, *c: [tuple(r) for r in spark.read.parquet(f"{DATA}/{name}.parquet").select(*c).collect()]
    brand, at = dict(read("part", "p_partkey", "p_brand")), {}
    for s, p in read("lineitem", "l_suppkey", "l_partkey"):
        at.setdefault(s, set()).add(brand[p])
    want = {(a, b) for f in at.values() for a in f for b in f if a < b}
    got = [tuple(r) for r in queries.QUERIES["meeting_graph"](spark, DATA).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    customers, orders = {c for (c,) in read("customer", "c_custkey")}, read("orders", "o_orderkey", "o_custkey")
    want = {(c, "missing") for c in customers - {c for _, c in orders}} | {(o, "extra") for o, _ in orders if o not in customers}
    got = [tuple(r) for r in queries.QUERIES["reconcile_sets"](spark, DATA).select("id", "side").collect()]
    assert len(got) == len(set(got)) and set(got) == want


def rows_of(spark, name):
    return [r.asDict() for r in queries.QUERIES[name](spark, DATA).collect()]


def test_journeys_by_dijkstra(spark):
    """Least seconds over (station, line) states; a change between two lines costs extra, a walk ends the line."""
    out = {}
    for e in queries.edge_table(spark, DATA).filter("seconds IS NOT NULL").collect():
        out.setdefault(e["from"], []).append((e["to"], str(e["line_id"]), e["seconds"], e["dist_m"]))
    start = min(out)
    for w in queries.walk_table(spark, DATA).collect():
        for a, b in ((w["a_id"], w["b_id"]), (w["b_id"], w["a_id"])):
            out.setdefault(a, []).append((b, "", w["seconds"], 0))
    best, heap = {}, [(0, 0, start, "")]
    while heap:
        s, d, at, line = heapq.heappop(heap)
        if (at, line) in best:
            continue
        best[(at, line)] = (s, d)
        for to, by, seconds, metres in out.get(at, []):
            heapq.heappush(heap, (s + seconds + (180 if line and by and line != by else 0), d + metres, to, by))
    want = {}
    for (at, _), label in best.items():
        want[at] = min(label, want.get(at, label))
    got = {r["station_id"]: (r["seconds"], r["dist_m"]) for r in rows_of(spark, "journeys_from_first")}
    assert got == want and len(got) > 10


def test_colours_by_trying_all(spark):
    got = {r["family"]: r for r in rows_of(spark, "colour_assign")}
    ring = sorted(got)
    assert ring == sorted(r["r_name"] for r in spark.read.parquet(f"{DATA}/region.parquet").collect()) and len({r["colour"] for r in got.values()}) == len(ring)
    from metroloom.functions.colour import candidate_grid, delta_e

    grid = [(r["light"], r["dark"]) for r in candidate_grid(spark, 18, [("mid", 0.55, 0.72)]).orderBy("hue").collect()]
    apart = {frozenset(p): min(delta_e(grid[p[0]][k], grid[p[1]][k]) for k in (0, 1)) for p in itertools.combinations(range(len(grid)), 2)}
    for a, b in itertools.combinations(ring, 2):
        near = abs(ring.index(a) - ring.index(b)) in (1, len(ring) - 1)
        assert apart[frozenset((got[a]["colour"], got[b]["colour"]))] >= (15 if near else 10)
    largest = next(n for n in range(len(grid), 0, -1) if any(all(apart[frozenset(p)] >= 15 for p in itertools.combinations(c, 2)) for c in itertools.combinations(range(len(grid)), n)))
    assert {r["clique"] for r in got.values()} == {largest}


def test_places_one_by_one(spark):
    """Greedy clusters of the whole table, each place against all members of all clusters of its name."""
    rows = queries.customers(spark, DATA).select("id", "name", "segment", "lat", "lon").orderBy("id").collect()
    far = lambda a, b: 2 * 6371008.8 * math.asin(min(1, math.sqrt(math.sin(math.radians(b["lat"] - a["lat"]) / 2) ** 2 + math.cos(math.radians(a["lat"])) * math.cos(math.radians(b["lat"])) * math.sin(math.radians(b["lon"] - a["lon"]) / 2) ** 2)))
    groups = []
    for r in rows:
        own = next((g for g in groups if g[0]["segment"] == r["segment"] and any(far(r, m) <= 200 for m in g)), None)
        own.append(r) if own else groups.append([r])
    want = sorted((min(g, key=lambda m: (m["id"] % 3, m["id"]))["id"], len(g)) for g in groups)
    assert sorted((r["ord"], r["members"]) for r in rows_of(spark, "dedupe_greedy")) == want


def test_relaxed_points_keep_their_distance(spark):
    before = {r["station_id"]: (r["x"], r["y"]) for r in queries.layout.project(queries.suppliers(spark, DATA).withColumnRenamed("id", "station_id")).collect()}
    from tests.test_places_layout import spread_out

    got = rows_of(spark, "layout_relax")
    want = dict(zip(sorted(before), spread_out([before[k] for k in sorted(before)])))
    assert all(abs(complex(r["x"], r["y"]) - want[r["station_id"]]) < 1e-6 and abs(r["shift"] - abs(want[r["station_id"]] - complex(*before[r["station_id"]]))) < 1e-6 for r in got)


def test_labels_one_by_one(spark):
    from tests.test_places_layout import labels_one_by_one

    at = {r["station_id"]: (r["x"], r["y"]) for r in queries.layout.project(queries.suppliers(spark, DATA).withColumnRenamed("id", "station_id")).collect()}
    last, rows = {}, []
    for k in sorted(at):
        text = f"Stop {k % 40}"
        if text not in last or math.dist(last[text], at[k]) >= 34:
            last[text] = at[k]
            rows.append((k, text, *at[k], k % 7))
    got = {r["ord"]: (r["x"], r["y"], r["anchor"]) for r in rows_of(spark, "label_place")}
    want = labels_one_by_one(rows, 10.0)
    assert got.keys() == want.keys() and all(math.dist(got[k][:2], want[k][:2]) < 1e-6 and got[k][2] == want[k][2] for k in got)


def test_release_dates_of_odd_events(spark, tmp_path):
    """Keys below 0, above 2**53 and null; years that have not four digits."""
    keys = "0 1 -1 -4 -5 NULL 10000001 4503599627370497 9007199254740995 9223372036854775807 -9223372036854775807".split()
    times = ["NULL", *(f"TIMESTAMP '{t}'" for t in ("2024-01-01 23:59:59.9", "0001-01-01 00:00:00", "1582-10-10 12:00:00", "9999-12-31 23:59:59", "10000-01-01 00:00:00", "12345-06-07 08:09:10", "0044-03-15 (BC) 00:00:00"))]
    c = duckdb.connect()
    c.execute("CREATE TABLE events AS SELECT event_id::BIGINT AS event_id, ts FROM (VALUES " + ", ".join(f"({k}, {t})" for k in keys for t in times) + ") v(event_id, ts)")
    c.execute(f"COPY events TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    got = queries.QUERIES["release_dates"](spark, str(tmp_path)).select("id", "version", "day", "metric").collect()
    assert sorted(repr(tuple(r)) for r in got) == sorted(map(repr, c.execute(queries.ORACLES["release_dates"]).fetchall()))
