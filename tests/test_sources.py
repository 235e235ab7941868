import json

import pytest
from pyspark.sql import functions as F

from metroloom.functions.names import Overrides
from metroloom.operators import checks, reports
from metroloom.plans import build
from metroloom.sources import curated, elements, fetch, sinks
from metroloom.streaming import places as stream

DOC = {
    "version": 0.6,
    "osm3s": {"timestamp_osm_base": "2026-01-01T00:00:00Z"},
    "elements": [{"type": "node", "id": i, "lat": 19 + i * 0.01, "lon": 72.0, "tags": {"name": f"Stop {i}", "railway": "stop"}} for i in range(1, 6)]
    + [{"type": "way", "id": 100, "nodes": [1, 2, 3]}, {"type": "way", "id": 101, "nodes": [5, 4, 3]}]
    + [{"type": "relation", "id": 7, "tags": {"ref": "1", "name": "Line One"}, "members": [{"type": "node", "ref": i, "role": "stop"} for i in (1, 3, 2, 5)] + [{"type": "way", "ref": w, "role": ""} for w in (100, 101)]}]
    + [{"type": "node", "id": 1, "lat": 19.01, "lon": 72.0, "tags": {"name": "Later 1"}}],
}


@pytest.fixture
def document(tmp_path):
    p = tmp_path / "doc.json"
    p.write_text(json.dumps(DOC, indent=1))
    return str(p)


def test_read_and_split(spark, document):
    e = elements.read_elements(spark, document)
    nodes, ways, relations = elements.split(e)
    assert (nodes.count(), ways.count(), relations.count()) == (5, 2, 1)
    assert nodes.filter("id = 1").first()["tags"]["name"] == "Later 1"
    assert tuple(reports.element_counts(e).first()) == (6, 2, 1)
    one = elements.split(e.filter("type = 'relation'"))[2].withColumn("type", F.lit("relation"))
    under = elements.descend(e.filter("type = 'relation'"), e)
    assert under.groupBy("type").count().count() == 3 and one.count() == 1


def test_extraction_end_to_end(spark, document):
    nodes, ways, relations = elements.split(elements.read_elements(spark, document))
    lines = spark.createDataFrame([("L1", 7, "op", 4.0, None)], "line_id string, relation_id bigint, operator string, published_km double, length_floor double")
    got = build.extract(lines, nodes, ways, relations, Overrides())
    assert [r["node_id"] for r in got.stops.orderBy("geo_idx").collect()] == [1, 2, 3, 5]
    assert [round(r["dist_m"]) for r in got.segments.orderBy("segment").collect()] == [1112, 1112, 2224]
    assert {(r["rule"], r["level"]) for r in got.checks.collect()} == {("order-by-geometry", "warn"), ("length-band", "fatal")}


def test_line_rules(spark):
    lines = spark.createDataFrame(
        [("a", "d", 1, None, "9", "Zed", 2, None, None, None), ("b", "d", 2, None, None, None, None, None, None, None), ("c", "x", 1, None, None, None, None, None, None, None), ("e", "d", None, None, None, None, None, None, None, None), ("f", "d", None, ["s"], None, None, None, None, None, None)],
        "id string, dataset string, relation_id bigint, station_order array<string>, assert_ref string, assert_name_includes string, assert_stops int, station_tag string, way_tag string, published_km double",
    )
    rel = spark.createDataFrame([("d", 1, {"ref": "1", "name": "Line"})], "dataset string, id bigint, tags map<string,string>")
    stops = spark.createDataFrame([("a", "way", 5, True), ("a", "node", 6, False), ("a", "node", 7, True)], "line_id string, member_type string, node_id bigint, known boolean")
    got = checks.line_config(lines, spark.createDataFrame([("d",)], "name string"), rel, stops)
    assert sorted((r["rule"], r["subject"]) for r in got.collect()) == [("curated-config", "f"), ("dataset-fetched", "c"), ("name-includes", "a"), ("ref-equals", "a"), ("relation-given", "e"), ("relation-present", "b"), ("stop-count", "a"), ("stop-is-node", "a"), ("stop-node-known", "a")]


def test_fetch_retries_caches_and_counts_failures(tmp_path):
    calls, waits = [], []

    def post(endpoint, query):
        calls.append(endpoint)
        if len(calls) < 4:
            raise ConnectionError("down")
        return DOC

    how = {"post": post, "sleep": waits.append}
    doc, cached = fetch.fetch_dataset(tmp_path, "x", "q1 ", ["m0", "m1", "m2"], **how)
    assert not cached and calls == ["m0", "m1", "m2", "m0"] and waits == [2, 4, 8]
    assert fetch.fetch_dataset(tmp_path, "x", " q1", ["m0"], **how)[1]
    assert not fetch.fetch_dataset(tmp_path, "x", "q2", ["m0"], **how)[1]
    (tmp_path / "x.meta.json").unlink()
    assert fetch.read_cached(tmp_path, "x") is None

    def bad(endpoint, query):
        raise fetch.QueryError("no")

    assert set(fetch.fetch_all(tmp_path, {"a": "q", "b": "q"}, ["m"], only="b", post=bad)) == {"b"}
    assert doc["elements"] and fetch.counts(DOC) == {"nodes": 6, "ways": 2, "relations": 1}


def test_gated_writers(spark, tmp_path):
    df = spark.range(3)
    bad = spark.createDataFrame([("r", "fatal", "s", "m")], "rule string, level string, subject string, message string")
    with pytest.raises(checks.BuildError):
        sinks.gate_then_write(str(tmp_path / "a"), {"t": df}, bad)
    assert not (tmp_path / "a").exists()
    with pytest.raises(checks.BuildError):
        sinks.write_then_gate(str(tmp_path / "b"), {"t": df}, bad)
    assert spark.read.parquet(str(tmp_path / "b/t")).count() == 3
    raw, packed = sinks.write_asset(tmp_path / "n.json", sinks.as_document({"t": df}), bad.limit(0))
    assert raw > packed - 100 and json.loads((tmp_path / "n.json").read_text()) == {"t": [{"id": 0}, {"id": 1}, {"id": 2}]}
    p = spark.createDataFrame([('A "b"', 1.5, 2.5, 1, -1)], "name string, lat double, lon double, kind int, locality_index int")
    assert json.loads(sinks.positional(p).first()[0]) == ['A "b"', 1.5, 2.5, 1, -1]


def test_stream_takes_a_place_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.json").write_text("\n".join(json.dumps(e) for e in DOC["elements"]))
    q = stream.fresh_places(stream.read_stream(spark, str(src)), []).writeStream.format("memory").queryName("fresh").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        q.processAllAvailable()
        (src / "2.json").write_text(json.dumps(DOC["elements"][0]))
        q.processAllAvailable()
        assert spark.table("fresh").count() == 6
    finally:
        q.stop()


def test_curated_tables(spark, tmp_path):
    def write(name, doc):
        p = tmp_path / name
        p.write_text(json.dumps(doc, indent=1))
        return str(p)

    lines = curated.lines(spark, write("l.json", {"$c": "x", "lines": [{"id": "A", "dataset": "d", "relationId": 5, "assertStops": 3, "publishedRouteLengthKm": 2.5, "stationTag": {"key": "k", "value": "v"}}]})).first()
    assert (lines["id"], lines["relation_id"], lines["published_km"], lines["station_tag"]["key"], lines["station_order"]) == ("A", 5, 2.5, "k", None)
    s = curated.slabs(spark, write("s.json", {"tables": [{"operator": "m", "class": "x", "confidence": "verified", "slabs": [{"maxKm": 3, "farePaise": 1000}, {"maxKm": None, "farePaise": 2000}]}]})).collect()
    assert [(r["max_km"], r["fare_paise"]) for r in s] == [(3.0, 1000), (None, 2000)]
    o = curated.pair_fares(spark, write("o.json", {"tables": [{"operator": "m", "pairs": [{"a": "P", "b": "Q", "farePaise": 7}]}]})).first()
    assert (o["a_name"], o["b_operator"], o["fare_paise"]) == ("P", "m", 7)
    k = curated.links(spark, write("i.json", {"links": [{"a": {"name": "P", "operator": "m"}, "b": {"name": "Q", "operator": "n"}, "distanceM": 74, "reason": "r"}], "rejected": [{}]})).collect()
    assert [(r["a_name"], r["b_operator"], r["distance_m"]) for r in k] == [("P", "n", 74)]
    ops = curated.operators(spark, write("p.json", {"operators": [{"id": "m", "status": "suspended", "statusNote": "x"}]})).first()
    assert (ops["id"], ops["status_note"]) == ("m", "x")
    modes, classes = curated.speeds(spark, write("v.json", {"modes": {"$c": 1, "metro": {"runningSpeedKmph": 45, "dwellSeconds": 25}}, "serviceClassOverrides": {"fast": {"runningSpeedKmph": 55, "dwellSeconds": 30}}}))
    assert tuple(modes.first()) == ("metro", 45.0, 25) and tuple(classes.first()) == ("fast", 55.0, 30)
    names, guards, forced = curated.name_rules(write("n.json", {"normStopWords": {"words": ["jn"]}, "stripSuffixes": {}, "doNotMerge": {"names": [{"norm": "a", "maxClusterSpreadM": 300}]}, "forceMerge": {"groups": [{"norm": "b", "operator": "m", "maxSpreadM": 400}]}}))
    assert names.stop_words == ["jn"] and guards == [("a", 300.0)] and forced == [("b", "m", 400.0)]


def test_line_without_a_relation(spark):
    nodes = [(i, 19 + i * 0.01, 72.0) for i in range(1, 7)]
    coords = spark.createDataFrame(nodes, "node_id bigint, lat double, lon double")
    named = coords.join(spark.createDataFrame([(1, "A", 0), (3, "B", 1), (5, "C", 2), (6, None, 3)], "node_id bigint, name string, ord int"), "node_id")
    ways = spark.createDataFrame([(100, [1, 2, 3], 0), (101, [5, 6], 1)], "way_id bigint, nodes array<bigint>, ord int")
    order = spark.createDataFrame([(0, "A"), (1, "B"), (2, "C"), (3, "D")], "idx int, name string")
    got = build.extract_ordered("L", order, named, ways, coords, 6000.0)
    seg = got.segments.orderBy("segment").collect()
    assert [r["quality"] for r in seg] == ["measured", "estimated-gap"] and abs(sum(r["dist_m"] for r in seg) - 6000) < 1e-6
    assert {(r["rule"], r["level"]) for r in got.checks.collect()} == {("station-order", "fatal"), ("calibration", "warn"), ("stop-named", "fatal")}


def test_reports(spark, document):
    nodes, _, relations = elements.split(elements.read_elements(spark, document))
    assert [r["name"] for r in reports.dump_stops(relations, nodes, "1").collect()] == ["Later 1", "Stop 3", "Stop 2", "Stop 5"]
    assert reports.unrouted_stations(nodes).count() == 0
    assert reports.inspection(relations, nodes).first()["stops"] == 4
    seg = spark.createDataFrame([("L", 0, "measured"), ("L", 1, "estimated-gap")], "line_id string, segment int, quality string")
    assert reports.unmeasured(seg).count() == 1
