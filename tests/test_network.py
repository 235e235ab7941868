import pytest
from pyspark.sql import functions as F

from metroloom.functions.numbers import half_up, to_fixed
from metroloom.operators import checks, fares, network
from metroloom.plans import journeys

SLABS = [("m", 3.0, 1000), ("m", 12.0, 2000), ("m", None, 3000)]


def test_rounding(spark):
    r = spark.range(1).select(half_up(F.lit(-0.5)), half_up(F.lit(2.5)), to_fixed(F.lit(1.005), 2)).first()
    assert tuple(r) == (0, 3, 1.0)


def test_slabs_are_inclusive_and_overrides_win(spark):
    slabs = spark.createDataFrame(SLABS, "operator string, max_km double, fare_paise int")
    trips = spark.createDataFrame([(1, "m", 3.0, "x", "y"), (2, "m", 3.01, "x", "z"), (3, "m", 99.0, "y", "x"), (4, "n", 1.0, "x", "y"), (5, "m", 12.0, None, "y")], "id int, operator string, km double, a string, b string")
    got = {r["id"]: r["fare_paise"] for r in fares.slab_fares(trips, slabs, ["operator"]).collect()}
    assert got == {1: 1000, 2: 2000, 3: 3000, 4: None, 5: 2000}
    exact = spark.createDataFrame([("m", "y", "x", 7)], "operator string, a string, b string, fare_paise int")
    got = {r["id"]: r["fare_paise"] for r in fares.pair_fares(fares.slab_fares(trips, slabs, ["operator"]), exact, ["operator"]).collect()}
    assert got == {1: 7, 2: 2000, 3: 7, 4: None, 5: 2000}
    assert [r["lo_km"] for r in fares.slab_bounds(slabs, ["operator"]).orderBy(F.col("max_km").asc_nulls_last()).collect()] == [None, 3.0, 12.0]


@pytest.mark.parametrize(("km", "hops", "speed", "dwell", "minutes"), [(60.18, 28, 40, 25, 102), (60.18, 15, 55, 30, 73), (32.69, 26, 45, 25, 54), (10.90, 11, 45, 25, 19)])
def test_time_model(spark, km, hops, speed, dwell, minutes):
    s = spark.range(1).select(network.edge_seconds(F.lit(km * 1000 / hops), F.lit(float(speed)), F.lit(dwell))).first()[0]
    assert abs(s * hops / 60 - minutes) < 0.7


def test_walk_time(spark):
    r = spark.range(1).select(network.walk_seconds(F.lit(74), F.lit(False)), network.walk_seconds(F.lit(74), F.lit(True))).first()
    assert tuple(r) == (302, 182)


def edge_rows(spark):
    members = spark.createDataFrame([("L", 0, 10), ("L", 1, 11), ("L", 2, 12), ("L", 3, 12)], "line_id string, stop_index int, station_id bigint")
    seg = spark.createDataFrame([("L", 0, 1000.4, "measured"), ("L", 1, 2000.0, "measured"), ("L", 2, 5.0, "measured"), ("L", 3, 5.0, "measured")], "line_id string, segment int, dist_m double, quality string")
    lines = spark.createDataFrame([("L", 36.0, 20)], "line_id string, speed_kmph double, dwell_s int")
    return network.edges(seg, members, lines)


def test_edges_go_both_ways_and_faults_are_rows(spark):
    e, bad = edge_rows(spark)
    assert sorted((r["from"], r["to"], r["dist_m"], r["seconds"]) for r in e.collect()) == [(10, 11, 1000, 120), (11, 10, 1000, 120), (11, 12, 2000, 220), (12, 11, 2000, 220)]
    assert sorted((r["segment"], r["fault"]) for r in bad.collect()) == [(2, "self-loop"), (3, "unmapped")]
    assert {r["station_id"] for r in network.endpoints(e).collect()} == {10, 12}


def test_connectivity_over_edges_and_walks(spark):
    e, _ = edge_rows(spark)
    stations = spark.createDataFrame([(10,), (11,), (12,), (20,), (21,)], "station_id bigint")
    walks = spark.createDataFrame([(12, 20, 60, 100)], "a_id bigint, b_id bigint, seconds bigint, distance_m bigint")
    got = {r["station_id"]: (r["component"], r["degree"] > 0) for r in network.connectivity(stations, e, walks).collect()}
    assert got == {10: (10, True), 11: (10, True), 12: (10, True), 20: (10, True), 21: (21, False)}
    j = {r["station_id"]: r["seconds"] for r in journeys.fastest(e, walks, spark.createDataFrame([(10,)], "source bigint")).collect()}
    assert j == {10: 0, 11: 120, 12: 340, 20: 400}


def test_a_change_of_line_costs(spark):
    e = spark.createDataFrame([("A", 1, 2, 10, 5), ("B", 2, 3, 10, 5), ("C", 1, 3, 150, 9)], "line_id string, `from` bigint, `to` bigint, seconds bigint, dist_m bigint")
    none = spark.createDataFrame([], "a_id bigint, b_id bigint, seconds bigint, distance_m bigint")
    j = {r["station_id"]: (r["seconds"], r["dist_m"]) for r in journeys.fastest(e, none, spark.createDataFrame([(1,)], "source bigint")).collect()}
    assert j == {1: (0, 0), 2: (10, 5), 3: (150, 9)}


def test_gate_stops_on_fatal_rows_only(spark):
    rows = spark.createDataFrame([("a", "warn", "x", "m")], "rule string, level string, subject string, message string")
    checks.gate(rows)
    with pytest.raises(checks.BuildError, match="boom"):
        checks.gate(rows.union(spark.createDataFrame([("b", "fatal", "y", "boom")], rows.schema)))
    assert [r["level"] for r in checks.asset_size(spark, 500_000, 100_000).collect()] == ["fatal", "warn"]
    factors = spark.createDataFrame([("L", 1.2), ("M", 2.5), ("N", None)], "line_id string, factor double")
    assert sorted((r["subject"], r["level"]) for r in checks.calibration(factors).collect()) == [("L", "warn"), ("M", "fatal")]
