import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from metroloom.llm import hnsw, queries

from .conftest import DATA


def brute(rows, asks, top):
    """Exact nearest: id -> list of (id, score), ties to the smaller id."""
    ok = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v, float) / max(abs(x) for x in v)
    out = {}
    for q, v in ok.items():
        if asks(q):
            s = [(-float((v * w).sum() / (np.sqrt((v * v).sum()) * np.sqrt((w * w).sum()))), i) for i, w in ok.items() if i != q and len(w) == len(v)]
            out[q] = [(i, -x) for x, i in sorted(s)[:top]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_copies_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(300 + i, [1.0] * 8) for i in range(200)]
    rows += [(600, None), (601, []), (602, [0.0] * 8), (603, [1.0, None] * 4), (604, [float("nan")] + [1.0] * 7), (605, [float("inf")] + [1.0] * 7), (606, [1.0, 2.0]), (607, [2.0, 4.0]), (608, [3.0])]
    rows += [(610, [1e200, 2e200, 0.0]), (611, [1e-200, 2e-200, 0.0]), (612, [1.5, 3.0, 1e-3]), (613, [5e-324, 0.0, 0.0])]
    rows += rows[:20]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "'x' AS id", "'y' AS v").repartition(3)
    got = found(hnsw.nearest(df, F.col("vec_id") % 2 == 0, top=5, shard_rows=100))
    want = brute(rows, lambda q: q % 2 == 0, 5)
    assert got.keys() == {q for q, x in want.items() if x}
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in got)
    assert hits / sum(map(len, want.values())) > 0.97
    assert [a for a, _ in got[400]] == [300, 301, 302, 303, 304] and [a for a, _ in got[300]] == [301, 302, 303, 304, 305]
    assert got[606] == [(607, 1.0)] or abs(got[606][0][1] - 1) < 1e-15
    assert [a for a, _ in got[610]] == [611, 612, 613] and got[612][0][0] in (610, 611) and [s for _, s in got[610]][0] == 1.0
    assert hnsw.nearest(df.limit(0), F.lit(True)).count() == 0


def test_recall_on_the_table(spark):
    got = found(queries.op2_hnsw(spark, DATA))
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    want = brute(rows, lambda q: q % 50 == 0, 5)
    hits = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.95
    scores = {(q, a): s for q, x in brute(rows, lambda q: q % 50 == 0, 10**6).items() for a, s in x}
    assert all(abs(scores[(q, a)] - s) < 1e-12 for q, x in got.items() for a, s in x)


def test_recall_of_many_vectors_in_shards(spark):
    """50,000 vectors, clustered as embeddings are, in several shards: recall at 5 against brute force."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(400, 32))
    v = (centres[rng.integers(0, 400, 50_000)] + 0.6 * rng.normal(size=(50_000, 32))).astype(np.float32)
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(len(v)), "embedding": list(v)})).repartition(4)
    got = found(hnsw.nearest(df, F.col("vec_id") % 250 == 0))
    unit = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    near = unit[::250] @ unit.T
    near[np.arange(len(near)), np.arange(0, len(v), 250)] = -2
    want = np.argsort(-near, axis=1)[:, :5]
    recall = np.mean([len({a for a, _ in got[250 * i]} & set(w.tolist())) / 5 for i, w in enumerate(want)])
    print(f"recall at 5 of 50,000: {recall:.4f}")
    assert recall >= 0.95


def test_a_graph_finds_neighbours_of_clustered_vectors():
    rng = np.random.default_rng(3)
    v = np.repeat(rng.normal(size=(10, 32)), 200, 0) + 0.05 * rng.normal(size=(2000, 32))
    unit = (v / np.linalg.norm(v, axis=1)[:, None]).astype(np.float32)
    g = hnsw.Graph.build(unit)
    q = unit[::20]
    ids, _ = g.search(q, g.descend(q, 0), 0, hnsw.SEARCH_WIDTH)
    want = np.argsort(-(q @ unit.T), axis=1)[:, :6]
    assert np.mean([len(set(a[:6]) & set(b)) / 6 for a, b in zip(ids, want)]) > 0.95
