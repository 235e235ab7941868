"""Connected components by repeated contraction (G2): joins and minima only, no driver-side graph."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import materialise

#: Edges that one task finishes by itself; more are contracted by joins until so few are left.
FEW = 16_384


def least_reachable(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, up) of the ends of at most FEW edges; up is the smallest node reachable."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := above.setdefault(x, x)) != x:
            above[x] = x = above[up]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            low, high = sorted((top(a), top(b)))
            above[high] = low
    yield pa.RecordBatch.from_arrays([pa.array(list(above), pa.int64()), pa.array([top(x) for x in list(above)], pa.int64())], ["node", "up"])


def hooks_of(live: DataFrame) -> DataFrame:
    """(node, up): every node hooked to the least of itself and its neighbours, hooks followed twice."""
    both = live.union(live.select("b", "a"))
    hooks = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("up")), "hooks")
    for _ in range(2):
        above = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
        hooks = hooks.join(above, "up").select("node", F.col("top").alias("up"))
    return materialise(hooks, "hooks")


def components(edges: DataFrame, a: str = "a", b: str = "b", few: int = FEW) -> DataFrame:
    """(node, component) for every end of an edge; component is the smallest node reachable.

    Each round hooks every node to the least of itself and its neighbours, follows the hooks twice,
    and contracts the edges to the roots found, until ``few`` edges are left, which one task joins. The count of
    edges shrinks by at least half a round for connected parts, so rounds are logarithmic. A node
    with very many neighbours is met by partial minima before the shuffle, and by skew splitting in
    the joins. Nodes are whole numbers. Self-loops give a component of one; an empty table gives an empty table."""
    pairs = materialise(edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).filter("a IS NOT NULL AND b IS NOT NULL").distinct(), "edges")
    labels = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct().withColumn("component", F.col("node"))
    live = pairs.filter("a <> b")
    while n := live.count():
        hooks = hooks_of(live) if n > few else live.coalesce(1).mapInArrow(least_reachable, "node long, up long")
        labels = labels.join(hooks.select(F.col("node").alias("component"), "up"), "component", "left").select("node", F.coalesce("up", "component").alias("component"))
        if n <= few:
            break
        labels = materialise(labels, "labels")
        step = live.join(hooks.select(F.col("node").alias("a"), F.col("up").alias("ua")), "a").join(hooks.select(F.col("node").alias("b"), F.col("up").alias("ub")), "b")
        live = materialise(step.filter("ua <> ub").select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(), "edges")
    return materialise(labels, "labels")
