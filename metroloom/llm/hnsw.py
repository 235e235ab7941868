"""Approximate nearest neighbours by sharded navigable small-world graphs (operator 2).

Distinct vectors are dealt over shards by a hash. Each shard builds a hierarchical small-world graph:
a vector's top level is geometric, every level keeps neighbours as one flat array of fixed width, and
neighbours are chosen to differ in direction. Vectors are inserted in growing batches: a batch is
searched against the graph so far, all its vectors at once, and linked to what it finds and to its
own members. Finished graphs are rows of flat bytes. Queries go to every shard in blocks, descend
the levels and widen at the ground level; a shard's findings are measured anew in double precision on the
original vectors, and the shards' best are merged.

Equal vectors are one node that lists the ``top + 1`` smallest identifiers: enough for the nearest of any
query, its own row aside, so copies neither crowd a graph nor a result.

A shard holds as many vectors as spread all of them over the cluster's tasks, but SHARD_LEAST at least,
for small graphs find no faster, and SHARD_MOST at most, which bounds a graph's memory. Each graph is built by a
task of its own and searched by one; queries of several shards meet it in blocks.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components take no part; all
others do, for each is scaled by a power of two before its squares are summed; only vectors of a query's own length are candidates; with fewer
candidates all are returned; ties go to the smaller identifier; repeated rows count once; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _shared as sh

WIDTH, BUILD_WIDTH, SEARCH_WIDTH, BLOCK = 16, 64, 96, 256
SHARD_LEAST, SHARD_MOST = 8192, 131_072


def pick(candidates: np.ndarray, near: np.ndarray, unit: np.ndarray, width: int) -> np.ndarray:
    """Of each row's candidates (-1: none; nearest first) up to ``width`` that are nearer to the row than to each other.

    Places left over are filled with the nearest that were passed by."""
    n, c = candidates.shape
    vectors = unit[np.maximum(candidates, 0)]
    among = np.einsum("nid,njd->nij", vectors, vectors)
    good = candidates >= 0
    taken = np.zeros((n, c), bool)
    for j in range(c):
        closer = (taken & (among[:, j] > near[:, j, None])).any(1)
        taken[:, j] = good[:, j] & ~closer & (taken.sum(1) < width)
    rank = np.where(taken, 0, np.where(good, 1, 2)) * c + np.arange(c)
    order = np.argsort(rank, axis=1)[:, :width]
    out = np.take_along_axis(candidates, order, 1)
    if out.shape[1] < width:
        out = np.concatenate([out, np.full((n, width - out.shape[1]), -1, out.dtype)], 1)
    return out


class Graph:
    """Flat neighbour arrays: ``links[level]`` has a row for each node (ground level) or ranked node (above)."""

    def __init__(self, unit: np.ndarray, levels: np.ndarray) -> None:
        self.unit, self.levels = unit, levels
        top = int(levels.max(initial=0))
        self.row = [np.cumsum(levels >= v) - 1 for v in range(top + 1)]
        self.links = [np.full((int((levels >= v).sum()), WIDTH * (2 if v == 0 else 1)), -1, np.int32) for v in range(top + 1)]
        self.entry = -1

    @staticmethod
    def draw_levels(n: int) -> np.ndarray:
        rng = np.random.default_rng(n)
        return np.minimum((-np.log(1 - rng.random(n)) / np.log(WIDTH)).astype(np.int64), 8)

    def search(self, queries: np.ndarray, start: np.ndarray, level: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Best ``width`` nodes of a level for each query (similarity falls; -1 fills), from its start nodes."""
        n, links, row = len(queries), self.links[level], self.row[level]
        ids = np.full((n, width), -1, np.int64)
        near = np.full((n, width), -np.inf, np.float32)
        done = np.zeros((n, width), bool)
        ids[:, 0] = start
        near[:, 0] = np.einsum("nd,nd->n", queries, self.unit[start])
        seen = np.zeros((n, len(self.unit)), bool)
        seen[np.arange(n), start] = True
        live = np.arange(n)
        step = min(4, width)
        while len(live):
            open_ = np.where(done[live] | (ids[live] < 0), -np.inf, near[live])
            at = np.argsort(-open_, axis=1)[:, :step]
            best = np.take_along_axis(open_, at, 1)
            go = best[:, 0] > -np.inf
            live, at, best = live[go], at[go], best[go]
            if not len(live):
                break
            usable = best > -np.inf
            done[live[:, None], at] |= usable
            nodes = np.where(usable, ids[live[:, None], at], -1)
            around = np.where(nodes[:, :, None] >= 0, links[row[np.maximum(nodes, 0)]], -1).reshape(len(live), -1)
            fresh = (around >= 0) & ~seen[live[:, None], np.maximum(around, 0)]
            order = np.argsort(np.where(fresh, around, -1), axis=1)  # a node met twice counts once
            sorted_ = np.take_along_axis(np.where(fresh, around, -1), order, 1)
            once = sorted_ >= 0
            once[:, 1:] &= sorted_[:, 1:] != sorted_[:, :-1]
            most = int(once.sum(1).max())
            if not most:
                continue
            pack = np.argsort(~once, axis=1, kind="stable")[:, :most]
            new = np.where(np.take_along_axis(once, pack, 1), np.take_along_axis(sorted_, pack, 1), -1)
            seen[live[:, None], np.maximum(new, 0)] |= new >= 0
            score = np.where(new >= 0, np.einsum("nd,nkd->nk", queries[live], self.unit[np.maximum(new, 0)]), -np.inf)
            all_ids, all_near = np.concatenate([ids[live], new], 1), np.concatenate([near[live], score], 1)
            all_done = np.concatenate([done[live], np.zeros_like(new, bool)], 1)
            top = np.argsort(-all_near, axis=1, kind="stable")[:, :width]
            ids[live], near[live], done[live] = (np.take_along_axis(x, top, 1) for x in (all_ids, all_near, all_done))
        return ids, near

    def descend(self, queries: np.ndarray, to: int) -> np.ndarray:
        at = np.full(len(queries), self.entry)
        for level in range(int(self.levels[self.entry]), to, -1):
            at = self.search(queries, at, level, 1)[0][:, 0]
        return at

    def link(self, batch: np.ndarray, level: int, ids: np.ndarray, near: np.ndarray) -> None:
        """Links new nodes of a level to what was found, both ways."""
        width, row, links = self.links[level].shape[1], self.row[level], self.links[level]
        own = self.unit[batch] @ self.unit[batch].T  # members of one batch find each other
        np.fill_diagonal(own, -np.inf)
        k = min(WIDTH, len(batch) - 1)
        if k > 0:
            mates = np.argsort(-own, axis=1)[:, :k]
            ids, near = np.concatenate([ids, batch[mates]], 1), np.concatenate([near, np.take_along_axis(own, mates, 1)], 1)
            order = np.argsort(-near, axis=1, kind="stable")[:, :BUILD_WIDTH]
            ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
        chosen = pick(ids, near, self.unit, WIDTH)
        links[row[batch], :WIDTH] = chosen
        source, target = np.repeat(batch, WIDTH), chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        names, first, counts = np.unique(target, return_index=True, return_counts=True)
        for i in range(0, len(names), 512):
            t, c, f = names[i : i + 512], counts[i : i + 512], first[i : i + 512]
            most = int(c.max())
            grid = np.full((len(t), most), -1, np.int64)
            inside = np.arange(most)[None] < c[:, None]
            grid[inside] = source[(f[:, None] + np.arange(most)[None])[inside]]
            old = links[row[t]].astype(np.int64)
            grid[(grid[:, :, None] == old[:, None]).any(2)] = -1  # linked already
            both = np.concatenate([old, grid], 1)
            score = np.where(both >= 0, np.einsum("nd,nkd->nk", self.unit[t], self.unit[np.maximum(both, 0)]), -np.inf)
            order = np.argsort(-score, axis=1, kind="stable")
            both, score = np.take_along_axis(both, order, 1), np.take_along_axis(score, order, 1)
            cap = min(both.shape[1], 2 * width)
            links[row[t]] = pick(both[:, :cap], score[:, :cap], self.unit, width)

    @classmethod
    def build(cls, unit: np.ndarray) -> Graph:
        g = cls(unit, cls.draw_levels(len(unit)))
        order = np.argsort(-g.levels, kind="stable")  # high nodes first: the upper levels stand early
        g.entry = int(order[0])
        done = 1
        while done < len(order):
            batch = order[done : done + min(512, max(16, done))]
            done += len(batch)
            met = []  # on every level before any is linked, so that no way leads to a node without links below
            for level in range(int(g.levels[batch].max()), -1, -1):
                own = batch[g.levels[batch] >= level]
                met.append((own, level, *g.search(unit[own], g.descend(unit[own], level), level, BUILD_WIDTH)))
            for step in met:
                g.link(*step)
        return g


def usable(v: Column) -> Column:
    """Neither null, empty nor zero, and all components finite."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors, each times the power of two that brings its largest component to 0.5 to 1: cosines stay
    what they are, to the last bit, and squares neither vanish nor overflow."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return scaled(flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1))


def scaled(v: np.ndarray) -> np.ndarray:
    return np.ldexp(v, -np.frexp(np.abs(v).max(1, initial=0))[1][:, None])


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of pairs of rows in double precision; a pair's value depends on that pair alone."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def shard_sizes(nodes: DataFrame, shard_rows: int | None) -> dict[int, int]:
    """Shards of each vector length (a row a length)."""
    tasks = nodes.sparkSession.sparkContext.defaultParallelism
    counts = dict(nodes.groupBy(F.size("v")).count().collect())
    rows = shard_rows or min(SHARD_MOST, max(SHARD_LEAST, -(-sum(counts.values()) // tasks)))
    return {n: -(-c // rows) for n, c in counts.items()}


def nearest(df: DataFrame, queries: Column, top: int = 5, key: str = "vec_id", vector: str = "embedding", shard_rows: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: for each row that ``queries`` selects its ``top`` nearest other rows.

    ``shard_rows``: vectors of a shard, if it is not to follow the cluster's size."""
    clean = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"), queries.alias("asks")).filter(F.col("id").isNotNull()).filter(usable(F.col("v")))
    clean = sh.materialise(clean, "vectors")
    # copies: the smallest identifiers are ranked before the shuffle too
    ranked = clean.select("v", "id").distinct().withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("r") <= top + 1)
    nodes = sh.materialise(ranked.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "nodes")
    sizes = shard_sizes(nodes, shard_rows)
    before = dict(zip(sizes, np.cumsum([0, *sizes.values()]).tolist(), strict=False))  # shards are numbered over all lengths
    tasks = max(1, sum(sizes.values()))
    of = lambda table: F.create_map(*[F.lit(x) for pair in (table or {0: 0}).items() for x in pair])[F.size("v")]
    shard = (of(before) + F.pmod(F.xxhash64("v"), of(sizes))).cast("int")

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        for no in np.unique(table["no"].to_numpy()).tolist():
            own = table.filter(pc.equal(table["no"], no))
            v = matrix(own["v"].combine_chunks())
            g = Graph.build((v / np.sqrt((v * v).sum(1))[:, None]).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([no], pa.int32()),
                    pa.array([v.shape[1]], pa.int32()),
                    pa.array([v.tobytes()], pa.binary()),
                    pa.array([own["ids"].to_pylist()], pa.list_(pa.list_(pa.int64()))),
                    pa.array([g.levels.astype(np.int8).tobytes()], pa.binary()),
                    pa.array([[x.tobytes() for x in g.links]], pa.list_(pa.binary())),
                    pa.array([g.entry], pa.int64()),
                ],
                ["no", "dim", "body", "ids", "levels", "links", "entry"],
            )

    schema = "no int, dim int, body binary, ids array<array<long>>, levels binary, links array<binary>, entry long"
    members = nodes.select(shard.alias("no"), "v", F.col("ids").cast("array<long>").alias("ids"))
    index = sh.materialise(members.repartitionById(tasks, "no").mapInArrow(build, schema), "index")

    asked = clean.filter("asks").select("id", "v").distinct()
    sent = asked.filter(of(sizes) > 0).select(F.explode(F.sequence(of(before), of(before) + of(sizes) - 1)).alias("no"), "id", "v")
    nothing = {"dim": "int", "body": "binary", "ids": "array<array<long>>", "levels": "binary", "links": "array<binary>", "entry": "long"}
    both = index.select("*", F.lit(None).cast("long").alias("id"), F.lit(None).cast("array<double>").alias("v")).unionByName(sent.select("no", *[F.lit(None).cast(t).alias(n) for n, t in nothing.items()], "id", "v"))
    stream = both.withColumn("asks", F.col("id").isNotNull()).repartitionById(tasks, "no").sortWithinPartitions("no", "asks")

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, vectors, members = None, None, None
        for b in batches:
            heads = np.flatnonzero(b.column("id").is_null().to_numpy(zero_copy_only=False))
            edges = [0, *heads.tolist(), b.num_rows]
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                if j <= i:
                    continue
                if i in heads:
                    r = b.slice(i, 1).to_pylist()[0]
                    vectors = np.frombuffer(r["body"], np.float64).reshape(-1, r["dim"])
                    graph = Graph((vectors / np.sqrt((vectors * vectors).sum(1))[:, None]).astype(np.float32), np.frombuffer(r["levels"], np.int8).astype(np.int64))
                    graph.links = [np.frombuffer(x, np.int32).reshape(y.shape) for x, y in zip(r["links"], graph.links, strict=True)]
                    graph.entry, members = r["entry"], r["ids"]
                    i += 1
                for lo in range(i, j, BLOCK):
                    part = b.slice(lo, min(BLOCK, j - lo))
                    yield answer(graph, vectors, members, part.column("id").to_pylist(), matrix(part.column("v")))

    def answer(graph: Graph, vectors: np.ndarray, members: list, names: list, asked_: np.ndarray) -> pa.RecordBatch:
        unit = (asked_ / np.sqrt((asked_ * asked_).sum(1))[:, None]).astype(np.float32)
        found, _ = graph.search(unit, graph.descend(unit, 0), 0, min(SEARCH_WIDTH, len(vectors)))
        q, at = np.nonzero(found >= 0)
        node = found[q, at]
        score = cosine(asked_[q], vectors[node])
        out = []
        for k, name in enumerate(names):
            own = np.flatnonzero(q == k)
            own = own[np.argsort(-score[own], kind="stable")]
            floor, rows = -np.inf, []
            for i in own.tolist():
                if len(rows) >= top and score[i] < floor:
                    break
                rows += [(-score[i], m) for m in members[node[i]] if m != name]
                rows = sorted(rows)[:top]
                floor = -rows[-1][0] if rows else -np.inf
            out += [(name, m, -s) for s, m in rows]
        a, m, s = zip(*out, strict=True) if out else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(m, pa.int64()), pa.array(s, pa.float64())], ["query_id", "vec_id", "score"])

    found = stream.mapInArrow(ask, "query_id long, vec_id long, score double")
    merged = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(merged)).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
