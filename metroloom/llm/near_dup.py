"""Near-duplicate documents by an LSH forest of MinHash signatures (operator 5).

Texts with equal shingle sets form a class; one member stands for it. A signature is a row of minima
(levels, a byte each); order t of a forest of depth d starts at level t * d, goes round the signature and
is sorted, so that neighbours in an order share the longest common prefixes. A region of an order
is what shares its first d levels. In each order

* a region of up to WINDOW + 1 rows is compared whole: each row with all its neighbours that share the prefix;
* in a denser one each row is compared with the neighbours next to it, whose common prefix is the
  longest there is, and in the shallowest forest with pivots, rows that share most levels with the region's
  commonest ones.

Comparisons keep pairs whose estimated similarity is within five deviations of the threshold; those are
confirmed on full shingle sets by exact integer counts. Confirmed links make components, and a dense region
that lies in one component is done. Of every other dense region, rows outside its main component, if they
fill a block at most, are compared with all its rows; the rows of the remaining regions are sorted anew
with a depth greater by two and as many orders as that depth asks for, so the depth follows each region's
density. At the greatest depth all rows outside the main component are compared with all rows,
whatever the region's size. Such comparisons are dealt out as blocks of about BLOCK rows against blocks, and
confirmed in their task on full sets, so no region is cut and no pair is passed over.

What is left to chance: a pair at the threshold s shares no region of a forest of depth d with the
probability (1 - s**d)**orders. The orders are chosen to keep that below MISS for every depth, so a pair
is lost with a probability below 4 * MISS; all else is exact.

Edge cases: null text and text without words have an empty set, link to nothing and stay; fewer
than five words make one shingle; rows with equal identifiers share their class, and as a stage an
identifier stays with all its rows if one of them stays; texts are read whole; an empty table gives an
empty table; further columns are not touched.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from . import _shared as sh
from .words import mix, shingle_sets, signatures, stream, word_hashes

DEPTHS, MISS, MOST = (2, 4, 6, 8), 1e-6, 640
WINDOW, PIVOTS = 16, 4
#: Levels that rows carry in an order; the whole signature stays with the class.
CARRIED = 128
#: Rows (and shingles) of a block, and rows that choose pivots together: these set how work is dealt out, not what is linked.
BLOCK, BLOCK_SHINGLES, PIECE = 2048, 1 << 21, 4096


def orders(depth: int, threshold: float) -> int:
    """Orders of a forest of this depth that lose a pair at the threshold with a probability of MISS."""
    return math.ceil(math.log(MISS) / math.log(1 - threshold**depth)) if threshold < 1 else 1


def depths(threshold: float) -> list[int]:
    """The depths whose orders fit a signature of MOST levels (a low threshold needs many orders)."""
    return [d for d in DEPTHS if d == DEPTHS[0] or d * orders(d, threshold) <= MOST]


def levels_of(threshold: float) -> int:
    return max(d * orders(d, threshold) for d in depths(threshold))


def set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def sketch(df: DataFrame, key: str, text: str, words: int, threshold: float) -> DataFrame:
    """key, n_shingles, class (of equal sets), signature bytes, and the regions of the shallowest forest."""
    depth, trees = DEPTHS[0], orders(DEPTHS[0], threshold)
    size = levels_of(threshold)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = stream(4, trees)
        for batch in batches:
            done = 0
            for part in sh.blocks(sh.strings(batch.column(1))):
                sets = shingle_sets(*word_hashes(part), words)
                full = [i for i, s in enumerate(sets) if len(s)]
                minima = signatures([sets[i] for i in full], size)
                levels = (minima * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8)
                with np.errstate(over="ignore"):
                    regions = np.tile(order, (len(full), 1))
                    for d in range(depth):
                        regions = mix(regions + minima[:, d : trees * depth : depth])
                sig: list = [None] * len(sets)
                reg: list = [None] * len(sets)
                for i, row, r in zip(full, levels, regions.view(np.int64).tolist(), strict=True):
                    sig[i], reg[i] = row.tobytes(), r
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(part)), pa.array(map(len, sets), pa.int64()), pa.array(map(set_key, sets), pa.binary()), pa.array(sig, pa.binary()), pa.array(reg, pa.list_(pa.int64()))],
                    [key, "n_shingles", "cls", "sig", "own"],
                )
                done += len(part)

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_shingles long, cls binary, sig binary, own array<long>")


class Region:
    """Rows of one region: nodes, components, set sizes, levels."""

    def __init__(self, rows: np.ndarray) -> None:
        self.node, self.component, self.size, self.levels = rows["node"], rows["component"], rows["n_shingles"], rows["levels"]

    def spare(self, threshold: float) -> int:
        """Levels that may differ, five deviations allowed."""
        k = self.levels.shape[1]
        return k - math.ceil((threshold - 5 * math.sqrt(threshold * (1 - threshold) / k)) * k)

    def alike(self, i: np.ndarray, j: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Which of the pairs (i, j), of two components, may be similar enough."""
        fits = np.minimum(self.size[i], self.size[j]) >= threshold * np.maximum(self.size[i], self.size[j])
        fits &= self.component[i] != self.component[j]
        i, j = i[fits], j[fits]
        near = np.count_nonzero(self.levels[i] != self.levels[j], axis=1) <= self.spare(threshold)
        return i[near], j[near]

    def like(self, i: int, among: np.ndarray, threshold: float) -> np.ndarray:
        """Which of ``among``, of other components, may be similar enough to row i."""
        s, spare = self.size[among], self.spare(threshold)
        fits = np.minimum(s, self.size[i]) >= threshold * np.maximum(s, self.size[i])
        among = among[fits & (self.component[among] != self.component[i])]
        few = min(self.levels.shape[1], spare * 5 // 4 + 1)  # the first ones alone often differ more
        among = among[np.count_nonzero(self.levels[among, :few] != self.levels[i, :few], axis=1) <= spare]
        return among[np.count_nonzero(self.levels[among] != self.levels[i], axis=1) <= spare]

    def middle(self, among: np.ndarray) -> int:
        """The row that shares most levels with the commonest ones."""
        own = self.levels[among]
        common = np.array([np.bincount(c, minlength=256).argmax() for c in own.T], np.uint8)
        return int(among[(own == common).sum(1).argmax()])

    def pivots(self) -> list[int]:
        rest, found = np.arange(len(self.node)), []
        while len(rest) > 1 and len(found) < PIVOTS:
            i = self.middle(rest)
            found.append(i)
            rest = rest[(self.levels[rest] == self.levels[i]).mean(1) < 0.9]
        return found


MEMBER = ("region", "n", "node", "n_shingles", "component")


def table_of(batch: pa.RecordBatch, numbers: tuple[str, ...], **wide: tuple[str, int]) -> np.ndarray:
    """The columns of a batch as one structured array; ``wide``: columns with so many values a row; a body is an object."""
    kinds = [(x, "i8") for x in numbers] + [(x, kind, (n,)) for x, (kind, n) in wide.items()]
    out = np.zeros(batch.num_rows, kinds + [("body", "O")] * ("body" in batch.schema.names))
    for name in numbers:
        out[name] = batch.column(name).to_numpy(zero_copy_only=False)
    for name, (kind, n) in wide.items():
        c = batch.column(name)
        flat = c.flatten().to_numpy() if pa.types.is_list(c.type) else np.frombuffer(b"".join(c.to_pylist()), kind)
        out[name] = flat.reshape(batch.num_rows, n)
    if "body" in batch.schema.names:
        for k, b in enumerate(batch.column("body")):
            out["body"][k] = np.frombuffer(b.as_buffer(), np.uint64)
    return out


def chunks(tables: Iterable[np.ndarray], keys: list[str], enough: int, whole: bool) -> Iterator[np.ndarray]:
    """Rows of sorted tables, at least ``enough`` at a time, cut between keys; not ``whole``: also inside a key that fills a chunk."""
    held: list[np.ndarray] = []
    for table in tables:
        held.append(table)
        if sum(map(len, held)) < enough:
            continue
        rows = np.concatenate(held)
        edges = np.flatnonzero(rows[keys][1:] != rows[keys][:-1])
        if len(edges) or not whole:
            at = int(edges[-1]) + 1 if len(edges) else len(rows)
            yield rows[:at]
            rows = rows[at:]
        held = [rows]
    if held:
        yield np.concatenate(held)


def groups(rows: np.ndarray, keys: list[str]) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.append(rows[keys][1:] != rows[keys][:-1], True)) + 1
    return list(zip([0, *edges[:-1].tolist()], edges.tolist(), strict=True)) if len(rows) else []


def candidates(batches: Iterable[pa.RecordBatch], threshold: float, carried: int, pivots: bool) -> Iterator[pa.RecordBatch]:
    """Candidate pairs (a < b) of rows sorted by (region, levels): neighbours and, if asked for, pivots of dense regions."""
    tables = (table_of(b, MEMBER, levels=("u1", carried)) for b in batches if b.num_rows)
    for rows in chunks(tables, ["region"], PIECE, False):
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

        def give(i: np.ndarray, j: np.ndarray) -> None:
            a.append(np.minimum(rows["node"][i], rows["node"][j]))  # noqa: B023
            b.append(np.maximum(rows["node"][i], rows["node"][j]))  # noqa: B023

        every = Region(rows)
        for w in range(1, min(WINDOW + 1, len(rows))):
            i = np.arange(len(rows) - w)
            i = i[(rows["region"][i] == rows["region"][i + w]) & (rows["n"][i] <= (WINDOW + 1 if w > 1 else rows["n"][i]))]
            give(*every.alike(i, i + w, threshold))
        for lo, hi in groups(rows, ["region"]) if pivots and (rows["n"] > WINDOW + 1).any() else []:
            if rows["n"][lo] > WINDOW + 1:
                region = Region(rows[lo:hi])
                for i in region.pivots():
                    near = region.like(i, np.arange(hi - lo), threshold)
                    give(np.full(len(near), lo + i), lo + near)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])


def regions_of(depth: int, trees: int) -> Column:
    """The region of each order of a deeper forest, from the signature ``sig``."""
    return F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.xxhash64(t, F.substring(F.col("sig"), t * depth + 1, F.lit(depth))))


def members_of(rows: DataFrame, depth: int, carried: int) -> DataFrame:
    """region, n, node, n_shingles, component, levels of ``rows`` (node, n_shingles, component, sig, own) in every order;
    regions within one component are left out."""
    spots = rows.select("node", "component", F.posexplode("own").alias("t", "region"))
    counts = spots.groupBy("region").agg(F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("region", "n")
    placed = spots.select("node", "t", "region").join(counts, "region")
    levels = F.substring(F.concat("sig", "sig"), F.col("t") * depth + 1, F.lit(carried))
    return placed.join(rows.select("node", "n_shingles", "component", "sig"), "node").select(*MEMBER, levels.alias("levels"))


def meet(members: DataFrame, threshold: float, carried: int, pivots: bool) -> DataFrame:
    """Candidate pairs of all regions. Those compared whole are dealt by region; a dense one may lie in many tasks."""
    small, dense = members.filter(F.col("n") <= WINDOW + 1), members.filter(F.col("n") > WINDOW + 1)
    dense = dense.repartitionByRange("region", "levels").sortWithinPartitions("region", "levels")
    run = lambda it: candidates(it, threshold, carried, pivots)
    return sh.dealt(small, "region", order=("levels",)).mapInArrow(run, "a long, b long").union(dense.mapInArrow(run, "a long, b long")).distinct()


def open_regions(dense: DataFrame, last: bool) -> tuple[DataFrame, DataFrame]:
    """Of (region, node, n_shingles, component): regions of several components (region, main, askers, all, direct), written."""
    counts = dense.groupBy("region", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    main = F.max_by(F.struct("component", "n", "s"), F.struct("n", "component")).alias("m")
    shapes = counts.groupBy("region").agg(F.sum("n").alias("rows"), F.sum("s").alias("total"), main).filter("m.n < rows")
    blocks = lambda n, s: F.greatest(F.ceil(n / BLOCK), F.ceil(s / BLOCK_SHINGLES)).cast("int")
    strays = F.col("rows") - F.col("m.n")
    return sh.materialise(
        shapes.select("region", F.col("m.component").alias("main"), blocks(strays, F.col("total") - F.col("m.s")).alias("askers"), blocks(F.col("rows"), F.col("total")).alias("all"), (F.lit(last) | (strays <= BLOCK)).alias("direct")), "open"
    )


def blocks_of(members: DataFrame, shapes: DataFrame) -> DataFrame:
    """(region, i, j, node, main, asks, told): each row outside its region's main component asks in every
    (i, j) of its own i, each row of the region is told in every (i, j) of its own j."""
    rows = members.select("region", "node", "component").join(shapes.filter("direct"), "region").withColumn("main", F.col("component") == F.col("main"))
    rows = rows.withColumn("own_i", F.pmod(F.hash("region", "node"), "askers")).withColumn("own_j", F.pmod(F.xxhash64("region", "node"), "all").cast("int"))
    cell = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    told = F.transform(upto("askers"), lambda i: cell(i, F.col("own_j")))
    asks = F.transform(upto("all"), lambda j: cell(F.col("own_i"), j))
    rows = rows.withColumn("cell", F.explode(F.when(F.col("main"), told).otherwise(F.array_union(told, asks))))
    flags = {"main": F.col("main"), "asks": ~F.col("main") & (F.col("own_i") == F.col("cell.i")), "told": F.col("own_j") == F.col("cell.j")}
    return rows.select("region", "cell.i", "cell.j", "node", *[c.cast("long").alias(n) for n, c in flags.items()])


class Shared:
    """Counts the shingles that a set shares with each of many sets."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), list(map(len, sets)))
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner, self.n = flat[order], owner[order], len(sets)

    def counts(self, s: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(self.flat, s, "left"), np.searchsorted(self.flat, s, "right")
        ends = np.cumsum(hi - lo)
        at = np.arange(ends[-1]) + np.repeat(hi - ends, hi - lo)
        return np.bincount(self.owner[at], minlength=self.n)


def compare_blocks(batches: Iterable[pa.RecordBatch], percent: int, size: int, trees: int) -> Iterator[pa.RecordBatch]:
    """In each (region, i, j), links of rows that ask with rows of other components that are told.

    A pair that shares several regions is compared in the first of them alone. Rows that a link has joined
    are one component from then on, so of the links between two components one is given."""
    numbers, cell = ("region", "i", "j", "node", "n_shingles", "component", "main", "asks", "told"), ["region", "i", "j"]

    def links(rows: np.ndarray) -> pa.RecordBatch:
        region, told = Region(rows), np.flatnonzero(rows["told"])
        region.component = region.component.copy()  # links change it
        shared, a, b = None, [], []
        for i in np.flatnonzero(rows["asks"]).tolist():
            row = rows[i]
            near = told[(rows["main"][told] == 1) | (rows["node"][told] > row["node"])]  # others meet it from their side
            near = region.like(i, near, percent / 100)
            near = near[row["own"][(rows["own"][near] == row["own"]).argmax(1)] == row["region"]]
            if not len(near):
                continue
            shared = shared or Shared(list(rows["body"]))
            both = shared.counts(row["body"])[near]
            hits = near[100 * both >= percent * (region.size[near] + region.size[i] - both)]
            for c, at in zip(*np.unique(region.component[hits], return_index=True), strict=True):
                a.append(min(row["node"], rows["node"][hits[at]]))
                b.append(max(row["node"], rows["node"][hits[at]]))
                region.component[region.component == c] = region.component[i]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    tables = (table_of(b, numbers, levels=("u1", size), own=("i8", trees)) for b in batches if b.num_rows)
    for rows in chunks(tables, cell, 1, True):
        for lo, hi in groups(rows, cell):
            yield links(rows[lo:hi])


def fetch_sets(nodes: DataFrame, reps: DataFrame, df: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """(node, body): the full shingle sets of nodes, from their texts.

    The list of nodes is written first, so the planner knows its size."""
    need = sh.materialise(reps.select("node", "cls", F.col("key").alias("__key")).join(nodes, "node"), "need").hint("merge")
    found = df.select(key, text).join(need, F.col(key).eqNullSafe(F.col("__key"))).select("node", "cls", text)

    def sets_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in sh.blocks(sh.strings(batch.column(2))):
                sets = shingle_sets(*word_hashes(part), words)
                cls = batch.column(1).slice(done, len(part)).to_pylist()
                hit = [i for i, s in enumerate(sets) if set_key(s) == cls[i]]  # a repeated identifier can have other texts
                nodes = batch.column(0).slice(done, len(part)).take(pa.array(hit, pa.int32()))
                yield pa.RecordBatch.from_arrays([nodes, pa.array([sets[i].tobytes() for i in hit], pa.binary())], ["node", "body"])
                done += len(part)

    return sh.materialise(found.mapInArrow(sets_of, "node long, body binary").dropDuplicates(["node"]), "sets")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("body").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("body").alias("y")), "b")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (batch.column(i) for i in range(4))
            hit = []
            for i in range(batch.num_rows):
                p, q = np.frombuffer(x[i].as_buffer(), np.uint64), np.frombuffer(y[i].as_buffer(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                if 100 * both >= percent * (len(p) + len(q) - both):
                    hit.append(i)
            take = pa.array(hit, pa.int32())
            yield pa.RecordBatch.from_arrays([a.take(take), b.take(take)], ["a", "b"])

    return both.select("a", "b", "x", "y").mapInArrow(count, "a long, b long")


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.drop("component").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def join_links(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after further links: those so far are contracted, so only new links are followed."""
    if labels is None:
        return components(links)
    ends = links
    for end in ("a", "b"):
        ends = ends.join(labels.select(F.col("node").alias(end), F.col("component").alias(f"{end}_of")), end, "left").withColumn(f"{end}_of", F.coalesce(f"{end}_of", end))
    ends = sh.materialise(ends.select("a_of", "b_of").filter("a_of <> b_of").distinct(), "ends")
    if ends.isEmpty():
        return labels
    moved = components(ends, "a_of", "b_of").select(F.col("node").alias("component"), F.col("component").alias("to"))
    fresh = moved.select(F.col("component").alias("node"), "component").join(labels.select("node"), "node", "left_anti")
    every = labels.select("node", "component").union(fresh.select("node", "component"))
    return sh.materialise(every.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "labels")


def forest(reps: DataFrame, percent: int, sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, component) of all nodes with a link; ``reps`` has node, n_shingles, sig, own."""
    threshold = percent / 100
    size, steps = levels_of(threshold), depths(threshold)
    carried = min(CARRIED, size)
    rows, labels, sets, tested = reps.withColumn("component", F.col("node")), None, None, None
    for depth in steps:
        trees, last = orders(depth, threshold), depth == steps[-1]
        members = sh.materialise(members_of(rows, depth, carried), "members")
        pairs = meet(members, threshold, carried, depth == steps[0])
        pairs = sh.materialise(pairs.join(tested, ["a", "b"], "left_anti") if tested is not None else pairs, "pairs")
        dense = members.filter(F.col("n") > WINDOW + 1)
        if sets is None:  # rows of later rounds are among these
            sets = sets_of(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(dense.select("node")).distinct())
        labels = join_links(labels, sh.materialise(confirm(pairs, sets, percent), "links"))
        dense = sh.materialise(labelled(dense.select("region", "node", "n_shingles"), labels), "dense")
        shapes = open_regions(dense, last)
        if not shapes.filter("direct").isEmpty():
            cells = blocks_of(dense, shapes).join(labelled(rows.select("node", "n_shingles", "sig", "own"), labels), "node").join(sets, "node")
            cells = cells.select("region", "i", "j", "node", "n_shingles", "component", "main", "asks", "told", F.col("sig").alias("levels"), "own", "body")
            more = sh.dealt(cells, "region", "i", "j").mapInArrow(lambda it, t=trees: compare_blocks(it, percent, size, t), "a long, b long")
            more = sh.materialise(more, "more")
            labels = labels if more.isEmpty() else join_links(labels, more)
        if last or shapes.filter("NOT direct").isEmpty():
            return labels
        tested = pairs if tested is None else tested.union(pairs)
        deeper = dense.join(shapes.filter("NOT direct").select("region"), "region").select("node").distinct()
        after = steps[steps.index(depth) + 1]
        rows = labelled(reps.select("node", "n_shingles", "sig").join(deeper, "node"), labels).withColumn("own", regions_of(after, orders(after, threshold)))
        rows = sh.materialise(rows, "deeper")
    return labels


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``df``: key, n_shingles, component_id (smallest key reachable), kept."""
    rows = sh.materialise(sketch(df, key, text, words, percent / 100).withColumn("uid", F.monotonically_increasing_id()), "sketches")
    solid = rows.filter("n_shingles > 0")
    first = F.min_by(F.struct(F.col(key).alias("key"), "n_shingles", "sig", "own"), "uid").alias("r")
    reps = sh.materialise(solid.groupBy("cls").agg(F.min("uid").alias("node"), F.min(key).alias("least"), first).select("cls", "node", "least", "r.*"), "classes")
    joined = forest(reps.select("node", "n_shingles", "sig", "own"), percent, lambda nodes: fetch_sets(nodes, reps, df, key, text, words))

    rooted = reps.select("cls", "node", "least").join(joined, "node", "left").select("cls", "least", F.coalesce("component", "node").alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = rooted.join(names, "root").select("cls", "component_id")
    out = solid.select(key, "n_shingles", "cls").join(of_class, "cls").select(key, "n_shingles", "component_id")
    empty = rows.filter("n_shingles = 0").select(key, "n_shingles", F.col(key).alias("component_id"))
    return out.union(empty).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))


def drop_near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component stays (that with the smallest key), all columns as they are."""
    return sh.keep_rows(df, near_duplicates(df, key, text, words, percent).filter("kept"), key)
