"""Packing into fixed windows by non-negative least squares (operator 9).

A document's ids are cut into full windows and one remainder. Remainder lengths make a histogram of
at most ``window - 1`` bins. All combinations of at most three lengths that fill a window exactly
are enumerated, and non-negative least squares solves how often each is used; counts are rounded
down and never exceed the pieces there are. What rounding and misfit leave over is packed greedily,
piece after piece, cut where a window ends. Only the histogram reaches the driver. A piece's place
follows from its rank among pieces of its length and from tables of a bounded size, so placing is
arithmetic on rows; ranks come from global prefix sums.

Edge cases: null text counts as empty and is the end id alone; a document of any length is cut into
as many windows as it needs; rows with equal identifiers are packed as documents of their own; an
empty table gives an empty table. Only the last window of the greedy part can need padding.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.prefix import with_prefix
from . import _shared as sh
from .bpe import codec


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Rows (a, b, c), a <= b <= c, of lengths that fill the window; a = 0: a pair."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    there[0] = True
    rows = []
    for a in np.flatnonzero(there[: window // 3 + 1]).tolist():
        b = np.arange(max(a, 1), (window - a) // 2 + 1)
        b = b[there[b] & there[window - a - b]]
        rows.append(np.stack([np.full(len(b), a), b, window - a - b], 1))
    return np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)


def solve_counts(combos: np.ndarray, histogram: np.ndarray, rounds: int = 300) -> np.ndarray:
    """x >= 0 that minimises the squared misfit of the lengths used, by accelerated projected gradients."""
    bins = len(histogram)
    h = histogram.astype(float)
    used = combos.T.copy()

    def apply(x: np.ndarray) -> np.ndarray:
        out = np.zeros(bins)
        for c in used:
            out += np.bincount(c, x, bins)
        out[0] = 0
        return out

    def back(r: np.ndarray) -> np.ndarray:
        return sum(r[c] for c in used)

    norm = apply(np.ones(len(combos))).max() * 3  # bounds the largest eigenvalue
    step = 1 / max(norm, 1.0)
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        residual = h - apply(y)
        residual[0] = 0
        nxt = np.maximum(0, y + step * back(residual))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = nxt + (t - 1) / t2 * (nxt - x)
        x, t = nxt, t2
    return x


def plan(histogram: np.ndarray, window: int) -> tuple[list[tuple], np.ndarray, int]:
    """Slots (length, first rank, ranks, first sequence, offset); pieces placed of each length; sequences used.

    A slot says: of the pieces of this length, those with ranks from the first on stand one in each
    of as many sequences, at the offset."""
    combos = combinations(np.flatnonzero(histogram), window)
    left = histogram.copy()
    slots: list[tuple] = []
    sequences = 0
    if len(combos):
        x = solve_counts(combos, histogram)
        # rounded values first, the largest ones ahead; then whatever each combination still fills
        order = np.argsort(-x, kind="stable")
        for whole in (False, True):
            for j in order.tolist():
                if not whole and x[j] < 1:
                    break
                need: dict[int, int] = {}
                for length in combos[j].tolist():
                    if length:
                        need[length] = need.get(length, 0) + 1
                most = min(int(left[v]) // m for v, m in need.items())
                n = most if whole else min(int(x[j]), most)
                if n <= 0:
                    continue
                offset = 0
                for length in combos[j].tolist():
                    if length:
                        slots.append((length, int(histogram[length] - left[length]), n, sequences, offset))
                        left[length] -= n
                        offset += length
                sequences += n
    return slots, histogram - left, sequences


def token_pieces(df: DataFrame, path: str, end_id: int, window: int, key: str, text: str) -> DataFrame:
    """A row per document: its number of ids, the CRC of each full window, its remainder's length, CRC and ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            done = 0
            for part in sh.blocks(sh.strings(batch.column(1))):
                ids, offsets = c.encode_batch(part.to_pylist())
                ids = ids.astype("<u4")
                totals, full, rest, crc, body = [], [], [], [], []
                for i, j in itertools.pairwise(offsets.tolist()):
                    own = np.append(ids[i:j], np.uint32(end_id)).astype("<u4")
                    q = len(own) // window
                    tail = own[q * window :].tobytes()
                    totals.append(len(own))
                    full.append([zlib.crc32(own[k * window : (k + 1) * window].tobytes()) for k in range(q)])
                    rest.append(len(own) - q * window)
                    crc.append(zlib.crc32(tail))
                    body.append(tail)
                keys = batch.column(0).slice(done, len(part))
                done += len(part)
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(totals, pa.int64()), pa.array(full, pa.list_(pa.int64())), pa.array(rest, pa.int32()), pa.array(crc, pa.int64()), pa.array(body, pa.binary())],
                    [key, "doc_tokens", "full", "rest", "rest_crc32", "rest_ids"],
                )

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, doc_tokens long, full array<long>, rest int, rest_crc32 long, rest_ids binary")


SLOTS = T.StructType([T.StructField(n, T.LongType()) for n in ("rest", "from", "n", "sequence", "offset")])


def pack(df: DataFrame, path: str, window: int = 1024, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = df.sparkSession
    enc = sh.materialise(token_pieces(df, path, end_id, window, key, text).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    narrow = enc.select("uid", "rest", F.size("full").cast("long").alias("windows"), F.lit(1).cast("long").alias("one"))
    placed = with_prefix(narrow, ["rest", "uid"], ["one", "windows"], "ranks")

    histogram = np.zeros(window, np.int64)
    for length, n in narrow.filter("rest > 0").groupBy("rest").count().collect():  # at most window - 1 rows
        histogram[length] = n
    slots, taken, sequences = plan(histogram, window)
    left = histogram - taken
    empty = int(narrow.filter("rest = 0").count())
    ahead = np.concatenate([[0], np.cumsum(histogram)[:-1]]) + empty  # rank at which a length begins
    tokens_ahead = np.concatenate([[0], np.cumsum(left * np.arange(window))[:-1]])
    stats = spark.createDataFrame([(int(v), int(ahead[v]), int(taken[v]), int(tokens_ahead[v])) for v in np.flatnonzero(histogram)], "rest int, ahead long, taken long, stream long")
    table = spark.createDataFrame(slots, SLOTS).withColumn("rest", F.col("rest").cast("int"))

    greedy = sequences  # sequences of the greedy part, then those of full windows
    streamed = int((left * np.arange(window)).sum())
    windows_at = greedy + -(-streamed // window)

    ranked = sh.materialise(
        placed.join(F.broadcast(stats), "rest", "left").select("uid", "rest", "windows_before", "ahead", "taken", "stream", (F.col("one_before") - F.col("ahead")).alias("rank")), "ranked"
    )  # stats: a row a length
    docs = enc.drop("rest_ids").join(ranked.drop("rest"), "uid")
    of_full = docs.filter(F.size("full") > 0).select(key, "doc_tokens", "windows_before", F.posexplode("full").alias("k", "ids_crc32"))
    of_full = of_full.select(
        key, (F.col("k") * window).cast("long").alias("start"), F.lit(window).cast("long").alias("length"), "ids_crc32", "doc_tokens", (F.col("windows_before") + F.col("k") + windows_at).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    start = F.col("doc_tokens") - F.col("rest")
    rests = docs.filter("rest > 0")
    # ranks of a slot are one range; the slots of a length lie one after another
    ranges = table.groupBy("rest").agg(F.sort_array(F.collect_list(F.struct("from", "n", "sequence", "offset"))).alias("slots"))
    slotted = rests.filter("rank < taken").join(F.broadcast(ranges), "rest")
    hit = F.filter("slots", lambda s: (s["from"] <= F.col("rank")) & (F.col("rank") < s["from"] + s["n"]))[0]
    in_slots = slotted.withColumn("slot", hit).select(
        key, start.alias("start"), F.col("rest").cast("long").alias("length"), F.col("rest_crc32").alias("ids_crc32"), "doc_tokens", (F.col("slot.sequence") + F.col("rank") - F.col("slot.from")).alias("sequence_id"), F.col("slot.offset").alias("offset")
    )
    at = F.col("stream") + (F.col("rank") - F.col("taken")) * F.col("rest")
    spread = rests.filter("rank >= taken").withColumn("at", at).withColumn("head", F.least(F.col("rest").cast("long"), window - F.col("at") % window))
    uncut = spread.filter("head = rest").select(key, start.alias("start"), F.col("head").alias("length"), F.col("rest_crc32").alias("ids_crc32"), "doc_tokens", (F.floor(F.col("at") / window) + greedy).alias("sequence_id"), (F.col("at") % window).alias("offset"))
    cut = spread.filter("head < rest").select("uid", "at", "head").join(enc.drop("full"), "uid")
    halves = cut.select(
        key,
        "doc_tokens",
        F.explode(
            F.array(
                F.struct(start.alias("start"), F.col("head").alias("length"), F.crc32(F.substring("rest_ids", F.lit(1), (F.col("head") * 4).cast("int"))).alias("ids_crc32"), F.col("at").alias("at")),
                F.struct(
                    (start + F.col("head")).alias("start"), (F.col("rest") - F.col("head")).alias("length"), F.crc32(F.substring("rest_ids", (F.col("head") * 4 + 1).cast("int"), F.lit(4 * window))).alias("ids_crc32"), (F.col("at") + F.col("head")).alias("at")
                ),
            )
        ).alias("p"),
    ).select(key, "p.start", "p.length", "p.ids_crc32", "doc_tokens", (F.floor(F.col("p.at") / window) + greedy).alias("sequence_id"), (F.col("p.at") % window).alias("offset"))
    return of_full.unionByName(in_slots).unionByName(uncut).unionByName(halves)
