"""Toxicity scores by non-negative positive-unlabelled learning (operator 7).

Positives are texts confirmed as toxic; unlabelled texts are any others, toxic or not. The risk of a
classifier f at class prior p is p R+(f) + max(0, Ru-(f) - p Rp-(f)): the last term, the part of
the unlabelled risk that true negatives cause, is never negative in truth, so where a step makes it
negative the step goes back up that term instead. Several linear classifiers over hashed words, each
trained in numpy on its own draw of unlabelled texts, are averaged. Features are words and beginnings of
words. One has a weight only if the corrected risk's slope in it, before anything is learned, is beyond six
deviations of chance, and if five positives and one in a hundred of them have it. Only rows outside the held-out fold are learned from; inputs of a score are the words of
the whole text alone.

The training sample is bounded by MAX_POSITIVE and MAX_UNLABELLED (drawn by a hash of the text's
identifier); everything else covers all rows.

Edge cases: null text counts as empty and gets the score of no evidence; without positives or
without unlabelled texts every score is the prior; repeated rows get equal scores; label rows that
disagree count as toxic if one says so; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _shared as sh
from .words import SIGNS, word_parts

BITS = 20
PREFIXES = (3, 4, 5, 6)
MAX_POSITIVE, MAX_UNLABELLED = 2500, 7000
MEMBERS, EPOCHS, BATCH, RATE, RIDGE = 6, 120, 512, 0.05, 1e-4
#: A feature takes part if its slope is beyond so many deviations, and so many positives and such a share of them have it.
DEVIATIONS, LEAST, SHARE = 6, 5, 0.01


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


def numbers(part: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers (a row for the words and one for each prefix) and words a text."""
    hashes, counts = word_parts(part, SIGNS, PREFIXES)
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64), counts


def distinct(found: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text, text after text, and the text of each."""
    keys = np.unique(rows << BITS | found)
    return keys & (1 << BITS) - 1, keys >> BITS


class Sparse:
    """Rows of a 0/1 matrix, as ranges of one flat array of columns; a choice of rows shares it."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        self.flat, self.starts, self.sizes = flat, starts, sizes

    def __len__(self) -> int:
        return len(self.sizes)

    def rows(self, which: np.ndarray) -> Sparse:
        return Sparse(self.flat, self.starts[which], self.sizes[which])

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Columns of the chosen rows, and the row (in the choice) of each."""
        sizes = self.sizes[which]
        before = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) + np.repeat(self.starts[which] - before, sizes)
        return self.flat[at], np.repeat(np.arange(len(which)), sizes)

    def counts(self, columns: int) -> np.ndarray:
        out = np.zeros(columns, np.int64)
        for i in range(0, len(self), 1000):
            out += np.bincount(self.take(np.arange(i, min(len(self), i + 1000)))[0], minlength=columns)
        return out

    def only(self, table: np.ndarray) -> Sparse:
        """The same rows with the columns that ``table`` numbers (others: -1)."""
        parts, sizes = [], []
        for i in range(0, len(self), 1000):
            which = np.arange(i, min(len(self), i + 1000))
            flat, row = self.take(which)
            to = table[flat]
            parts.append(to[to >= 0])
            sizes.append(np.bincount(row[to >= 0], minlength=len(which)))
        sizes = np.concatenate(sizes)
        return Sparse(np.concatenate(parts), np.cumsum(sizes) - sizes, sizes)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(positive: Sparse, unlabelled: Sparse, prior: float, seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias of one classifier: logistic loss, Adam on mini-batches, a small ridge."""
    rng = np.random.default_rng(seed)
    size = 1 << BITS
    n_p, n_u = len(positive), len(unlabelled)
    in_p, in_u = positive.counts(size), unlabelled.counts(size)
    # slope of the risk at zero weights, over the prior: unlabelled texts push, positives pull
    share = np.maximum(in_u, 1) / n_u
    usable = (np.abs(in_p / n_p - in_u / n_u) > DEVIATIONS * np.sqrt(share * (1 - share) / n_p)) & (in_p >= max(LEAST, SHARE * n_p))
    table = np.full(size, -1)
    kept = np.flatnonzero(usable)
    table[kept] = np.arange(len(kept))
    positive, unlabelled = positive.only(table), unlabelled.only(table)
    w, b = np.zeros(len(kept)), float(np.log(prior / (1 - prior)))
    m, v, mb, vb, t = np.zeros(len(kept)), np.zeros(len(kept)), 0.0, 0.0, 0
    steps = max(1, n_u // BATCH)
    for _ in range(EPOCHS):
        u_order = rng.permutation(n_u)
        for k in range(steps):
            p, u = rng.integers(0, n_p, min(BATCH, n_p)), u_order[k * BATCH : (k + 1) * BATCH]
            (pf, pr), (uf, ur) = positive.take(p), unlabelled.take(u)
            zp = b + np.bincount(pr, w[pf], len(p))
            zu = b + np.bincount(ur, w[uf], len(u))
            sp, su = sigmoid(zp), sigmoid(zu)
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            if negative >= 0:
                gp, gu = (prior * (sp - 1) - prior * sp) / len(p), su / len(u)
            else:  # back up the corrected term
                gp, gu = prior * sp / len(p), -su / len(u)
            g = np.bincount(pf, gp[pr], len(kept)) + np.bincount(uf, gu[ur], len(kept)) + RIDGE * w
            gb = gp.sum() + gu.sum()
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
            rate = RATE * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
            w -= rate * m / (np.sqrt(v) + 1e-6)
            b -= rate * mb / (np.sqrt(vb) + 1e-6)
    out = np.zeros(size)
    out[kept] = w
    return out, b


def sample(df: DataFrame, labels: DataFrame, key: str, text: str) -> tuple[Sparse, Sparse, float]:
    """Features of the bounded training sample and the class prior, all from outside the held-out fold."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key))).groupBy(key).agg(F.max("toxic").alias("toxic"))
    shares = known.agg(F.avg("toxic"), F.sum("toxic")).first()
    prior = min(0.5, max(1e-3, float(shares[0] or 0)))
    toxic = known.filter("toxic = 1").select(key)
    drawn = F.xxhash64(F.col(key).cast("string"))
    positive = toxic.orderBy(drawn, key).limit(MAX_POSITIVE).select(key, F.lit(1).alias("kind"))
    others = df.select(key).filter(F.col(key).isNotNull() & ~held_out(F.col(key)))
    unlabelled = others.distinct().orderBy(drawn, key).limit(MAX_UNLABELLED).select(key, F.lit(0).alias("kind"))
    chosen = sh.materialise(positive.union(unlabelled), "sample")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in sh.blocks(sh.strings(batch.column(1))):
                found, counts = numbers(part)
                flat, rows = distinct(found.ravel(), np.tile(np.repeat(np.arange(len(part)), counts), len(found)))
                sizes = np.bincount(rows, minlength=len(part))
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(part)), lists, batch.column(2).slice(done, len(part))], ["kind", "features", "at"])
                done += len(part)

    # at most MAX_POSITIVE + MAX_UNLABELLED identifiers
    rows = df.select(key, text).join(F.broadcast(chosen), key).select("kind", text, F.xxhash64(F.col(key).cast("string")).alias("at"))
    table = rows.mapInArrow(run, "kind int, features array<int>, at long").toArrow()
    order = np.argsort(table["at"].to_numpy(), kind="stable")
    kinds, lists = table["kind"].to_numpy()[order], table["features"].combine_chunks()
    ends = lists.offsets.to_numpy().astype(np.int64)
    every = Sparse(lists.values.to_numpy(), ends[:-1], np.diff(ends)).rows(order)
    return every.rows(np.flatnonzero(kinds == 1)), every.rows(np.flatnonzero(kinds == 0)), prior


def train(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[np.ndarray, np.ndarray, float]:
    """The averaged classifier: features with a weight, their weights, bias."""
    positive, unlabelled, prior = sample(df, labels, key, text)
    if not len(positive) or not len(unlabelled):
        return np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior)))
    w, b = np.zeros(1 << BITS), 0.0
    for i in range(MEMBERS):
        rng = np.random.default_rng(100 + i)
        own = rng.permutation(len(unlabelled))[: max(1, len(unlabelled) * 2 // 3)]
        wi, bi = fit(positive, unlabelled.rows(own), prior, i)
        w, b = w + wi / MEMBERS, b + bi / MEMBERS
    at = np.flatnonzero(w)
    return at, w[at], b


def scores(part: pa.Array, table: np.ndarray, bias: float) -> np.ndarray:
    found, counts = numbers(part)
    told = table[found] != 0
    rows = np.broadcast_to(np.repeat(np.arange(len(part)), counts), found.shape)
    flat, row = distinct(found[told], rows[told])
    return sigmoid(bias + np.bincount(row, table[flat], len(part)))


def weight_table(model: tuple[np.ndarray, np.ndarray, float]) -> np.ndarray:
    table = np.zeros(1 << BITS, np.float32)
    table[model[0]] = model[1]
    return table


def score(df: DataFrame, model: tuple[np.ndarray, np.ndarray, float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and score of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = weight_table(model)
        for batch in batches:
            done = 0
            for part in sh.blocks(sh.strings(batch.column(1))):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(part)), pa.array(scores(part, table, model[2]))], [key, "score"])
                done += len(part)

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, score double")


def toxicity(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", model: tuple | None = None) -> DataFrame:
    """One row per row of ``df``: key, held_out, score, predicted."""
    scored = score(df, model or train(df, labels, key, text), key, text)
    return scored.select(key, F.coalesce(held_out(F.col(key)), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that are not predicted toxic, all columns as they are."""
    model = train(df, labels, key, text)
    place = df.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = weight_table(model)
        for batch in batches:
            keep = [scores(part, table, model[2]) < 0.5 for part in sh.blocks(sh.strings(batch.column(place)))]
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return df.mapInArrow(run, df.schema)
