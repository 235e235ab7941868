"""Exact deduplication by a tree merge of sorted digest runs (operator 6, DataFrame functions only).

Every input partition belongs to a run. A run has one entry for each distinct text in it: digest, check
(length and a second, independent hash), the identifier that wins, the count of its rows. Runs exchange
their entries once, by digest, so that each task holds a stretch of every run, and sort them. From then on
binomial rounds merge run 2r with run 2r + 1 (``fan_in`` neighbours in general, a multiway merge), each
round a sort of runs that are sorted already and one pass over neighbours: of entries with equal digests
and equal checks the one with the winning identifier goes on, with the sum of the counts. The check is
compared at every level, so a collision of the digest alone keeps two entries. Rounds move nothing
between tasks, and a group of copies of any size comes to them as one entry a run.

Edge cases: null text counts as empty; rows that tie on the identifier all count, and each of them
is marked as kept; a null identifier loses to any other; an identifier that stands for several texts
counts in the group of each, and as a stage stays with the texts it wins; an empty table gives an empty
table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _shared as sh


def digests(df: DataFrame, text: str = "text") -> list[Column]:
    body = F.coalesce(F.col(text), F.lit(""))
    return [F.unhex(F.sha2(body, 256)).alias("digest"), F.struct(F.octet_length(body).alias("n"), F.xxhash64(body).alias("h")).alias("check")]


def merge_tree(entries: DataFrame, key: str, keep: str, runs: int, fan_in: int) -> DataFrame:
    """Rounds of merges of (run, digest, check, key, rows) until one run is left; entries are sorted and dealt by digest."""
    first = F.col(key).desc_nulls_last() if keep == "largest" else F.col(key).asc_nulls_last()
    same = Window.partitionBy("run", "digest", "check")
    merged = entries.repartition("digest").sortWithinPartitions("run", "digest", "check", first)
    for _ in range(max(1, math.ceil(math.log(runs, fan_in)))):
        merged = merged.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        total = F.sum("rows").over(same.orderBy(first).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        merged = merged.select("run", "digest", "check", key, total.alias("rows"), F.row_number().over(same.orderBy(first)).alias("__place")).filter("__place = 1").drop("__place")
    return merged


def exact_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "largest", runs: int = 64, fan_in: int = 2) -> DataFrame:
    """One row per row of ``df``: key, keep_id, group_size, kept, text_sha256.

    ``keep``: ``largest`` or ``smallest`` identifier of equal texts. ``runs``: runs at the leaves."""
    narrow = df.select(F.col(key), *digests(df, text), F.pmod(F.spark_partition_id(), F.lit(runs)).alias("run"))
    narrow = sh.materialise(narrow, "digests")
    best = F.max(key) if keep == "largest" else F.min(key)
    leaves = narrow.groupBy("run", "digest", "check").agg(best.alias(key), F.count("*").alias("rows"))
    winners = merge_tree(leaves, key, keep, runs, fan_in).select("digest", "check", F.col(key).alias("keep_id"), F.col("rows").alias("group_size"))
    joined = narrow.join(winners, ["digest", "check"])
    return joined.select(key, "keep_id", "group_size", F.col(key).eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "largest") -> DataFrame:
    """The rows of ``df`` that stay, all columns as they are."""
    taken = {c.lower() for c in df.columns}
    k, d = (next(n for i in range(len(taken) + 1) if (n := f"__{x}{i}") not in taken) for x in ("key", "sha"))
    stays = exact_duplicates(df, key, text, keep).filter("kept").select(F.col(key).alias(k), F.col("text_sha256").alias(d)).distinct()
    return df.join(stays, F.col(key).eqNullSafe(F.col(k)) & (F.sha2(F.coalesce(F.col(text), F.lit("")), 256) == F.col(d)), "left_semi")
