"""Contiguous shards of near equal bytes by global prefix sums (operator 8, DataFrame functions only).

Rows are sorted into range partitions by (digest of the text, identifier); each partition's byte and row
totals, summed over the partitions before it, are added to the running sums inside it. That gives
every row its place in one global order without a task that sees all rows, and the order is cut at
``shards`` equal byte targets. Equal texts are neighbours in the order. A group of them that lies
across a cut moves whole to the shard before the cut if it is at most ``slack`` of a shard; a larger
one is cut, for sizes near equal come first. Shards differ from the target by two such groups and two
rows at most: 1 % keeps every group but those of hundreds of copies whole and shards within 2 %.

Edge cases: null text has no bytes; every row weighs ``overhead`` more; rows repeated in full are
rows of their own; more shards than rows leave shards empty; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.prefix import with_prefix
from . import _shared as sh


def shard_by_bytes(df: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text", overhead: int = 8, slack: float = 0.01) -> DataFrame:
    """One row per row of ``df``: key, size, text_crc32, shard, slot (gapless from 0 in each shard)."""
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = df.select(
        F.col(key), (F.octet_length(body) + overhead).cast("long").alias("size"), F.crc32(F.encode(body, "utf-8")).alias("text_crc32"), F.unhex(F.sha2(body, 256)).alias("digest"), F.lit(1).cast("long").alias("one")
    )
    narrow = sh.materialise(narrow, "sizes")
    ordered = with_prefix(narrow, ["digest", key], ["size", "one"], "sorted")
    total = narrow.agg(F.sum("size").alias("total"))
    placed = ordered.crossJoin(F.broadcast(total))  # one row
    # a row goes where its middle lies
    at = F.expr(f"(size_before * 2 + size) * {shards} div (total * 2)")  # whole numbers, exact at any size
    cut = sh.materialise(placed.select(*ordered.columns, "total", F.least(at, F.lit(shards - 1)).cast("int").alias("shard")), "cut")
    # groups of equal texts across a cut: at most one for each cut
    edges = cut.groupBy("shard").agg(F.min_by("digest", "one_before").alias("first"), F.max_by("digest", "one_before").alias("last"))
    later = edges.select(F.col("shard").alias("to"), F.col("first").alias("digest"))
    across = edges.select(F.col("shard").alias("home"), F.col("last").alias("digest")).join(later, "digest").filter("to > home").groupBy("digest").agg(F.min("home").alias("home"))
    sizes = cut.join(F.broadcast(across), "digest").groupBy("digest", "home").agg(F.sum("size").alias("group_size"), F.max("total").alias("total"))
    moved = sizes.filter(F.col("group_size") <= F.col("total") * (slack / shards)).select("digest", "home")
    whole = cut.join(F.broadcast(moved), "digest", "left").withColumn("shard", F.coalesce("home", "shard"))
    firsts = whole.groupBy("shard").agg(F.min("one_before").alias("base"))
    return whole.join(F.broadcast(firsts), "shard").select(key, "size", "text_crc32", "shard", (F.col("one_before") - F.col("base")).alias("slot"))
