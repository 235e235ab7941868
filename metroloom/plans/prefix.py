"""Global running sums and ranks without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import materialise


def with_prefix(df: DataFrame, order: list[str], totals: list[str], name: str = "sorted") -> DataFrame:
    """Adds ``<total>_before``, the sum of each total over all rows ahead in ``order``.

    One range sort, written; the totals of its partitions (a row a partition) are summed over the
    partitions before and added to the running sums inside. DataFrame functions only."""
    placed = materialise(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), name)
    sums = placed.groupBy("part").agg(*[F.sum(c).alias(f"{c}_total") for c in totals])
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("part", *[F.coalesce(F.sum(f"{c}_total").over(ahead), F.lit(0)).cast("long").alias(f"{c}_ahead") for c in totals])
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = placed.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).cast("long").alias(f"{c}_inside") for c in totals])
    joined = running.join(F.broadcast(starts), "part")  # a row a partition
    return joined.select(*df.columns, *[(F.col(f"{c}_inside") + F.col(f"{c}_ahead")).alias(f"{c}_before") for c in totals])


def ranked(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds ``name``, the 0-based rank of each row in ``order``."""
    return with_prefix(df.withColumn("one", F.lit(1)), order, ["one"]).withColumnRenamed("one_before", name).drop("one")
