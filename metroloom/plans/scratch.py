"""Written tables in the shared folder: they cut lineage and survive the loss of executors."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where it is unset and all runs on this machine."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="metroloom-"))
        atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
    return f"file://{_OWN[0]}"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, visible to the driver and to every executor."""
    return f"{shared_dir(spark)}/metroloom/{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends here."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys: str, order: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with all rows of a key in one partition, sorted there by the keys, then ``order``.

    For steps that stream sorted partitions. The exchange is on a hash of the keys, not on the keys: an
    exchange that repeats a join's own partitioning is dropped by the planner, and the join's may
    then be split or read locally at run time, which parts the rows of a key."""
    return df.repartition(F.xxhash64(*keys)).sortWithinPartitions(*keys, *order)
