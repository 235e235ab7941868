"""The registered queries of this subpackage: thin calls of its operators with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, exact_dedup, hnsw, near_dup, packing, sharding, toxicity, url_lists, warc
from ._shared import tokenizer_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    parts = rows.unionByName(extra).select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))
    return chat.digest_conversations(chat.format_messages(parts))


def op2_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, top=5)


def list_entries(pages: DataFrame) -> DataFrame:
    """A dated list over the pages' own hosts and domains: blocked, released, put under review."""
    host = url_lists.host_of(F.col("url")).alias("host")
    hosts = pages.select(host).filter("host IS NOT NULL").distinct()
    labels = F.split("host", r"\.")
    patterns = hosts.select("host").union(hosts.select(F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.size(labels)), "."))).distinct().withColumnRenamed("host", "pattern")
    n = F.conv(F.substring(F.md5(F.col("pattern").cast("binary")), 1, 6), 16, 10).cast("long")
    days = [(n % 90, "block"), (n % 90 + 40 + n % 7, "allow"), (n % 90 + 120 + n % 11, "review")]
    rows = F.array(*[F.struct(F.date_add(F.lit("2024-01-01").cast("date"), d.cast("int")).alias("date"), F.lit(a).alias("action")) for d, a in days])
    return patterns.select("pattern", F.explode(rows).alias("e")).select("pattern", "e.date", "e.action")


def op3_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    captures = pages.withColumn("fetched", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(366)).cast("int")))
    found = url_lists.evaluate(captures, list_entries(pages))
    return found.withColumns({c: F.col(c).cast("string") for c in ("fetched", "listed_since")})


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archive = warc.write_archive(pages, warc.new_root(spark))
    records = warc.read_records(archive, warc.lookup(archive, warc.keys_of(pages)))
    return records.select(F.col("page").alias("page_id"), "payload_bytes", F.col("payload_sha1").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), words=5, percent=85)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=24)
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), window=1024, end_id=0)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.roundtrip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_chat_format, op2_hnsw, op3_url_lists, op4_warc, op5_near_dup, op6_exact_dedup, op7_toxicity, op8_sharding, op9_packing, op10_bpe)}
