"""Sharding: a two-pass external shuffle.

Pass one scatters rows into shards by a seeded hash of their key, and within a shard into buckets of
about ``bucket_bytes`` by another; pass two takes each bucket into memory, permutes it by Fisher and
Yates' exchange (the built-in ``shuffle``) and lays the buckets of a shard one behind the other.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SHARDS, SEED, BUCKET_BYTES = 24, 20_240_229, 8 << 20
#: What a row takes besides its text.
ROW_BYTES = 8


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard of ``key``, decided by the key and the number of shards alone. It is built up one
    shard at a time: with n shards in place of n - 1, each key moves to the new shard with
    probability 1/n and else stays."""
    moves = lambda n: F.pmod(F.xxhash64(key, F.lit(seed).cast("bigint"), n), n) == 0
    return F.aggregate(
        F.sequence(F.lit(2).cast("bigint"), F.lit(shards).cast("bigint")) if shards > 1 else F.array().cast("array<bigint>"),
        F.lit(0),
        lambda at, n: F.when(moves(n), (n - 1).cast("int")).otherwise(at),
    )


def row_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + ROW_BYTES


def external_shuffle(
    rows: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """The columns of ``rows`` with ``_shard`` (int, from 0) and ``_slot`` (long, gapless from 0 in
    each shard): a seeded random order of each shard, the same on every run over the same rows.

    Every row lands once, repeated rows as often as they occur; rows with a null key share a shard;
    null and empty texts count ROW_BYTES. Rows are spread over buckets by key and text, so copies of
    a text under other keys part. Only hot keys repeated with the same text stay in one bucket.
    Columns named ``_shard``, ``_slot`` or ``_bucket`` must not be in ``rows``.
    """
    k, t = F.col(f"`{key}`"), F.col(f"`{text}`")
    total = rows.agg(F.sum(row_size(t))).first()[0] or 0
    per_shard = max(1, math.ceil(total / shards / bucket_bytes))
    bucket = F.pmod(F.xxhash64(F.lit(seed + 1).cast("bigint"), k, t), F.lit(per_shard)).cast("int")
    scattered = rows.withColumns({"_shard": shard_of(k, shards, seed), "_bucket": bucket})
    before = Window.partitionBy("_shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        scattered.groupBy("_shard", "_bucket")
        .count()
        .select("_shard", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    # the built-in shuffle draws its numbers by partition, so rows and buckets come in an order that any run gives
    order = ["_shard", "_bucket", F.xxhash64("_shard", "_bucket", k), k, t]
    dealt = (
        scattered.repartition(shards * per_shard, "_shard", "_bucket")
        .sortWithinPartitions(*order)
        .groupBy("_shard", "_bucket")
        .agg(F.shuffle(F.collect_list(F.struct(*[f"`{c}`" for c in rows.columns])), seed).alias("_rows"))
        .join(starts, ["_shard", "_bucket"])
    )
    return dealt.select("_shard", "_start", F.posexplode("_rows")).select("col.*", "_shard", (F.col("_start") + F.col("pos")).alias("_slot"))


def write_shards(shuffled: DataFrame, path: str) -> None:
    """One folder per shard, each file of it in slot order."""
    shuffled.repartition("_shard", (F.col("_slot") / 65_536).cast("bigint")).sortWithinPartitions("_shard", "_slot").write.partitionBy("_shard").parquet(path)


def op4_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    grows = F.pmod(F.xxhash64("doc_id", F.lit(SEED).cast("bigint"), F.lit(SHARDS + 1).cast("bigint")), F.lit(SHARDS + 1).cast("bigint")) == 0
    return external_shuffle(docs).select(
        "doc_id",
        row_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
        F.when(grows, F.lit(SHARDS)).otherwise(F.col("_shard")).alias("grown_shard"),
    )


QUERIES = {"op4_external_shuffle": op4_external_shuffle}
ORACLE_SQL: dict[str, str] = {}
