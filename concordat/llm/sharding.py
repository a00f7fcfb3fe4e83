"""Rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, partitions, stored


def rendezvous(keys: Sequence[Column | str], weights: Mapping[int, float]) -> Column:
    """Shard of a record: every shard draws a value from the hash of key and shard number; the heaviest draw wins.

    A draw is ``-ln(u) / weight`` with u uniform in (0, 1), and the smallest wins, so a shard gets its weight's share,
    and a new shard takes records only into itself: about its share of all, and no record moves between old ones.
    A null key hashes like any other value, so all its records share a shard. Ties go to the smaller number.
    """
    if not weights or any(not w > 0 for w in weights.values()):
        raise ValueError("at least one shard, and weights above zero")

    def draw(shard: int) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(*(F.col(k) if isinstance(k, str) else k for k in keys), F.lit(int(shard))), 11)
        return -F.log((bits + F.lit(0.5)) / F.lit(float(2**53))) / F.lit(float(weights[shard]))

    draws = [F.struct(draw(n).alias("draw"), F.lit(int(n)).alias("shard")) for n in sorted(weights)]
    return (draws[0] if len(draws) == 1 else F.least(*draws))["shard"]


def with_slots(df: DataFrame, shard: str, order: Sequence[str], slot: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps; a shard is never gathered in one task.

    Rows are dealt over buckets of their shard by their hash; a bucket is numbered by ``order`` after the rows of the
    buckets before it. There are as many buckets a shard as shuffle partitions, so the table of bucket sizes stays
    small. The input partition takes part in the hash, which spreads rows that are equal in ``order``; the dealt rows
    are stored first, so a task that runs again finds them where they were.
    """
    bucket, base = free_name(df, "bucket"), free_name(df, "base")
    count = partitions(df.sparkSession)
    dealt = stored(df.withColumn(bucket, F.pmod(F.xxhash64(*order, F.spark_partition_id()), F.lit(count)).cast("int")))
    before = Window.partitionBy(shard).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(shard, bucket).agg(F.count(F.lit(1)).alias(base))
    sizes = sizes.withColumn(base, F.coalesce(F.sum(base).over(before), F.lit(0)))
    within = Window.partitionBy(shard, bucket).orderBy(*order)
    numbered = dealt.withColumn(slot, F.row_number().over(within).cast("long") - 1)
    return numbered.join(sizes, [shard, bucket]).withColumn(slot, F.col(slot) + F.col(base)).drop(bucket, base)


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document, over equally heavy shards.

    The document id is the key: null ids share a shard, equal ids too. A null text has size 1 and the checksum of no
    bytes. Repeated rows each get a slot. Other columns are ignored.
    """
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(["doc_id"], dict.fromkeys(range(shards), 1.0)).alias("shard"),
        rendezvous(["doc_id"], dict.fromkeys(range(shards + 1), 1.0)).alias("grown_shard"),
    )
    slotted = with_slots(rows, "shard", ["doc_id", "text_crc32", "size"])
    return slotted.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
