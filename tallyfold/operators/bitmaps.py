"""Exact distinct counts that add up: bitmaps of numbered keys, stored per group and merged.

Every key gets a number once: a bucket by its hash, and a place among the keys of that bucket. A group's keys
are then one bit each, 4 kilobytes for a bucket of up to 32768 keys. The keys of any union of groups, of
what two groups share, or of what one has and the other lacks, are counted from these bitmaps; facts are read
once, and no question shuffles keys again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Bits of one bitmap, and how many of them are meant to be used: hashing fills buckets unevenly.
BITS = 32768
LOAD = 16384


def key_numbers(df: DataFrame, key: Sequence[str], buckets: int | None = None) -> DataFrame:
    """key columns, bucket and place (from 0) of every distinct key; keys with a null part are left out.

    The places follow the order of the keys in their bucket, so the same keys get the same numbers. With
    `buckets` given, it must leave room: a bucket of more than 32768 keys fails the job.
    """
    keys = df.select(*key).where(" AND ".join(f"`{k}` IS NOT NULL" for k in key)).distinct()
    n = buckets or -(-max(1, keys.count()) // LOAD)
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(*key)) - 1
    rows = keys.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")).withColumn("place", place)
    full = F.raise_error(F.lit("too many keys for the number of buckets")).cast("int")
    return rows.withColumn("place", F.when(F.col("place") < BITS, F.col("place")).otherwise(full))


def group_bitmaps(df: DataFrame, numbers: DataFrame, key: Sequence[str], by: Sequence[str]) -> DataFrame:
    """by, bucket and bits of the keys that each group has. Keys without a number are left out."""
    return df.select(*by, *key).join(numbers, list(key)).groupBy(*by, "bucket").agg(
        F.bitmap_construct_agg(F.col("place").cast("bigint")).alias("bits")
    )


def merge_bitmaps(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of the unions of groups: `by` is a part of their columns, or none for all together."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(bitmaps: DataFrame, by: Sequence[str], name: str = "jobs") -> DataFrame:
    """Keys of each group; one row per group with any key."""
    return bitmaps.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))


def shared(bitmaps: DataFrame, column: str, left: str, right: str) -> DataFrame:
    """One row: keys that only group `left` of `column` has, that both have, and that only `right` has."""
    merged = merge_bitmaps(bitmaps.where(F.col(column).isin(left, right)), [column])
    sizes = merged.groupBy("bucket").agg(
        F.coalesce(F.sum(F.when(F.col(column) == left, F.bitmap_count("bits"))), F.lit(0)).alias("a"),
        F.coalesce(F.sum(F.when(F.col(column) == right, F.bitmap_count("bits"))), F.lit(0)).alias("b"),
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("either"),
    )
    a, b, either = (F.coalesce(F.sum(c), F.lit(0)) for c in ("a", "b", "either"))
    return sizes.agg(a.alias("a"), b.alias("b"), either.alias("either")).select(
        (F.col("either") - F.col("b")).alias("only_left"),
        (F.col("a") + F.col("b") - F.col("either")).alias("both"),
        (F.col("either") - F.col("a")).alias("only_right"),
    )
