"""Equality of large sets: order-independent sums of row hashes, bucket by bucket; only what differs is compared by row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import kept

#: Buckets of rows.
BUCKETS = 1 << 18


def row_hash(columns: Sequence[str], seed: int) -> Column:
    """64 bits of a row; nulls count where they stand."""
    return F.xxhash64(F.lit(seed), *(x for c in columns for x in (F.col(c).isNull(), F.col(c))))


def _sums(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """A row for each lowest bucket: how many rows, and sums of 128 bits of their hashes, 32 at a time, which nothing but the
    rows themselves and how often each stands decides."""
    a, b = row_hash(columns, 11), row_hash(columns, 12)
    half = lambda h, high: F.shiftrightunsigned(h, 32) if high else h.bitwiseAND(F.lit(0xFFFFFFFF))
    sums = [F.sum(half(h, high).cast("decimal(20,0)")).alias(f"s{2 * i + high}") for i, h in enumerate((a, b)) for high in (0, 1)]
    return df.groupBy(F.pmod(row_hash(keys, 13), F.lit(BUCKETS)).alias("bucket")).agg(F.count("*").alias("n"), *sums)


def differing_buckets(a: DataFrame, b: DataFrame, columns: Sequence[str], keys: Sequence[str] | None = None) -> DataFrame:
    """Buckets (of `keys`, by default all columns) whose rows differ between a and b. Only sums are shuffled, a row for each bucket
    and task; the sums of all buckets are the root, and equal sets end there."""
    keys = keys or columns
    sums = ["n", "s0", "s1", "s2", "s3"]
    lowest = kept(_sums(a, columns, keys).withColumn("side", F.lit(1)).unionByName(_sums(b, columns, keys).withColumn("side", F.lit(-1))))
    tree = lowest.groupBy("bucket").agg(*(F.sum(F.col(c) * F.col("side")).alias(c) for c in sums))
    same = reduce(lambda x, y: x & y, (F.col(c) == 0 for c in sums))
    wrong = tree.where(~same)
    # the root: one row that says whether anything differs at all
    return wrong.select("bucket").limit(0) if wrong.agg(F.count("*").alias("m")).first().m == 0 else wrong.select("bucket")


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other: side, the columns, n (how many times more)."""
    columns = a.columns
    buckets = differing_buckets(a, b, columns)
    both = in_buckets(a, columns, buckets).withColumn("_d", F.lit(1)).unionByName(in_buckets(b, columns, buckets).withColumn("_d", F.lit(-1)))
    counted = both.groupBy(*columns).agg(F.sum("_d").alias("_d")).where("_d <> 0")
    return counted.select(F.when(F.col("_d") > 0, "left").otherwise("right").alias("side"), *columns, F.abs("_d").alias("n"))


def in_buckets(df: DataFrame, keys: Sequence[str], buckets: DataFrame) -> DataFrame:
    return df.withColumn("bucket", F.pmod(row_hash(keys, 13), F.lit(BUCKETS))).join(buckets, "bucket", "left_semi").drop("bucket")


def sample(differing: DataFrame, columns: Sequence[str], k: int = 20) -> DataFrame:
    """k of the rows that differ: the same ones whatever the partitioning, by the order of a digest of the row."""
    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("side", *columns)))
    return differing.withColumn("_o", F.md5(text)).orderBy("_o", "side", *columns).limit(k).drop("_o")
