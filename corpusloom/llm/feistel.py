"""Sharding by a permutation of the global row numbers (DataFrame functions only).

Every row gets a global number, a Feistel network with cycle walking permutes the numbers
``0 .. n-1``, and the permuted number ``p`` gives shard ``p % n_shards`` and slot ``p // n_shards``.
Shard sizes differ by one row at most, and where a row lies is computable from its number alone.

Defined results: a null text counts as empty (size 16, checksum of nothing); an empty table gives an
empty result; repeated rows and equal ids each get a place of their own; null ids sort first; other
columns of the input are not read.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUNDS = 8
#: Steps of cycle walking in the plan. A step leaves the range for less than one number in
#: ``sqrt(n)``, so even ten in a row are out of reach; a number that needed more would fail the job.
WALK_STEPS = 12
BUCKET_ROWS = 1 << 20
LEAST_BUCKETS = 64


def number_rows(rows: DataFrame, key: str, ties: list[str], n: int) -> DataFrame:
    """Add ``row_number`` from 0: order of (bucket, key, ties), where a bucket is a hash of key and ties.

    Buckets are ranked on their own and start where the earlier ones end, so no task sees all rows.
    """
    buckets = max(LEAST_BUCKETS, -(-n // BUCKET_ROWS))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(key, *ties), F.lit(buckets)).cast("int"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("bucket").count().select(
        "bucket", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("bucket_start")
    )
    within = Window.partitionBy("bucket").orderBy(key, *ties)
    ranked = rows.withColumn("bucket_rank", F.row_number().over(within))
    return (
        ranked.join(starts, "bucket")
        .withColumn("row_number", F.col("bucket_start") + F.col("bucket_rank") - 1)
        .drop("bucket", "bucket_start", "bucket_rank")
    )


def permute(number: Column, n: int, seed: int) -> Column:
    """The place of ``number`` in a permutation of ``0 .. n-1`` that ``seed`` chooses."""
    if n <= 1:
        return number
    # A grid of `left` x `right` cells that holds fewer than `left` cells too many.
    left = isqrt(n - 1) + 1
    right = -(-n // left)

    def round_of(i: int):
        key = F.lit(seed * ROUNDS + i)

        def half(cell: Column) -> Column:
            low, high = F.pmod(cell, F.lit(right)), F.call_function("div", cell, F.lit(right))
            if i % 2:
                return high * right + F.pmod(low + F.pmod(F.xxhash64(high, key), F.lit(right)), F.lit(right))
            return F.pmod(high + F.pmod(F.xxhash64(low, key), F.lit(left)), F.lit(left)) * right + low

        return half

    def bound(value: Column, then) -> Column:
        """``then(value)`` with the value worked out once."""
        return F.element_at(F.transform(F.array(value), then), 1)

    def network(cell: Column) -> Column:
        for i in range(ROUNDS):
            cell = bound(cell, round_of(i))
        return cell

    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK_STEPS)),
        network(number),
        lambda cell, _: F.when(cell < n, cell).otherwise(network(cell)),
    )
    return bound(walked, lambda x: F.when(x < n, x).otherwise(F.raise_error(F.lit("cycle not closed: take another seed"))))


def shard_documents(docs: DataFrame, n_shards: int = 40, seed: int = 11) -> DataFrame:
    """``doc_id, size, text_crc32, row_number, shard, slot`` of every row of ``docs(doc_id, text)``.

    The law is `rows`: shards hold equally many rows, or one more. The rows are counted first.
    """
    content = F.encode(F.coalesce(F.col("text"), F.lit("")), "utf-8")
    rows = docs.select("doc_id", (F.length(content) + 16).cast("long").alias("size"), F.crc32(content).alias("text_crc32"))
    n = docs.count()
    numbered = number_rows(rows, "doc_id", ["size", "text_crc32"], n)
    return (
        numbered.withColumn("place", permute(F.col("row_number"), n, seed))
        .withColumn("shard", F.pmod("place", F.lit(n_shards)).cast("int"))
        .withColumn("slot", F.call_function("div", F.col("place"), F.lit(n_shards)))
        .drop("place")
    )
