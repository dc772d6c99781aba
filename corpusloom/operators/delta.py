"""Adding deliveries to a cleaned corpus without cleaning or moving what is there.

A corpus keeps, besides its posts, the digests of their cleaned texts and a Bloom filter of these digests in blocks of 64 bits: a
digest sets ``HASHES`` bits of one block, so a test is one equi-join with the blocks and a mask. A delivery is cleaned and
deduplicated by itself; its digests meet the filter, and only those that may be there meet the digests, so that nearly all of
a new delivery is settled by the filter. The small side of each join is the delivery, which Spark broadcasts by its size:
the corpus is scanned where it lies, and is neither read as text nor shuffled.

Blocks of several deliveries need not be merged for a test, since a digest's bits lie in one block of its own delivery;
``compact_filter`` merges them by OR to keep the filter small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.dedup import DEFAULT_ORDER, prepared_posts, surviving_prepared
from corpusloom.session import child_names, stage
from corpusloom.sources.posts import CLEANED_COLUMNS

#: Blocks of the filter; ``BITS_PER_KEY`` bits for each expected post are enough for about one false alarm in a hundred.
BITS_PER_KEY = 16
HASHES = 4
DEFAULT_POSTS = 1 << 20


def filter_blocks(expected_posts: int) -> int:
    return max(1, -(-expected_posts * BITS_PER_KEY // 64))


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def mask_of(key: Column) -> Column:
    """The bits of a digest within its block."""
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(key, F.lit(i)), F.lit(64)).cast("int")) for i in range(1, HASHES + 1)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask


def bloom_of(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """``word, bits``: the filter of the keys. Bits merge in the tasks before they are exchanged."""
    return keys.groupBy(block_of(F.col(key), blocks).alias("word")).agg(F.bit_or(mask_of(F.col(key))).alias("bits"))


def merge_blooms(*blooms: DataFrame) -> DataFrame:
    """The filter of a union: blocks are merged by OR."""
    union = blooms[0]
    for bloom in blooms[1:]:
        union = union.unionByName(bloom)
    return union.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def may_hold(keys: DataFrame, key: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``keys`` whose key the filter does not rule out, each once."""
    asked = keys.withColumn("word", block_of(F.col(key), blocks)).withColumn("mask", mask_of(F.col(key)))
    met = asked.join(bloom, "word").filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    return met.select(*keys.columns).distinct()


def deliveries(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(name.removeprefix("delivery=")) for name in child_names(spark, f"{folder}/corpus") if name.startswith("delivery="))


def read_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """All posts with the number of their ``delivery``."""
    return spark.read.parquet(f"{folder}/corpus")


def add_delivery(
    posts: DataFrame, folder: str, number: int, min_length: int = 50, order_by: Sequence[str] = DEFAULT_ORDER, expected_posts: int = DEFAULT_POSTS
) -> DataFrame:
    """Clean ``posts`` and add those whose cleaned text neither the corpus nor an earlier post has; returns their counts.

    Deliveries are numbered, and a number that is delivered again replaces what it left, so a failed run can be repeated; it
    must be the last one. ``expected_posts`` sizes the filter and must be the same for all deliveries of a corpus.
    Adding deliveries one by one equals one clean job in the order of (delivery, ``order_by``).
    """
    spark = posts.sparkSession
    blocks = filter_blocks(expected_posts)
    earlier = [n for n in deliveries(spark, folder) if n < number]
    fresh = surviving_prepared(prepared_posts(posts), order_by, min_length)
    fresh = stage(fresh, "fresh")
    keys = fresh.select("body_key")
    asked = found = spark.createDataFrame([], keys.schema)
    if earlier:

        def kept(kind: str) -> DataFrame:
            return spark.read.parquet(*[f"{folder}/{kind}/delivery={n}" for n in earlier])

        asked = stage(may_hold(keys, "body_key", kept("filter"), blocks), "maybe-known")
        found = stage(kept("digests").select("body_key").join(asked, "body_key", "left_semi").distinct(), "known")
    added = fresh.join(found, "body_key", "left_anti")
    added.select(*CLEANED_COLUMNS).write.mode("overwrite").parquet(f"{folder}/corpus/delivery={number}")
    new_keys = added.select("body_key")
    new_keys.write.mode("overwrite").parquet(f"{folder}/digests/delivery={number}")
    bloom_of(spark.read.parquet(f"{folder}/digests/delivery={number}"), "body_key", blocks).write.mode("overwrite").parquet(f"{folder}/filter/delivery={number}")
    none = F.lit(0).cast("long")
    parts = [(keys, "cleaned"), (asked, "asked"), (found, "known")]
    names = [name for _, name in parts]
    union = None
    for table, name in parts:
        one = table.select(*[F.lit(1).cast("long").alias(n) if n == name else none.alias(n) for n in names])
        union = one if union is None else union.unionByName(one)
    return union.agg(*[F.coalesce(F.sum(n), none).alias(n) for n in names])


def compact_filter(spark: SparkSession, folder: str) -> None:
    """Merge the filters of all deliveries into that of the last one."""
    numbers = [n for n in deliveries(spark, folder) if f"delivery={n}" in child_names(spark, f"{folder}/filter")]
    if len(numbers) < 2:
        return
    merged = stage(merge_blooms(spark.read.parquet(*[f"{folder}/filter/delivery={n}" for n in numbers])), "merged-filter")
    merged.write.mode("overwrite").parquet(f"{folder}/filter/delivery={numbers[-1]}")
    for n in numbers[:-1]:
        spark.createDataFrame([], merged.schema).write.mode("overwrite").parquet(f"{folder}/filter/delivery={n}")
