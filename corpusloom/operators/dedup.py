"""Keep-first deduplication and its counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import add_cleaned_text, text_digest
from corpusloom.session import stage

DEFAULT_ORDER = ("category", "filename")


def first_per_group(df: DataFrame, key: Column, order_by: Sequence[str]) -> DataFrame:
    """The first row of each ``key`` in the order of ``order_by``.

    Spark turns ``row_number() = 1`` into a group limit on both sides of the shuffle, so a group
    of copies sends one row per map task however many rows it has.
    """
    window = Window.partitionBy("_key").orderBy(*order_by)
    return (
        df.withColumn("_key", key)
        .withColumn("_position", F.row_number().over(window))
        .filter(F.col("_position") == 1)
        .drop("_key", "_position")
    )


def later_copies(keys: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """The places ``order_by`` of rows whose ``key`` an earlier row has, staged.

    Only digests and places move. Counts and least places merge in the tasks; a key without copies
    goes no further, and a key of many rows is split by the join.
    """
    narrow = keys.select(key, *order_by)
    place = F.struct(*order_by)
    groups = narrow.groupBy(key).agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    found = narrow.join(groups, key).filter(place > F.col("_first"))
    return stage(found.select(*order_by), "later-copies")


def without_later_copies(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """The first row of each ``key``; ``order_by`` names a row and has no nulls. ``df`` should be a stored table.

    Copies are few as a rule, and their places small enough for a broadcast, so the rows that stay
    are not moved. Where there are too many, Spark joins by shuffle.
    """
    return df.join(later_copies(df, key, order_by), [*order_by], "left_anti")


def dedup_keep_first(df: DataFrame, column: str = "text", order_by: Sequence[str] = DEFAULT_ORDER) -> DataFrame:
    """Drop rows whose ``column`` equals that of an earlier row.

    Digests and places are stored, texts are not: ``df`` is read once for them and once for the rows that stay, so it should be a
    stored table, or columns that are cheap to make of one.
    """
    keys = stage(df.select(text_digest(F.col(column)).alias("_key"), *order_by), "keys")
    return df.join(later_copies(keys, "_key", order_by), [*order_by], "left_anti")


def prepared_posts(posts: DataFrame) -> DataFrame:
    """Posts with ``cleaned_text, cleaned_len, text_key, body_key``, staged: texts are cleaned once."""
    cleaned = add_cleaned_text(posts).withColumn("cleaned_len", F.length("cleaned_text"))
    keys = {"text_key": text_digest(F.col("text")), "body_key": text_digest(F.col("cleaned_text"))}
    return stage(cleaned.withColumns(keys), "prepared")


def surviving_prepared(
    prepared: DataFrame, order_by: Sequence[str] = DEFAULT_ORDER, min_length: int = 50
) -> DataFrame:
    """The first post of each cleaned text, if it is long enough.

    Exact duplicates need no pass of their own: copies of a text share their cleaned text, and the
    first post of a cleaned text is also the first of its text.
    """
    return without_later_copies(prepared, "body_key", order_by).filter(F.col("cleaned_len") >= min_length)


def duplicate_counts(keys: DataFrame) -> DataFrame:
    """``(exact_duplicates, body_duplicates)``: rows minus distinct texts, rows minus distinct bodies.

    ``keys`` has ``text_key, body_key`` per post. A text has one body, so grouping by both and then
    by the body gives both numbers from one scan; copies merge before each shuffle.
    """
    texts = keys.groupBy("text_key", "body_key").agg(F.count(F.lit(1)).alias("posts"))
    bodies = texts.groupBy("body_key").agg(F.sum("posts").alias("posts"), F.count(F.lit(1)).alias("texts"))
    return bodies.agg(
        F.coalesce(F.sum(F.col("posts") - F.col("texts")), F.lit(0)).alias("exact_duplicates"),
        F.coalesce(F.sum(F.col("posts") - 1), F.lit(0)).alias("body_duplicates"),
    )


def surviving_posts(
    posts: DataFrame, order_by: Sequence[str] = DEFAULT_ORDER, min_length: int = 50
) -> DataFrame:
    """As ``surviving_prepared`` in one lazy plan, for results that need no text; adds ``cleaned_len``."""
    cleaned = add_cleaned_text(posts).withColumn("cleaned_len", F.length("cleaned_text"))
    kept = first_per_group(cleaned, text_digest(F.col("cleaned_text")), order_by)
    return kept.filter(F.col("cleaned_len") >= min_length)


def removed_per_step(posts: DataFrame, min_length: int = 50) -> DataFrame:
    """One row with the number of posts that each cleaning step removes, in step order.

    Copies collapse before the first shuffle and again before the second; only digests move.
    ``posts`` may be prepared, or is cleaned here.
    """
    if "body_key" not in posts.columns:
        posts = add_cleaned_text(posts).select(
            text_digest(F.col("text")).alias("text_key"),
            text_digest(F.col("cleaned_text")).alias("body_key"),
            F.length("cleaned_text").alias("cleaned_len"),
        )
    keys = posts.select("text_key", "body_key", F.coalesce(F.col("cleaned_len") < min_length, F.lit(True)).alias("short"))
    texts = keys.groupBy("text_key", "body_key", "short").agg(F.count(F.lit(1)).alias("posts"))
    bodies = texts.groupBy("body_key", "short").agg(
        F.sum("posts").alias("posts"), F.count(F.lit(1)).alias("texts")
    )
    total = bodies.agg(
        F.coalesce(F.sum("posts"), F.lit(0)).alias("loaded"),
        F.coalesce(F.sum("texts"), F.lit(0)).alias("texts"),
        F.count(F.lit(1)).alias("bodies"),
        F.count_if("short").alias("short"),
    )
    return total.select(
        "loaded",
        (F.col("loaded") - F.col("texts")).alias("exact_duplicates"),
        (F.col("texts") - F.col("bodies")).alias("body_duplicates"),
        F.col("short").alias("too_short"),
        (F.col("bodies") - F.col("short")).alias("remaining"),
    )
