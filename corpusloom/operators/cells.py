"""Meeting rows of one table with rows of another in cells of bounded size.

Similarity needs every row of one side to meet rows of the other. Both sides are cut into blocks by a hash of
their keys, and a cell is a block of either side in one task, brought together by a cogroup. A block is sent
once for every block of the other side, so cells are as large as a task can hold and no larger. No row passes the driver, which
sees counts; no pair is ever a row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import ship

#: Rows on either side of a cell, about.
QUERY_ROWS = 4096
HELD_ROWS = 16384
ENTRY_ROWS = 8192
#: Bytes of vectors on either side of a cell, about, where there are more rows than that: a row is sent once for every block of
#: the other side, so what is sent grows with the square of the rows over the size of a block.
CELL_BYTES = 64 << 20
#: Rows for which another task pays.
TASK_ROWS = 2048


def block_count(rows: int, block_rows: int) -> int:
    return max(1, -(-rows // block_rows))


def large_block(width: int, block_rows: int) -> int:
    """Rows of vectors of ``width`` components that a block takes at most; ``block_rows`` at least."""
    return max(block_rows, CELL_BYTES // (8 * max(1, width)))


def fewest_blocks(rows: int, width: int, block_rows: int, wanted: int) -> int:
    """Blocks as large as a task can hold, or smaller ones, ``block_rows`` at least, until there are ``wanted`` of them."""
    return max(block_count(rows, large_block(width, block_rows)), min(block_count(rows, block_rows), wanted))


def vector_width(rows: DataFrame) -> int:
    """Components of the vectors, as the first one tells."""
    first = rows.select(F.size("embedding").alias("width")).filter("width >= 0").first()
    return first["width"] if first else 0


def count_up_to(rows: DataFrame, most: int) -> int:
    """How many rows there are; a small table is not read twice, a large one no further than it must."""
    few = rows.limit(most + 1).count()
    return few if few <= most else rows.count()


def _numbers(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), n - 1))


def _block(key: str, n: Column) -> Column:
    return F.pmod(F.xxhash64(key), n).cast("int")


def all_cells(asked: DataFrame, held: DataFrame, asked_key: str, held_key: str, run: Callable, schema: str, asked_blocks: int, held_blocks: int) -> DataFrame:
    """What ``run(asked, held)``, a function of Arrow tables, yields for every cell of two tables."""
    ship(asked.sparkSession)
    left = asked.withColumn("_held", _numbers(F.lit(held_blocks))).withColumn("_asked", _block(asked_key, F.lit(asked_blocks)))
    right = held.withColumn("_asked", _numbers(F.lit(asked_blocks))).withColumn("_held", _block(held_key, F.lit(held_blocks)))
    return left.groupBy("_asked", "_held").cogroup(right.groupBy("_asked", "_held")).applyInArrow(run, schema)


def cluster_sizes(held: DataFrame) -> dict[int, int]:
    """Rows of each cluster, of which there are as many as the model has components."""
    return {r["dominant_cluster"]: r["count"] for r in held.groupBy("dominant_cluster").count().collect()}


def in_cells(
    asked: DataFrame, held: DataFrame, run: Callable, schema: str, n_asked: int, sizes: dict[int, int], block_rows: int = ENTRY_ROWS
) -> DataFrame:
    """What ``run(queries, entries)`` yields for every cell of queries and the clusters in their routes.

    A cell is a block of queries and a block of the entries of one cluster, so a cluster of any size is spread over
    many cells. Blocks have ``block_rows`` rows at least, and as many as ``CELL_BYTES`` hold where tasks are enough. ``asked`` has ``qid, embedding, route``, ``held`` has ``entry_id, embedding,
    dominant_cluster``; ``n_asked`` and ``sizes`` are their rows, by cluster for ``held``.
    """
    ship(asked.sparkSession)
    if not sizes:
        return asked.sparkSession.createDataFrame([], schema)
    # A few small blocks need no second look.
    large = max(n_asked, *sizes.values()) > block_rows
    width = vector_width(held) if large else 0
    entry_blocks = {c: fewest_blocks(n, width, block_rows, 1) if width else block_count(n, block_rows) for c, n in sizes.items()}
    blocks = F.create_map(*[F.lit(x) for c, n in entry_blocks.items() for x in (c, n)])
    wanted = -(-2 * asked.sparkSession.sparkContext.defaultParallelism // sum(entry_blocks.values()))
    query_blocks = fewest_blocks(n_asked, width, block_rows, wanted) if width else block_count(n_asked, block_rows)
    present = F.array(*[F.lit(c) for c in sizes])
    cluster = F.explode(F.when(F.col("route").isNull(), present).otherwise(F.array_intersect("route", present)))
    queries = (
        asked.withColumn("cluster", cluster)
        .withColumn("entry_block", _numbers(blocks[F.col("cluster")]))
        .withColumn("query_block", _block("qid", F.lit(query_blocks)))
    )
    entries = (
        held.withColumnRenamed("dominant_cluster", "cluster")
        .withColumn("dominant_cluster", F.col("cluster"))
        .withColumn("entry_block", _block("entry_id", blocks[F.col("cluster")]))
        .withColumn("query_block", _numbers(F.lit(query_blocks)))
    )
    keys = ["cluster", "query_block", "entry_block"]
    return queries.groupBy(*keys).cogroup(entries.groupBy(*keys)).applyInArrow(run, schema)
