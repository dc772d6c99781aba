"""Merkle manifest of a dataset: a digest tree for each source, and one over the sources, with a proof for every row.

A leaf is the SHA-256 of a row's fields. The leaves of a source, by ``doc_id``, are hashed in runs of ``FAN`` (16) until one node, the
subroot, is left; the subroots, by source, give the root likewise. Digests are lowercase hex, and hashed as such.

Levels are concatenated strings: an aligned block of ``BLOCK`` (256) nodes holds each of its levels as one hex string.
Substrings of fixed width are hashed to the next level's string; a block's last node is a node of the next round of blocks, until
each tree has one node. On the way back a block gets the sibling segments above it, once for all of its nodes, and the substrings
on either side of a node within its run are its own segments. Rows are never joined with their proofs: they lie in their block.

Nodes get their place in the tree by a range sort over (tree, order), so a source with any share of the rows is spread over
tasks; blocks are groups of 256 at most. The number of rounds is the depth of the largest tree, the only figure that the driver sees.
Strings are held as bytes of their ASCII characters, since a substring of bytes is found without reading what is before it.

Defined results: a null field counts as ``-``, an empty one as ``0:``; rows with a null source are a tree of their own, before
all others, and null ids come first in theirs; rows of one source and id are ordered by leaf, repeated rows have a place and a proof each
(all rows equal in source, id and leaf pass one task when they are sorted); an empty table gives an empty
result; columns beyond the five fields play no part, those named in ``keep`` pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import stage

#: Fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 16
#: Levels of a block, and its nodes.
LEVELS = 2
BLOCK = FAN**LEVELS
HEX = 64
SEGMENTS = "array<struct<left:binary,right:binary>>"


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:``, and the value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(fields: dict[str, Column] | None = None) -> Column:
    """The digest of a row's fields."""
    fields = fields or {c: F.col(c) for c in FIELDS}
    return F.sha2(F.concat(*[field(fields[c]) for c in FIELDS]), 256)


def digest(data: Column) -> Column:
    return F.sha2(data, 256).cast("binary")


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    joined = F.aggregate(proof, F.lit(b""), lambda sum, s: F.concat(sum, s["left"], s["right"]))
    return F.sha2(joined, 256)


def fold(node: Column, proof: Column) -> Column:
    """The root that ``node`` (hex) leads to with the siblings of ``proof``."""
    return F.aggregate(proof, node.cast("binary"), lambda own, s: digest(F.concat(s["left"], own, s["right"])), lambda own: own.cast("string"))


def numbered(nodes: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``nodes`` with ``place`` within the tree, from 0, and ``n``, the tree's size. ``tree`` is a column without nulls."""
    # Sorted runs of rows, written out with the number of their partition, which is then a column like any other.
    sorted_rows = nodes.repartitionByRange(tree, *[F.asc_nulls_first(c) for c in order])
    parts = stage(sorted_rows.withColumn("part", F.spark_partition_id()), "manifest-nodes")
    counts = parts.groupBy(tree, "part").count()
    earlier = Window.partitionBy(tree).orderBy("part")
    before = F.coalesce(F.sum("count").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = stage(counts.select(tree, "part", before.alias("base"), F.sum("count").over(Window.partitionBy(tree)).alias("n")), "manifest-bases")
    within = Window.partitionBy(tree, "part").orderBy(*[F.asc_nulls_first(c) for c in order])
    ranked = parts.withColumn("rank", F.row_number().over(within))
    return ranked.join(bases, [tree, "part"]).withColumn("place", F.col("base") + F.col("rank") - 1).drop("part", "base", "rank")


def lifted(level: Column) -> Column:
    """The next level's string: every run's digest."""
    width = FAN * HEX
    runs = F.sequence(F.lit(0), F.call_function("div", F.octet_length(level) - 1, F.lit(width)).cast("int"))
    return F.array_join(F.transform(runs, lambda r: F.sha2(F.substring(level, r * width + 1, F.lit(width)), 256)), "").cast("binary")


def blocks_of(nodes: DataFrame, keep: list[str]) -> DataFrame:
    """``tree, block, n, members, level_0 .. level_2, lifts, top`` of ``nodes(tree, place, node, n, *keep)``.

    ``members`` are the nodes' ``keep`` columns in order; ``lifts`` tells how many levels the block goes up.
    """
    block = F.call_function("div", F.col("place"), F.lit(BLOCK)).alias("block")
    member = F.struct("place", F.col("node").cast("binary").alias("node"), *keep)
    grouped = nodes.groupBy("tree", block, "n").agg(F.array_sort(F.collect_list(member)).alias("members"))
    # All nodes of a level have 64 characters, so the string of a block is a concatenation.
    level_0 = F.array_join(F.transform("members", lambda m: m["node"].cast("string")), "").cast("binary")
    # One level while the tree has more than one node, another while that leaves more than one.
    lifts = sum(((F.col("n") > FAN**i).cast("int") for i in range(LEVELS)), F.lit(0))
    out = grouped.withColumn("lifts", lifts).withColumn("level_0", level_0)
    for i in range(LEVELS):
        out = out.withColumn(f"level_{i + 1}", F.when(F.col("lifts") > i, lifted(F.col(f"level_{i}"))))
    top = F.coalesce(*[F.col(f"level_{i}") for i in range(LEVELS, -1, -1)])
    return out.withColumn("top", top)


def segments(i: Column) -> Column:
    """Siblings of the block's node number ``i`` at the block's levels."""
    width = FAN * HEX

    def at(level: int) -> Column:
        own = F.call_function("div", i, F.lit(FAN**level)).cast("int")
        start = F.call_function("div", own, F.lit(FAN)).cast("int") * width
        skipped = F.pmod(own, F.lit(FAN)) * HEX
        return F.struct(
            F.substring(F.col(f"level_{level}"), start + 1, skipped).alias("left"),
            F.substring(F.col(f"level_{level}"), start + skipped + HEX + 1, F.lit(width - HEX) - skipped).alias("right"),
        )

    return F.slice(F.array(*[at(level) for level in range(LEVELS)]), F.lit(1), F.col("lifts"))


def rounds_of(nodes: DataFrame, keep: list[str]) -> list[DataFrame]:
    """The blocks of all rounds, written out; the last round has one block, and one ``top``, for each tree."""
    found = [stage(blocks_of(nodes, keep), "manifest-blocks")]
    most = found[0].agg(F.max("n")).first()[0] or 0
    while most > BLOCK:
        up = found[-1].select("tree", F.col("block").alias("place"), F.col("top").alias("node"), F.call_function("div", F.col("n") + BLOCK - 1, F.lit(BLOCK)).alias("n"))
        found.append(stage(blocks_of(up, []), "manifest-blocks"))
        most = -(-most // BLOCK)
    return found


def with_proofs(rounds: list[DataFrame], above: DataFrame, passed: list[str], keep: list[str]) -> DataFrame:
    """``tree, *passed, node, *keep, proof`` of the nodes that ``rounds`` began with.

    ``above`` holds ``tree, proof, *passed``: the segments over each tree's top, and columns for all of its nodes.
    """
    upper = above.withColumn("block", F.lit(0).cast("long"))
    for i, blocks in reversed(list(enumerate(rounds))):
        own = keep if i == 0 else []
        joined = blocks.join(upper, ["tree", "block"])
        # Made within the block's row, so that no level's string is copied for each of its nodes.
        nodes = F.transform("members", lambda m, j: F.struct(
            m["place"].alias("place"), m["node"].cast("string").alias("node"), *[m[c].alias(c) for c in own],
            F.concat(segments(j), F.col("proof")).cast(SEGMENTS).alias("proof"),
        ))
        upper = joined.select("tree", *passed, F.explode(nodes).alias("x")).select("tree", *passed, F.col("x.place").alias("block"), F.col("x.node").alias("node"), *[F.col(f"x.{c}").alias(c) for c in own], "x.proof")
        if i:
            upper = upper.drop("node")
    return upper.drop("block")


def manifest(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``doc_id, source, leaf, subroot, root, proof`` and the columns ``keep`` of every row of ``docs``.

    ``proof`` holds ``left, right`` for each level up to the root: the siblings of the row's node, hex digits as bytes.
    """
    keep = keep or []
    aside = [f"kept_{i}" for i in range(len(keep))]
    # Null sorts before everything, and the letter keeps an empty source apart from it.
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
    rows = docs.select(tree.alias("tree"), leaf().alias("node"), F.col("doc_id"), F.col("source"), *[F.col(c).alias(a) for c, a in zip(keep, aside)])
    own = ["doc_id", "source", *aside]
    rounds = rounds_of(numbered(rows, "tree", ["doc_id", "node"]), own)
    subroots = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source_tree"), F.col("top").cast("string").alias("node"))
    top_rounds = rounds_of(numbered(subroots, "tree", ["source_tree"]), ["source_tree"])
    none = F.array().cast(SEGMENTS)
    root = top_rounds[-1].select("tree", none.alias("proof"), F.col("top").cast("string").alias("root"))
    sources = with_proofs(top_rounds, root, ["root"], ["source_tree"])
    above = stage(sources.select(F.col("source_tree").alias("tree"), F.col("node").alias("subroot"), "root", "proof"), "manifest-sources")
    found = with_proofs(rounds, above, ["subroot", "root"], own)
    return found.select("doc_id", "source", F.col("node").alias("leaf"), "subroot", "root", "proof", *[F.col(a).alias(c) for c, a in zip(keep, aside)])
