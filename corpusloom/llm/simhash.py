"""SimHash near-duplicates, found by anchor points of a covering code.

A fingerprint has 64 bits. Two that differ in ``BITS`` (3) or fewer differ in one bit at most in one of
two blocks of 31 bits. The code words of the Hamming code of 31 bits are the anchors of a block: they
cover it with radius 1. A fingerprint goes to every anchor within 1 + 1 bits, which are 16 or 1, so
two fingerprints with that close blocks meet at the anchor nearest to either, and what meets there is
compared in full. Anchors that many fingerprints share are split further by the other bits: of four
parts of these, one is equal in any linked pair.

Equal fingerprints are one node with their smallest id, so copies are never paired. Of each anchor's
links only a spanning forest leaves the task.

Defined results: a null text counts as empty, words there are none, the fingerprint is zero and links
like any other; rows with a null id have a fingerprint and no component, and link nothing; rows of
equal ids are one document with each row's fingerprint; an empty table gives an empty result; other
columns are not read by ``near_duplicates`` and pass through ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.batches import pieces, starts_of, text_bytes
from corpusloom.llm.components import components
from corpusloom.session import ship, stage

SHINGLE = 3
BITS = 3
SEED = 42
BLOCK = 31
#: An anchor with more fingerprints is split by the bits outside its block.
SHARED = 4096
#: Ids that are broadcast at most, 24 bytes each or so.
BROADCAST_IDS = 1 << 21
#: Groups up to this size are compared as a batch, larger ones member by member.
SMALL = 64


def fingerprints_of(texts: pa.Array, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The fingerprint of each text as an unsigned 64-bit integer."""
    flat, ends = text_bytes(texts)
    raw = np.where((flat >= 65) & (flat <= 90), flat | 32, flat).astype(np.uint8).tobytes()
    hashed, sizes = [], np.zeros(len(ends), np.int64)
    digest = xxhash.xxh64_intdigest
    for i, (a, b) in enumerate(zip(starts_of(ends).tolist(), ends.tolist())):
        words = raw[a:b].split()
        if words:
            runs = zip(*(words[k:] for k in range(shingle))) if len(words) >= shingle else [words]
            own = [digest(x, seed) for x in map(b" ".join, runs)]
            sizes[i] = len(own)
            hashed.append(own)
    hashes = np.fromiter(chain.from_iterable(hashed), np.uint64, int(sizes.sum()))
    out = np.zeros(len(ends), np.uint64)
    filled = sizes > 0
    if filled.any():
        first = starts_of(np.cumsum(sizes))[filled]
        for bit in range(64):
            ones = np.add.reduceat((hashes >> np.uint64(bit)) & np.uint64(1), first)
            out[filled] |= (2 * ones > sizes[filled].astype(np.uint64)).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id, fingerprint long`` of ``docs(doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            found = fingerprints_of(piece.column("text"), shingle, seed).view(np.int64)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(found)], names=["doc_id", "fingerprint"])

    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint long")


def syndromes(block: np.ndarray) -> np.ndarray:
    """For words of 31 bits, numbered 1 to 31: the number of the bit whose change gives a code word, or 0."""
    out = np.zeros(len(block), np.uint64)
    for k in range(5):
        mask = np.uint64(sum(1 << (i - 1) for i in range(1, BLOCK + 1) if i >> k & 1))
        out |= (np.bitwise_count(block & mask).astype(np.uint64) & np.uint64(1)) << np.uint64(k)
    return out


def anchors(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``found`` and an anchor of each, in both blocks; an anchor is a block's number and a code word."""
    rows, keys = [], []
    one = np.uint64(1)
    for number in range(2):
        block = (found >> np.uint64(BLOCK * number)) & np.uint64((1 << BLOCK) - 1)
        tag = np.uint64(number << BLOCK)
        off = syndromes(block)
        is_word = np.flatnonzero(off == 0)
        rows.append(is_word)
        keys.append(block[is_word] | tag)
        other = np.flatnonzero(off)
        near, s = block[other], off[other]
        rows.append(other)
        keys.append((near ^ (one << (s - one))) | tag)
        # Two changed bits i and j give a code word if the numbers' exclusive or is the syndrome.
        for i in range(1, BLOCK + 1):
            j = s ^ np.uint64(i)
            pair = (j > np.uint64(i)) & (j <= np.uint64(BLOCK))
            rows.append(other[pair])
            keys.append((near[pair] ^ (one << np.uint64(i - 1)) ^ (one << (j[pair] - one))) | tag)
    return np.concatenate(rows), np.concatenate(keys)


def spread_to_anchors(nodes: DataFrame) -> DataFrame:
    """``anchor, fingerprint, node``: a row for every anchor near enough to a fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                rows, keys = anchors(part.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64))
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), part.column("fingerprint").take(at), part.column("node").take(at)],
                    names=["anchor", "fingerprint", "node"],
                )

    return nodes.select("fingerprint", "node").mapInArrow(run, "anchor long, fingerprint long, node long")


def split_shared(spread: DataFrame) -> DataFrame:
    """``bucket, fingerprint, node``: an anchor is a bucket, or four sets of buckets if many share it.

    Two buckets whose keys meet by chance are compared as one, which finds no false link.
    """
    shared = stage(spread.groupBy("anchor").count().filter(F.col("count") > SHARED).select("anchor", F.lit(True).alias("shared")), "shared-anchors")
    joined = spread.join(shared, "anchor", "left")
    second = F.col("anchor") >= (1 << BLOCK)
    outside = F.when(second, F.col("fingerprint").bitwiseAND(F.lit((1 << BLOCK) - 1))).otherwise(
        F.shiftrightunsigned("fingerprint", BLOCK).bitwiseAND(F.lit((1 << BLOCK) - 1))
    )
    top = F.shiftrightunsigned("fingerprint", 2 * BLOCK)
    parts = [F.shiftright(outside, 8 * i).bitwiseAND(F.lit(255)) for i in range(3)]
    # The last part: 7 bits of the other block and the two bits of no block.
    parts.append(F.shiftright(outside, 24) * 4 + top)
    keys = F.array(*[F.xxhash64("anchor", F.lit(i), part) for i, part in enumerate(parts)])
    bucket = F.when(F.col("shared"), keys).otherwise(F.array("anchor"))
    return joined.select(F.explode(bucket).alias("bucket"), "fingerprint", "node")


def forest(group: np.ndarray, found: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within groups; rows come sorted by group. Pairs of row numbers."""
    n = len(group)
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, n))
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    small = np.repeat(sizes <= SMALL, sizes)
    at = np.flatnonzero(small & np.repeat(sizes > 1, sizes))
    own, values = group[at], found[at]
    for step in range(1, SMALL):
        same = own[step:] == own[:-step]
        if not same.any():
            break
        close = np.flatnonzero(same & (np.bitwise_count(values[step:] ^ values[:-step]) <= bits))
        left.append(at[close])
        right.append(at[close + step])
    for start, size in zip(first[sizes > SMALL], sizes[sizes > SMALL]):
        waiting = np.arange(start, start + size)
        while len(waiting):
            # Visit a component: whoever is reached leaves the ones that are still compared.
            reached, waiting = [waiting[0]], waiting[1:]
            while reached and len(waiting):
                me = reached.pop()
                close = np.bitwise_count(found[waiting] ^ found[me]) <= bits
                if close.any():
                    new, waiting = waiting[close], waiting[~close]
                    left.append(np.full(len(new), me))
                    right.append(new)
                    reached += new.tolist()
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(left), np.concatenate(right)
    # The least row of each component, by passing the least along links until nothing changes.
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def links(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """``a, b``: node ids that link all fingerprints which ``bits`` or fewer bits tell apart, as far as connected."""
    if bits > BITS:
        raise ValueError(f"two blocks of radius 1 find {BITS} bits at most")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def linked(rows: pa.Table) -> pa.RecordBatch:
            bucket, found, node = (rows.column(c).to_numpy() for c in ("bucket", "fingerprint", "node"))
            a, b = forest(bucket, found.view(np.uint64), bits)
            return pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            last = batch.column("bucket")[batch.num_rows - 1].as_py()
            # The last bucket may go on in the next batch.
            cut = int(np.searchsorted(batch.column("bucket").to_numpy(), last))
            if cut or (held and held[-1].column("bucket")[0].as_py() != last):
                yield linked(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield linked(pa.Table.from_batches(held))

    ship(nodes.sparkSession)
    buckets = split_shared(spread_to_anchors(nodes))
    return buckets.repartition("bucket").sortWithinPartitions("bucket", "node").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, seed: int = SEED) -> DataFrame:
    """``doc_id, fingerprint long, component_id`` of every row: the smallest id that links lead to."""
    found = stage(fingerprints(docs, shingle, seed), "fingerprints")
    nodes = stage(found.filter("doc_id is not null").groupBy("fingerprint").agg(F.min("doc_id").cast("long").alias("node")), "fingerprint-nodes")
    roots = components(links(nodes, bits))
    placed = nodes.join(roots, nodes["node"] == roots["a"], "left").select("fingerprint", F.coalesce("b", "node").alias("root"))
    component = F.when(F.col("doc_id").isNotNull(), F.col("root")).alias("component_id")
    return found.join(placed, "fingerprint", "left").select("doc_id", "fingerprint", component)


def keep_one(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS, seed: int = SEED) -> DataFrame:
    """One row of each component, and all rows without an id.

    It is a row whose own id and component are one: of several, that of the least fingerprint (as a signed number), text and then
    other columns (as JSON). Rows stay where they are: the ids that go are sent to them, by broadcast while they are known to be few
    (``BROADCAST_IDS``) and else as Spark joins. Only rows of ids that occur more than once and stay are exchanged, one a task and id.
    """
    found = stage(near_duplicates(docs, shingle, bits, seed).filter("doc_id is not null"), "near-duplicates")
    own = F.when(F.col("doc_id") == F.col("component_id"), F.col("fingerprint"))
    ids = stage(found.groupBy("doc_id").agg(F.count("*").alias("n"), F.min(own).alias("least")).filter("n > 1 or least is null"), "other-ids")
    repeated = stage(ids.filter("least is not null").select("doc_id", "least"), "repeated-ids")

    def sent(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if table.count() <= BROADCAST_IDS else table

    aside = docs.toDF(*[c if c in ("doc_id", "text") else f"in_{i}" for i, c in enumerate(docs.columns)])
    once = aside.join(sent(ids.select("doc_id")), "doc_id", "left_anti").select(*aside.columns)
    again = with_fingerprint(aside.join(sent(repeated), "doc_id").select(*aside.columns, "least"), shingle, seed).filter("own = least")
    others = [c for c in aside.columns if c not in ("doc_id", "text")]
    order = F.struct(F.coalesce("text", F.lit("")), F.col("text").isNotNull(), F.to_json(F.struct(F.lit(0), *others)))
    first = again.groupBy("doc_id").agg(F.min_by(F.struct(*aside.columns), order).alias("row")).select("row.*")
    return once.unionByName(first).toDF(*docs.columns)


def with_fingerprint(rows: DataFrame, shingle: int, seed: int) -> DataFrame:
    """``rows`` with ``own``, the fingerprint of their ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            yield piece.append_column("own", pa.array(fingerprints_of(piece.column("text"), shingle, seed).view(np.int64)))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, own long")
