"""Best-fit packing of documents into sequences of several permitted lengths.

Packing needs the lengths only, so it is planned on their histogram, which has a row for each length
up to the largest capacity however many documents there are. Lengths go from long to short into the
open bin with the least room that takes them; where none does, the permitted length is opened that costs
least for each token of what it would hold if filled from the lengths still waiting. Bins that are filled
alike are one entry with a count. At the end every bin is cut down to the smallest permitted length
that holds its contents. Documents then take their places by rank among those of equal length.

Defined results: a text has its bytes and one end mark as tokens, so a null or empty text has length 1;
texts longer than the largest capacity are cut into pieces, of which all but the last fill a bin;
repeated rows and null ids are packed each; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import ship

CAPACITIES = (1024, 2048, 4096, 8192)
#: A sequence costs its length, and attention over it in proportion to the square.
ATTENTION = 65536
BUCKET_ROWS = 1 << 20
LEAST_BUCKETS = 64


def cost(capacity: int) -> float:
    return capacity + capacity**2 / ATTENTION


@dataclass
class Plan:
    """Runs of equal pieces: ``ranks[i]`` and on of ``lengths[i]`` go ``each[i]`` to a bin, from ``bins[i]`` on, at ``fill[i]``."""

    lengths: np.ndarray
    ranks: np.ndarray
    bins: np.ndarray
    each: np.ndarray
    fill: np.ndarray
    #: Bins from ``first[j]`` on have ``capacities[j]`` after cutting down.
    first: np.ndarray
    capacities: np.ndarray

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bin, place in the bin and the bin's capacity of pieces with a length and a rank among its equals."""
        # Runs are sorted by length, then rank; a key of both finds the run that a piece falls in.
        scale = int(max(rank.max(initial=0), self.ranks.max(initial=0))) + 1
        run = np.searchsorted(self.lengths * scale + self.ranks, length * scale + rank, side="right") - 1
        nth = rank - self.ranks[run]
        found = self.bins[run] + nth // self.each[run]
        offset = self.fill[run] + nth % self.each[run] * length
        return found, offset, self.capacities[np.searchsorted(self.first, found, side="right") - 1]


def plan_packing(counts: dict[int, int], capacities: tuple[int, ...] = CAPACITIES) -> Plan:
    """Best fit, from long to short, of ``counts[length]`` pieces of each length."""
    capacities = tuple(sorted(capacities))
    if counts and max(counts) > capacities[-1]:
        raise ValueError("a piece is longer than the largest capacity")
    waiting = {n: c for n, c in counts.items() if c}
    lengths = sorted(waiting)
    rooms: list[int] = []  # sorted, of the open bins
    open_bins: dict[int, list[tuple[int, int, int]]] = {}  # by room: first bin, how many, capacity
    closed: list[tuple[int, int]] = []  # first bin, contents
    runs: list[tuple[int, int, int, int, int]] = []
    n_bins = 0

    def put_back(first: int, n: int, capacity: int, room: int) -> None:
        if n <= 0:
            return
        if room < lengths[0]:
            closed.append((first, capacity - room))
            return
        if room not in open_bins:
            open_bins[room] = []
            insort(rooms, room)
        open_bins[room].append((first, n, capacity))

    def filled(capacity: int, length: int) -> int:
        """What a new bin would hold if the longest waiting pieces that fit were added one by one."""
        room, top = capacity, bisect_left(lengths, length) + 1
        while room >= lengths[0]:
            top = bisect_left(lengths, room + 1, 0, top)
            if not top:
                break
            n = lengths[top - 1]
            room -= n * min(waiting[n], room // n)
            top -= 1
        return capacity - room

    for length in reversed(lengths):
        rank = 0
        while waiting[length]:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                fit = [c for c in capacities if c >= length]
                capacity = min(fit, key=lambda c: (cost(c) / filled(c, length), c))
                needed = -(-waiting[length] // (capacity // length))
                put_back(n_bins, needed, capacity, capacity)
                n_bins += needed
                continue
            room = rooms[at]
            first, n, capacity = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
                rooms.pop(at)
            each = room // length
            full = min(n, waiting[length] // each)
            if full:
                runs.append((length, rank, first, each, capacity - room))
                put_back(first, full, capacity, room - each * length)
                rank += full * each
                waiting[length] -= full * each
            rest = waiting[length] if full < n else 0
            if rest:
                runs.append((length, rank, first + full, rest, capacity - room))
                put_back(first + full, 1, capacity, room - rest * length)
                rank += rest
                waiting[length] = 0
            put_back(first + full + bool(rest), n - full - bool(rest), capacity, room)
    for room, held in open_bins.items():
        closed += [(first, capacity - room) for first, _, capacity in held]
    closed.sort()
    columns = np.array(sorted(runs), np.int64).reshape(-1, 5).T
    contents = np.array([c for _, c in closed], np.int64)
    sizes = np.array(capacities, np.int64)
    return Plan(*columns, np.array([f for f, _ in closed], np.int64), sizes[np.searchsorted(sizes, contents)])


def document_lengths(docs: DataFrame) -> DataFrame:
    """``doc_id, n_tokens``: bytes of the text and an end mark."""
    return docs.select("doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("n_tokens"))


def cut_pieces(lengths: DataFrame, largest: int) -> DataFrame:
    """``doc_id, piece, piece_start, length``: ``n_tokens`` in pieces of ``largest`` and what is left."""
    last = F.call_function("div", F.col("n_tokens") - 1, F.lit(largest))
    rows = lengths.select("doc_id", "n_tokens", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    start = F.col("piece") * largest
    return rows.select(
        "doc_id", F.col("piece").cast("int"), start.alias("piece_start"),
        F.least(F.col("n_tokens") - start, F.lit(largest).cast("long")).alias("length"),
    )


def rank_pieces(pieces: DataFrame, n: int) -> DataFrame:
    """Add ``rank``: numbers from 0 among pieces of equal length, by (bucket, id, piece); buckets are hashes."""
    buckets = max(LEAST_BUCKETS, -(-n // BUCKET_ROWS))
    rows = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("bucket", "length").count().select(
        "bucket", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("bucket", "length").orderBy("doc_id", "piece")
    ranked = rows.withColumn("nth", F.row_number().over(within) - 1)
    return ranked.join(starts, ["bucket", "length"]).withColumn("rank", F.col("before") + F.col("nth")).drop("bucket", "before", "nth")


def pack_documents(lengths: DataFrame, capacities: tuple[int, ...] = CAPACITIES) -> DataFrame:
    """``doc_id, piece, piece_start, length, bin_id, bin_offset, capacity``: a place for every piece.

    ``lengths(doc_id, n_tokens)``. The histogram, at most ``max(capacities)`` rows, is planned on the driver.
    """
    largest = max(capacities)
    pieces = cut_pieces(lengths, largest)
    counts = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    plan = plan_packing(counts, capacities)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            placed = plan.place(length, rank)
            kept = [batch.column(c) for c in ("doc_id", "piece", "piece_start", "length")]
            yield pa.RecordBatch.from_arrays(
                [*kept, *(pa.array(x, pa.int64()) for x in placed)],
                names=["doc_id", "piece", "piece_start", "length", "bin_id", "bin_offset", "capacity"],
            )

    ship(lengths.sparkSession)
    kind = lengths.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, piece int, piece_start long, length long, bin_id long, bin_offset long, capacity long"
    return rank_pieces(pieces, sum(counts.values())).mapInArrow(run, fields)


def bins(placed: DataFrame) -> DataFrame:
    """``bin_id, capacity, contents, pieces``: a row for each bin, its pieces in order; a bin holds ``capacity`` at most."""
    piece = F.struct("bin_offset", "doc_id", "piece", "piece_start", "length")
    return placed.groupBy("bin_id", "capacity").agg(
        F.sum("length").alias("contents"), F.array_sort(F.collect_list(piece)).alias("pieces")
    )


def fill_share(placed: DataFrame) -> Column:
    """Tokens over capacity of all bins, as an aggregate over ``placed``."""
    return F.sum("length") / F.sum(F.when(F.col("bin_offset") == 0, F.col("capacity")))
