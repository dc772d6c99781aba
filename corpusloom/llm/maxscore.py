"""Exact top-k by inner product, with MaxScore over postings of the components.

A vector's components are its terms; a shard holds, for every component, the vectors in which it is not
zero with their weights. For a query, a term can add so much and so little in a shard; counted from
its least, each term adds between 0 and a bound. Terms whose bounds together can't lift a vector to the
k-th score so far are not essential: candidates come from the postings of the others, and the rest is
probed, largest bound first, for those that can still get there. Shards are searched apart and merged.

Scores are integers: a component x counts as floor(1024 x), whatever its size. Shards and queries whose products might leave
64 bits are scored with Python's integers, all others with machine integers; a score that 64 bits can't hold counts
as the nearest one they can. Defined results: vectors that are null, or hold null or non-finite components, and rows with a null id take no part; components
that a shorter vector lacks are zero; rows of one id are candidates each, but never for their own id, and
the least of a query id's vectors is asked; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import ship

SCALE = 1024
#: Sums of products below this are exact in machine integers.
SAFE = 1 << 62
LEAST_SCORE, LARGEST_SCORE = -(1 << 63), (1 << 63) - 1
#: Rows of a shard and of a block of queries, about; small tables still get as many shards as ``LEAST_SHARDS``.
SHARD_ROWS = 1 << 16
BLOCK_ROWS = 1 << 12
LEAST_SHARDS = 12
#: Vectors that are scored in full to begin with; later strips are ever longer.
FIRST_STRIP = 256
#: Terms that are probed before vectors that can't get there any more are left out.
PROBED = 8


def weights(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of integer components, padded with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = np.diff(vectors.offsets.to_numpy())
    # In extended range, since a finite double times 1024 may not be one.
    values = np.floor(np.longdouble(SCALE) * vectors.flatten().to_numpy(zero_copy_only=False))
    small = np.abs(values).max(initial=0) < SAFE
    values = values.astype(np.int64) if small else np.array([int(x) for x in values], object)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), values.dtype)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


class Shard:
    """Postings of one shard, vectors in ascending order of id.

    Postings that hold half of the vectors or more need no list of them; they are kept as columns of one
    array, with zeros for the others. ``asked`` is the largest weight of the queries to come.
    """

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, asked: int = 1):
        order = np.argsort(ids, kind="stable")
        self.ids, matrix = ids[order], matrix[order]
        n = len(ids)
        largest = max(int(np.abs(matrix).max(initial=0)), 1)
        self.kind = np.int64 if largest * max(asked, 1) * max(1, matrix.shape[1]) < SAFE else object
        matrix = matrix.astype(self.kind)
        held = [np.flatnonzero(column) for column in matrix.T]
        self.full = np.array([2 * len(h) >= n for h in held], bool)
        self.postings = [None if f else (h, column[h]) for f, h, column in zip(self.full, held, matrix.T)]
        self.weights = np.where(self.full[None, :], matrix, 0)
        # The most and the least of each component; a vector without a posting counts as zero.
        self.most = matrix.max(0) if n else np.zeros(matrix.shape[1], self.kind)
        self.least = matrix.min(0) if n else np.zeros(matrix.shape[1], self.kind)
        # Sums of products are exact as doubles, and fast, if they stay below 2**53.
        self.exact_below = (1 << 53) // (largest * max(1, matrix.shape[1]))
        self.doubles = self.weights.astype(np.float64) if self.exact_below else self.weights

    def full_sums(self, query: np.ndarray, terms: np.ndarray, at) -> np.ndarray:
        """What the full postings of ``terms`` add to the vectors ``at``, a slice or places."""
        asked = np.zeros(self.weights.shape[1], self.kind)
        asked[terms] = query[terms]
        if np.abs(asked).max(initial=0) < self.exact_below:
            return (self.doubles[at] @ asked.astype(np.float64)).astype(np.int64).astype(self.kind)
        return self.weights[at] @ asked

    def part(self, term: int, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        held, values = self.postings[term]
        a, b = np.searchsorted(held, (start, stop))
        return held[a:b] - start, values[a:b]

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best vectors other than ``own``, ties to smaller ids."""
        query = query.astype(self.kind)
        terms = np.flatnonzero(query[: len(self.postings)])
        ends = query[terms, None] * np.stack([self.most[terms], self.least[terms]], 1)
        low, high = np.minimum(ends[:, 0], ends[:, 1]), np.maximum(ends[:, 0], ends[:, 1])
        order = np.argsort(-(high - low), kind="stable")
        terms, low, bound = terms[order], low[order], (high - low)[order]
        floor = int(low.sum())
        # What the terms from each one on can add together.
        rest = np.append(np.cumsum(bound[::-1])[::-1], 0)
        ids, scores = np.zeros(0, np.int64), np.zeros(0, self.kind)
        start, width = 0, FIRST_STRIP
        while start < len(self.ids):
            stop = min(len(self.ids), start + width)
            needed = int(scores[-1]) if len(scores) == k and scores[-1] > LEAST_SCORE else None
            found, partial = self.strip(start, stop, query, terms, low, rest, floor, needed)
            if self.kind is object:
                partial = np.minimum(np.maximum(partial, LEAST_SCORE), LARGEST_SCORE)
            other = self.ids[found] != own
            ids, scores = np.append(ids, self.ids[found[other]]), np.append(scores, partial[other])
            by_id = np.argsort(ids, kind="stable")
            best = by_id[np.argsort(-scores[by_id], kind="stable")][:k]
            ids, scores = ids[best], scores[best]
            start, width = stop, 4 * width
        return ids, scores

    def strip(self, start, stop, query, terms, low, rest, floor, needed):
        """Vectors of a strip that reach ``needed``, with their scores."""
        essential = len(terms) if needed is None else int(np.searchsorted(-rest, floor - needed, side="right"))
        # With the terms from `essential` on alone, floor + rest[essential] < needed.
        essential = min(essential, len(terms))
        total = np.full(stop - start, floor, self.kind)
        seen = np.zeros(stop - start, bool) if needed is not None else np.ones(stop - start, bool)
        first, is_full = terms[:essential], self.full[terms[:essential]]
        if is_full.any():
            total += self.full_sums(query, first[is_full], slice(start, stop)) - low[:essential][is_full].sum()
            seen[:] = True
        for term, least in zip(first[~is_full], low[:essential][~is_full]):
            # No posting is a weight of zero, which lies -least above the term's least.
            at, values = self.part(term, start, stop)
            total -= least
            total[at] += query[term] * values
            seen[at] = True
            if least < 0:
                seen[:] = True
        candidates = np.flatnonzero(seen)
        total = total[candidates]
        for i in range(essential, len(terms), PROBED):
            able = total + rest[i] >= needed
            candidates, total = candidates[able], total[able]
            if not len(candidates):
                break
            probed, is_full = terms[i : i + PROBED], self.full[terms[i : i + PROBED]]
            total = total - low[i : i + PROBED].sum()
            if is_full.any():
                total += self.full_sums(query, probed[is_full], candidates + start)
            for term in probed[~is_full]:
                at, values = self.part(term, start, stop)
                if len(at):
                    place = np.searchsorted(at, candidates)
                    hit = at[np.minimum(place, len(at) - 1)] == candidates
                    total[hit] += query[term] * values[place[hit]]
        if needed is not None:
            reach = total >= needed
            candidates, total = candidates[reach], total[reach]
        return candidates + start, total


def taking_part(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``key, vector`` (array of doubles) of the rows that take part."""
    values = F.col(vector).cast("array<double>")

    def sound(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    return vectors.select(F.col(key).alias("id"), values.alias("vector")).filter("id is not null and vector is not null").filter(F.forall("vector", sound))


def search(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vectors`` where ``is_query`` (over ``id``) holds.

    Shards meet blocks of queries in cells: a cell holds one shard and one block, both of bounded size.
    """
    rows = taking_part(vectors, key, vector)
    counted = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    shards = max(LEAST_SHARDS, -(-counted["n"] // SHARD_ROWS))
    blocks = max(1, -(-counted["q"] // BLOCK_ROWS))
    shard = F.pmod(F.xxhash64("id"), F.lit(shards))
    block = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks))

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def cell(shard: Column, block: Column) -> Column:
        return (shard.cast("long") * blocks + block).alias("cell")

    candidates = rows.withColumn("block", numbers(blocks)).select(cell(shard, F.col("block")), "id", "vector")
    asked_rows = rows.filter(is_query).groupBy("id").agg(F.min("vector").alias("vector"))
    queries = asked_rows.withColumn("shard", numbers(shards)).select(cell(F.col("shard"), block), "id", "vector")

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if asked.num_rows and held.num_rows:
            queries = weights(asked.column("vector"))
            found = Shard(held.column("id").to_numpy(), weights(held.column("vector")), int(np.abs(queries).max(initial=0)))
            for own, query in zip(asked.column("id").to_pylist(), queries):
                ids, scores = found.top(own, query, k)
                out.append((np.full(len(ids), own), ids, scores.astype(np.int64)))
        columns = [np.concatenate(x) if out else np.zeros(0, np.int64) for x in (zip(*out) if out else [()] * 3)]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)})

    ship(vectors.sparkSession)
    best = queries.groupBy("cell").cogroup(candidates.groupBy("cell")).applyInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
