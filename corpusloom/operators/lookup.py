"""Looking queries up in a similarity cache."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.blocks import first_equal_rows, first_in_order, for_products, just_below, ordered_dots, row_blocks, to_keys, to_matrix, with_vectors
from corpusloom.functions.vectors import route
from corpusloom.operators.cells import ENTRY_ROWS, cluster_sizes, count_up_to, in_cells

THRESHOLD = 0.85
SEARCH_DEPTH = 3
FAR = np.iinfo(np.int16).max


def route_ranks(routes: pa.Array, clusters: np.ndarray) -> np.ndarray:
    """Place of each cluster in each query's route, ``FAR`` if absent; a null route visits all clusters alike."""
    ranks = np.full((len(routes), len(clusters)), FAR, dtype=np.int16)
    lengths = np.diff(routes.offsets.to_numpy())
    null = routes.is_null().to_numpy(zero_copy_only=False)
    lengths = np.where(null, 0, lengths)
    row = np.repeat(np.arange(len(routes)), lengths)
    place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    cluster = routes.flatten().to_numpy(zero_copy_only=False)
    column = np.searchsorted(clusters, cluster)
    known = column < len(clusters)
    known[known] = clusters[column[known]] == cluster[known]
    ranks[row[known], column[known]] = place[known]
    ranks[null] = 0
    return ranks


class Entries:
    """Cache entries filed by cluster, ready to be compared with batches of queries.

    Of equal vectors in a cluster only the first entry can be a match, so the others are left out.
    """

    def __init__(self, held: pa.Table):
        vectors, cluster = to_matrix(held["embedding"]), held["dominant_cluster"].to_numpy()
        ids = to_keys(held["entry_id"].combine_chunks())
        order = np.lexsort((ids, cluster))
        firsts = first_equal_rows(np.column_stack([cluster, vectors])[order])
        order = order[np.sort(firsts)]
        self.vectors, self.ids = vectors[order], ids[order]
        self.clusters, self.starts = np.unique(cluster[order], return_index=True)
        self.parts = [slice(a, b) for a, b in zip(self.starts, [*self.starts[1:], len(order)])]

    def best(self, batch: pa.RecordBatch, earlier_only: bool, min_score: float):
        """``(query row, entry, score, route rank)`` arrays of the best entries, for queries that have one.

        A query is compared with the entries of its routed clusters only, and with those before it where only these count.
        Products in single precision tell what is near enough to be scored.
        """
        vectors, qids = to_matrix(batch["embedding"]), to_keys(batch["qid"])
        ranks = route_ranks(batch["route"], self.clusters)
        queries, held, margin = for_products(vectors, self.vectors)
        in_order = earlier_only and qids.dtype.kind in "iu" and self.ids.dtype.kind in "iu"
        floor = np.full(len(vectors), min_score)
        found = [np.zeros((2, 0), dtype=np.int64)]
        for cluster, entries in enumerate(self.parts):
            routed = np.flatnonzero(ranks[:, cluster] < FAR)
            if in_order:
                routed = routed[np.argsort(qids[routed], kind="stable")]
            for part in row_blocks(len(routed), entries.stop - entries.start):
                rows, earlier = routed[part], entries
                if in_order:
                    # Entries of a cluster lie in the order of their ids.
                    earlier = slice(entries.start, entries.start + np.searchsorted(self.ids[entries], qids[rows[-1]]))
                    if earlier.stop == earlier.start:
                        continue
                scores = queries[rows] @ held[earlier].T
                if earlier_only:
                    first = np.searchsorted(self.ids[earlier], qids[rows[0]]) if in_order else 0
                    scores[:, first:][self.ids[earlier][None, first:] >= qids[rows][:, None]] = -np.inf
                floor[rows] = np.maximum(floor[rows], scores.max(axis=1) - margin[rows])
                near, entry = np.nonzero(scores >= just_below(floor[rows] - margin[rows], scores)[:, None])
                found.append(np.stack([rows[near], entry + entries.start]))
        rows, cols = np.concatenate(found, axis=1)
        score = ordered_dots(vectors, self.vectors, rows, cols)
        keep = (score >= min_score) & (score >= floor[rows] - margin[rows])
        rows, cols, score = rows[keep], cols[keep], score[keep]
        rank = ranks[rows, np.searchsorted(self.starts, cols, side="right") - 1]
        pick = first_in_order(rows, -score, rank, self.ids[cols])
        return rows[pick], cols[pick], score[pick], rank[pick]


def best_of_cell(earlier_only: bool, min_score: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The best entry of each query of a cell, among the earlier ones if ``earlier_only``."""

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        asked, held = with_vectors(asked), with_vectors(held)
        kinds = asked.schema.field("qid").type, held.schema.field("entry_id").type
        rows, ids, score, rank = np.zeros(0, np.int64), [], np.zeros(0), np.zeros(0)
        if asked.num_rows and held.num_rows:
            entries = Entries(held)
            rows, cols, score, rank = entries.best(asked.combine_chunks().to_batches()[0], earlier_only, min_score)
            ids = entries.ids[cols]
        columns = [asked["qid"].take(pa.array(rows)).cast(kinds[0]), pa.array(ids, kinds[1]), pa.array(score), pa.array(rank.astype(np.int32))]
        return pa.table(dict(zip(["qid", "entry_id", "score", "route_rank"], columns)))

    return run


def best_match(
    queries: DataFrame,
    entries: DataFrame,
    earlier_only: bool = False,
    min_score: float = -1.0,
    block_rows: int = ENTRY_ROWS,
) -> DataFrame:
    """``(qid, entry_id, score)``: the most similar entry in each query's route.

    ``queries`` has ``qid, embedding, route`` (null route: every cluster), ``entries``, a stored table, has
    ``entry_id, embedding, dominant_cluster``. Equal scores go to the cluster routed first, then to
    the earlier entry. ``earlier_only`` limits a query to entries whose id lies below its own.
    Queries without a routed entry at or above ``min_score``, or without a vector, have no row.
    """
    types = dict(queries.dtypes)["qid"], dict(entries.dtypes)["entry_id"]
    schema = f"qid {types[0]}, entry_id {types[1]}, score double, route_rank int"
    held = entries.select("entry_id", "embedding", "dominant_cluster")
    asked = queries.select("qid", "embedding", "route")
    n_asked = count_up_to(queries.select("qid"), block_rows)
    found = in_cells(asked, held, best_of_cell(earlier_only, min_score), schema, n_asked, cluster_sizes(held), block_rows)
    return best_of_matches(found)


def best_of_matches(matches: DataFrame) -> DataFrame:
    """Each query's best row of ``(qid, entry_id, score, route_rank)``."""
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "route_rank", "entry_id")
    best = matches.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") == 1)
    return best.select("qid", "entry_id", "score")


def with_route(queries: DataFrame, depth: int = SEARCH_DEPTH) -> DataFrame:
    """Add ``route`` from ``cluster_probs``; without memberships every cluster is searched."""
    if "cluster_probs" in queries.columns:
        return queries.withColumn("route", route(F.col("cluster_probs"), depth))
    return queries.withColumn("route", F.lit(None).cast("array<int>"))


def lookup(queries: DataFrame, entries: DataFrame, threshold: float = THRESHOLD, depth: int = SEARCH_DEPTH) -> DataFrame:
    """Hit or miss of every query against a given cache.

    Adds ``cache_hit, entry_id, matched_query, score, dominant_cluster``; the entry's fields are
    null on a miss. A query without a vector is a miss.
    """
    found = best_match(with_route(queries, depth), entries, min_score=threshold)
    details = entries.select(
        "entry_id", F.col("query").alias("matched_query"), F.col("dominant_cluster").alias("entry_cluster")
    )
    return (
        queries.join(found, "qid", "left")
        .join(details, "entry_id", "left")
        .select(
            "qid",
            F.col("entry_id").isNotNull().alias("cache_hit"),
            "entry_id",
            "matched_query",
            "score",
            F.col("entry_cluster").alias("dominant_cluster"),
        )
    )
