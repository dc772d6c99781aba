"""Exact inner-product search for many queries at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.blocks import first_in_order, for_products, just_below, ordered_dots, row_blocks, single, to_keys, to_matrix, with_vectors
from corpusloom.operators.cells import HELD_ROWS, QUERY_ROWS, TASK_ROWS, all_cells, block_count, count_up_to, fewest_blocks, large_block, vector_width

SNIPPET_LENGTH = 500


#: Queries that are compared with a block of vectors at a time, at most, and blocks to one of ``BLOCK_CELLS``: their scores stay in a
#: core's cache, and a block has vectors enough that few of them beat the best so far.
COMPARED_ROWS = 256
PARTS = 4


def _best_candidates(scores: np.ndarray, k: int, floor: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells that can be among the ``k`` best of their row, given the ``k``-th best score it holds already.

    Most rows end with the look at their largest score. The block's own ``k``-th best is looked for only where the floor lets too much through.
    """
    low = just_below(floor - margin, scores)
    open_rows = np.flatnonzero(scores.max(axis=1) >= low)
    if 2 * len(open_rows) < len(scores):
        scores, low = scores[open_rows], low[open_rows]
    else:
        open_rows = np.arange(len(scores))
    wanted = (scores >= low[:, None]) & (scores > -np.inf)
    crowded = np.flatnonzero(np.count_nonzero(wanted, axis=1) > 2 * k)
    if len(crowded):
        some = scores[crowded] if len(crowded) < len(scores) else scores
        kth = np.partition(some, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        low = just_below(kth.astype(np.float64) - 2 * margin[open_rows[crowded]], scores)
        wanted[crowded] &= some >= low[:, None]
    rows, cols = np.divmod(np.flatnonzero(wanted), scores.shape[1])
    return open_rows[rows], cols


def _first_copies(block: np.ndarray, ids: np.ndarray, rows: np.ndarray, cols: np.ndarray, k: int):
    """Of equal vectors only the ``k`` lowest ids can win; spares scoring every copy."""
    used, place = np.unique(rows, return_inverse=True)
    copies = np.unique(block[used], axis=0, return_inverse=True)[1].ravel()[place]
    kept = first_in_order(cols * (int(copies.max()) + 1) + copies, ids[rows], n=k)
    return rows[kept], cols[kept]


def best_of_vectors(k: int, filtered: bool, query_rows: int = QUERY_ROWS):
    """The ``k`` best rows of a cell's vectors for every query of the cell, ``query_rows`` queries at a time."""

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        asked, held = with_vectors(asked), with_vectors(held)
        vectors, ids = to_matrix(held["embedding"]), to_keys(held["doc_id"])
        near, step = single(vectors), min(query_rows, COMPARED_ROWS)
        starts = range(0, max(1, asked.num_rows), step)
        return pa.concat_tables(best(asked.slice(start, step), held, vectors, near, ids) for start in starts)

    def best(asked: pa.Table, held: pa.Table, vectors: np.ndarray, near: np.ndarray | None, ids: np.ndarray) -> pa.Table:
        queries = to_matrix(asked["embedding"])
        best_query, best_id, best_score = np.zeros(0, np.int64), ids[:0], np.zeros(0)
        if not (len(queries) and len(vectors)):
            return _hits(asked, held, best_query, best_id, best_score)
        if filtered:
            names = pc.unique(asked["category_filter"].combine_chunks().drop_null())
            wanted = pc.fill_null(pc.index_in(asked["category_filter"], names), -1).to_numpy()
            found = pc.fill_null(pc.index_in(held["category"], names), -2).to_numpy()
        floor = np.full(len(queries), -np.inf)
        left, right, margin = for_products(queries, vectors, near)
        for part in row_blocks(len(vectors), PARTS * len(queries)):
            block, block_ids = vectors[part], ids[part]
            scores = left @ right[part].T
            if filtered:
                scores[(found[None, part] != wanted[:, None]) & (wanted[:, None] != -1)] = -np.inf
            if scores.dtype == np.float64:
                scores[~np.isfinite(scores)] = -np.inf
            cols, rows = _best_candidates(scores, k, floor, margin)
            if not len(rows):
                continue
            if len(rows) > 4 * k * len(queries):
                rows, cols = _first_copies(block, block_ids, rows, cols, k)
            exact = ordered_dots(block, queries, rows, cols)
            query = np.r_[best_query, cols]
            doc = np.concatenate([best_id, block_ids[rows]])
            score = np.r_[best_score, exact]
            kept = first_in_order(query, -score, doc, n=k)
            best_query, best_id, best_score = query[kept], doc[kept], score[kept]
            full, size = np.unique(best_query, return_counts=True)
            worst = np.full(len(queries), np.inf)
            np.minimum.at(worst, best_query, best_score)
            floor[full[size == k]] = worst[full[size == k]]
        return _hits(asked, held, best_query, best_id, best_score)

    return run


def _hits(asked: pa.Table, held: pa.Table, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> pa.Table:
    return pa.table({"qid": asked["qid"].take(pa.array(query)), "doc_id": pa.array(ids, held.schema.field("doc_id").type), "score": pa.array(score, pa.float64())})


def ranked(hits: DataFrame, k: int) -> DataFrame:
    """The ``k`` best hits of each query with their rank; equal scores go by id.

    Tasks send at most ``k`` rows per query: Spark applies the rank limit before the shuffle too.
    """
    window = Window.partitionBy("qid").orderBy(F.desc("score"), "doc_id")
    return hits.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, filtered: bool = False, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``(qid, rank, doc_id, score)`` of the ``k`` vectors with the largest inner product per query.

    ``vectors`` has ``doc_id, embedding`` and should be a stored table, ``queries`` has ``qid, embedding``. With ``filtered``,
    ``vectors`` also has ``category`` and each query's ``category_filter`` (null for none) limits
    what it may find. Rows without a vector are left out.
    """
    held = vectors.select("doc_id", "embedding", *(["category"] if filtered else []))
    asked = queries.select("qid", "embedding", *(["category_filter"] if filtered else []))
    key_types = dict(queries.dtypes)["qid"], dict(vectors.dtypes)["doc_id"]
    schema = f"qid {key_types[0]}, doc_id {key_types[1]}, score double"
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    n_held = vectors.select("doc_id").count()
    n_asked = count_up_to(queries.select("qid"), query_rows)
    # Vectors go to as few cells as can hold them with their queries, and as tasks can share the work.
    width = vector_width(vectors) if max(n_asked, n_held) > query_rows else 0
    held_rows = large_block(width, HELD_ROWS) if width else HELD_ROWS
    held_blocks = max(block_count(n_held, held_rows), min(cores, block_count(n_held, TASK_ROWS)))
    asked_blocks = fewest_blocks(n_asked, width, query_rows, -(-2 * cores // held_blocks)) if width else block_count(n_asked, query_rows)
    hits = all_cells(asked, held, "qid", "doc_id", best_of_vectors(k, filtered, query_rows), schema, asked_blocks, held_blocks)
    return ranked(hits, k).select("qid", "rank", "doc_id", "score")


def top_k_overfetch(vectors: DataFrame, queries: DataFrame, k: int = 5, overfetch: int = 5) -> DataFrame:
    """Filter after fetching ``overfetch * k`` hits, so a query may end with fewer than ``k``."""
    fetched = top_k(vectors, queries, k * overfetch).drop("rank")
    found = with_metadata_columns(fetched, vectors.select("doc_id", "category"))
    kept = found.join(queries.select("qid", "category_filter"), "qid").filter(
        F.col("category_filter").isNull() | (F.col("category") == F.col("category_filter"))
    )
    return ranked(kept, k).select("qid", "rank", "doc_id", "score")


def with_metadata_columns(hits: DataFrame, table: DataFrame) -> DataFrame:
    """Join hits to columns of the vector table by ``doc_id``; the side of the join is Spark's choice."""
    return hits.join(table, "doc_id", "left")


def with_metadata(hits: DataFrame, index: DataFrame) -> DataFrame:
    """Look up category, text and file name of the final hits only."""
    found = with_metadata_columns(hits, index.select("doc_id", "category", "snippet", "filename"))
    return found.select(
        "qid",
        "rank",
        "doc_id",
        F.coalesce("category", F.lit("unknown")).alias("category"),
        "score",
        F.coalesce(F.substring("snippet", 1, SNIPPET_LENGTH), F.lit("")).alias("text"),
        F.coalesce("filename", F.lit("")).alias("filename"),
    )


def search(
    index: DataFrame, queries: DataFrame, k: int = 5, filtered: bool = False, overfetch: int | None = None
) -> DataFrame:
    """Search hits with their metadata; ``overfetch`` filters after the fetch instead of before."""
    if filtered and overfetch:
        hits = top_k_overfetch(index, queries, k, overfetch)
    else:
        hits = top_k(index, queries, k, filtered)
    return with_metadata(hits, index)


def build_index(docs: DataFrame, embeddings: DataFrame | None = None) -> DataFrame:
    """Vector table with a snippet of the cleaned text.

    ``docs`` has ``doc_id, category, filename, cleaned_text`` and either its own ``embedding`` or
    gets it from ``embeddings(doc_id, embedding)``.
    """
    joined = docs if embeddings is None else docs.join(embeddings.select("doc_id", "embedding"), "doc_id")
    return joined.select(
        "doc_id",
        "category",
        "filename",
        F.substring("cleaned_text", 1, SNIPPET_LENGTH).alias("snippet"),
        F.lit(None).cast("int").alias("dominant_cluster"),
        "embedding",
    )


def tag_clusters(index: DataFrame, assignments: DataFrame) -> DataFrame:
    """Set ``dominant_cluster`` from ``(doc_id, dominant_cluster)``; vectors without one get null."""
    return index.drop("dominant_cluster").join(
        assignments.select("doc_id", "dominant_cluster"), "doc_id", "left"
    ).select("doc_id", "category", "filename", "snippet", "dominant_cluster", "embedding")
