"""The cache as keyed state of a stream: one key a cluster, searched at depth 1.

At depth 1 a query looks only into its own dominant cluster, so clusters are independent and a key's queries can be
answered one after another where the key's state lives: arbitrary stateful processing with the RocksDB state store, no table to rewrite, no
join. A micro-batch costs what its clusters hold. Entries leave after ``ttl`` without use, and the least recently used
ones of a cluster beyond ``max_entries`` of it, at the end of a batch; both bound the state of a key, which is one task's.

Defined results: a query without a vector is a miss that leaves no entry; ids must grow from batch to batch; equal scores go to
the earlier entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from corpusloom.functions.blocks import SCORE_MARGIN, ordered_dots
from corpusloom.operators.clusters import ClusterModel
from corpusloom.operators.lookup import THRESHOLD
from corpusloom.operators.state import MAX_ENTRIES
from corpusloom.session import ship

RESPONSE = "qid bigint, dominant_cluster int, cache_hit boolean, entry_id bigint, score double"
#: Queries that meet the entries at once, and entries that they meet at a time.
ASKED_ROWS = 256
HELD_ROWS = 8192
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _near(matrix: np.ndarray, queries: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, row)`` of all rows that may reach the threshold and be a query's best, by query and row, and each query's limit for that."""
    best = np.full(len(queries), threshold - SCORE_MARGIN)
    found = [np.zeros((3, 0))]
    for start in range(0, len(matrix), HELD_ROWS):
        rough = queries @ matrix[start : start + HELD_ROWS].T
        most = rough.max(axis=1, initial=-np.inf)
        best = np.maximum(best, most)
        few = np.flatnonzero(most >= best - SCORE_MARGIN)
        asked, rows = np.nonzero(rough[few] >= (best[few] - SCORE_MARGIN)[:, None])
        found.append(np.stack([few[asked], rows + start, rough[few[asked], rows]]))
    asked, rows, rough = np.concatenate(found, axis=1)
    asked = asked.astype(np.int64)
    kept = np.flatnonzero(rough >= best[asked] - SCORE_MARGIN)
    kept = kept[np.argsort(asked[kept], kind="stable")]
    return asked[kept], rows[kept].astype(np.int64), best


class ClusterCache(StatefulProcessor):
    """The entries of a cluster: id, vector, and the last query that used it."""

    def __init__(self, threshold: float, max_entries: int, ttl_ms: int | None):
        self.threshold, self.max_entries, self.ttl_ms = threshold, max_entries, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entries = handle.getMapState("entries", "entry_id bigint", "embedding array<double>, used bigint", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        asked = sorted(((r.qid, r.embedding) for r in rows), key=lambda r: r[0])
        held = sorted((k[0], v[0], v[1]) for k, v in self.entries.iterator())
        known = len(held)
        vectors = [np.array(v, float) for _, v, _ in held]
        ids, used = [i for i, _, _ in held], {i: u for i, _, u in held}
        before = dict(used)
        size = known + len(asked)
        matrix = np.zeros((size, len(next((v for _, v in asked if v is not None), vectors[0] if vectors else ()))))
        if vectors:
            matrix[:known] = vectors
        for start in range(0, len(asked), ASKED_ROWS):
            block = asked[start : start + ASKED_ROWS]
            present = [v for _, v in block if v is not None]
            queries = np.array(present, float).reshape(len(present), matrix.shape[1])
            # The entries before the block are compared with all of it at once, those that it adds one query at a time.
            before_block, number = len(ids), 0
            query_of, row_of, limits = _near(matrix[:before_block], queries, self.threshold)
            scores = ordered_dots(queries, matrix, query_of, row_of)
            stops = np.searchsorted(query_of, np.arange(len(queries) + 1))
            for qid, vector in block:
                if vector is None:
                    yield Row(qid=qid, dominant_cluster=key[0], cache_hit=False, entry_id=None, score=None)
                    continue
                near, exact = row_of[stops[number] : stops[number + 1]], scores[stops[number] : stops[number + 1]]
                query, n = queries[number], len(ids)
                rough = matrix[before_block:n] @ query
                limit, number = np.maximum(limits[number], rough.max(initial=-np.inf)) - SCORE_MARGIN, number + 1
                late = np.flatnonzero(rough >= limit) + before_block
                # As everywhere, close scores are summed again in a fixed order; equal ones go to the earlier entry.
                near, exact = np.append(near, late), np.append(exact, ordered_dots(query[None, :], matrix, np.zeros(len(late), int), late))
                if exact.max(initial=-np.inf) >= self.threshold and limit == limit:
                    place, score = int(near[exact.argmax()]), float(exact.max())
                    used[ids[place]] = qid
                    yield Row(qid=qid, dominant_cluster=key[0], cache_hit=True, entry_id=ids[place], score=score)
                else:
                    matrix[n] = query
                    ids.append(qid)
                    used[qid] = qid
                    yield Row(qid=qid, dominant_cluster=key[0], cache_hit=False, entry_id=None, score=None)
        kept = set(sorted(ids, key=lambda i: (used[i], i), reverse=True)[: self.max_entries])
        for place, i in enumerate(ids):
            if i not in kept:
                if place < known:
                    self.entries.removeKey((i,))
            elif used[i] != before.get(i):
                # A use starts the time to live anew.
                self.entries.updateValue((i,), (matrix[place].tolist(), used[i]))

    def close(self) -> None:
        pass


def answer_keyed(
    queries: DataFrame,
    folder: str,
    model: ClusterModel | None = None,
    threshold: float = THRESHOLD,
    max_entries: int = MAX_ENTRIES,
    ttl_ms: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Hits and misses of a stream of ``queries(qid, embedding)``, written to ``folder/responses`` as ``RESPONSE``.

    State and progress are in ``folder/progress``; a stream that starts again with the same folder goes on where it stopped.
    Without ``trigger`` it takes what is there and ends; with ``ttl_ms`` Spark lets a stream run on for what expires, so that it
    never ends by itself, and the trigger must be another one than ``availableNow``.
    """
    if ttl_ms and (trigger or {}).get("availableNow"):
        raise ValueError("a stream with a time to live does not end by itself")
    spark = queries.sparkSession
    ship(spark)
    asked = model.predict(queries) if model is not None else queries.withColumn("dominant_cluster", F.lit(0))
    keyed = asked.select("qid", F.col("embedding").cast("array<double>").alias("embedding"), "dominant_cluster").groupBy("dominant_cluster")
    answered = keyed.transformWithState(ClusterCache(threshold, max_entries, ttl_ms), RESPONSE, "Append", "ProcessingTime" if ttl_ms else "None")
    earlier = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        return (
            answered.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/responses")
            .option("checkpointLocation", f"{folder}/progress").trigger(**(trigger or ({"processingTime": "0 seconds"} if ttl_ms else {"availableNow": True}))).start()
        )
    finally:
        if earlier is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, earlier)
