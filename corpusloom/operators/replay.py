"""Order-exact replay of a query log through an initially given cache."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from corpusloom.functions.blocks import SCORE_MARGIN, first_in_order, for_products, just_below, ordered_dots, row_blocks, to_lists, to_matrix
from corpusloom.functions.vectors import dot
from corpusloom.operators.cells import ENTRY_ROWS, cluster_sizes, count_up_to, in_cells
from corpusloom.operators.lookup import FAR, THRESHOLD, best_of_cell, best_of_matches, route_ranks
from corpusloom.operators.state import retain, touch
from corpusloom.session import child_names, ship, stage, stage_path

#: Queries between two cuts of the cache back to its capacity.
SLICE_ROWS = 1_000_000
#: More slices than these, each at most this large with its cache, go through one task in a row, about so many queries a job.
FEW_SLICES = 4
CHAIN_CELL = 4096
CHAIN_ROWS = 131_072
LOG_COLUMNS = ["qid", "embedding", "route", "dominant_cluster"]


@dataclass(frozen=True)
class Replay:
    """``admitted(qid)``: the misses, which became entries; ``hits(qid, entry_id, score)``: the rest."""

    admitted: DataFrame
    hits: DataFrame


def _decide(threshold: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For the queries of a cell that find an earlier row: whether an entry answers, whether an open query might."""

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        qids = asked["qid"].to_numpy()
        answered, blocked = np.zeros(len(qids), bool), np.zeros(len(qids), bool)
        if asked.num_rows and held.num_rows:
            vectors, others = to_matrix(asked["embedding"]), to_matrix(held["embedding"])
            ids, is_open = held["entry_id"].to_numpy(), held["is_open"].to_numpy(zero_copy_only=False)
            queries, earlier, margin = for_products(vectors, others)
            # In the order of ids, so that a block of queries meets the rows before its last one only.
            by_id, by_qid = np.argsort(ids, kind="stable"), np.argsort(qids, kind="stable")
            earlier, sorted_ids = earlier[by_id], ids[by_id]
            for part in row_blocks(len(vectors), len(others)):
                block = by_qid[part]
                similar = queries[block] @ earlier[: np.searchsorted(sorted_ids, qids[block[-1]])].T
                rows, cols = np.nonzero(similar >= just_below(threshold - margin[block], similar)[:, None])
                before = sorted_ids[cols] < qids[block[rows]]
                score = similar[rows[before], cols[before]].astype(np.float64)
                rows, cols = block[rows[before]], by_id[cols[before]]
                unsure = np.abs(score - threshold) <= margin[rows]
                score[unsure] = ordered_dots(vectors, others, rows[unsure], cols[unsure])
                rows, cols = rows[score >= threshold], cols[score >= threshold]
                answered[rows[~is_open[cols]]] = True
                blocked[rows[is_open[cols]]] = True
        told = np.flatnonzero(answered | blocked)
        return pa.table({"qid": qids[told], "answered": answered[told], "blocked": blocked[told]})

    return run


def first_of_equals(log: DataFrame, threshold: float) -> DataFrame:
    """Queries that equal no earlier one. The others are hits whatever becomes of the first of them.

    That holds where a query finds its own like: its cluster is in its route, and its vector is long enough.
    """
    vector = F.col("embedding").cast("array<double>")
    finds_itself = (dot(vector, vector) >= threshold + SCORE_MARGIN) & F.coalesce(
        F.array_contains("route", F.col("dominant_cluster")), F.lit(True)
    )
    own = F.when(~finds_itself, F.col("qid"))
    firsts = log.groupBy("embedding", "route", "dominant_cluster", own.alias("own")).agg(F.min("qid").alias("qid"))
    return firsts.select(*LOG_COLUMNS)


def replay_log(
    log: DataFrame, entries: DataFrame | None = None, threshold: float = THRESHOLD, block_rows: int = ENTRY_ROWS
) -> Replay:
    """Hits and misses as if the queries came one by one, each miss becoming an entry at once.

    ``log``, a stored table, has ``qid`` (its order), ``embedding, route, dominant_cluster``; ``entries``, if given,
    is the cache before the log, with ids below those of the log. Nothing is evicted on the way.

    Queries are settled in rounds in the tasks: one is answered if an admitted earlier one reaches the
    threshold, and admitted if no open or admitted earlier one does. A round settles all queries
    whose earlier likes are settled, so there are as many rounds as the longest chain of queries of which
    each is like the one before. A round is one job: it compares what is still open with itself and with what the round
    before admitted, writes the open queries with their new state, and counts them on the way. No pairs are kept, and the driver sees
    counts only. At the end each query takes its best match among all earlier entries.
    """
    spark = log.sparkSession
    rows = log.select(*LOG_COLUMNS).filter(F.col("embedding").isNotNull())
    asked_sizes = cluster_sizes(rows)
    n_asked = sum(asked_sizes.values())
    given = None if entries is None else entries.select("entry_id", "embedding", "dominant_cluster").filter(F.col("embedding").isNotNull())
    given_sizes = {} if given is None else cluster_sizes(given)
    rounds: list[str] = []

    def settled(table: DataFrame) -> tuple[DataFrame, dict[int, int], dict[int, int]]:
        """A round's table, written, and how many of it are open and admitted in each cluster, counted as it is written."""
        seen, rounds_path = Observation(), stage_path(spark, "settling")
        counts = [F.count_if((F.col("state") == state) & (F.col("dominant_cluster") == c)).alias(f"{state}_{c}") for state in ("open", "admitted") for c in asked_sizes]
        rounds.append(rounds_path)
        written = stage(table.observe(seen, F.count(F.lit(1)).alias("n"), *counts), "settling", path=rounds_path)
        found = seen.get
        return written, *({c: found[f"{state}_{c}"] for c in asked_sizes if found[f"{state}_{c}"]} for state in ("open", "admitted"))

    def as_entries(table: DataFrame, state: str) -> DataFrame:
        held = table.filter(F.col("state") == state)
        return held.select(F.col("qid").alias("entry_id"), "embedding", "dominant_cluster", F.lit(state == "open").alias("is_open"))

    settling, n_open, _ = settled(first_of_equals(rows, threshold).withColumn("state", F.lit("open")))
    n_admitted: dict[int, int] = {}
    # What a query may meet in a round: open ones, and what was admitted since the round before.
    newest, newest_sizes = None if given is None else given.withColumn("is_open", F.lit(False)), given_sizes
    while n_open:
        held = as_entries(settling, "open")
        held = held if newest is None else held.unionByName(newest)
        sizes = _added(n_open, newest_sizes)
        still_open = settling.filter("state = 'open'").select(*LOG_COLUMNS)
        told = in_cells(still_open, held, _decide(threshold), "qid bigint, answered boolean, blocked boolean", sum(n_open.values()), sizes, block_rows)
        told = told.groupBy("qid").agg(F.max("answered").alias("answered"), F.max("blocked").alias("blocked"))
        state = F.when(F.col("answered"), F.lit("answered")).when(F.col("blocked"), F.lit("open")).otherwise(F.lit("admitted"))
        settling, n_open, newest_sizes = settled(still_open.join(told, "qid", "left").select(*LOG_COLUMNS, state.alias("state")))
        newest = as_entries(settling, "admitted")
        n_admitted = _added(n_admitted, newest_sizes)
    admitted = spark.read.schema(settling.schema).parquet(*rounds).filter("state = 'admitted'")
    candidates = admitted.select(F.col("qid").alias("entry_id"), "embedding", "dominant_cluster")
    if given is not None:
        candidates = candidates.unionByName(given)
    schema = "qid bigint, entry_id bigint, score double, route_rank int"
    found = in_cells(rows, candidates, best_of_cell(True, threshold), schema, n_asked, _added(given_sizes, n_admitted), block_rows)
    return Replay(admitted.select("qid"), best_of_matches(found))


def _added(a: dict[int, int], b: dict[int, int]) -> dict[int, int]:
    return {c: a.get(c, 0) + b.get(c, 0) for c in a.keys() | b.keys()}


def ordered_slices(log: DataFrame, key: str, rows: int) -> list[DataFrame]:
    """The log in the order of ``key``, cut after every ``rows`` rows.

    Rows are ranked within sorted ranges, and ranges start where the ones before end.
    """
    spark = log.sparkSession
    ranged = log.repartitionByRange(key).withColumn("_range", F.spark_partition_id())
    ranged = stage(ranged, "ordered")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_range").count().select("_range", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_start"))
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(key)) - 1
    number = F.floor((F.col("_start") + F.col("_rank")) / rows).cast("int")
    sliced = ranged.withColumn("_rank", rank).join(starts, "_range").withColumn("_slice", number)
    path = stage_path(spark, "slices")
    stage(sliced.drop("_range", "_start", "_rank"), "slices", partition_by="_slice", path=path)
    names = sorted(int(x.removeprefix("_slice=")) for x in child_names(spark, path) if x.startswith("_slice="))
    return [spark.read.schema(log.schema).parquet(f"{path}/_slice={i}") for i in names] or [log.limit(0)]


def replay_with_retention(
    log: DataFrame, entries: DataFrame, max_entries: int, slice_rows: int = SLICE_ROWS, threshold: float = THRESHOLD
) -> tuple[DataFrame, DataFrame]:
    """Hits of the whole log, and the entries afterwards, if every slice ends with the most recently used entries.

    With slices of one query this is eviction before each insert at capacity; a longer slice lets the
    cache grow by its misses until it ends. ``log`` also has ``ts``, which grows with ``qid``;
    ``entries`` has ``entry_id, embedding, dominant_cluster, last_accessed``.

    A slice needs the cache that the one before left, so slices follow each other. Large ones are replayed by all tasks, a few
    jobs each. Where there are many, small enough for one cell with their cache, a task takes slices in a row (``_chain``).
    """
    spark = log.sparkSession
    path = stage_path(spark, "slice-hits")
    columns = ["entry_id", "embedding", "dominant_cluster", "last_accessed"]
    before, paths = entries.select(*columns), []
    small = max_entries + slice_rows <= CHAIN_CELL and count_up_to(before.select("entry_id"), CHAIN_CELL) <= CHAIN_CELL
    if small and log.select("qid").limit(FEW_SLICES * slice_rows + 1).count() > FEW_SLICES * slice_rows:
        return _replay_chained(log, before, max_entries, slice_rows, threshold)
    for part in ordered_slices(log, "qid", slice_rows):
        replayed = replay_log(part, before, threshold)
        paths.append(f"{path}/{len(paths)}")
        hits = stage(replayed.hits, "hits", path=paths[-1])
        new = part.join(replayed.admitted, "qid", "left_semi").withColumnsRenamed({"qid": "entry_id", "ts": "last_accessed"})
        touched = touch(before.unionByName(new.select(*columns)), hits.join(part.select("qid", "ts"), "qid"))
        before = stage(retain(touched, max_entries), "entries")
    return spark.read.schema(hits.schema).parquet(*paths), before


def _replay_chained(log: DataFrame, before: DataFrame, max_entries: int, slice_rows: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Small slices: a job and a task for about ``CHAIN_ROWS`` queries of the log in a row; the cache goes from job to job."""
    spark = log.sparkSession
    ship(spark)
    paths = []
    used = F.unix_micros(F.col("last_accessed").cast("timestamp"))
    for part in ordered_slices(log.select(*LOG_COLUMNS, "ts"), "qid", slice_rows * max(1, CHAIN_ROWS // slice_rows)):
        held = before.select(
            F.lit(True).alias("held"), F.col("entry_id").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"),
            F.lit(None).cast("array<int>").alias("route"), "dominant_cluster", used.alias("used"),
        )
        asked = part.select(
            F.lit(False).alias("held"), F.col("qid").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"),
            F.col("route").cast("array<int>").alias("route"), "dominant_cluster", F.unix_micros(F.col("ts").cast("timestamp")).alias("used"),
        )
        in_order = held.unionByName(asked).coalesce(1).sortWithinPartitions(F.desc("held"), "id")
        paths.append(stage_path(spark, "chained"))
        chained = stage(in_order.mapInArrow(_chain(max_entries, slice_rows, threshold), CHAINED), "chained", path=paths[-1])
        last = F.timestamp_micros("used").alias("last_accessed")
        before = chained.filter("score is null").select("entry_id", "embedding", "dominant_cluster", last)
    return spark.read.schema(CHAINED).parquet(*paths).filter("score is not null").select("qid", "entry_id", "score"), before


#: Hits, and the entries in the end, which have no ``score``.
CHAINED = "qid bigint, entry_id bigint, score double, embedding array<double>, dominant_cluster int, used bigint"
NEVER = np.iinfo(np.int64).min


@dataclass
class _Rows:
    """Entries or queries of a chain: ids, vectors (of zeros where there is none), clusters, times in microseconds."""

    ids: np.ndarray
    vectors: np.ndarray
    known: np.ndarray
    clusters: np.ndarray
    used: np.ndarray
    routes: list

    @staticmethod
    def of(batch: pa.Table | pa.RecordBatch) -> _Rows:
        embedding = batch["embedding"].combine_chunks() if isinstance(batch, pa.Table) else batch["embedding"]
        known = embedding.is_valid().to_numpy(zero_copy_only=False)
        present = to_matrix(embedding.drop_null())
        vectors = np.zeros((len(known), present.shape[1]))
        vectors[known] = present
        ids, clusters, used = (pc.fill_null(batch[c], v).to_numpy(zero_copy_only=False) for c, v in (("id", -1), ("dominant_cluster", -1), ("used", NEVER)))
        # A query without an id can neither be answered nor become an entry.
        known = known & batch["id"].is_valid().to_numpy(zero_copy_only=False)
        return _Rows(ids, vectors, known, clusters, used, batch["route"].to_pylist())

    def take(self, rows: np.ndarray) -> _Rows:
        columns = (x[rows] for x in (self.ids, self.vectors, self.known, self.clusters, self.used))
        return _Rows(*columns, [self.routes[i] for i in np.arange(len(self.ids))[rows]])

    def plus(self, other: _Rows) -> _Rows:
        if not self.vectors.shape[1] or not other.vectors.shape[1]:
            width = max(self.vectors.shape[1], other.vectors.shape[1])
            self, other = (x if x.vectors.shape[1] else replace(x, vectors=np.zeros((len(x.ids), width))) for x in (self, other))
        pairs = zip((self.ids, self.vectors, self.known, self.clusters, self.used), (other.ids, other.vectors, other.known, other.clusters, other.used))
        return _Rows(*(np.concatenate(pair) for pair in pairs), self.routes + other.routes)


def _chain(max_entries: int, slice_rows: int, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Entries, then queries in order: one slice after the other, with the cache that the one before left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, waiting = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            n_held = pc.sum(batch["held"].cast(pa.int64())).as_py()
            held = _Rows.of(batch.slice(0, n_held))
            cache = held if cache is None else cache.plus(held)
            waiting.append(batch.slice(n_held))
            while sum(b.num_rows for b in waiting) >= slice_rows:
                rows = pa.Table.from_batches(waiting)
                hits, cache = _replay_slice(_Rows.of(rows.slice(0, slice_rows)), cache, max_entries, threshold)
                waiting = rows.slice(slice_rows).to_batches()
                yield _chained(*hits)
        if sum(b.num_rows for b in waiting):
            hits, cache = _replay_slice(_Rows.of(pa.Table.from_batches(waiting)), cache, max_entries, threshold)
            yield _chained(*hits)
        if cache is not None:
            yield _chained(entries=cache)

    return run


def _chained(qid: np.ndarray | None = None, entry: np.ndarray | None = None, score: np.ndarray | None = None, entries: _Rows | None = None) -> pa.RecordBatch:
    schema = pa.schema({"qid": pa.int64(), "entry_id": pa.int64(), "score": pa.float64(), "embedding": pa.list_(pa.float64()), "dominant_cluster": pa.int32(), "used": pa.int64()})
    if entries is None:
        columns = [pa.array(x, kind) for x, kind in zip((qid, entry, score), schema.types)]
        return pa.RecordBatch.from_arrays(columns + [pa.nulls(len(qid), kind) for kind in schema.types[3:]], schema=schema)
    n = len(entries.ids)
    lists = to_lists(entries.vectors, pa.float64()).take(pa.array(np.arange(n), mask=~entries.known))
    rest = pa.array(entries.ids), pa.nulls(n, pa.float64()), lists, pa.array(entries.clusters, pa.int32()), pa.array(entries.used, mask=entries.used == NEVER)
    return pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), *rest], schema=schema)


def _replay_slice(queries: _Rows, cache: _Rows, max_entries: int, threshold: float) -> tuple[tuple[np.ndarray, ...], _Rows]:
    """``(qid, entry_id, score)`` of the hits of a slice asked one by one, and the cache after it."""
    asked, given = queries.take(queries.known), cache.take(cache.known)
    may_answer = given.plus(asked)
    n_given, n = len(given.ids), len(asked.ids)
    hits = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    admitted = np.zeros(0, np.int64)
    if n:
        ranks = route_ranks(pa.array(asked.routes, pa.list_(pa.int32())), np.unique(may_answer.clusters))
        ranks = ranks[:, np.searchsorted(np.unique(may_answer.clusters), may_answer.clusters)]
        similar = asked.vectors @ may_answer.vectors.T
        rows, cols = np.nonzero(np.abs(similar - threshold) <= SCORE_MARGIN)
        similar[rows, cols] = ordered_dots(asked.vectors, may_answer.vectors, rows, cols)
        found = (similar >= threshold) & (ranks < FAR) & (may_answer.ids[None, :] < asked.ids[:, None])
        enters = np.r_[np.ones(n_given, bool), np.zeros(n, bool)]
        firsts = _firsts(asked, threshold)
        answered = (found[:, :n_given]).any(axis=1)
        # Rows of one id are settled together; only earlier ids can answer them.
        for start, stop in _runs(asked.ids):
            own = np.arange(start, stop)[firsts[start:stop]]
            if len(own) and not answered[own].any() and not found[own][:, enters].any():
                enters[n_given + own] = True
        admitted = asked.ids[enters[n_given:]]
        found &= enters
        similar[~found] = -np.inf
        rows, cols = np.nonzero(found & (similar >= similar.max(axis=1)[:, None] - SCORE_MARGIN))
        score = ordered_dots(asked.vectors, may_answer.vectors, rows, cols)
        reach = score >= threshold
        rows, cols, score = rows[reach], cols[reach], score[reach]
        best = first_in_order(asked.ids[rows], -score, ranks[rows, cols], may_answer.ids[cols])
        hits = asked.ids[rows[best]], may_answer.ids[cols[best]], score[best]
    every = cache.plus(queries.take(np.isin(queries.ids, admitted)))
    order = np.argsort(queries.ids, kind="stable")
    starts, stops = (np.searchsorted(queries.ids[order], hits[0], side) for side in ("left", "right"))
    last = dict[int, int]()
    for entry, a, b in zip(hits[1].tolist(), starts, stops):
        last[entry] = max(last.get(entry, NEVER), int(queries.used[order[a:b]].max()))
    if last:
        every.used = np.maximum(every.used, [last.get(i, NEVER) for i in every.ids.tolist()])
    return hits, every.take(np.lexsort((every.ids, every.used))[::-1][:max_entries])


def _runs(ids: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and stop of every run of equal ids."""
    starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, np.int64)
    return zip(starts.tolist(), np.r_[starts[1:], len(ids)].tolist())


def _firsts(asked: _Rows, threshold: float) -> np.ndarray:
    """Which queries equal no earlier one, as ``first_of_equals`` has it."""
    own = ordered_dots(asked.vectors, asked.vectors, *[np.arange(len(asked.ids))] * 2)
    seen, firsts = set(), np.ones(len(asked.ids), bool)
    for i, route in enumerate(asked.routes):
        finds_itself = not own[i] < threshold + SCORE_MARGIN and (route is None or asked.clusters[i] in route)
        key = (asked.vectors[i] + 0.0).tobytes(), None if route is None else tuple(route), asked.clusters[i], None if finds_itself else asked.ids[i]
        firsts[i] = key not in seen
        seen.add(key)
    return firsts
