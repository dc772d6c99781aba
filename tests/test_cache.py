import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators.clusters import ClusterModel
from corpusloom.operators.lookup import best_match, lookup, with_route
from corpusloom.operators.mixture import Mixture
from corpusloom.operators.replay import replay_log, replay_with_retention
from corpusloom.operators.state import admit, cache_stats, empty_cache, retain, touch
from corpusloom.operators.sweep import pair_similarity, threshold_sweep
from corpusloom.plans.answer import answer_queries, split_empty
from corpusloom.streaming.cache_stream import (
    answer_stream,
    flush_stream,
    read_responses,
    read_state,
    stream_stats,
)

START = dt.datetime(2024, 1, 1)


def unit(v):
    return v / np.linalg.norm(v)


def query_rows(spark, vectors, first=0, probs=None, texts=None):
    rows = [
        (first + i, texts[i] if texts else f"q{first + i}", None if v is None else [float(x) for x in v],
         START + dt.timedelta(seconds=first + i), [], probs[i] if probs else None)
        for i, v in enumerate(vectors)
    ]
    df = spark.createDataFrame(
        rows,
        "qid bigint, query string, embedding array<float>, ts timestamp, "
        "result array<struct<category:string,score:double,text:string>>, cluster_probs array<double>",
    )
    return df if probs else df.drop("cluster_probs")


def stats(spark, queries, entries):
    return tuple(cache_stats(lookup(queries, entries), entries).first())


# The nine cases of a cache that is filled and asked.


def test_same_vector_hits(spark):
    v = unit(np.random.default_rng(0).normal(size=384))
    entries = admit(empty_cache(spark), query_rows(spark, [v], texts=["What is machine learning?"]))
    row = lookup(query_rows(spark, [v], 1), entries).first()
    assert row.cache_hit and row.matched_query == "What is machine learning?" and row.score > 0.999999


@pytest.mark.parametrize("seed", range(3))
def test_near_vector_hits_iff_similar(spark, seed):
    rng = np.random.default_rng(seed)
    v = unit(rng.normal(size=384)).astype(np.float32)
    w = unit(v + rng.normal(size=384) * (0.01 + 0.02 * seed)).astype(np.float32)
    row = lookup(query_rows(spark, [w], 1), admit(empty_cache(spark), query_rows(spark, [v]))).first()
    assert row.cache_hit == (float(np.dot(v.astype(float), w.astype(float))) >= 0.85)


def test_hit_and_miss_counts(spark):
    e = np.eye(384)
    entries = admit(empty_cache(spark), query_rows(spark, [e[0]]))
    assert stats(spark, query_rows(spark, [e[0]], 1), entries) == (1, 1, 0, 1.0)
    assert stats(spark, query_rows(spark, [e[1]], 1), entries) == (1, 0, 1, 0.0)
    assert stats(spark, query_rows(spark, [e[0], e[100]], 1), entries) == (1, 1, 1, 0.5)


def test_empty_and_flushed_cache(spark):
    v = np.eye(4)[:1]
    assert not lookup(query_rows(spark, v), empty_cache(spark)).first().cache_hit
    assert stats(spark, query_rows(spark, v).limit(0), empty_cache(spark)) == (0, 0, 0, 0.0)


# Further cases.


def test_threshold_is_inclusive_and_first_of_equals_wins(spark):
    entries = admit(empty_cache(spark), query_rows(spark, [[1.0, 0.0], [1.0, 0.0]]))
    asked = query_rows(spark, [[0.75, 0.5]], 5)
    assert lookup(asked, entries, threshold=0.75).first().entry_id == 0
    assert not lookup(asked, entries, threshold=0.7500001).first().cache_hit


def test_missing_vector_is_a_miss(spark):
    entries = admit(empty_cache(spark), query_rows(spark, np.eye(2)))
    assert stats(spark, query_rows(spark, [None, [1.0, 0.0]], 5), entries) == (2, 1, 1, 0.5)


def test_routing_depth(spark):
    probs = [[0.6, 0.3, 0.1], [0.1, 0.6, 0.3]]
    entries = admit(empty_cache(spark), query_rows(spark, [[1.0, 0.0], [1.0, 0.0]], probs=probs))
    asked = query_rows(spark, [[1.0, 0.0]], 5, probs=[[0.2, 0.3, 0.5]])
    assert not lookup(asked, entries, depth=1).first().cache_hit
    assert lookup(asked, entries, depth=2).first().entry_id == 1
    # Equal scores: the cluster routed first wins over the earlier entry.
    assert lookup(asked, entries, depth=3).first().entry_id == 1
    assert lookup(asked.drop("cluster_probs"), entries).first().entry_id == 0


@pytest.mark.parametrize("block_rows", [4096, 7])
def test_best_match_against_brute_force(spark, block_rows):
    rng = np.random.default_rng(4)
    entries = [unit(v) for v in rng.normal(size=(40, 5))] * 2
    asked = [unit(v) for v in rng.normal(size=(30, 5))]
    entry_probs = rng.dirichlet(np.ones(4), 80).tolist()
    asked_probs = rng.dirichlet(np.ones(4), 30).tolist()
    cached = admit(empty_cache(spark), query_rows(spark, entries, probs=entry_probs))
    routed = with_route(query_rows(spark, asked, 100, probs=asked_probs).repartition(3), 2)
    found = {r.qid: r.entry_id for r in best_match(routed, cached, block_rows=block_rows).collect()}
    for i, v in enumerate(asked):
        best = None
        v = v.astype(np.float32).astype(float)
        for place, cluster in enumerate(np.argsort(-np.array(asked_probs[i]), kind="stable")[:2]):
            for e, w in enumerate(entries):
                if int(np.argmax(entry_probs[e])) == cluster:
                    score = float(sum(a * b for a, b in zip(v, w.astype(np.float32).astype(float))))
                    if best is None or score > best[0]:
                        best = (score, e)
        assert found.get(100 + i) == (best and best[1])


def test_touch_and_evict(spark):
    entries = admit(empty_cache(spark), query_rows(spark, np.eye(4)))
    hits = spark.createDataFrame(
        [(0, START + dt.timedelta(hours=h)) for h in (2, 1)] + [(1, START - dt.timedelta(hours=1))],
        "entry_id bigint, ts timestamp",
    )
    touched = touch(entries, hits)
    times = {r.entry_id: r.last_accessed for r in touched.collect()}
    assert times[0] == START + dt.timedelta(hours=2) and times[1] == START + dt.timedelta(seconds=1)
    assert {r.entry_id for r in retain(touched, 2).collect()} == {0, 3}
    same = entries.withColumn("last_accessed", F.lit(START))
    assert {r.entry_id for r in retain(same, 2).collect()} == {2, 3}


def test_sweep_and_pairs(spark):
    originals = [(0, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0])]
    close = [(0, [0.9, float(np.sqrt(1 - 0.81)), 0.0]), (1, [0.0, 0.8, 0.6])]
    table = lambda rows: spark.createDataFrame(rows, "pair_id bigint, embedding array<double>")
    pairs = {r.pair_id: r.similarity for r in pair_similarity(table(originals), table(close)).collect()}
    assert pairs == pytest.approx({0: 0.9, 1: 0.8})
    entries = table(originals).select(F.col("pair_id").alias("entry_id"), "embedding", F.lit(0).alias("dominant_cluster"))
    probes = spark.createDataFrame(
        [(0, "paraphrase", close[0][1]), (1, "paraphrase", close[1][1]), (2, "unrelated", [0.72, 0.0, -0.69]), (3, "unrelated", None)],
        "qid bigint, kind string, embedding array<double>",
    )
    rows = [tuple(r) for r in threshold_sweep(probes, entries).orderBy("threshold").collect()]
    assert [r[1:3] + r[4:] for r in rows] == [(3, 1, 1), (2, 2, 0), (2, 2, 0), (1, 3, 0), (1, 3, 0), (0, 4, 0)]
    assert rows[0][3] == 0.75


class PlainCache:
    """The cache in a loop: what a replay must equal. Entries leave at the end of each slice of queries."""

    def __init__(self, threshold=0.85, depth=3, capacity=10000, slice_rows=1):
        self.threshold, self.depth, self.capacity, self.slice_rows = threshold, depth, capacity, slice_rows
        self.entries, self.used, self.asked = [], {}, 0

    def ask(self, qid, v, probs):
        match = self.find(qid, v, probs)
        self.asked += 1
        if self.asked % self.slice_rows == 0:
            self.entries = sorted(self.entries, key=lambda entry: -self.used[entry[0]])[: self.capacity]
        return match

    def find(self, qid, v, probs):
        if probs is None:
            routes = [0]
        else:
            routes = np.argsort(-np.array(probs), kind="stable")[: self.depth].tolist()
        best = None
        for cluster in routes:
            for entry, w, c in self.entries:
                score = float(sum(a * b for a, b in zip(v, w)))
                if c == cluster and (best is None or score > best[0]):
                    best = (score, entry)
        if best and best[0] >= self.threshold:
            self.used[best[1]] = qid
            return best[1]
        self.used[qid] = qid
        self.entries.append((qid, v, 0 if probs is None else int(np.argmax(probs))))
        return None


def chained_log(seed, n, d=4, hot=0):
    """Queries that drift, so that hits depend on which earlier ones were admitted; some are one hot query."""
    rng = np.random.default_rng(seed)
    vectors = [unit(rng.normal(size=d))]
    for i in range(n - 1):
        base = vectors[rng.integers(len(vectors))]
        vectors.append(vectors[0] if hot and i % hot == 0 else unit(base + rng.normal(scale=0.45, size=d)))
    return [v.astype(np.float32).astype(float) for v in vectors]


@pytest.mark.parametrize("routed", [False, True])
@pytest.mark.parametrize("block_rows", [8192, 70])
def test_replay_equals_the_loop(spark, routed, block_rows):
    log = chained_log(5, 300, hot=3)
    probs = np.random.default_rng(6).dirichlet(np.ones(5), 300).tolist() if routed else None
    cache = PlainCache()
    expected = {i: cache.ask(i, v, probs and probs[i]) for i, v in enumerate(log)}
    rows = query_rows(spark, log, probs=probs).repartition(3)
    if routed:
        rows = rows.withColumn("dominant_cluster", F.expr("cast(array_position(cluster_probs, array_max(cluster_probs)) - 1 as int)"))
    else:
        rows = rows.withColumn("dominant_cluster", F.lit(0))
    replayed = replay_log(with_route(rows), block_rows=block_rows)
    hits = {r.qid: r.entry_id for r in replayed.hits.collect()}
    assert {i: hits.get(i) for i in expected} == expected
    assert {r.qid for r in replayed.admitted.collect()} == {i for i, m in expected.items() if m is None}


def retained(spark, log, capacity, slice_rows, probs=None):
    """Hits and entries of a log that goes through in slices, and the loop's."""
    cache = PlainCache(capacity=capacity, slice_rows=slice_rows)
    expected = {i: cache.ask(i, v, probs and probs[i]) for i, v in enumerate(log)}
    # A log that ends within a slice is cut back at its end, too.
    cache.entries = sorted(cache.entries, key=lambda entry: -cache.used[entry[0]])[:capacity]
    rows = query_rows(spark, log, probs=probs).repartition(3)
    cluster = "cast(array_position(cluster_probs, array_max(cluster_probs)) - 1 as int)" if probs else "0"
    rows = rows.withColumn("dominant_cluster", F.expr(cluster))
    hits, entries = replay_with_retention(with_route(rows), empty_cache(spark), capacity, slice_rows)
    found = {r.qid: r.entry_id for r in hits.collect()}
    assert {i: found.get(i) for i in expected} == expected
    assert {r.entry_id for r in entries.collect()} == {entry[0] for entry in cache.entries}


@pytest.mark.parametrize("capacity, slice_rows", [(5, 40), (20, 60), (1, 33)])
def test_retention_equals_the_loop(spark, capacity, slice_rows):
    probs = np.random.default_rng(22).dirichlet(np.ones(4), 160).tolist()
    retained(spark, chained_log(21, 160, hot=6), capacity, slice_rows, probs)


def test_slices_of_one_query_evict_before_each_insert(spark):
    log = [unit(v).astype(np.float32).astype(float) for v in np.eye(4)[[0, 1, 0, 2, 1, 3]]]
    retained(spark, log, 2, 1)


def test_cyclic_log_takes_as_many_turns_as_slices(spark, monkeypatch):
    """One vector more than the cache holds, asked in turn."""
    from corpusloom.operators import replay

    turns = []
    plain = replay.replay_log
    monkeypatch.setattr(replay, "replay_log", lambda *args: turns.append(1) or plain(*args))
    retained(spark, [v.astype(float) for _ in range(125) for v in np.eye(4)], 3, 125)
    assert len(turns) == 4


def test_many_small_slices_take_no_jobs_of_their_own(spark, monkeypatch):
    from corpusloom.operators import replay

    turns = []
    plain = replay.replay_log
    monkeypatch.setattr(replay, "replay_log", lambda *args: turns.append(1) or plain(*args))
    # Two jobs of the log, the second of which starts from the cache of the first.
    monkeypatch.setattr(replay, "CHAIN_ROWS", 100)
    probs = np.random.default_rng(24).dirichlet(np.ones(4), 160).tolist()
    retained(spark, chained_log(23, 160, hot=6), 12, 7, probs)
    assert not turns


def test_no_rows_on_the_driver():
    from pathlib import Path

    from corpusloom.operators import cells, lookup, replay, search

    for module in (cells, lookup, replay, search):
        source = Path(module.__file__).read_text()
        assert "toArrow" not in source and "toPandas" not in source and ".broadcast(" not in source
        # What is collected are counts, by cluster.
        assert source.count(".collect()") == source.count(".count().collect()") == (module is cells)


def test_null_vectors_are_misses_and_no_entries(spark):
    rows = spark.createDataFrame([(0, None), (1, [1.0, 0.0]), (2, None), (3, [1.0, 0.0])], "qid bigint, embedding array<double>")
    replayed = replay_log(with_route(rows.withColumn("dominant_cluster", F.lit(0))))
    assert [r.qid for r in replayed.admitted.collect()] == [1]
    assert [(r.qid, r.entry_id) for r in replayed.hits.collect()] == [(3, 1)]


def index_table(spark, n=20, d=4):
    rng = np.random.default_rng(9)
    rows = [(i, f"c{i % 3}", f"f{i}", f"text {i}", unit(v).tolist()) for i, v in enumerate(rng.normal(size=(n, d)))]
    return spark.createDataFrame(
        rows, "doc_id bigint, category string, filename string, snippet string, embedding array<float>"
    )


def small_model(d=4):
    rng = np.random.default_rng(10)
    return ClusterModel(Mixture(np.full(3, 1 / 3), rng.normal(size=(3, d)), np.ones((3, d))))


def test_answers_in_two_batches_equal_one(spark):
    log = chained_log(12, 80, hot=4)
    index, model = index_table(spark), small_model()
    queries = query_rows(spark, log).drop("result")
    whole = answer_queries(queries, index, model)
    first = answer_queries(queries.filter("qid < 30"), index, model)
    second = answer_queries(queries.filter("qid >= 30"), index, model, first.entries)
    rows = lambda df: {r.qid: r for r in df.collect()}
    assert rows(first.responses) | rows(second.responses) == rows(whole.responses)
    assert {r.entry_id for r in second.entries.collect()} == {r.entry_id for r in whole.entries.collect()}
    cache = PlainCache()
    probs = {r.qid: r.cluster_probs for r in model.predict(queries).collect()}
    for qid, response in sorted(rows(whole.responses).items()):
        match = cache.ask(qid, log[qid], probs[qid])
        assert response.cache_hit == (match is not None)
        assert response.matched_query == (None if match is None else f"q{match}")
        assert len(response.result) == 5 and len(response.cluster_probabilities) == 3
        owner = qid if match is None else match
        assert response.dominant_cluster == int(np.argmax(probs[owner]))


def test_long_logs_go_in_slices(spark):
    log = chained_log(13, 90, hot=5)
    index, model = index_table(spark), small_model()
    queries = query_rows(spark, log).drop("result").repartition(3)
    whole = answer_queries(queries, index, model)
    pieces = answer_queries(queries, index, model, slice_rows=25)
    rows = lambda df: {r.qid: r for r in df.collect()}
    assert rows(pieces.responses) == rows(whole.responses)
    assert {r.entry_id for r in pieces.entries.collect()} == {r.entry_id for r in whole.entries.collect()}
    # A full cache is cut back after each slice.
    for slice_rows in (1000, 40):
        small = answer_queries(queries, index, model, max_entries=7, slice_rows=slice_rows)
        cache = PlainCache(capacity=7, slice_rows=slice_rows)
        probs = {r.qid: r.cluster_probs for r in model.predict(queries).collect()}
        matches = {i: cache.ask(i, v, probs[i]) for i, v in enumerate(log)}
        found = {r.qid: r.matched_query for r in small.responses.collect()}
        assert found == {i: None if m is None else f"q{m}" for i, m in matches.items()}
        last = sorted(cache.entries, key=lambda entry: -cache.used[entry[0]])[:7]
        assert {r.entry_id for r in small.entries.collect()} == {entry[0] for entry in last}


def test_answered_conversations_keep_every_miss(spark, tmp_path, monkeypatch):
    """Whatever the length of the log: were it cut into slices that end with a full cache, the second half would be misses."""
    from corpusloom.operators.replay import ordered_slices
    from corpusloom.plans import answer, registered

    words = [f"alpha{i} beta{i} gamma{i}" for i in range(12)]
    asked = [(i, 0, "user", words[i % 12]) for i in range(24)]
    spark.createDataFrame(asked, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    docs = [(i, f"{w} " + " ".join(f"delta{i}word{j}" for j in range(12)), "en", "s", 99) for i, w in enumerate(words)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(answer, "ordered_slices", lambda log, key, rows: ordered_slices(log, key, 8))
    monkeypatch.setattr(answer, "retain", lambda entries, most: retain(entries, 3))
    rows = registered.answer_conversations(spark, str(tmp_path)).orderBy("qid").collect()
    assert [r.cache_hit for r in rows] == [False] * 12 + [True] * 12
    assert [r.matched_query for r in rows[12:]] == words and [r.result for r in rows[12:]] == [r.result for r in rows[:12]]


def test_answers_without_model_and_eviction(spark):
    queries = query_rows(spark, np.eye(4)).drop("result")
    answers = answer_queries(queries, index_table(spark), max_entries=3)
    assert {r.dominant_cluster for r in answers.responses.collect()} == {0}
    assert {r.cluster_probabilities for r in answers.responses.collect()} == {None}
    assert {r.entry_id for r in answers.entries.collect()} == {1, 2, 3}


def test_hit_refreshes_the_entry(spark):
    e = np.eye(4)
    answers = answer_queries(query_rows(spark, [e[0], e[1], e[0], e[2]]).drop("result"), index_table(spark), max_entries=2)
    assert {r.entry_id for r in answers.entries.collect()} == {0, 3}


def test_answers_over_text_and_empty_queries(spark):
    queries = spark.createDataFrame(
        [(0, "red car", START), (1, "", START), (2, "Red CAR!", START), (3, None, START)], "qid bigint, query string, ts timestamp"
    )
    valid, rejected = split_empty(queries)
    assert {r.qid for r in rejected.collect()} == {1, 3} and valid.count() == 2
    from corpusloom.operators.embed import embed_documents
    from corpusloom.operators.search import build_index

    docs = spark.createDataFrame(
        [(0, "c", "f0", "a red car"), (1, "d", "f1", "blue sky")], "doc_id bigint, category string, filename string, cleaned_text string"
    )
    index = build_index(embed_documents(docs, dimension=64))
    rows = {r.qid: r for r in answer_queries(queries, index, dimension=64).responses.collect()}
    assert set(rows) == {0, 2} and not rows[0].cache_hit and rows[2].cache_hit
    assert rows[0].result[0].text == "a red car" and rows[2].result == rows[0].result


def test_empty_log(spark):
    queries = query_rows(spark, np.eye(4)).drop("result").limit(0)
    answers = answer_queries(queries, index_table(spark))
    assert answers.responses.count() == 0 and answers.entries.count() == 0


def test_stream_equals_batch(spark, tmp_path):
    log = chained_log(14, 40, hot=4)
    queries = query_rows(spark, log).drop("result")
    index, model = index_table(spark), small_model()
    source, folder = str(tmp_path / "source"), str(tmp_path / "cache")
    schema = queries.schema
    queries.filter("qid < 15").coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(schema).parquet(source)
    answer_stream(stream, index, folder, model).awaitTermination()
    queries.filter("qid >= 15").coalesce(1).write.mode("append").parquet(source)
    answer_stream(stream, index, folder, model).awaitTermination()
    whole = answer_queries(queries, index, model)
    assert {r.qid: r for r in read_responses(spark, folder).collect()} == {r.qid: r for r in whole.responses.collect()}
    left = {r.entry_id for r in read_state(spark, folder, 1).collect()}
    hits = whole.responses.filter("cache_hit").count()
    assert tuple(stream_stats(spark, folder).first()) == (40 - hits, hits, 40 - hits, round(hits / 40, 4))
    assert left == {r.entry_id for r in whole.entries.collect()}


def test_flushed_stream(spark, tmp_path):
    folder, source = str(tmp_path / "cache"), str(tmp_path / "source")
    flush_stream(spark, folder)
    assert tuple(stream_stats(spark, folder).first()) == (0, 0, 0, 0.0)
    index = index_table(spark)
    queries = query_rows(spark, [*np.eye(4), np.eye(4)[0], np.eye(4)[0]]).drop("result")
    queries.filter("qid < 5").coalesce(1).write.parquet(source)
    answer_stream(spark.readStream.schema(queries.schema).parquet(source), index, folder).awaitTermination()
    assert tuple(stream_stats(spark, folder).first()) == (4, 1, 4, 0.2)
    flush_stream(spark, folder)
    assert tuple(stream_stats(spark, folder).first()) == (0, 0, 0, 0.0)
    queries.filter("qid = 5").coalesce(1).write.mode("append").parquet(source)
    answer_stream(spark.readStream.schema(queries.schema).parquet(source), index, folder).awaitTermination()
    assert tuple(stream_stats(spark, folder).first()) == (1, 0, 1, 0.0)


def test_a_batch_writes_what_it_changes_and_reads_what_it_visits(spark, tmp_path, monkeypatch):
    """Three clusters and depth 1: folders of untouched clusters stay as they are, and the plan prunes them."""
    from corpusloom.streaming import cache_store

    monkeypatch.setattr(cache_store, "COMPACT_EVERY", 3)
    folder, source = str(tmp_path / "cache"), str(tmp_path / "source")
    model = ClusterModel(Mixture(np.full(3, 1 / 3), np.eye(3), np.full((3, 3), 0.01)))
    e = np.eye(3)
    near = lambda i, j: unit(e[i] + 0.1 * e[j])
    asked = [[e[0], e[1], e[2], near(0, 1)], [near(1, 2), unit(e[1] + 1.2 * e[0])], [near(1, 0)], [e[2], near(2, 0), near(0, 2)]]
    index, start, whole = index_table(spark, d=3), 0, []
    for batch in asked:
        rows = query_rows(spark, batch, start).drop("result")
        whole.append(rows)
        rows.coalesce(1).write.mode("append").parquet(source)
        start += len(batch)
        answer_stream(spark.readStream.schema(rows.schema).parquet(source), index, folder, model, depth=1, max_entries=3).awaitTermination()
    written = [sorted(p.name for p in (tmp_path / "cache" / "entries" / f"batch={b}").glob("dominant_cluster=*")) for b in range(4)]
    # The first batch admits one entry a cluster; the second one in the cluster of its second query, for which that of
    # cluster 2 leaves; the third none; the fourth that of cluster 2 again.
    assert written[0] == [f"dominant_cluster={c}" for c in range(3)] and len(written[1]) == 1
    assert written[2:] == [[], ["dominant_cluster=2"]]
    clusters = spark.createDataFrame([(1,)], "cluster int")
    read = cache_store.read_entries(spark, folder, 1, clusters)
    assert {r.dominant_cluster for r in read.collect()} <= {1}
    assert "dynamicpruning" in read._jdf.queryExecution().executedPlan().toString().lower()
    # Answers and entries are those of one log whose cache is cut back after each batch.
    entries, responses = None, {}
    for rows in whole:
        answers = answer_queries(rows, index, model, entries, depth=1, max_entries=3)
        entries = spark.createDataFrame(answers.entries.collect(), answers.entries.schema)
        responses |= {r.qid: r for r in answers.responses.collect()}
    assert {r.qid: r for r in read_responses(spark, folder).collect()} == responses
    left = lambda df: {(r.entry_id, r.last_accessed) for r in df.collect()}
    assert left(read_state(spark, folder, 3)) == left(entries) and len(left(entries)) == 3
    assert (tmp_path / "cache" / "base" / "after=2").exists()
