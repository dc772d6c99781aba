"""Blocks of vectors, deliveries, sketches, narrowing, squared silhouettes and keyed state against plain statements of them."""

import math
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import block_search, delta, pivots, quantiles, sketch_pca, sketches
from corpusloom.operators.block_search import best_match_blocks, top_k_blocks
from corpusloom.operators.lookup import best_match, with_route
from corpusloom.operators.pivots import bounds, build_blocks
from corpusloom.operators.silhouette import silhouette_squared
from corpusloom.plans.clean_job import clean_corpus
from corpusloom.sources import posts_source
from corpusloom.sources.posts import load_posts
from corpusloom.streaming.keyed_cache import RESPONSE, answer_keyed
from tests.test_search import brute, triples


def families(rng, n, d=12, spread=0.3, of=6):
    centers = rng.normal(size=(n // of + 1, d))
    return (centers[np.arange(n) // of] + spread * rng.normal(size=(n, d))).astype(np.float32)


def table_of(spark, vectors, key="doc_id", parts=3):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(vectors)], f"{key} bigint, embedding array<double>").repartition(parts)


def test_bounds_hold():
    rng = np.random.default_rng(0)
    for scale in (1e-3, 1, 1e4):
        for spread in (0.01, 0.5, 3):
            groups = [scale * (rng.normal(size=5) + spread * rng.normal(size=(rng.integers(1, 9), 5))) for _ in range(20)]
            groups += [np.zeros((2, 5)), np.eye(5) - np.eye(5)[::-1]]
            queries = np.concatenate([scale * rng.normal(size=(30, 5)), np.zeros((1, 5)), groups[0][:1]])
            center = np.array([g.mean(0) for g in groups])
            radius = np.array([np.sqrt(((g - g.mean(0)) ** 2).sum(1)).max() for g in groups])
            angle = np.array([pivots.angles(g, g.mean(0)[None, :]).max() for g in groups])
            norm = np.array([np.sqrt((g**2).sum(1)).max() for g in groups])
            best = np.array([[(g @ q).max() for g in groups] for q in queries])
            assert (bounds(queries, center, radius, angle, norm) >= best).all()


def test_blocks_hold_every_vector_once(spark):
    rng = np.random.default_rng(1)
    vectors = [*families(rng, 300), *np.repeat(families(rng, 1), 90, axis=0), None, np.zeros(12)]
    index = build_blocks(table_of(spark, vectors), block_rows=20)
    placed = index.vectors.collect()
    assert sorted(r.doc_id for r in placed) == [i for i, v in enumerate(vectors) if v is not None]
    sizes = {r.block: r.n for r in index.summaries.collect()}
    assert sum(sizes.values()) == len(placed)
    # Equal vectors are cut by a hash, which is not even.
    assert max(sizes.values()) <= 40 and len(sizes) >= 15


@pytest.mark.parametrize("first", [1, 3])
def test_block_search_equals_a_full_search(spark, first):
    rng = np.random.default_rng(2)
    vectors = [*families(rng, 240), *np.repeat(families(rng, 1), 30, axis=0), np.zeros(12, np.float32)]
    queries = [vectors[0], vectors[77], vectors[250], *rng.normal(size=(4, 12)).astype(np.float32), np.zeros(12, np.float32)]
    index = build_blocks(table_of(spark, vectors), block_rows=12)
    asked = table_of(spark, [*queries, None], "qid")
    found = top_k_blocks(index, asked, 5, first)
    assert triples(found.hits) == brute([[float(x) for x in v] for v in vectors], [[float(x) for x in q] for q in queries], 5)
    visits = {r.qid: r.n for r in found.visits.groupBy("qid").agg(F.count("*").alias("n")).collect()}
    blocks = index.summaries.count()
    assert visits[0] < blocks / 2 and max(visits.values()) <= blocks
    assert found.visits.count() == found.visits.distinct().count()


def test_block_search_edges(spark):
    rng = np.random.default_rng(3)
    vectors = families(rng, 9)
    index = build_blocks(table_of(spark, vectors), block_rows=4)
    asked = table_of(spark, vectors[:2], "qid")
    assert top_k_blocks(index, asked, 50).hits.count() == 18
    assert top_k_blocks(index, asked.limit(0)).hits.collect() == []
    empty = build_blocks(table_of(spark, vectors).limit(0))
    assert top_k_blocks(empty, asked).hits.collect() == []


def written_rows(spark, name):
    """Rows of the tables that were staged as ``name``."""
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/corpusloom"
    return sum(spark.read.parquet(f"{folder}/{x}").count() for x in os.listdir(folder) if x.startswith(f"{name}-"))


def test_visits_are_counted_where_they_are_made(spark, monkeypatch):
    """Every block is as good as the next here, so that nearly all are visited; the visits are neither stored nor sent."""
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(200, 12))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    entries = table_of(spark, [*vectors, vectors[3], vectors[3]], "entry_id").withColumn("dominant_cluster", F.lit(0))
    index = build_blocks(entries, "entry_id", 4)
    asked = with_route(table_of(spark, vectors[:60], "qid"))
    monkeypatch.setattr(block_search, "HELD_HITS", 50)
    stored = written_rows(spark, "visits"), written_rows(spark, "other-visits")
    matches, visited = best_match_blocks(index, asked, 0.1, counted=True)
    assert sorted(map(tuple, matches.collect())) == sorted(map(tuple, best_match(asked, entries, min_score=0.1).collect()))
    pairs = best_match_blocks(index, asked, 0.1)[1].groupBy("qid").count()
    assert sorted(map(tuple, visited.groupBy("qid").agg(F.sum("n")).collect())) == sorted(map(tuple, pairs.collect()))
    renamed = pivots.BlockIndex(index.vectors.withColumnRenamed("entry_id", "doc_id"), index.summaries)
    found = top_k_blocks(renamed, asked.select("qid", "embedding"))
    assert triples(found.hits) == brute([list(v) for v in [*vectors, vectors[3], vectors[3]]], [list(v) for v in vectors[:60]], 5)
    assert sorted(map(tuple, found.visited.collect())) == sorted(map(tuple, found.visits.groupBy("qid").count().collect()))
    assert (written_rows(spark, "visits"), written_rows(spark, "other-visits")) == stored


def test_hot_blocks_go_to_several_tasks(spark):
    rng = np.random.default_rng(4)
    vectors = families(rng, 60)
    index = build_blocks(table_of(spark, vectors), block_rows=10)
    asked = table_of(spark, [vectors[0] + 0.01 * rng.normal(size=12) for _ in range(50)], "qid")
    visits = block_search.reaching_blocks(asked, index.summaries, 1).select("qid", "block")
    seen = block_search.visit(asked, index.vectors.select("doc_id", "embedding", "block"), visits, lambda a, b: a.select(["qid"]), "qid bigint", query_rows=8)
    assert sorted(r.qid for r in seen.collect()) == list(range(50))


def test_match_by_pivots_equals_all_cells(spark):
    rng = np.random.default_rng(5)
    vectors = families(rng, 200, spread=0.25)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    entries = table_of(spark, vectors[:150], "entry_id").withColumn("dominant_cluster", (F.col("entry_id") % 3).cast("int"))
    probs = F.array(*[F.pmod(F.col("qid") + i, F.lit(3)).cast("double") / 3 for i in range(3)])
    asked = with_route(table_of(spark, vectors[100:], "qid").withColumn("cluster_probs", probs), 2)
    index = build_blocks(entries, "entry_id", 10)
    found, visits = best_match_blocks(index, asked, 0.85)
    plain = best_match(asked, entries, min_score=0.85)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
    assert 0 < visits.count() < 0.5 * 100 * index.summaries.count()


VALUES = [
    [], [None], [1.0], [1.0, 2.0], [3.0, None, 1.0, 2.0], [5.0] * 50, [math.inf, 1.0, -math.inf], [math.nan, 1.0, 2.0], [math.nan] * 3, [-math.inf] * 3 + [0.0],
    [1e308, -1e308, 0.0, 5.0], [0.1 + i * 1e-16 for i in range(40)], [10.0**i for i in range(-300, 300, 7)], [-0.0, 0.0, 1.0],
]


@pytest.mark.parametrize("few, bins", [(4096, 4096), (1, 3)])
def test_exact_quantiles(spark, monkeypatch, few, bins):
    monkeypatch.setattr(quantiles, "FEW_ROWS", few)
    monkeypatch.setattr(quantiles, "BINS", bins)
    rng = np.random.default_rng(6)
    for values in VALUES + [rng.normal(size=501).tolist(), rng.integers(0, 5, 400).astype(float).tolist()]:
        rows = spark.createDataFrame([(v,) for v in values], "x double")
        ordered = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
        for q in (0.5, 0.0, 1.0) if len(values) < 60 else (0.5,):
            got = quantiles.exact_quantile(rows, "x", q)
            if not ordered:
                assert got is None
                continue
            place = q * (len(ordered) - 1)
            low, high = ordered[int(place)], ordered[min(int(place) + 1, len(ordered) - 1)]
            want = low if place == int(place) or low == high else low + (place - int(place)) * (high - low)
            assert got == want or math.isnan(got) and math.isnan(want), (values, q)


def test_silhouette_of_squared_distances(spark):
    rng = np.random.default_rng(7)
    points = np.concatenate([rng.normal(size=(40, 4)), 3 + rng.normal(size=(25, 4)), [[9, 9, 9, 9]], [[1, 1, 1, 1]] * 2])
    labels = [0] * 40 + [1] * 25 + [2] + [5] * 2
    rows = spark.createDataFrame([(p.tolist(), l) for p, l in zip(points, labels)] + [(None, 1), ([0.0] * 4, None)], "features array<double>, label int").repartition(3)
    total = 0.0
    for i, own in enumerate(labels):
        means = {}
        for c in set(labels):
            others = [j for j, l in enumerate(labels) if l == c and j != i]
            if others:
                means[c] = np.mean([((points[i] - points[j]) ** 2).sum() for j in others])
        if own in means:
            a, b = means[own], min(m for c, m in means.items() if c != own)
            total += (b - a) / max(a, b)
    got = silhouette_squared(rows).first()
    assert got.n == len(labels) and abs(got.silhouette - total / len(labels)) < 1e-9
    assert tuple(silhouette_squared(rows.filter("label = 1")).first()) == (None, 25)
    assert tuple(silhouette_squared(rows.limit(0)).first()) == (None, 0)


def test_sketches_merge(spark):
    rows = spark.range(60_000).select((F.col("id") % 7).alias("part"), (F.col("id") % 40_000).cast("string").alias("a"), (F.col("id") % 50).cast("string").alias("b"))
    columns = ["a", "b"]
    merged = sketches.merge_parts(sketches.sketch_parts(rows, "part", columns), columns)
    whole = sketches.merge_parts(sketches.sketch_parts(rows.withColumn("all", F.lit(1)), "all", columns), columns)
    told = [sketches.estimated("a_sketch"), sketches.estimated("b_sketch"), "rows"]
    assert merged.select(*told).first() == whole.select(*told).first()
    a, b, n = merged.select(*told).first()
    assert abs(a - 40_000) <= sketches.ERROR_BOUND * 40_000 and b == 50 and n == 60_000
    none = sketches.merge_parts(sketches.sketch_parts(rows.limit(0), "part", columns), columns)
    assert tuple(none.select(*told).first()) == (0, 0, 0)
    keys = rows.select("part", F.col("a").alias("text_key"), F.col("b").alias("body_key"))
    duplicates = sketches.duplicate_estimates(sketches.merge_parts(sketches.sketch_parts(keys, "part", ["text_key", "body_key"]), ["text_key", "body_key"])).first()
    assert abs(duplicates.exact_duplicates - 20_000) <= sketches.ERROR_BOUND * 40_000 and duplicates.body_duplicates == 59_950


def posts_of(spark, texts, start=0):
    rows = [(f"c{i % 3}", f"f{i:04d}", t) for i, t in enumerate(texts, start)]
    return spark.createDataFrame(rows, "category string, filename string, text string")


def made_texts(n, seed):
    rng = np.random.default_rng(seed)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(60)]
    texts = [" ".join(words[i] for i in rng.integers(0, 60, rng.integers(3, 15))) for _ in range(n)]
    return [f"From: a@b.c {i}\n\n{texts[int(rng.integers(0, n))]}" for i in range(n)]


@pytest.mark.parametrize("expected_posts", [1 << 12, 1])
def test_deliveries_equal_one_clean_job(spark, tmp_path, expected_posts):
    """With room in the filter, and with a filter so small that it rules nothing out."""
    folder = str(tmp_path / "corpus")
    old, new, last = (posts_of(spark, made_texts(80, 8), 1000 * k).withColumn("delivery", F.lit(k)) for k in range(3))
    last = last.limit(0).unionByName(posts_of(spark, made_texts(40, 9), 2000).withColumn("delivery", F.lit(2)))
    counts = [tuple(delta.add_delivery(x.drop("delivery"), folder, k, expected_posts=expected_posts).first()) for k, x in enumerate((old, new, last))]
    whole = clean_corpus(old.unionByName(new).unionByName(last), ["delivery", "category", "filename"])
    got = delta.read_corpus(spark, folder)
    rows = lambda df: sorted(map(tuple, df.select("category", "filename", "cleaned_text").collect()))
    assert rows(got) == rows(whole)
    # The second delivery brings the texts of the first again.
    assert counts[0][1:] == (0, 0) and counts[1][0] == counts[1][1] == counts[1][2]
    assert counts[2][1] <= (3 if expected_posts > 1 else counts[2][0])
    again = rows(got)
    delta.add_delivery(last.drop("delivery"), folder, 2, expected_posts=expected_posts).collect()
    delta.compact_filter(spark, folder)
    assert rows(delta.read_corpus(spark, folder)) == again
    assert tuple(delta.add_delivery(old.drop("delivery"), folder, 3, expected_posts=expected_posts).first())[1:] == (counts[0][0],) * 2


def test_the_corpus_is_not_shuffled_for_a_delivery(spark, tmp_path):
    folder = str(tmp_path / "corpus")
    delta.add_delivery(posts_of(spark, made_texts(50, 1)), folder, 0).collect()
    bloom = spark.read.parquet(f"{folder}/filter/delivery=0")
    keys = spark.createDataFrame([("a",), ("b",)], "body_key string")
    plan = delta.may_hold(F.broadcast(keys), "body_key", bloom, delta.filter_blocks(1 << 20))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def keyed(spark, tmp_path, parts, name, wait=0.0, **options):
    folder, schema = str(tmp_path / name), "qid bigint, embedding array<double>"
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/source")
        answer_keyed(spark.readStream.schema(schema).parquet(f"{folder}/source"), folder, **options).awaitTermination()
        time.sleep(wait)
    return {r.qid: r.entry_id for r in spark.read.schema(RESPONSE).parquet(f"{folder}/responses").collect()}


def test_keyed_state_restarts_expires_and_evicts(spark, tmp_path):
    e = np.eye(4).tolist()
    parts = [[(0, e[0]), (1, e[1]), (2, None), (3, e[0])], [(4, e[0]), (5, e[2]), (6, e[1])]]
    assert keyed(spark, tmp_path, parts, "plain") == {0: None, 1: None, 2: None, 3: 0, 4: 0, 5: None, 6: 1}
    # One entry stays after each batch: the last used one.
    assert keyed(spark, tmp_path, parts, "small", max_entries=1) == {0: None, 1: None, 2: None, 3: 0, 4: 0, 5: None, 6: None}
    assert keyed(spark, tmp_path, parts, "expired", wait=2.0, ttl_ms=1500, trigger={"once": True}) == {0: None, 1: None, 2: None, 3: 0, 4: None, 5: None, 6: None}


@pytest.mark.parametrize("size, parts", [(12, 1), (6, 5), (12, 40)])
def test_sketch_bounds(spark, size, parts):
    """Shares of a matrix with a few strong directions, in one task, in several, and in so many that sketches merge twice."""
    rng = np.random.default_rng(10)
    rows = rng.normal(size=(400, 30)) * np.r_[[9, 5, 3], np.full(27, 0.4)] @ np.linalg.qr(rng.normal(size=(30, 30)))[0] + 7
    table = spark.createDataFrame([(r.tolist(),) for r in rows] + [(None,)], "embedding array<double>").repartition(parts)
    centered = rows - rows.mean(0)
    exact = np.linalg.svd(centered, compute_uv=False) ** 2 / (centered**2).sum()
    got = sorted(map(tuple, sketch_pca.sketch_shares(table, 3, size).collect()))
    assert [g[0] for g in got] == [0, 1, 2] and all(g[4] == 400 for g in got)
    for i, low, high, direction, _ in got:
        assert low - 1e-9 <= exact[i] <= high + 1e-9 and high - low <= 1 / size
        held = ((centered @ np.array(direction)) ** 2).sum() / (centered**2).sum()
        assert held >= low - 1e-9
    assert sketch_pca.sketch_shares(table.limit(0), 2, 5).collect() == []
    with pytest.raises(ValueError):
        sketch_pca.sketch_shares(table, 5, 5)


def test_posts_source(spark, tmp_path):
    posts = {("b", "2"): b"caf\xe9\r\nx\ry", ("a", "1"): b"", ("a", "_hidden"): b"no", ("a", "3"): b"text", (".c", "4"): b"no", ("b", "deep/5"): b"no"}
    for (category, name), raw in posts.items():
        path = tmp_path / category / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(raw)
    (tmp_path / "top").write_bytes(b"no")
    for i in range(50):
        (tmp_path / "many").mkdir(exist_ok=True)
        (tmp_path / "many" / f"{i}").write_bytes(b"z" * 1000)
    posts_source.register(spark)
    read = lambda: spark.read.format("posts").option("partition_bytes", 20 * (posts_source.OPEN_BYTES + 1000)).load(str(tmp_path))
    plain = load_posts(spark, str(tmp_path)).filter("category != '.c'")
    # Spark's reader of binary files passes over files without bytes.
    assert sorted(map(tuple, read().collect())) == sorted([("a", "1", ""), *map(tuple, plain.collect())])
    assert read().filter("category != 'none'").rdd.getNumPartitions() == 3
    some = read().filter(F.col("category").isin("a", "b") & (F.length("text") > 0))
    assert sorted(map(tuple, some.collect())) == [("a", "3", "text"), ("b", "2", "café\nx\ny")]
    assert read().filter("category = 'absent'").collect() == []
    reader = posts_source.PostsReader({"path": str(tmp_path)})
    left = list(reader.pushFilters([posts_source.EqualTo(("category",), "b"), posts_source.EqualTo(("filename",), "2")]))
    assert len(left) == 1 and [p.path.split("/")[-2:] for pack in reader.partitions() for p in pack.posts] == [["b", "2"]]


def test_posts_arrive_as_a_stream(spark, tmp_path):
    root, out = tmp_path / "tree", str(tmp_path / "out")
    posts_source.register(spark)

    def arrive(names, at):
        for name in names:
            path = root / "c" / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(f"post {name}")
            os.utime(path, ns=(at, at))
        stream = spark.readStream.format("posts").load(str(root)).writeStream.format("parquet").option("path", out)
        stream.option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start().awaitTermination()
        return sorted(r.filename for r in spark.read.schema("category string, filename string, text string").parquet(out).collect())

    assert arrive(["1", "2"], 10**18) == ["1", "2"]
    assert arrive(["3"], 10**18 + 5) == ["1", "2", "3"]
    # Of one time, paths decide what has been taken.
    assert arrive(["30"], 10**18 + 5) == ["1", "2", "3", "30"]


def test_bounds_of_a_cell_are_made_in_parts(monkeypatch):
    """A cell of many queries and summaries keeps no matrix of all of them, and tells the same blocks."""
    import pyarrow as pa

    from corpusloom.functions.blocks import to_lists
    from corpusloom.operators import block_search

    rng = np.random.default_rng(31)
    vectors, centers = rng.normal(size=(50, 4)), rng.normal(size=(40, 4))
    asked = pa.table({"qid": pa.array(range(50)), "embedding": to_lists(vectors, pa.float64()), "floor": pa.array([0.5] * 50)})
    held = pa.table({
        "block": pa.array([str(i) for i in range(40)]), "center": to_lists(centers, pa.float64()),
        "radius": pa.array([0.1] * 40), "angle": pa.array([0.1] * 40), "norm": pa.array([3.0] * 40),
    })
    whole = [block_search._reaching(first)(asked, held) for first in (None, 2)]
    monkeypatch.setattr("corpusloom.functions.blocks.BLOCK_CELLS", 200)
    cells, plain = [], block_search.bounds
    monkeypatch.setattr(block_search, "bounds", lambda q, *rest: cells.append(len(q) * len(rest[0])) or plain(q, *rest))
    parts = [block_search._reaching(first)(asked, held) for first in (None, 2)]
    assert max(cells) <= 200
    for a, b in zip(whole, parts):
        assert a.num_rows and a.select(["qid", "block"]).equals(b.select(["qid", "block"]))


def test_cells_are_as_large_as_tasks_can_hold():
    """Twice the rows send a row to no more blocks while a block can hold them."""
    from corpusloom.operators import cells

    assert cells.fewest_blocks(20_000, 64, 8192, 1) == cells.fewest_blocks(40_000, 64, 8192, 1) == 1
    assert cells.fewest_blocks(1_000_000, 64, 8192, 24) == 24 < cells.block_count(1_000_000, 8192)
    # Wide vectors take smaller blocks, and never smaller ones than asked for.
    assert cells.fewest_blocks(1_000_000, 384, 8192, 1) == cells.block_count(1_000_000, cells.CELL_BYTES // 3072)
    assert cells.fewest_blocks(1_000, 1 << 20, 100, 1) == 10


def test_small_query_blocks_send_no_more_copies_of_the_vectors(spark):
    """Queries in blocks of 10 meet the vectors in as few cells as there are tasks for, with the hits of one block."""
    from corpusloom.operators import search

    rng = np.random.default_rng(32)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(200, 8)).round(1))]
    vectors = spark.createDataFrame(rows, "doc_id long, embedding array<double>")
    queries = spark.createDataFrame(rows, "qid long, embedding array<double>")
    counts, plain = [], search.all_cells
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(search, "all_cells", lambda *args: counts.append(args[-2]) or plain(*args))
        found = [sorted(map(tuple, search.top_k(vectors, queries, 3, query_rows=n).collect())) for n in (10, 1000)]
    assert found[0] == found[1] and counts[0] <= 2 * spark.sparkContext.defaultParallelism


class HeldState:
    """Stands in for a key's state."""

    def __init__(self):
        self.rows = {}

    def iterator(self):
        return iter(list(self.rows.items()))

    def updateValue(self, key, value):
        self.rows[key] = value

    def removeKey(self, key):
        del self.rows[key]


def test_keyed_queries_meet_the_entries_in_blocks(monkeypatch):
    """As one at a time; entries are compared with whole blocks of queries, so a product per query and entry before it is not made."""
    from types import SimpleNamespace

    from corpusloom.streaming import keyed_cache

    rng = np.random.default_rng(9)
    vectors = families(rng, 300, d=6, spread=0.4)
    vectors = [None if i % 11 == 5 else (v / np.linalg.norm(v)).tolist() for i, v in enumerate(np.concatenate([vectors, vectors[::-3]]))]
    products = []
    near = keyed_cache._near
    monkeypatch.setattr(keyed_cache, "_near", lambda matrix, queries, threshold: products.append(len(queries)) or near(matrix, queries, threshold))
    monkeypatch.setattr(keyed_cache, "ASKED_ROWS", 16)
    monkeypatch.setattr(keyed_cache, "HELD_ROWS", 10)
    cache = keyed_cache.ClusterCache(0.85, 1000, None)
    cache.entries, held = HeldState(), []
    for start in range(0, len(vectors), 150):
        rows = [SimpleNamespace(qid=i, embedding=v) for i, v in enumerate(vectors)][start : start + 150]
        for row in cache.handleInputRows((3,), iter(rows[::-1]), None):
            v = vectors[row.qid]
            scores = [] if v is None else [sum(a * b for a, b in zip(v, w)) for _, w in held]
            best = max(range(len(scores)), key=lambda i: scores[i], default=None)
            if best is not None and scores[best] >= 0.85:
                assert (row.cache_hit, row.entry_id) == (True, held[best][0]) and abs(row.score - scores[best]) < 1e-12
            else:
                assert (row.cache_hit, row.entry_id, row.score) == (False, None, None)
                if v is not None:
                    held.append((row.qid, v))
    assert sorted(cache.entries.rows) == [(i,) for i, _ in held] and max(products) == 16 - 1
