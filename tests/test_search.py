import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.vectors import dot, l2_normalize, probability_map, route
from corpusloom.operators.embed import embed_documents, hash_embedding
from corpusloom.operators.search import build_index, search, tag_clusters, top_k
from corpusloom.sources.tables import append_index, load_embeddings, load_index, save_embeddings, save_index


def unit(rng, n, d=16):
    v = rng.normal(size=(n, d))
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def vector_table(spark, vectors, categories=None, parts=3):
    rows = [(i, v.tolist(), categories[i] if categories else "c") for i, v in enumerate(vectors)]
    schema = "doc_id bigint, embedding array<float>, category string"
    return spark.createDataFrame(rows, schema).repartition(parts)


def query_table(spark, vectors, filters=None):
    rows = [(i, v.tolist(), filters[i] if filters else None) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "qid bigint, embedding array<float>, category_filter string")


def brute(vectors, queries, k, allowed=None):
    out = []
    for q, query in enumerate(queries):
        scores = [sum(float(a) * float(b) for a, b in zip(v, query)) for v in vectors]
        order = sorted((i for i in range(len(vectors)) if not allowed or allowed(q, i)), key=lambda i: (-scores[i], i))
        out += [(q, r, i) for r, i in enumerate(order[:k], 1)]
    return out


def triples(hits):
    return sorted((r.qid, r["rank"], r.doc_id) for r in hits.collect())


@pytest.mark.parametrize("query_rows", [4096, 3])
def test_equals_full_sort(spark, query_rows):
    rng = np.random.default_rng(1)
    vectors, queries = unit(rng, 200), unit(rng, 10)
    hits = top_k(vector_table(spark, vectors), query_table(spark, queries), 5, query_rows=query_rows)
    assert triples(hits) == brute(vectors, queries, 5)


@pytest.mark.parametrize("parts", [1, 7])
def test_copies_go_by_id(spark, parts):
    rng = np.random.default_rng(2)
    base = unit(rng, 40)
    vectors = np.concatenate([base, np.repeat(base[:1], 400, axis=0), base])
    hits = top_k(vector_table(spark, vectors, parts=parts), query_table(spark, base[:4]), 6)
    assert triples(hits) == brute(vectors, base[:4], 6)


def test_filters(spark):
    rng = np.random.default_rng(3)
    vectors, queries = unit(rng, 120), unit(rng, 4)
    categories = [f"c{i % 4}" for i in range(120)]
    filters = ["c1", None, "c3", "absent"]
    table, asked = vector_table(spark, vectors, categories), query_table(spark, queries, filters)
    expected = brute(vectors, queries, 5, lambda q, i: filters[q] in (None, categories[i]))
    assert triples(top_k(table, asked, 5, filtered=True)) == expected
    index = table.withColumn("snippet", F.lit("s")).withColumn("filename", F.lit("f"))
    after = search(index, asked, 5, filtered=True, overfetch=5)
    fetched = {(q, i) for q, _, i in brute(vectors, queries, 25)}
    assert {(q, i) for q, _, i in triples(after)} == {(q, i) for q, _, i in expected if (q, i) in fetched}


def test_edges(spark):
    rng = np.random.default_rng(4)
    vectors, queries = unit(rng, 3), unit(rng, 2)
    table, asked = vector_table(spark, vectors), query_table(spark, queries)
    assert top_k(table.limit(0), asked).count() == 0
    assert top_k(table, asked.limit(0)).count() == 0
    assert top_k(table, asked, 10).count() == 6
    with_null = table.unionByName(table.limit(1).withColumn("embedding", F.lit(None).cast("array<float>")))
    assert top_k(with_null, asked, 10).count() == 6


def test_string_ids(spark):
    rng = np.random.default_rng(5)
    vectors = unit(rng, 30)
    table = vector_table(spark, vectors).withColumn("doc_id", F.concat(F.lit("d/"), F.col("doc_id").cast("string")))
    hits = top_k(table, query_table(spark, vectors[:3]).withColumn("qid", F.concat(F.lit("q"), "qid")), 1)
    assert sorted((r.qid, r.doc_id) for r in hits.collect()) == [("q0", "d/0"), ("q1", "d/1"), ("q2", "d/2")]


def test_index_round_trip_and_tags(spark, tmp_path):
    docs = spark.createDataFrame(
        [(i, None if i == 2 else "cat", f"f{i}", "word " * 200) for i in range(4)],
        "doc_id bigint, category string, filename string, cleaned_text string",
    )
    embedded = embed_documents(docs, dimension=32)
    save_embeddings(embedded, str(tmp_path / "embeddings"))
    vectors = load_embeddings(spark, str(tmp_path / "embeddings"))
    assert vectors.columns == ["doc_id", "embedding"]
    index = build_index(docs, vectors)
    assert index.agg(F.max(F.length("snippet"))).first()[0] == 500
    save_index(index.filter("doc_id < 3"), str(tmp_path / "index"))
    append_index(index.filter("doc_id = 3"), str(tmp_path / "index"))
    loaded = load_index(spark, str(tmp_path / "index"))
    assert loaded.count() == 4 and load_index(spark, str(tmp_path / "absent")) is None
    tags = spark.createDataFrame([(0, 7), (1, 3)], "doc_id bigint, dominant_cluster int")
    tagged = {r.doc_id: r.dominant_cluster for r in tag_clusters(loaded, tags).collect()}
    assert tagged == {0: 7, 1: 3, 2: None, 3: None}
    question = spark.createDataFrame([(1, "word")], "qid bigint, query string")
    hits = search(loaded, embed_documents(question, "query", 32), 3)
    rows = {r.doc_id: r for r in hits.collect()}
    assert rows[2].category == "unknown" and rows[0].category == "cat" and len(rows[0].text) == 500


def test_rank_limit_before_shuffle(spark):
    rng = np.random.default_rng(6)
    hits = top_k(vector_table(spark, unit(rng, 20)), query_table(spark, unit(rng, 2)))
    plan = hits._jdf.queryExecution().toString()
    physical = plan[plan.index("Physical Plan") :]
    assert physical.count("WindowGroupLimit") == 2 and "CartesianProduct" not in physical and "NestedLoop" not in physical


def test_hash_embedding(spark):
    df = spark.createDataFrame([(0, "Alpha beta beta"), (1, ""), (2, None), (3, "!!"), (4, "beta alpha BETA")], "i int, t string")
    rows = [r[0] for r in df.orderBy("i").select(hash_embedding(F.col("t"), 24)).collect()]
    assert abs(np.linalg.norm(rows[0]) - 1) < 1e-6 and rows[0] == rows[4]
    assert rows[1] == [0.0] * 24 == rows[3] and rows[2] is None


def test_encoder_hook(spark):
    def encoder():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    df = spark.createDataFrame([(i, "x" * i) for i in range(150)], "i int, cleaned_text string")
    rows = embed_documents(df, encoder=encoder, batch_size=64).orderBy("i").collect()
    for row in rows:
        assert np.allclose(row.embedding, np.array([row.i, 1.0]) / np.hypot(row.i, 1.0))


def test_vector_expressions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0], [0.2, 0.4, 0.4])], "a array<float>, z array<float>, p array<double>")
    row = df.select(
        dot(F.col("a"), F.col("a")).alias("dot"),
        l2_normalize(F.col("a")).alias("unit"),
        l2_normalize(F.col("z")).alias("zero"),
        route(F.col("p"), 2).alias("route"),
        probability_map(F.col("p")).alias("map"),
    ).first()
    assert row.dot == 25.0 and np.allclose(row.unit, [0.6, 0.8]) and row.zero == [0.0, 0.0]
    assert row.route == [1, 2] and row.map == {"cluster_1": 0.4, "cluster_2": 0.4, "cluster_0": 0.2}


def test_products_in_single_precision_decide_like_exact_ones():
    """What single precision cannot tell apart is scored again; the rest is compared in single precision, and not at all if it is later."""
    import pyarrow as pa

    from corpusloom.functions.blocks import for_products, to_lists
    from corpusloom.operators.lookup import best_of_cell
    from corpusloom.operators.replay import _decide
    from corpusloom.operators.search import best_of_vectors

    rng = np.random.default_rng(33)
    for scale in (1e-3, 1.0, 1e6):
        left, right = rng.normal(size=(30, 50)) * scale, rng.normal(size=(40, 50))
        a, b, margin = for_products(left, right)
        assert a.dtype == b.dtype == np.float32 and (np.abs(a @ b.T - left @ right.T) <= margin[:, None]).all()
    assert for_products(left, np.full((2, 50), np.nan))[0].dtype == for_products(left, np.full((2, 50), 1e30))[1].dtype == np.float64

    base = unit(rng, 20, 24).astype(float)
    # Differences far below single precision; later ids are the nearer ones.
    vectors = np.concatenate([base * (1 + i * 1e-10) for i in range(12)])
    scores = np.array([[float(np.add.accumulate(q * v)[-1]) for v in vectors] for q in base])
    held = pa.table({"doc_id": pa.array(range(240)), "embedding": to_lists(vectors, pa.float64())})
    asked = pa.table({"qid": pa.array([7 * i + 100 for i in range(20)]), "embedding": to_lists(base, pa.float64())})
    for step in (3, 4096):
        found = best_of_vectors(4, False, step)(asked, held).to_pylist()
        for q in range(20):
            mine = sorted((-r["score"], r["doc_id"]) for r in found if r["qid"] == 7 * q + 100)
            assert mine == sorted((-s, i) for i, s in enumerate(scores[q]))[:4]
    limit = float(scores[3, 63])  # reached by the later copies of one vector only
    asked = asked.append_column("route", pa.nulls(20, pa.list_(pa.int32())))
    entries = held.rename_columns(["entry_id", "embedding"]).append_column("dominant_cluster", pa.array([0] * 240, pa.int32()))
    reached = (scores >= limit) & (np.arange(240)[None, :] < np.array(asked["qid"])[:, None])
    best = {r["qid"]: (r["entry_id"], r["score"]) for r in best_of_cell(True, limit)(asked, entries).to_pylist()}
    assert best == {7 * q + 100: min(((i, scores[q, i]) for i in np.flatnonzero(reached[q])), key=lambda x: (-x[1], x[0])) for q in range(20) if reached[q].any()}
    is_open = np.arange(240) % 2 == 0
    told = {r["qid"]: (r["answered"], r["blocked"]) for r in _decide(limit)(asked, entries.append_column("is_open", pa.array(is_open))).to_pylist()}
    assert told == {7 * q + 100: (bool((reached[q] & ~is_open).any()), bool((reached[q] & is_open).any())) for q in range(20) if reached[q].any()}


def test_scores_of_a_cell_stay_in_the_cache(monkeypatch):
    """A cell of many queries and vectors compares few of them at a time, and finds the same."""
    import pyarrow as pa

    from corpusloom.functions.blocks import to_lists
    from corpusloom.operators import search as searching

    rng = np.random.default_rng(34)
    vectors, queries = unit(rng, 3000, 8), unit(rng, 700, 8)
    held = pa.table({"doc_id": pa.array(range(3000)), "embedding": to_lists(vectors, pa.float32())})
    asked = pa.table({"qid": pa.array(range(700)), "embedding": to_lists(queries, pa.float32())})
    sizes, plain = [], searching._best_candidates
    monkeypatch.setattr(searching, "_best_candidates", lambda scores, *rest: sizes.append(scores.nbytes) or plain(scores, *rest))
    found = searching.best_of_vectors(3, False)(asked, held).to_pylist()
    assert max(sizes) <= 2_000_000
    exact = queries.astype(float) @ vectors.astype(float).T
    mine = {(r["qid"], r["doc_id"]) for r in found}
    assert mine == {(q, int(i)) for q in range(700) for i in np.argsort(-exact[q], kind="stable")[:3]}
