"""The registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import (
    CLEANING_RULES,
    add_cleaned_text,
    clean_text,
    normalize_whitespace,
    remove_non_ascii,
)
from corpusloom.functions.vectors import l2_normalize, probability_map
from corpusloom.operators import dedup
from corpusloom.operators import profile as figures
from corpusloom.operators.clusters import (
    ClusterModel,
    find_optimal_clusters,
    load_model,
    predict,
    save_model,
    tag_with_model,
    train,
)
from corpusloom.operators.dedup import dedup_keep_first, removed_per_step
from corpusloom.operators.embed import embed_documents
from corpusloom.operators.lookup import lookup, with_route
from corpusloom.operators.mixture import (
    Centers,
    Mixture,
    expectation_maximization,
    fit_mixtures,
    mixture_from_labels,
    mixture_step,
    one_pass,
)
from corpusloom.operators.project import explained_variance, fit_projection, project
from corpusloom.operators.replay import replay_log, replay_with_retention
from corpusloom.operators.report import (
    cluster_composition,
    confidence_bands,
    membership_check,
    top_three_report,
)
from corpusloom.operators.sample import hash_sample
from corpusloom.operators.search import build_index, search, tag_clusters, top_k
from corpusloom.operators.selection import aic, bic, select_k, silhouette
from corpusloom.operators.state import admit, cache_stats, empty_cache, retain, touch
from corpusloom.operators.sweep import pair_similarity, threshold_sweep
from corpusloom.plans.answer import answer_queries, split_empty
from corpusloom.plans.clean_job import clean_corpus, corpus_summary, run_clean_job
from corpusloom.session import spread, stage, stage_path
from corpusloom.sources.posts import RAW_SCHEMA, load_cleaned, save_cleaned, save_cleaned_json, save_raw, write_posts
from corpusloom.sources.tables import append_index, load_embeddings, load_index, save_composition, save_embeddings, save_index, save_selection
from corpusloom.streaming.cache_stream import answer_stream, flush_stream, read_responses, stream_stats

# Posts made of a document: header with sender and groups, a quoted line, the text, a signature.
# The same expression text is valid in Spark SQL and in the SQL of the checks.
POST_TEXT = (
    "'From: u' || doc_id || '@mail.example.com' || chr(10) || 'Newsgroups: ' || source"
    " || CASE WHEN doc_id % 3 = 0 THEN ',x.misc' ELSE '' END || chr(10) || 'Subject: s' || chr(10) || chr(10)"
    " || CASE WHEN doc_id % 2 = 0 THEN '> quoted line' || chr(10) ELSE '' END || text"
    " || CASE WHEN doc_id % 5 < 2 THEN chr(10) || '-- ' || chr(10) || 'sig' ELSE '' END"
)

# The questions of the search smoke test.
SMOKE_QUERIES = [
    "What is the best graphics card for gaming?",
    "Is there life on other planets?",
    "How does encryption work?",
    "What are the rules of baseball?",
    "I want to sell my old car",
]

LRU_ENTRIES = 300
GMM_ROUNDS = 5
BLOCK = 300
GRID = (2, 3, 5)
GRID_ROUNDS = 2
SMALL_CACHE = 200
SLICE = 150
EMBED_DIMENSION = 384


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(_table(spark, sf, "documents"), "doc_id")


def _plain_posts(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).select(
        "doc_id", F.col("source").alias("category"), F.col("doc_id").cast("string").alias("filename"), "text"
    )


def _posts(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).select(
        "doc_id",
        F.col("source").alias("category"),
        F.col("doc_id").cast("string").alias("filename"),
        F.expr(POST_TEXT).alias("text"),
    )


def _mixed_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Every document twice, bare and as a post: exact copies, body copies and short texts together."""
    posts = _posts(spark, sf).withColumn("filename", F.concat(F.lit("p"), "filename"))
    return _plain_posts(spark, sf).unionByName(posts)


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("doc_id"),
        "embedding",
        "label",
        F.concat(F.lit("label_"), F.col("label").cast("string")).alias("category"),
    )


def _round(*names: str, places: int = 6) -> list[Column]:
    return [F.round(name, places).alias(name) for name in names]


# --- cleaning, deduplication, profile -------------------------------------------------------------


def clean_posts(spark: SparkSession, sf: str) -> DataFrame:
    return add_cleaned_text(_posts(spark, sf)).select("doc_id", "cleaned_text")


def clean_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Each cleaning rule by itself, over posts and pages; the whitespace rule expects ASCII text."""
    pages = spread(_table(spark, sf, "pages"), "page_id")
    texts = _posts(spark, sf).select(F.concat(F.lit("d"), "filename").alias("id"), "text").unionByName(
        pages.select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"), F.col("html").alias("text"))
    )
    results = {}
    for rule in CLEANING_RULES:
        source = remove_non_ascii(F.col("text")) if rule is normalize_whitespace else F.col("text")
        results[rule.__name__] = F.md5(rule(source))
    return texts.select("id", *[result.alias(name) for name, result in results.items()])


def clean_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = spread(_table(spark, sf, "pages"), "page_id")
    return pages.select("page_id", clean_text(F.col("html")).alias("cleaned_text"))


def dedup_exact(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_keep_first(_plain_posts(spark, sf)).select("category", "filename", "text")


def dedup_body(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = stage(add_cleaned_text(_posts(spark, sf)).select("category", "filename", "cleaned_text"), "cleaned")
    return dedup_keep_first(cleaned, "cleaned_text").select("category", "filename", "cleaned_text")


def corpus_clean_job(spark: SparkSession, sf: str) -> DataFrame:
    return clean_corpus(_posts(spark, sf))


def clean_step_counts(spark: SparkSession, sf: str) -> DataFrame:
    return removed_per_step(_mixed_posts(spark, sf))


def corpus_summary_query(spark: SparkSession, sf: str) -> DataFrame:
    summary = corpus_summary(_mixed_posts(spark, sf))
    return summary.select("documents", "categories", *_round("mean_length"), "min_length", "max_length")


def docs_per_category(spark: SparkSession, sf: str) -> DataFrame:
    return figures.docs_per_category(_plain_posts(spark, sf))


def load_totals(spark: SparkSession, sf: str) -> DataFrame:
    return figures.load_totals(_plain_posts(spark, sf))


def first_document(spark: SparkSession, sf: str) -> DataFrame:
    return figures.first_document(_plain_posts(spark, sf))


def duplicate_counts(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.duplicate_counts(figures.post_features(_mixed_posts(spark, sf), "text_key", "body_key"))


def _profile_part(part: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        one_row = figures.profile_part(_posts(spark, sf), part)
        return one_row.select(*[F.round(F.col(c).cast("double"), 6).alias(c) for c in one_row.columns])

    return query


def profile_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = spread(_table(spark, sf, "pages"), "page_id").select(F.col("html").alias("text"))
    return figures.profile_part(pages, "markup")


def profile_all(spark: SparkSession, sf: str) -> DataFrame:
    return figures.profile_all(_mixed_posts(spark, sf)).select("metric", *_round("value"))


def saved_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaned corpus through its files: raw and cleaned tables, then the JSON form read back."""
    folder = stage_path(spark, "corpus")
    save_raw(_posts(spark, sf), f"{folder}/raw")
    save_cleaned(clean_corpus(spark.read.schema(RAW_SCHEMA).parquet(f"{folder}/raw")), f"{folder}/cleaned")
    save_cleaned_json(load_cleaned(spark, f"{folder}/cleaned"), f"{folder}/json")
    return spark.read.schema("category string, filename string, cleaned_text string").json(f"{folder}/json")


def posts_tree_job(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as a tree of files, loaded, cleaned and counted; the counts with a digest of what was written."""
    folder = stage_path(spark, "posts-tree")
    write_posts(_mixed_posts(spark, sf), f"{folder}/tree")
    counts = run_clean_job(spark, f"{folder}/tree", f"{folder}/cleaned", f"{folder}/json")
    written = load_cleaned(spark, f"{folder}/cleaned").agg(
        F.count(F.lit(1)).alias("written"), F.sum(F.length("text")).alias("characters"), F.sum(F.length("cleaned_text")).alias("cleaned_characters"),
        F.min(F.concat_ws("/", "category", "filename")).alias("first_file"),
    )
    # Two tables of one row as one row: each lacks the other's columns.
    columns = [*counts.columns, *written.columns]
    return counts.unionByName(written, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in columns])


def sample_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The sample that the silhouette draws, drawn from the documents."""
    return hash_sample(_plain_posts(spark, sf).select("doc_id", "category"))


def sample_some(spark: SparkSession, sf: str) -> DataFrame:
    """A sample of a third of the documents."""
    docs = _plain_posts(spark, sf).select("doc_id", "category")
    return hash_sample(docs, docs.count() // 3, seed=7)


def rejected_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Turns of the conversations that can and cannot be asked, by role."""
    turns = _table(spark, sf, "conversations").select("role", F.col("text").alias("query"))
    valid, rejected = split_empty(turns)
    both = valid.select("role", F.lit(True).alias("valid")).unionByName(rejected.select("role", F.lit(False).alias("valid")))
    return both.groupBy("role").agg(F.count_if("valid").alias("valid"), F.count_if(~F.col("valid")).alias("rejected"))


# --- vectors --------------------------------------------------------------------------------------


def _indexed_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Vector table of the cleaned documents, staged: text is hashed once."""
    docs = add_cleaned_text(_plain_posts(spark, sf))
    return stage(build_index(embed_documents(docs, dimension=EMBED_DIMENSION)), "index")


def hash_embed(spark: SparkSession, sf: str) -> DataFrame:
    docs = add_cleaned_text(_plain_posts(spark, sf))
    digits = F.transform("embedding", lambda x: F.round(x.cast("double") * 1_000_000).cast("bigint").cast("string"))
    embedded = embed_documents(docs, dimension=EMBED_DIMENSION)
    return embedded.select("doc_id", F.array_join(digits, ",").alias("embedding_e6"))


def _label_queries(vectors: DataFrame) -> DataFrame:
    """The mean direction of each label as a query that may look within its label only."""
    mean = Summarizer.mean(array_to_vector(F.col("embedding").cast("array<double>")))
    return vectors.groupBy("label").agg(vector_to_array(mean).alias("mean")).select(
        F.col("label").cast("bigint").alias("qid"),
        l2_normalize(F.col("mean")).alias("embedding"),
        F.concat(F.lit("label_"), F.col("label").cast("string")).alias("category_filter"),
    )


def topk_search(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _vectors(spark, sf)
    return top_k(vectors, _label_queries(vectors)).select("qid", "rank", "doc_id", *_round("score"))


def topk_all(spark: SparkSession, sf: str) -> DataFrame:
    """More hits asked for than there are vectors: every query gets all of them."""
    vectors = _vectors(spark, sf)
    hits = top_k(vectors, _label_queries(vectors), k=vectors.count() + 10)
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "doc_id")
    placed = hits.withColumn("place", F.row_number().over(order))
    return placed.groupBy("qid").agg(
        F.count(F.lit(1)).alias("hits"), F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"),
        F.bool_and(F.col("place") == F.col("rank")).alias("in_order"),
    )


def topk_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors and their paraphrases as queries, in blocks that meet the vectors apart."""
    queries = stage(_query_log(spark, sf).select("qid", "embedding"), "many-queries")
    hits = top_k(_vectors(spark, sf), queries, k=3, query_rows=BLOCK)
    return hits.select("qid", "rank", "doc_id", *_round("score"))


def search_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """Hits in a vector table in which every third vector has no metadata."""
    vectors = _vectors(spark, sf)
    known = F.col("doc_id") % 3 != 0
    index = _label_index(vectors).withColumn("category", F.when(known, F.col("category")))
    index = index.withColumn("filename", F.when(known, F.col("filename"))).withColumn("snippet", F.when(known, F.lit("text")))
    hits = search(index, _label_queries(vectors))
    return hits.select("qid", "rank", "doc_id", "category", *_round("score"), "text", "filename")


def topk_none(spark: SparkSession, sf: str) -> DataFrame:
    """A search in a vector table without rows."""
    vectors = _vectors(spark, sf)
    return top_k(vectors.filter("doc_id < 0"), _label_queries(vectors)).agg(F.count(F.lit(1)).alias("hits"))


def topk_filtered(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _vectors(spark, sf)
    hits = top_k(vectors, _label_queries(vectors), filtered=True)
    return hits.select("qid", "rank", "doc_id", *_round("score"))


def _label_index(vectors: DataFrame) -> DataFrame:
    return vectors.withColumn("snippet", F.lit(None).cast("string")).withColumn("filename", F.col("doc_id").cast("string"))


def topk_overfetch(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _vectors(spark, sf)
    hits = search(_label_index(vectors), _label_queries(vectors), filtered=True, overfetch=5)
    return hits.select("qid", "rank", "doc_id", "category", *_round("score"), "text", "filename")


def smoke_search(spark: SparkSession, sf: str) -> DataFrame:
    questions = spark.createDataFrame(list(enumerate(SMOKE_QUERIES)), "qid bigint, query string")
    queries = embed_documents(questions, "query", EMBED_DIMENSION)
    hits = search(_indexed_documents(spark, sf), queries, k=3)
    return hits.select("qid", "rank", "doc_id", "category", *_round("score"), "text", "filename")


def saved_index(spark: SparkSession, sf: str) -> DataFrame:
    """A vector for every document, saved and loaded, joined to the documents, written in two appends, loaded."""
    folder = stage_path(spark, "vectors")
    docs = _plain_posts(spark, sf).withColumnRenamed("text", "cleaned_text")
    vectors = _vectors(spark, sf).select("doc_id", "embedding")
    save_embeddings(_with_vector(spark, sf, docs.select("doc_id"), vectors), f"{folder}/embeddings")
    index = build_index(docs, load_embeddings(spark, f"{folder}/embeddings"))
    long = F.length("snippet") >= 500
    save_index(index.filter(long), f"{folder}/index")
    append_index(index.filter(~long), f"{folder}/index")
    loaded = load_index(spark, f"{folder}/index")
    return loaded.select("doc_id", "category", "filename", "snippet", F.size("embedding").alias("dimension"))


# --- clusters -------------------------------------------------------------------------------------


def _label_model(vectors: DataFrame) -> ClusterModel:
    return ClusterModel(mixture_from_labels(vectors))


def _assigned(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _vectors(spark, sf)
    return _label_model(vectors).predict(vectors)


def _assigned_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with the assignment of a vector, and its source as category."""
    return _with_vector(spark, sf, _table(spark, sf, "documents").select("doc_id", F.col("source").alias("category")), _assigned(spark, sf).drop("category"))


def _with_vector(spark: SparkSession, sf: str, docs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Documents and vectors, joined by the document's id modulo the number of vector ids."""
    count = _table(spark, sf, "embeddings").agg(F.max("vec_id") + 1).first()[0]
    vector = vectors.withColumnRenamed("doc_id", "vec_id")
    return docs.withColumn("vec_id", F.col("doc_id") % count).join(vector, "vec_id").drop("vec_id")


def dominant_cluster(spark: SparkSession, sf: str) -> DataFrame:
    return _assigned(spark, sf).select(
        "doc_id", "dominant_cluster", F.round(F.array_max("cluster_probs"), 6).alias("dominant_prob")
    )


def confidence_bands_query(spark: SparkSession, sf: str) -> DataFrame:
    return confidence_bands(_assigned(spark, sf))


def cluster_composition_query(spark: SparkSession, sf: str) -> DataFrame:
    composition = cluster_composition(_assigned_sources(spark, sf), n_clusters=12)
    named = F.transform("top_categories", lambda e: F.concat(e["category"], F.lit(":"), e["n"].cast("string")))
    return composition.select("cluster", "total_docs", F.array_join(named, ",").alias("top_categories"))


def cluster_report(spark: SparkSession, sf: str) -> DataFrame:
    return top_three_report(cluster_composition(_assigned_sources(spark, sf), n_clusters=10))


def _map_text(probabilities: Column) -> Column:
    entries = F.transform(
        F.map_entries(probabilities), lambda e: F.concat(e["key"], F.lit("="), F.format_string("%.4f", e["value"]))
    )
    return F.array_join(entries, ",")


def prob_map_top5(spark: SparkSession, sf: str) -> DataFrame:
    return _assigned(spark, sf).select("doc_id", _map_text(probability_map(F.col("cluster_probs"))).alias("probabilities"))


def membership_check_query(spark: SparkSession, sf: str) -> DataFrame:
    return membership_check(_assigned(spark, sf)).select("n_documents", "n_clusters", "is_distribution")


def tag_clusters_query(spark: SparkSession, sf: str) -> DataFrame:
    """Every document in the vector table, tagged where a vector of the same id has a cluster."""
    docs = _plain_posts(spark, sf)
    index = docs.select(
        "doc_id",
        "category",
        "filename",
        F.substring("text", 1, 500).alias("snippet"),
        F.lit(None).cast("int").alias("dominant_cluster"),
        F.lit(None).cast("array<float>").alias("embedding"),
    )
    return tag_clusters(index, _assigned(spark, sf)).select("doc_id", "snippet", "dominant_cluster")


def tag_index(spark: SparkSession, sf: str) -> DataFrame:
    """The vector table tagged in place by the model."""
    vectors = _vectors(spark, sf)
    tagged = tag_with_model(_label_index(vectors).withColumn("dominant_cluster", F.lit(None).cast("int")), _label_model(vectors))
    return tagged.select("doc_id", "category", "dominant_cluster")


def _points(vectors: DataFrame) -> DataFrame:
    return vectors.select("doc_id", F.col("embedding").alias("features"), "label")


def gmm_one_step(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _vectors(spark, sf)
    return _parameter_rows(spark, mixture_step(_points(vectors), mixture_from_labels(vectors))[0])


def gmm_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """Several rounds of fitting from the labels; the same rounds as a fit from random starts."""
    vectors = _vectors(spark, sf)
    fits = expectation_maximization(_points(vectors), {0: mixture_from_labels(vectors)}, max_iter=GMM_ROUNDS, tol=0.0)
    return _parameter_rows(spark, fits[0].mixture)


def _parameter_rows(spark: SparkSession, mixture: Mixture) -> DataFrame:
    rows = ClusterModel(mixture).parameters(spark)
    elements = rows.select("k", "weight", F.posexplode(F.arrays_zip("mean", "var")).alias("d", "e"))
    return elements.select(
        "k",
        "d",
        *_round("weight"),
        F.round("e.mean", 6).alias("mean"),
        F.round("e.var", 6).alias("var"),
    )


def bic_aic(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _vectors(spark, sf)
    mixture = mixture_from_labels(vectors)
    statistics = one_pass(_points(vectors), {0: mixture})[0]
    row = spark.createDataFrame(
        [(mixture.k, statistics.n, statistics.log_likelihood, mixture.parameter_count)],
        "k int, n bigint, log_likelihood double, parameters int",
    )
    likelihood, parameters = F.col("log_likelihood"), F.col("parameters")
    return row.select(
        "k",
        "n",
        F.round(likelihood, 4).alias("log_likelihood"),
        F.round(bic(likelihood, parameters, F.col("n")), 4).alias("bic"),
        F.round(aic(likelihood, parameters), 4).alias("aic"),
    )


def silhouette_sample(spark: SparkSession, sf: str) -> DataFrame:
    score = silhouette(hash_sample(_points(_vectors(spark, sf))), ["label"])
    return score.select("labelling", *_round("silhouette"), "n")


def pca_variance(spark: SparkSession, sf: str) -> DataFrame:
    """Shares of all components: their sum, and the sum of squares, which the covariances have too."""
    vectors = _vectors(spark, sf)
    dimension = vectors.select(F.max(F.size("embedding"))).first()[0]
    shares = explained_variance(fit_projection(vectors, dimension))
    rows = spark.createDataFrame(list(enumerate(shares)), "component int, share double")
    ordered = F.array_sort(F.collect_list(F.struct("component", "share")))
    falling = F.forall(F.sequence(F.lit(1), F.size("listed") - 1), lambda i: F.col("listed")[i]["share"] <= F.col("listed")[i - 1]["share"] + 1e-12)
    summed = rows.agg(
        F.count(F.lit(1)).alias("components"), F.round(F.sum("share"), 6).alias("share_sum"),
        F.round(F.sum(F.col("share") * F.col("share")), 6).alias("share_squares"), ordered.alias("listed"),
    )
    return summed.select("components", "share_sum", "share_squares", falling.alias("falling"))


def pca_projection(spark: SparkSession, sf: str) -> DataFrame:
    """What a full projection must keep: centered, uncorrelated components with the variance of the vectors."""
    vectors = _vectors(spark, sf)
    dimension = vectors.select(F.max(F.size("embedding"))).first()[0]
    points = project(vectors, fit_projection(vectors, dimension))
    mean = Summarizer.mean(array_to_vector("features"))
    variance = Summarizer.variance(array_to_vector("features"))
    rows = points.agg(
        F.count(F.lit(1)).alias("n"), vector_to_array(mean).alias("mean"), vector_to_array(variance).alias("variance"),
        F.corr(F.col("features")[0], F.col("features")[1]).alias("correlation"),
    )
    total = F.aggregate("variance", F.lit(0.0), lambda s, x: s + x)
    return rows.select(
        "n",
        F.round(total, 6).alias("total_variance"),
        (F.array_max(F.transform("mean", lambda x: F.abs(x))) < 1e-9).alias("centered"),
        (F.abs("correlation") < 1e-9).alias("uncorrelated"),
    )


def saved_model(spark: SparkSession, sf: str) -> DataFrame:
    """A model saved with its memberships, loaded, and applied to the query log."""
    vectors = _vectors(spark, sf)
    model = _label_model(vectors)
    folder = stage_path(spark, "model")
    save_model(model, spark, folder, model.predict(vectors))
    loaded, probs = load_model(spark, folder, projected=False)
    asked = predict(_query_log(spark, sf), loaded)
    known = probs.select((F.col("doc_id") * 2).alias("qid"), F.size("cluster_probs").alias("known_clusters"))
    return asked.join(known, "qid", "left").select(
        "qid", "dominant_cluster", F.round(F.array_max("cluster_probs"), 6).alias("dominant_prob"), "known_clusters"
    )


def saved_reports(spark: SparkSession, sf: str) -> DataFrame:
    """The composition report written as JSON and read back."""
    assigned = _assigned_sources(spark, sf)
    path = stage_path(spark, "report")
    save_composition(confidence_bands(assigned), cluster_composition(assigned, 10), path)
    clusters = spark.read.schema(
        "cluster int, total_docs bigint, top_categories array<struct<category:string,n:bigint>>"
    ).json(f"{path}/clusters")
    named = F.transform("top_categories", lambda e: F.concat(e["category"], F.lit(":"), e["n"].cast("string")))
    return clusters.select("cluster", "total_docs", F.array_join(named, ",").alias("top_categories"))


def saved_bands(spark: SparkSession, sf: str) -> DataFrame:
    """The confidence bands of the report, read back."""
    assigned = _assigned(spark, sf)
    path = stage_path(spark, "report")
    bands = confidence_bands(assigned)
    save_composition(bands, cluster_composition(assigned, 10), path)
    return spark.read.schema(bands.schema).json(f"{path}/bands")


def gmm_fit(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _vectors(spark, sf)
    return membership_check(train(vectors, n_clusters=20).predict(vectors)).select(
        "n_documents", "n_clusters", "is_distribution"
    )


def k_selection(spark: SparkSession, sf: str) -> DataFrame:
    selection, _ = find_optimal_clusters(_vectors(spark, sf))
    return selection.table


def _ordered_starts(vectors: DataFrame, ks: Sequence[int]) -> dict[int, Centers]:
    """The first vectors in the order of a hash of their ids, as many as the largest count; a center each."""
    first = hash_sample(vectors, max(ks)).select("embedding").collect()
    rows = np.array([row[0] for row in first], dtype=np.float32).astype(float)
    return {k: Centers(rows[:k]) for k in ks}


def k_selection_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """The grid from starts that SQL can state, with a given number of rounds, on the vectors themselves."""
    vectors = _vectors(spark, sf)
    points = stage(_points(vectors), "points")
    chosen = select_k(points, GRID, max_iter=GRID_ROUNDS, tol=0.0, starts=_ordered_starts(vectors, GRID))
    folder = stage_path(spark, "selection")
    save_selection(chosen.table, folder)
    saved = spark.read.schema("k int, bic double, aic double, silhouette double, optimal boolean, at_edge boolean").json(folder)
    return saved.select("k", *_round("bic", "aic", places=3), *_round("silhouette", places=6), "optimal", "at_edge")


def train_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """A model trained at one count from given starts for a given number of rounds, saved, loaded and applied."""
    vectors = _vectors(spark, sf)
    points = stage(_points(vectors), "points")
    fit = fit_mixtures(points, [GRID[-1]], max_iter=GRID_ROUNDS, tol=0.0, starts=_ordered_starts(vectors, GRID[-1:]))
    folder = stage_path(spark, "trained")
    save_model(ClusterModel(fit[GRID[-1]].mixture), spark, folder)
    loaded, _ = load_model(spark, folder, projected=False)
    return predict(vectors, loaded).select("doc_id", "dominant_cluster", F.round(F.array_max("cluster_probs"), 4).alias("dominant_prob"))


def saved_projection(spark: SparkSession, sf: str) -> DataFrame:
    """A model with its projection, saved and loaded: the same clusters for the same vectors, and how many."""
    vectors = _vectors(spark, sf)
    projection = fit_projection(vectors, 8)
    points = stage(project(vectors, projection), "projected")
    model = ClusterModel(mixture_from_labels(points, features="features"), projection)
    folder = stage_path(spark, "projected-model")
    save_model(model, spark, folder)
    loaded, _ = load_model(spark, folder)
    before = model.predict(vectors).select("doc_id", F.col("dominant_cluster").alias("before"))
    both = loaded.predict(vectors).select("doc_id", "dominant_cluster", "cluster_probs").join(before, "doc_id")
    return both.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("before") == F.col("dominant_cluster")).alias("same"),
        F.min(F.size("cluster_probs")).alias("n_clusters"),
    )


# --- cache ----------------------------------------------------------------------------------------


def _neighbours(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    """Each vector with the ones of the next two ids (its own past the end); ``rows`` may be a stream."""
    table = _table(spark, sf, "embeddings")
    vectors = (table if rows is None else rows).select("vec_id", F.col("embedding").cast("array<double>").alias("v"))

    def shifted(by: int) -> DataFrame:
        vector = F.col("embedding").cast("array<double>").alias(f"v{by}")
        return table.select((F.col("vec_id") - by).alias("vec_id"), vector)

    joined = reduce(lambda df, by: df.join(shifted(by), "vec_id", "left"), [1, 2], vectors)
    return joined.select("vec_id", "v", F.coalesce("v1", "v").alias("v1"), F.coalesce("v2", "v").alias("v2"))


def _paraphrase(neighbours: DataFrame) -> Column:
    """The vector mixed with the next one, in shares that put similarities on both sides of the threshold."""
    weight = F.lit(0.2) + F.lit(0.1) * (F.col("vec_id") % 13)
    return l2_normalize(F.zip_with("v", "v1", lambda a, b: a + weight * b))


def _unrelated() -> Column:
    return l2_normalize(F.zip_with("v1", "v2", lambda a, b: a + b))


def _query_log(spark: SparkSession, sf: str, vectors: DataFrame | None = None) -> DataFrame:
    """Two queries per vector, the vector and its paraphrase, at the time of the event of the same id, or so many seconds after 1970."""
    times = _table(spark, sf, "events").select(F.col("event_id").alias("vec_id"), F.col("ts").cast("timestamp").alias("ts"))
    rows = _neighbours(spark, sf, vectors).join(times, "vec_id", "left")
    rows = rows.withColumn("ts", F.coalesce("ts", F.timestamp_seconds("vec_id")))
    both = F.array(
        F.struct(F.lit(0).alias("i"), F.col("v").alias("embedding")),
        F.struct(F.lit(1).alias("i"), _paraphrase(rows).alias("embedding")),
    )
    return rows.select("vec_id", "ts", F.inline(both)).select(
        (F.col("vec_id") * 2 + F.col("i")).alias("qid"),
        F.concat(F.lit("q"), (F.col("vec_id") * 2 + F.col("i")).cast("string")).alias("query"),
        "ts",
        "embedding",
    )


def _cached_originals(log: DataFrame) -> DataFrame:
    """The original queries as cache entries."""
    return log.filter(F.col("qid") % 2 == 0).select(
        F.col("qid").alias("entry_id"), "query", "embedding", "dominant_cluster", F.col("ts").alias("last_accessed")
    )


def _probes(log: DataFrame) -> DataFrame:
    return log.filter(F.col("qid") % 2 == 1)


def _assigned_log(spark: SparkSession, sf: str) -> DataFrame:
    return stage(_label_model(_vectors(spark, sf)).predict(_query_log(spark, sf)), "log")


def pair_similarity_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = _neighbours(spark, sf).withColumnRenamed("vec_id", "pair_id")
    originals = rows.select("pair_id", F.col("v").alias("embedding"))
    paraphrases = rows.withColumn("vec_id", F.col("pair_id")).select("pair_id", _paraphrase(rows).alias("embedding"))
    return pair_similarity(originals, paraphrases).select("pair_id", *_round("similarity"))


def cache_lookup(spark: SparkSession, sf: str) -> DataFrame:
    log = _assigned_log(spark, sf)
    found = lookup(_probes(log), _cached_originals(log))
    return found.select("qid", "cache_hit", "matched_query", *_round("score"), "dominant_cluster")


def cache_stats_query(spark: SparkSession, sf: str) -> DataFrame:
    log = _assigned_log(spark, sf)
    entries = _cached_originals(log)
    return cache_stats(lookup(_probes(log), entries), entries)


def cache_admit(spark: SparkSession, sf: str) -> DataFrame:
    """The query log filed in an empty cache: entries by cluster."""
    log = _assigned_log(spark, sf).withColumn(
        "result", F.expr("array()").cast("array<struct<category:string,score:double,text:string>>")
    )
    entries = admit(empty_cache(spark), log)
    return entries.groupBy("dominant_cluster").agg(
        F.count(F.lit(1)).alias("entries"), F.min("entry_id").alias("first_entry"), F.max("entry_id").alias("last_entry")
    )


def cache_lru(spark: SparkSession, sf: str) -> DataFrame:
    log = _assigned_log(spark, sf)
    entries, probes = _cached_originals(log), _probes(log)
    hits = lookup(probes, entries).filter("cache_hit").join(probes.select("qid", "ts"), "qid")
    later = hits.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY"))
    kept = retain(touch(entries, later), LRU_ENTRIES)
    return kept.select("entry_id", "query", F.date_format("last_accessed", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_accessed"))


def cache_sweep(spark: SparkSession, sf: str) -> DataFrame:
    rows = stage(_neighbours(spark, sf), "neighbours")
    entries = rows.select(
        F.col("vec_id").alias("entry_id"),
        F.col("v").alias("embedding"),
        F.lit(0).alias("dominant_cluster"),
    )
    both = F.array(
        F.struct(F.lit(0).alias("i"), F.lit("paraphrase").alias("kind"), _paraphrase(rows).alias("embedding")),
        F.struct(F.lit(1).alias("i"), F.lit("unrelated").alias("kind"), _unrelated().alias("embedding")),
    )
    probes = rows.select("vec_id", F.inline(both)).select(
        (F.col("vec_id") * 2 + F.col("i")).alias("qid"), "kind", "embedding"
    )
    sweep = threshold_sweep(probes, entries)
    return sweep.select("threshold", "hits", "misses", *_round("hit_rate"), "false_positives")


def cache_replay(spark: SparkSession, sf: str) -> DataFrame:
    log = with_route(_assigned_log(spark, sf))
    hits = replay_log(log).hits
    return log.select("qid").join(hits, "qid", "left").select(
        "qid", F.col("entry_id").isNotNull().alias("cache_hit"), "entry_id", *_round("score")
    )


def cache_evict(spark: SparkSession, sf: str) -> DataFrame:
    """All vectors, then all paraphrases, through a cache so small that most entries leave in between."""
    second = (F.col("qid") % 2).cast("bigint")
    log = _assigned_log(spark, sf).withColumn("qid", second * 1_000_000_000 + F.floor(F.col("qid") / 2))
    log = stage(with_route(log.withColumn("ts", F.timestamp_seconds("qid"))), "two-rounds")
    hits, _ = replay_with_retention(log, empty_cache(spark), SMALL_CACHE, SLICE)
    return log.select("qid").join(hits, "qid", "left").select(
        "qid", F.col("entry_id").isNotNull().alias("cache_hit"), "entry_id", *_round("score")
    )


def _flat_responses(responses: DataFrame) -> DataFrame:
    listed = F.transform("result", lambda e: F.concat(e["category"], F.lit(":"), F.format_string("%.4f", e["score"])))
    return responses.select(
        "qid",
        "cache_hit",
        "matched_query",
        "similarity_score",
        F.array_join(listed, ",").alias("result"),
        "dominant_cluster",
        _map_text(F.col("cluster_probabilities")).alias("probabilities"),
    )


def answer_log(spark: SparkSession, sf: str) -> DataFrame:
    """The whole query path over the vectors, with cluster routing."""
    vectors = _vectors(spark, sf)
    answers = answer_queries(_query_log(spark, sf), _label_index(vectors), _label_model(vectors))
    return _flat_responses(answers.responses)


def answer_conversations(spark: SparkSession, sf: str) -> DataFrame:
    """User turns as queries over the documents, both through the hashing embedding, without clusters; every miss stays in the cache."""
    turns = _table(spark, sf, "conversations").filter(F.col("role") == "user")
    queries = turns.select(
        (F.col("conv_id") * 2**32 + F.col("turn")).cast("bigint").alias("qid"),
        F.col("text").alias("query"),
        F.timestamp_seconds(F.col("conv_id")).alias("ts"),
    )
    answers = answer_queries(queries, _indexed_documents(spark, sf), max_entries=None, dimension=EMBED_DIMENSION)
    return _flat_responses(answers.responses).drop("probabilities")


def _stream_in_parts(spark: SparkSession, sf: str, folder: str, parts: list[Column]) -> DataFrame:
    """Run the streaming cache over the vectors, a micro-batch for each part of them; returns the responses."""
    vectors, table = _vectors(spark, sf), _table(spark, sf, "embeddings")
    source = f"{folder}/source"
    for part in parts:
        table.filter(part).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(source)
    answer_stream(_query_log(spark, sf, stream), _label_index(vectors), folder, _label_model(vectors)).awaitTermination()
    return read_responses(spark, folder)


def _thirds(spark: SparkSession, sf: str) -> list[Column]:
    third = _table(spark, sf, "embeddings").agg(F.floor(F.max("vec_id") / 3) + 1).first()[0]
    return [F.floor(F.col("vec_id") / third) == i for i in range(3)]


def cache_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The query log of ``answer_log`` as a stream of three files, each a micro-batch."""
    return _flat_responses(_stream_in_parts(spark, sf, stage_path(spark, "cache-stream"), _thirds(spark, sf)))


def cache_flush(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of the stream's cache after two parts of the log, a flush, and the third."""
    folder = stage_path(spark, "cache-flush")
    last = _table(spark, sf, "embeddings").agg(F.floor(F.max("vec_id") * 2 / 3) + 1).first()[0]
    half = F.floor(F.lit(last) / 2)
    _stream_in_parts(spark, sf, folder, [F.col("vec_id") < half, F.col("vec_id").between(half, last - 1)])
    flush_stream(spark, folder)
    _stream_in_parts(spark, sf, folder, [F.col("vec_id") >= last])
    return stream_stats(spark, folder)


def cache_no_vector(spark: SparkSession, sf: str) -> DataFrame:
    """The replay of a log in which every seventh query has no vector."""
    log = with_route(_assigned_log(spark, sf)).withColumn("embedding", F.when(F.col("qid") % 7 != 0, F.col("embedding")))
    hits = replay_log(log).hits
    return log.select("qid").join(hits, "qid", "left").select("qid", F.col("entry_id").isNotNull().alias("cache_hit"), "entry_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_posts": clean_posts,
    "clean_pages": clean_pages,
    "clean_rules": clean_rules,
    "dedup_exact": dedup_exact,
    "dedup_body": dedup_body,
    "corpus_clean_job": corpus_clean_job,
    "clean_step_counts": clean_step_counts,
    "corpus_summary": corpus_summary_query,
    "saved_corpus": saved_corpus,
    "posts_tree_job": posts_tree_job,
    "sample_documents": sample_documents,
    "sample_some": sample_some,
    "rejected_queries": rejected_queries,
    "docs_per_category": docs_per_category,
    "load_totals": load_totals,
    "first_document": first_document,
    "duplicate_counts": duplicate_counts,
    **{f"profile_{part}": _profile_part(part) for part in figures.FIGURES},
    "profile_pages": profile_pages,
    "profile_all": profile_all,
    "hash_embed": hash_embed,
    "topk_search": topk_search,
    "topk_all": topk_all,
    "topk_none": topk_none,
    "topk_tiles": topk_tiles,
    "search_defaults": search_defaults,
    "topk_filtered": topk_filtered,
    "topk_overfetch": topk_overfetch,
    "smoke_search": smoke_search,
    "saved_index": saved_index,
    "tag_clusters": tag_clusters_query,
    "tag_index": tag_index,
    "dominant_cluster": dominant_cluster,
    "confidence_bands": confidence_bands_query,
    "cluster_composition": cluster_composition_query,
    "cluster_report": cluster_report,
    "prob_map_top5": prob_map_top5,
    "membership_check": membership_check_query,
    "gmm_one_step": gmm_one_step,
    "gmm_rounds": gmm_rounds,
    "bic_aic": bic_aic,
    "silhouette_sample": silhouette_sample,
    "pca_variance": pca_variance,
    "pca_projection": pca_projection,
    "saved_model": saved_model,
    "saved_reports": saved_reports,
    "saved_bands": saved_bands,
    "gmm_fit": gmm_fit,
    "k_selection": k_selection,
    "k_selection_rounds": k_selection_rounds,
    "train_rounds": train_rounds,
    "saved_projection": saved_projection,
    "pair_similarity": pair_similarity_query,
    "cache_lookup": cache_lookup,
    "cache_stats": cache_stats_query,
    "cache_admit": cache_admit,
    "cache_lru": cache_lru,
    "cache_sweep": cache_sweep,
    "cache_replay": cache_replay,
    "cache_evict": cache_evict,
    "answer_log": answer_log,
    "answer_conversations": answer_conversations,
    "cache_stream": cache_stream,
    "cache_flush": cache_flush,
    "cache_no_vector": cache_no_vector,
}
