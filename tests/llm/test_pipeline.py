"""The stages one after another, against plain rules on what each was given."""

import numpy as np

import corpus_pipeline
from corpusloom.llm import quality
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_suffixes import plain_removal

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near-duplicates", "repeated passages", "best-fit packing"]
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    (_, good), (_, one), (_, passages), (_, pack) = corpus_pipeline.STAGES

    kept = good(spark, documents, SF).cache()
    trees = quality.fit_quality(documents, spark.read.parquet(f"{SF}/labels.parquet"))
    judged = {r.doc_id for r in quality.judge_documents(documents, trees).filter("kept").collect()}
    assert kept.schema == documents.schema and {r.doc_id for r in kept.collect()} == judged
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    # Fitted on the few labels of the smallest table; test_quality measures accuracy on a larger one.
    assert len(judged) < documents.count() and np.mean([labels[i] for i in judged if i in labels]) > 0.9

    single = one(spark, kept, SF).cache()
    rows = sorted((r.doc_id, r.text) for r in kept.collect())
    root = plain_components([i for i, _ in rows], np.array([plain_fingerprint(t) for _, t in rows], np.uint64))
    assert sorted(single.columns) == sorted(documents.columns)
    assert sorted((r.doc_id, r.text) for r in single.collect()) == [(i, t) for i, t in rows if root[i] == i]

    cleaned = passages(spark, single, SF).cache()
    rows = [(r.doc_id, r.text) for r in single.collect()]
    left = {d: raw for d, _, _, _, raw in plain_removal(rows)}
    found = {r.doc_id: r.text.encode() for r in cleaned.collect()}
    assert found.keys() == left.keys() and cleaned.columns == single.columns
    # Only bytes of characters that would have been split stay beyond the plain rule.
    assert all(len(left[d]) <= len(raw) for d, raw in found.items())
    assert sum(raw == left[d] for d, raw in found.items()) > 0.9 * len(found)
    assert all(r.n_chars == len(r.text) for r in cleaned.collect())

    packed = pack(spark, cleaned, SF).collect()
    lengths = {d: len(raw) + 1 for d, raw in found.items()}
    total = {}
    for r in packed:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
        assert r.bin_offset + r.length <= r.capacity
    assert total == lengths


def test_run_equals_the_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, SF)
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, docs.collect()))


def test_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, SF)
    assert docs.collect() == []


def test_edge_rows_through_all_stages(spark, tmp_path):
    """Nulls in every column, empty and very long texts, repeated rows and ids, and columns with names that stages use."""
    draw = np.random.default_rng(6)
    words = ["".join(chr(97 + int(c)) for c in draw.integers(0, 26, draw.integers(2, 9))) for _ in range(400)]

    def text(n):
        return " ".join(words[int(i)] for i in draw.integers(0, 400, n))

    passage = text(60)
    rows = [(i, text(80) + ".\n" + text(40), f"s{i % 3}") for i in range(40)]
    rows += [(100, rows[0][1], "s0"), (101, None, None), (102, "", "s"), (None, text(90), None), (None, None, None), (103, text(30) + " " + passage, "s1"), (104, passage + " " + text(50), "s2"), (105, text(30000), "s1")]
    rows += [rows[3], rows[3], (4, text(70), "other text of an id")]
    fields = "doc_id long, text string, source string, bin_id string, fingerprint string, kept string, n long"
    docs = spark.createDataFrame([(*r, "b", None, "k", None) for r in rows], fields).repartition(3)
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(40)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    sizes, before = [], docs
    for name, function in corpus_pipeline.STAGES:
        after = function(spark, before, str(tmp_path))
        if name != "best-fit packing":
            assert after.columns == docs.columns
            assert {(r.bin_id, r.kept) for r in after.select("bin_id", "kept").collect()} <= {("b", "k")}
        after = spark.createDataFrame(after.collect(), after.schema)
        sizes.append(after.count())
        before = after
        if name == "near-duplicates":
            ids = [r.doc_id for r in after.collect() if r.doc_id is not None]
            assert len(ids) == len(set(ids)) and 100 not in ids
        if name == "repeated passages":
            kept = {r.doc_id: r.text for r in after.collect()}
            assert 103 not in kept or 104 not in kept or passage not in kept[104]
    assert all(sizes)
