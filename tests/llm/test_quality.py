"""Counts against brute force; trees by held-out accuracy and monotonicity."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import quality

SF = "/root/testdata/sf0.01"


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    stutters = sum(a == b for a, b in zip(words, words[1:]))
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        len(re.findall("[A-Z]", text)), len(re.findall("[!?]", text)), len(re.findall("[0-9]", text)), len(lines), stutters,
    )


TEXTS = [
    None, "", " \n\t ", "one", "a\x0bb\x0cc\rd", "é\xa0x 日本 #*$%&|<>", "l\nl\n\nl\n l\n", "w " * 300, "a b c d e f g h " * 2,
    "a b c d e f g h i a b c d e f g h", "x y\x1cz A B! 12?", " ".join(str(i % 9) for i in range(100)), "q" * 20000,
]


def test_counts(spark):
    real = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(300).collect()]
    got = quality.count(pa.array(TEXTS + real, pa.string()))
    assert list(zip(*(got[c].tolist() for c in quality.COUNTS))) == [plain_counts(x) for x in TEXTS + real]


def test_windows_whose_codes_meet(monkeypatch):
    """Windows are told apart by their words if their codes are equal."""

    class Same:
        def integers(self, *_, **__):
            return np.zeros(quality.WINDOW + 1, np.uint64)

    words = np.array([*range(20), *range(5, 16), 3, 3], np.int64)
    ends = np.array([25, len(words)])
    want = quality.repeated_words(words, ends)
    monkeypatch.setattr(np.random, "default_rng", lambda *_: Same())
    assert quality.repeated_words(words, ends).tolist() == want.tolist()


@pytest.fixture(scope="module")
def trees(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return quality.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))


def test_trees_are_monotonic(trees):
    draw = np.random.default_rng(1)
    rows = draw.random((400, len(quality.FEATURES))) * [9, 12, 1, 1, 1, 1, 1, 1, 1]
    assert trees.first
    for j, direction in enumerate(quality.FEATURES.values()):
        if direction:
            steps = np.linspace(0, 1, 60)
            scores = []
            for x in steps:
                moved = rows.copy()
                moved[:, j] = x
                scores.append(trees.score(moved))
            assert (direction * np.diff(scores, axis=0) >= -1e-12).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    trees = quality.fit_quality(docs, labels.filter("doc_id % 2 = 0"))
    judged = quality.judge_documents(docs, trees).join(labels.filter("doc_id % 2 = 1"), "doc_id").toPandas()
    good = judged["quality"] == 1
    assert judged["kept"][good & ~judged["base_failed"]].mean() > 0.99
    assert judged["kept"][~good].mean() < 0.02


def test_flat_trees_equal_a_walk(trees):
    rows = np.random.default_rng(2).random((50, len(quality.FEATURES))) * 3

    def walk(row):
        total = trees.base
        for node in trees.first:
            while trees.child[node, 0] != node:
                node = trees.child[node, int(row[trees.feature[node]] > trees.threshold[node])]
            total += trees.value[node]
        return total

    assert np.allclose(trees.score(rows), [walk(r) for r in rows], atol=1e-12)


def test_judge_and_keep(spark, trees):
    rows = [(i, t, "mine", 3) for i, t in enumerate(TEXTS)] + [(None, "plain words of prose " * 9, "mine", 3), (0, None, "mine", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int")
    judged = quality.judge_documents(docs, trees).collect()
    assert len(judged) == len(rows)
    for r in judged:
        words, repeated = r.n_words, r.n_repeat_words
        assert r.base_failed == (words < 20 or 100 * repeated > 30 * words)
        assert not (r.base_failed and r.kept)
    kept = quality.keep_documents(docs, trees)
    assert kept.columns == docs.columns and {r.kept for r in kept.collect()} <= {"mine"}
    assert kept.count() == sum(r.kept for r in judged)
    assert quality.judge_documents(docs.limit(0), trees).collect() == []


def test_without_labels_of_both_kinds(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    for some in (labels, labels.limit(0)):
        judged = quality.judge_documents(docs, quality.fit_quality(docs, some))
        assert judged.filter("kept = base_failed").count() == 0
