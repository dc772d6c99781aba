"""Benchmark words in documents against a search of every place."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate as D
from corpusloom.llm import queries

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_hits(text, items, gram=10):
    words, hit, met = WORD.findall(lower(text)), set(), set()
    for item, own in items:
        own = WORD.findall(lower(own))
        width = min(gram, len(own))
        for a in range(len(own) - width + 1) if own else []:
            for b in range(len(words) - width + 1):
                if words[b : b + width] == own[a : a + width]:
                    hit |= set(range(b, b + width))
                    met |= {item}
    return len(words), sorted(hit), sorted(x for x in met if x is not None)


def spans(hit):
    out = []
    for i in hit:
        if out and out[-1][1] == i:
            out[-1][1] = i + 1
        else:
            out.append([i, i + 1])
    return [tuple(x) for x in out]


def made(seed=1):
    draw = random.Random(seed)
    letters = ["a", "B", "cé", "É", "Σ", "x9", "ı"]
    long = [draw.choice(letters) for _ in range(60)]
    items = [(0, " ".join(long[:14])), (1, " ".join(long[20:30])), (2, " ".join(long[5:25]).upper()), (3, ""), (4, None), (5, "--- !"), (6, "B cé"), (7, "unseen"), (8, "Σ-É ı"), (None, "a a"), (2, "x9 x9 x9"), (0, " ".join(long[:14]))]
    docs = [(i, "".join(draw.choice(letters) + draw.choice([" ", ", ", "\n"]) for _ in range(draw.randint(0, 40)))) for i in range(30)]
    docs += [(100, "pre " + "; ".join(long) + " post"), (101, " ".join(long[:13])), (102, None), (103, ""), (104, "..."), (105, "unseen"), (100, "other"), (None, " ".join(long[18:40])), (105, "unseen"), (106, "q " * 30000 + " ".join(long[20:30]))]
    return docs, items


@pytest.mark.parametrize("limit", [D.BROADCAST_BYTES, 0])
def test_every_place(spark, limit):
    docs, items = made()
    table = spark.createDataFrame([(*r, "s", 1, 2) for r in docs], "doc_id long, text string, spans string, items int, n int").repartition(3)
    tests = spark.createDataFrame([(*r, "w") for r in items], "item_id long, text string, words string")
    got = [(r.doc_id, r.n_words, r.n_hit, [tuple(s) for s in r.spans], r["items"], r.contaminated) for r in D.judge_documents(table, tests, broadcast_bytes=limit).collect()]
    want = []
    for i, text in docs:
        n, hit, met = plain_hits(text, items)
        want.append((i, n, len(hit), spans(hit), met, bool(hit)))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(w[5] for w in want) > 10 and not all(w[5] for w in want)


def test_removal(spark):
    docs, items = made(2)
    table = spark.createDataFrame([(*r, "s") for r in docs], "doc_id long, text string, spans string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    cased = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
    want = []
    for i, text in docs:
        _, hit, _ = plain_hits(text, items)
        places = [m.span() for m in cased.finditer(text or "")]
        for a, b in reversed(spans(hit)):
            text = text[: places[a][0]] + text[places[b - 1][1] :]
        want.append((i, text, "s"))
    removed = D.remove_spans(table, tests)
    assert removed.columns == table.columns and sorted(map(tuple, removed.collect()), key=str) == sorted(want, key=str)
    kept = D.remove_documents(table, tests)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(((i, t, "s") for i, t in docs if not plain_hits(t, items)[1]), key=str)
    half = [(i, t, "s") for i, t in docs for n, hit, _ in [plain_hits(t, items)] if 2 * len(hit) <= n]
    assert sorted(map(tuple, D.remove_documents(table, tests, 0.5).collect()), key=str) == sorted(half, key=str)


def test_empty(spark):
    docs, items = made(3)
    table, tests = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert D.judge_documents(table.limit(0), tests).collect() == []
    assert D.judge_documents(table, tests.limit(0)).filter("contaminated").count() == 0
    assert D.remove_documents(table, tests.limit(0)).count() == len(docs)


def test_registered_rows(spark, tmp_path):
    docs, items = made(4)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([*items, (10, "a"), (21, "B")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.op13_decontaminate(spark, str(tmp_path)).collect()
    want = []
    for i, text in docs:
        n, hit, met = plain_hits(text, [*items, (10, "a"), (21, "B")])
        want.append((i, n, len(hit), len(met), hashlib.sha256(",".join(sorted(map(str, met))).encode()).hexdigest(), bool(hit)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_plan(spark):
    docs, items = made(5)
    table, tests = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    plan = D.find_hits(table, tests)._jdf.queryExecution().executedPlan().toString()
    # Places of documents meet the broadcast set where they are; only verified places are exchanged.
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 2
    assert D.windows_of(tests).select(F.max("n")).first()[0] == 10


@pytest.mark.parametrize("n", range(1, 12))
def test_every_place_of_a_window_covers_one_anchor(n):
    width, step = D.anchor_of(n)
    for start in range(30):
        assert sum(start <= at and at + width <= start + n for at in range(0, 60, step)) == 1


def test_windows_of_all_lengths_are_found_wherever_they_lie(spark):
    items = [(n, " ".join(f"w{n}x{i}" for i in range(n))) for n in range(1, 11)]
    docs = [(100 * n + lead, " ".join(["fill"] * lead + [items[n - 1][1].upper()] + ["fill"] * 3)) for n in range(1, 11) for lead in range(13)]
    found = D.judge_documents(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert {r.doc_id: (r.n_words, [tuple(s) for s in r.spans], r["items"]) for r in found} == {
        100 * n + lead: (n + lead + 3, [(lead, lead + n)], [n]) for n in range(1, 11) for lead in range(13)
    }
