"""Runs against a search of all periods, and the registered query against its rule stated plainly."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from corpusloom.llm import periodic, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_runs(words, least=12):
    """Start, length, period: for every period the stretches that keep it, the smallest period of each stretch."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        x = 0
        while x + q < n:
            start = x
            while x + q < n and words[x] == words[x + q]:
                x += 1
            if x - start + q >= max(least, 2 * q) and x > start:
                found.setdefault((start, x - start + q), q)
            x += x == start
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def made_texts(seed):
    draw = random.Random(seed)
    texts = []
    for _ in range(25):
        letters = [chr(97 + i) for i in range(draw.choice([1, 2, 2, 3, 4]))]
        n, kind = draw.randint(0, 90), draw.random()
        if kind < 0.4:
            words = [draw.choice(letters) for _ in range(n)]
        elif kind < 0.6:
            root = [draw.choice(letters) for _ in range(draw.randint(1, 20))]
            words = [draw.choice(letters) for _ in range(draw.randint(0, 4))] + (root * 60)[draw.randint(0, 9) :][:n]
        elif kind < 0.8:
            a, b = ["a"], ["a", "b"]
            while len(b) < n:
                a, b = b, b + a
            words = b[:n]
        else:
            words = ((["a", "b"] * 8)[: draw.randint(1, 15)] + [draw.choice(letters) for _ in range(draw.randint(0, 2))]) * 9
        texts.append("".join(w + draw.choice([" ", "\n", "\t ", "\x0b", "\x0c\r"]) for w in words))
    return texts


@pytest.mark.parametrize("least", [6, 12, 20])
def test_all_runs(least):
    for seed in range(60):
        texts = [t.split() for t in made_texts(seed)]
        numbers = np.array([ord(w) for t in texts for w in t], np.int32)
        ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
        doc, start, length, period = periodic.runs_of(numbers, ends, least)
        starts = np.append(0, ends[:-1])
        for i, words in enumerate(texts):
            own = doc == i
            assert list(zip((start - starts[doc])[own], length[own], period[own])) == plain_runs(words, least), words


EDGES = [
    None, "", " \t\n", "x", "a " * 11, "a " * 12, "é é " * 7, "a b c d e f " * 2, "a b c d e f\n" * 2 + "a", "A a " * 9, "x " * 5000,
    " ".join(["a"] * 30), ("p q r s t u v w " * 300) + "end", "long " + "y" * 200_000 + " z" * 14,
]


def test_find_runs(spark):
    texts = EDGES + made_texts(1) + made_texts(2)
    rows = [(i, t, "n", "r") for i, t in enumerate(texts)] + [(5, texts[5], "n", "r"), (None, texts[10], "n", "r"), (3, "b " * 40, "n", "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string, runs string").repartition(3)
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.find_runs(docs).collect()]
    want = []
    for i, text, *_ in rows:
        words = WORD.findall(text or "")
        runs = plain_runs(words) if len(words) < 4000 else [(0, len(words), 1)]
        want.append((i, len(words), runs, plain_collapsed(words, runs)))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert periodic.find_runs(docs.limit(0)).collect() == []


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in sorted(runs, key=lambda r: (r[0], r[2])))
    exponent = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, exponent, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest())


def test_registered(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: tuple(r) for r in queries.op11_periodic_runs(spark, SF).collect()}
    short = [(i, t) for i, t in docs if len(t or "") < 12_000]
    assert len(got) == len(docs) and len(short) > 0.9 * len(docs)
    assert sum(got[i][1] > 0 for i, _ in short) > 10
    for i, text in short:
        assert got[i] == plain_row(i, text)


def test_planted_rows(spark, tmp_path):
    rows = [(10, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3), (None, "a b " * 9), (30, None), (31, " "), *((i, f"w{i} x y z " * (i % 9)) for i in range(60, 160))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()}
    assert got == {i: plain_row(i, t) if i is not None else (None, *plain_row("none", t)[1:]) for i, t in rows}
