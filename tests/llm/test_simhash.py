"""Fingerprints, links and components against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from corpusloom.llm import simhash
from corpusloom.llm.components import components


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(ids, found):
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, x) in enumerate(zip(ids, found)):
        for j in np.flatnonzero(np.bitwise_count(found[k + 1 :] ^ x) <= 3) + k + 1:
            a, b = top(i), top(ids[int(j)])
            root[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


TEXTS = [
    None, "", " \t\n", "one", "Two Words", "a b c", "A B C", "a b c d e f g", "Ünïcode \xa0 x\x1cy ÄB", "x " * 5000, "a b c d e f h",
    *("the same text again and again number " + str(i // 3) for i in range(12)),
]


def test_fingerprints():
    got = simhash.fingerprints_of(pa.array(TEXTS, pa.string()))
    assert [int(x) for x in got] == [plain_fingerprint(x) for x in TEXTS]


def test_near_duplicates(spark):
    rows = [(i * 3, t, 0, "n") for i, t in enumerate(TEXTS)] + [(None, "a b c", 0, "n"), (6, TEXTS[2], 0, "n")]
    # `fingerprint`, `node` clash with names that the job uses.
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int, node string").repartition(3)
    got = simhash.near_duplicates(docs).collect()
    ids = [r[0] for r in rows if r[0] is not None]
    want = plain_components(ids, np.array([plain_fingerprint(r[1]) for r in rows if r[0] is not None], np.uint64))
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == want | {None: None}
    assert all(r.fingerprint % 2**64 == plain_fingerprint(dict((a, b) for a, b, *_ in rows)[r.doc_id]) for r in got)
    kept = simhash.keep_one(docs).collect()
    assert sorted((r.doc_id for r in kept), key=str) == sorted({want[i] for i in ids} | {None}, key=str)
    assert kept[0].asDict().keys() == {"doc_id", "text", "fingerprint", "node"}
    assert simhash.near_duplicates(docs.limit(0)).collect() == [] and simhash.keep_one(docs.limit(0)).collect() == []


def test_repeated_ids_keep_a_row_of_their_own(spark):
    """Rows of one id with texts of other groups: the id stays with its own text, once."""
    a, b = "one two three four five six seven", "entirely different words stand in this other text here"
    rows = [(1, a, "x"), (5, a, "y"), (5, b, "z"), (5, b, "a"), (7, b, "q"), (9, None, "n"), (9, "", "m"), (9, "", "m"), (None, a, "x"), (None, a, "x")]
    docs = spark.createDataFrame([(*r, {"k": 1}) for r in rows], "doc_id long, text string, n string, least map<string,int>").repartition(3)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text, r.n) for r in kept.collect()), key=str) == sorted([(1, a, "x"), (5, b, "a"), (9, None, "n"), (None, a, "x"), (None, a, "x")], key=str)


@pytest.mark.parametrize("shared", [200, 4096])
def test_links_of_a_large_group(spark, monkeypatch, shared):
    draw = np.random.default_rng(3)
    found = []
    for centre in draw.integers(0, 2**63, 30, dtype=np.uint64):
        for _ in range(draw.integers(1, 20)):
            found.append(int(centre) ^ sum(1 << int(k) for k in set(draw.integers(0, 64, draw.integers(0, 5)))))
    for _ in range(2500):
        found.append(found[0] ^ sum(1 << int(k) for k in draw.choice(64, draw.integers(0, 7), replace=False)))
    found = np.unique(np.array([*found, 0, 1, 7, 15, 31, 2**63, 2**64 - 1], np.uint64))
    draw.shuffle(found)
    monkeypatch.setattr(simhash, "SHARED", shared)
    nodes = spark.createDataFrame([(i, int(x)) for i, x in enumerate(found.view(np.int64))], "node long, fingerprint long")
    roots = {r.a: r.b for r in components(simhash.links(nodes)).collect()}
    assert {i: roots.get(i, i) for i in range(len(found))} == plain_components(list(range(len(found))), found)


def test_anchors_cover():
    draw = np.random.default_rng(0)
    found = draw.integers(0, 2**63, 300, dtype=np.uint64)
    rows, keys = simhash.anchors(found)
    for row in range(0, 300, 17):
        for number in range(2):
            block = int(found[row]) >> 31 * number & (2**31 - 1)
            own = [int(k) & (2**31 - 1) for k in keys[rows == row] if int(k) >> 31 == number]
            assert len(own) == len(set(own)) and len(own) in (1, 16)
            assert all((x ^ block).bit_count() <= 2 and simhash.syndromes(np.array([x], np.uint64))[0] == 0 for x in own)


def test_components_of_chains_and_stars(spark):
    draw = random.Random(2)
    chain = list(range(1000, 1200))
    draw.shuffle(chain)
    pairs = list(zip(chain, chain[1:])) + [(0, i) for i in range(1, 400)] + [(5000, 5001), (5001, 5000), (9, 8)]
    got = {r.a: r.b for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {i: 1000 for i in chain if i != 1000} | {i: 0 for i in range(1, 400)} | {5001: 5000}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
