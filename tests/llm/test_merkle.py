"""The manifest against a tree built in plain Python."""

import hashlib
import random
import re
import zlib

import pytest

from corpusloom.llm import merkle, queries


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(nodes):
    """Root, and the siblings (before, behind) of each node, level by level."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for path, own in zip(paths, at):
            run = level[own // 16 * 16 : own // 16 * 16 + 16]
            path.append(("".join(run[: own % 16]), "".join(run[own % 16 + 1 :])))
        level = [h(*level[i : i + 16]) for i in range(0, len(level), 16)]
        at = [x // 16 for x in at]
    return level[0], paths


def plain_manifest(rows):
    """For rows (doc_id, source, lang, n_chars, text): the registered query's row, in order."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        own = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[source] = (own, *plain_tree([plain_leaf(r) for r in own]))
    root, upper = plain_tree([trees[s][1] for s in order])
    out = []
    for source, above in zip(order, upper):
        own, subroot, paths = trees[source]
        for row, path in zip(own, paths):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None
            text = re.sub("[A-Z]", lambda m: m[0].lower(), row[4]) if tampered else row[4]
            node = plain_leaf((*row[:4], text))
            for left, right in path + above:
                node = h(left, node, right)
            proof = h(*(x for pair in path + above for x in pair))
            out.append((row[0], plain_leaf(row), subroot, root, proof, node, node == root))
    return out


FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


def made(sizes, seed=1):
    draw = random.Random(seed)
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            text = draw.choice([None, "", "Abc é", "plain", "X" * 3000, "1:a-"])
            rows.append((draw.choice([None, len(rows), -len(rows)]), source, draw.choice([None, "", "en"]), draw.choice([None, 0, 7]), text))
    return rows + rows[:3]


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16, "b": 17, None: 2}, {"big": 700, "": 1, "é": 33, "z": 257, None: 256, "Z": 255}])
def test_registered_rows(spark, tmp_path, sizes):
    rows = made(sizes)
    spark.createDataFrame(rows, FIELDS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_merkle_manifest(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_manifest(rows), key=str)


def test_three_rounds(spark, monkeypatch):
    """Blocks of one level, so that small trees have many rounds; hundreds of sources."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 16)
    rows = [(i, f"s{i % 300}" if i % 2 else "hot", "en", i, f"Text {i}") for i in range(1200)]
    docs = spark.createDataFrame(rows, FIELDS)
    found = merkle.manifest(docs).withColumn("folded", merkle.fold(merkle.F.col("leaf"), merkle.F.col("proof")))
    got = {r.doc_id: (r.leaf, r.subroot, r.root, r.folded) for r in found.collect()}
    want = {r[0]: (r[1], r[2], r[3], r[3]) for r in plain_manifest(rows)}
    assert got == want


def test_general(spark):
    rows = made({"a": 40, "b": 3}, 2)
    docs = spark.createDataFrame([(*r, "t", 5, "p") for r in rows], FIELDS + ", tree string, place int, proof string")
    found = merkle.manifest(docs, ["tree", "place"])
    assert found.columns == ["doc_id", "source", "leaf", "subroot", "root", "proof", "tree", "place"]
    assert {(r.tree, r.place) for r in found.collect()} == {("t", 5)} and found.count() == len(rows)
    assert merkle.manifest(docs.limit(0)).collect() == []
    # The largest documents change one leaf, and with it every root.
    changed = merkle.manifest(docs.withColumn("text", merkle.F.lit("x"))).select("root").distinct().collect()
    assert len(changed) == 1 and changed[0].root != found.first().root


def test_registered(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = queries.op12_merkle_manifest(spark, sf).collect()
    assert sorted(map(tuple, got)) == sorted(plain_manifest(rows))
    assert 0 < sum(not r.verified for r in got) < len(got) / 3
