"""Suffix arrays and passage removal against brute force."""

import hashlib
import random

import numpy as np
import pytest

from corpusloom.llm import suffixes
from corpusloom.llm.induced import permuted_matches, suffix_array


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_suffix_array(size):
    draw = np.random.default_rng(size)
    for _ in range(300):
        text = draw.integers(0, size, draw.integers(0, 40))
        plain = bytes(text.astype(np.uint8))
        assert suffix_array(text, size + 1).tolist() == sorted(range(len(text)), key=lambda i: plain[i:])


def test_long_runs_and_periods():
    for text in (b"a" * 3000, b"ab" * 1500, b"abc" * 700 + b"abd"):
        array = suffix_array(np.frombuffer(text, np.uint8), 257)
        assert array.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("length", [8, 11, 16, 50])
def test_permuted_matches(length):
    draw = np.random.default_rng(length)
    text = np.concatenate([np.tile(draw.integers(0, 3, 30), 6), draw.integers(0, 2, 300)]).astype(np.uint8)
    order = suffix_array(text, 257)
    starts = np.arange(len(text) - length + 1)
    raw, previous = text.tobytes(), {int(b): int(a) for a, b in zip(order, order[1:])}
    got = permuted_matches(np.append(text, np.zeros(8, np.uint8)), order, starts, length)
    want = [i in previous and previous[i] + length <= len(text) and raw[previous[i] : previous[i] + length] == raw[i : i + length] for i in starts]
    assert got.tolist() == want


def plain_removal(rows):
    least = {}
    docs = [(d, (t or "").encode()) for d, t in rows]
    for d, raw in docs:
        for i in range(len(raw) - 49):
            if d is not None:
                least[raw[i : i + 50]] = min(d, least.get(raw[i : i + 50], d))
    out = []
    for d, raw in docs:
        gone = bytearray(len(raw))
        for i in range(len(raw) - 49):
            if d is not None and least[raw[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        spans = sum(1 for i in range(len(raw)) if gone[i] and not (i and gone[i - 1]))
        out.append((d, len(raw), sum(gone), spans, bytes(x for x, g in zip(raw, gone) if not g)))
    return out


def made_rows():
    draw = random.Random(5)
    passages = ["".join(draw.choice("abé ") for _ in range(draw.randint(20, 200))) for _ in range(12)]
    rows = []
    for i in range(150):
        made = "".join(draw.choice(passages)[draw.randint(0, 20) :] for _ in range(draw.randint(0, 6)))
        rows.append((draw.choice([None, *range(-5, 60)]) if draw.random() < 0.3 else i, draw.choice([None, "", made])))
    rows += [(7, "a" * 3000), (8, "a" * 500), (9, "ab" * 400), (3, "ab" * 300), (200, rows[5][1]), (200, rows[5][1])]
    return rows


def test_removal(spark):
    rows = made_rows()
    docs = spark.createDataFrame([(*r, 1, b"k") for r in rows], "doc_id long, text string, bucket int, kept binary").repartition(5)
    got = sorted((tuple(r) for r in suffixes.digests(suffixes.remove_repeats(docs)).collect()), key=str)
    want = sorted(((*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in plain_removal(rows)), key=str)
    assert got == want
    assert sum(r[2] for r in got) > 3000


def test_texts_keep_whole_characters(spark):
    rows = made_rows() + [(500, "é" * 40 + "x" * 9), (501, "\x00y" + "é" * 40)]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, bucket int, kept string")
    kept = suffixes.keep_texts(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text, r.bucket, r.kept) for r in kept.collect()), key=str)
    plain = plain_removal(rows)
    assert sorted(str(r[0]) for r in got) == sorted(str(r[0]) for r in rows)
    assert [r for r in got if r[1] is None] == sorted(((d, None, 1, "k") for d, t in rows if t is None), key=str)
    # Cutting no characters, as many bytes are gone as the plain rule removes, but for those of split characters.
    left = sum(len(r[1].encode()) for r in got if r[1] is not None)
    assert 0 <= left - sum(len(r[4]) for r in plain) <= 2 * sum(r[3] for r in plain)


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.remove_repeats(docs).collect() == [] and suffixes.keep_texts(docs).collect() == []


def test_long_texts_are_hashed_in_parts(monkeypatch):
    monkeypatch.setattr(suffixes, "PART", 200)
    draw = np.random.default_rng(0)
    flat = draw.integers(0, 4, 3000).astype(np.uint8)
    ends = np.array([10, 60, 60, 1000, 1090, 1200, 3000])
    doc, number, hashes, first, n = suffixes.fragments(flat, ends)
    starts = np.append(0, ends[:-1])
    windows = suffixes.window_hashes(flat)
    covered = [(int(d), int(f) + k) for d, f, m in zip(doc, first, n) for k in range(m)]
    assert covered == [(d, i) for d, (a, b) in enumerate(zip(starts, ends)) for i in range(a, b - 49)]
    assert all((windows[f : f + m] == h).all() for h, f, m in zip(hashes, first, n))
    assert all(number[i] == (0 if i == 0 or doc[i] != doc[i - 1] else number[i - 1] + 1) for i in range(len(doc)))


def test_a_hot_passage_is_sent_once_a_bucket(spark):
    draw = random.Random(6)
    passage = "".join(draw.choice("abcdefgh ") for _ in range(300))
    own = ["".join(draw.choice("abcdefgh ") for _ in range(80)) for _ in range(200)]
    rows = [(i, own[i] + passage + own[-i]) for i in range(200)] + [(None, passage)] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    n = 2
    named = docs.filter("doc_id is not null")
    none = suffixes.F.lit(None).cast("long")
    hints = suffixes.shared_hashes(named, n, n).select("bucket", "payload", none.alias("copy_id"), none.alias("copy_hash"))
    text_hash = suffixes.F.xxhash64("text")
    bucketed = named.withColumn("text_hash", text_hash).withColumn("bucket", suffixes.bucket_column(suffixes.F.col("doc_id"), n))
    sent = suffixes.shared_fragments(bucketed, hints, n).collect()
    texts = []
    for r in sent:
        ends = np.cumsum(suffixes.unpack(bytes(r.payload), *suffixes.HEAD)[3].astype(int) + suffixes.MATCH - 1)
        texts += [bytes(r.bytes)[a:b] for a, b in zip([0, *ends], ends)]
    assert any(x in passage.encode() for x in texts) and max(texts.count(x) for x in texts) <= n
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.remove_repeats(docs).collect()), key=str)
    assert got == sorted(plain_removal(rows), key=str)


def test_large_inputs_get_more_groups(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "é" * 50) for i in range(40)] + [(40, None)], "doc_id long, text string")
    assert suffixes.group_count(docs) == 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(suffixes, "GROUP_BYTES", 100)
    assert suffixes.group_count(docs) == 40 and suffixes.group_count(docs.limit(0)) == 8


@pytest.mark.parametrize("part", [64, 1 << 20])
def test_parts_make_no_difference(spark, monkeypatch, part):
    monkeypatch.setattr(suffixes, "PART", part)
    rows = made_rows()
    held = suffixes.Documents(
        suffixes.pa.table({"doc_id": suffixes.pa.array([r[0] for r in rows], suffixes.pa.int64()), "text": [r[1] for r in rows], "text_hash": [hash(r[1]) for r in rows]}),
        suffixes.pa.table({"payload": suffixes.pa.array([], suffixes.pa.binary()), "copy_id": suffixes.pa.array([], suffixes.pa.int64()), "copy_hash": suffixes.pa.array([], suffixes.pa.int64())}),
    )
    doc, _, hashes, first, n = suffixes.fragments(held.flat, held.ends)
    least, smallest = suffixes.least_documents(held.flat, first, n, held.ids[doc])
    want = {}
    spots = [(f + k, held.ids[d]) for d, f, m in zip(doc, first, n) for k in range(m)]
    raw = held.flat.tobytes()
    for at, own in spots:
        want[raw[at : at + 50]] = min(own, want.get(raw[at : at + 50], own))
    assert least[smallest].tolist() == [want[raw[at : at + 50]] for at, _ in spots]


def test_many_rows_of_one_id(spark):
    """More rows of an id than two bytes count: the passage goes from the rows that have it, and from no others."""
    draw = random.Random(9)
    passage = "".join(draw.choice("abcdefgh ") for _ in range(120))
    rows = [(1, passage)] + [(7, f"row {i} " + (passage if i % 1000 == 0 else "")) for i in range(70_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = suffixes.remove_repeats(docs).filter("n_removed > 0")
    got = sorted((r.doc_id, bytes(r.kept).decode(), r.n_removed) for r in found.collect())
    assert got == sorted((7, f"row {i} ", 120) for i in range(0, 70_000, 1000))
