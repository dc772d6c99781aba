"""Packing plans and placed documents."""

import random

import numpy as np
import pytest

from corpusloom.llm import packing


def contents_of(counts, capacities):
    plan = packing.plan_packing(counts, capacities)
    bins = {}
    for length, n in counts.items():
        for b, at, capacity in zip(*plan.place(np.full(n, length), np.arange(n))):
            bins.setdefault((int(b), int(capacity)), []).append((int(at), length))
    return bins


@pytest.mark.parametrize("seed", range(40))
def test_plan(seed):
    draw = random.Random(seed)
    capacities = tuple(sorted(draw.sample(range(5, 60), draw.randint(1, 4))))
    counts = {draw.randint(1, capacities[-1]): draw.randint(1, 40) for _ in range(draw.randint(0, 25))}
    bins = contents_of(counts, capacities)
    assert sorted(b for b, _ in bins) == list(range(len(bins)))
    for (_, capacity), pieces in bins.items():
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert capacity == min(c for c in capacities if c >= at)
    # No two bins could be one: best fit would have used the room.
    rooms = sorted(sum(length for _, length in p) for p in bins.values())
    assert sum(1 for x in rooms if 2 * x <= min(capacities)) <= 1


def test_plan_equals_best_fit_one_by_one():
    """With one capacity the plan holds as many bins as best fit piece by piece."""
    draw = random.Random(1)
    for _ in range(60):
        counts = {draw.randint(1, 50): draw.randint(1, 12) for _ in range(draw.randint(1, 20))}
        rooms = []
        for length in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
            fit = min((r for r in rooms if r >= length), default=None)
            if fit is not None:
                rooms.remove(fit)
            rooms.append((50 if fit is None else fit) - length)
        assert len(contents_of(counts, (50,))) == len(rooms)


def test_sizes_are_chosen_jointly():
    assert {c for _, c in contents_of({10: 1}, (10, 100))} == {10}
    assert {c for _, c in contents_of({60: 4, 40: 4}, (64, 100))} == {100}
    with pytest.raises(ValueError):
        packing.plan_packing({101: 1}, (10, 100))


def test_documents(spark):
    rows = [(i, "x" * (i * 37 % 900)) for i in range(400)] + [(1000, "é" * 5000), (1001, None), (1002, ""), (None, "q"), (7, "x" * 259), (7, "x" * 259)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, length int, bin_id int").repartition(3)
    placed = packing.pack_documents(packing.document_lengths(docs), (128, 512, 1024))
    got = placed.collect()
    assert len(got) == sum(-(-(len((t or "").encode()) + 1) // 1024) for _, t in rows)
    per_doc = {}
    for r in got:
        per_doc.setdefault(r.doc_id, []).append((r.piece, r.piece_start, r.length))
    for doc in {i for i, _ in rows}:
        want = sorted(p for i, t in rows if i == doc for p in cut(len((t or "").encode()) + 1, 1024))
        assert sorted(per_doc[doc]) == want
    for b in packing.bins(placed).collect():
        at = 0
        for p in b.pieces:
            assert p.bin_offset == at
            at += p.length
        assert at == b.contents <= b.capacity == min(c for c in (128, 512, 1024) if c >= at)
    assert placed.agg(packing.fill_share(placed)).first()[0] > 0.97
    assert packing.pack_documents(packing.document_lengths(docs.limit(0))).collect() == []
    again = packing.pack_documents(packing.document_lengths(docs.repartition(7)), (128, 512, 1024)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def cut(n, largest):
    return [(k, k * largest, min(largest, n - k * largest)) for k in range(-(-n // largest))]
