"""Runs: passages of a text that repeat themselves, word by word, found with a dictionary of basic factors.

A run is a stretch of words with smallest period ``q``, at least ``LEAST`` (12) words and two periods long, that no
neighbouring word extends. Words are the parts between the ASCII blanks ``\\x20 \\x09-\\x0D``. For every document:

1. Basic factors: each stretch of 2**k words gets a name, made of the names of its halves. A name that occurs once in
   its document cannot take part in a repetition of that length, so its place drops out of the longer factors.
2. For each length, occurrences of one name in less than twice that length: those next to each other with the
   factor's own period form an arithmetic progression. A progression proposes its difference, and two
   progressions propose the distances of their ends: from the last member of one to all of the other, and from all
   of one to the first of the other. No period of a run is missing among these, for if all seeds of a run
   lay inside the same two progressions, both would join, and the run would have a smaller period. A period is asked
   for at one length only, the largest that any run of that period holds twice.
3. Proposals of one period are visited in order; each is extended word by word to both sides, and those that an earlier stretch
   covers are skipped. Of stretches with the same ends the smallest period stays.

Tasks work on pieces of bounded size, whole documents each, without any shuffle; a text is held as a row, so memory
grows with the longest text, and time with words times the number of factor lengths that still repeat.

Defined results: a null or blank text has no words and no runs; rows are answered each, whatever their ids, repeated rows
and null ids included; an empty table gives an empty result; other columns are not read. Runs come by start, then
period. Ties of length are for the caller to settle (``longest`` takes the smallest start, then the smallest period).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.batches import pieces, ranges, starts_of, text_bytes
from corpusloom.session import ship

#: Words of a run at least.
LEAST = 12
#: Bytes of text that a task works on at once.
PIECE = 4 << 20
#: Words compared at once when a proposal is extended, to begin with and at most.
CHUNK, LARGEST_CHUNK = 16, 1 << 16


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts, one after another, and where each text's words end."""
    flat, ends = text_bytes(column)
    visible = (flat != 32) & ((flat < 9) | (flat > 13))
    before = np.concatenate([[False], visible[:-1]])
    before[starts_of(ends)[ends > starts_of(ends)]] = False
    first = np.flatnonzero(visible & ~before)
    place = np.concatenate([[0], np.cumsum(visible)])
    offsets = np.append(place[first], place[-1]).astype(np.int32)
    data = flat[visible]
    words = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    return words, np.searchsorted(first, ends).astype(np.int64)


def dense(keys: np.ndarray) -> np.ndarray:
    """Numbers from 0 that are equal where the keys are."""
    return pa.array(keys).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def factor_of(period: int, least: int) -> int:
    """The length of the factors that propose ``period``: what every run of that period holds twice, a power of two."""
    return 1 << ((max(least, 2 * period) - period).bit_length() - 1)


def proposals(words: np.ndarray, ends: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Periods and places: ``words[place + i]`` equals ``words[place + period + i]`` for some steps from 0 on."""
    n = len(words)
    document = np.repeat(np.arange(len(ends)), ends - starts_of(ends))
    asked = np.array([factor_of(p, least) for p in range(1, max(2, least))])
    shortest = int(asked.min())
    periods, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    # Names are of one document each, so equal names never lie in two of them; -1: occurs once, or reaches over the end.
    name = dense(words.astype(np.int64) | document << 32)
    at = np.arange(n)
    length = 1
    while True:
        count = np.bincount(name[at] if length > 1 else name, minlength=1)
        at = at[count[name[at]] > 1]
        if not len(at):
            break
        if length >= shortest:
            for period, place in neighbours(name, at, length):
                mine = period < 2 * length
                small = period < len(asked)
                mine &= np.where(small, asked[np.minimum(period, len(asked)) - 1] == length, period >= length)
                periods.append(period[mine])
                places.append(place[mine])
        # Names of twice the length, where both halves still repeat.
        left = at[at + length < n]
        repeats = np.zeros(n, bool)
        repeats[at] = True
        left = left[repeats[left + length]]
        left = left[document[left] == document[left + length]]
        if not len(left):
            break
        longer = dense(name[left] * n + name[left + length])
        name = np.full(n, -1, np.int64)
        name[left] = longer
        at, length = left, 2 * length
    return np.concatenate(periods), np.concatenate(places)


def neighbours(name: np.ndarray, at: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distances and places of occurrences of one name, by their arithmetic progressions."""
    order = np.argsort(name[at], kind="stable")
    at = at[order]
    own = name[at]
    same = own[1:] == own[:-1]
    gap = np.diff(at)
    # Occurrences within half of the length are the factor's own period apart, hence all of them equally far.
    linked = same & (2 * gap <= length)
    chain = np.concatenate([[0], np.cumsum(~linked)])
    first = np.flatnonzero(np.concatenate([[True], ~linked]))
    last = np.append(first[1:], len(at)) - 1
    several = first[last > first]
    yield at[several + 1] - at[several], at[several]
    n_chains = len(first)
    step = 1
    while True:
        # From every occurrence to the first one of a later progression, and from the last one of an earlier one.
        some = np.flatnonzero(chain + step < n_chains)
        later = first[chain[some] + step]
        near = (own[later] == own[some]) & (at[later] - at[some] < 2 * length)
        some, later = some[near], later[near]
        yield at[later] - at[some], at[some]
        other = np.flatnonzero(chain >= step)
        earlier = last[chain[other] - step]
        near = (own[earlier] == own[other]) & (at[other] - at[earlier] < 2 * length)
        other, earlier = other[near], earlier[near]
        yield at[other] - at[earlier], at[earlier]
        if not len(some) and not len(other):
            return
        step += 1


def equal_ahead(a: np.ndarray, b: np.ndarray) -> int:
    """How many words of two views are equal from the start on."""
    n, done, chunk = min(len(a), len(b)), 0, CHUNK
    while done < n:
        stop = min(n, done + chunk)
        differ = a[done:stop] != b[done:stop]
        found = int(differ.argmax())
        if differ[found]:
            return done + found
        done, chunk = stop, min(2 * chunk, LARGEST_CHUNK)
    return n


def runs_of(words: np.ndarray, ends: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, start (in ``words``), length and period of every run, by start, then period."""
    period, place = proposals(words, ends, least)
    order = np.lexsort((place, period))
    period, place = period[order], place[order]
    # Places next to each other with one period lie in one stretch.
    opens = np.concatenate([[True], (period[1:] != period[:-1]) | (place[1:] > place[:-1] + 1)]) if len(period) else np.zeros(0, bool)
    period, place = period[opens], place[opens]
    starts = starts_of(ends)
    document = np.searchsorted(ends, place, side="right")
    found: list[tuple[int, int, int, int]] = []
    current = stop = -1
    for q, i, doc in zip(period.tolist(), place.tolist(), document.tolist()):
        if q == current and i < stop:
            continue
        low, high = int(starts[doc]), int(ends[doc])
        ahead = equal_ahead(words[i : high - q], words[i + q : high])
        behind = equal_ahead(words[low:i][::-1], words[low + q : i + q][::-1])
        current, stop = q, i + ahead
        length = behind + ahead + q
        if length >= max(least, 2 * q):
            found.append((i - behind, q, length, doc))
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    start, q, length, doc = np.array(sorted(set(found)), np.int64).T
    # The smallest period of a stretch comes first.
    order = np.lexsort((q, length, start))
    start, q, length, doc = start[order], q[order], length[order], doc[order]
    keep = np.concatenate([[True], (start[1:] != start[:-1]) | (length[1:] != length[:-1])])
    start, q, length, doc = start[keep], q[keep], length[keep], doc[keep]
    order = np.lexsort((q, start))
    return doc[order], start[order], length[order], q[order]


def collapsed(words: pa.Array, ends: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> pa.Array:
    """Each document's words but for those that a run holds after its first period, joined by one space."""
    n = len(words)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int32)[: n + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    sizes = np.diff(offsets)[kept]
    # A space after each word; a document ends before that of its last word.
    word_ends = np.cumsum(sizes + 1)
    out = np.full(int(word_ends[-1]) if len(word_ends) else 0, 32, np.uint8)
    out[ranges(starts_of(word_ends), sizes)] = flat[ranges(offsets[kept], sizes)]
    last = np.searchsorted(kept, ends)
    bounds = np.append(0, word_ends)
    raw = out.tobytes()
    first = starts_of(last)
    return pa.array([raw[bounds[a] : bounds[b] - 1] if b > a else b"" for a, b in zip(first.tolist(), last.tolist())], pa.binary()).cast(pa.string())


RUN = "struct<start:bigint,length:bigint,period:bigint>"


def find_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row of ``docs(doc_id, text)``.

    ``runs`` is an array of ``start, length, period``; ``collapsed`` is the text's words without repetitions.
    """
    fields = pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=PIECE):
            words, ends = words_of(piece.column("text"))
            numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int32)
            doc, start, length, period = runs_of(numbers, ends, least)
            offsets = np.searchsorted(doc, np.arange(len(ends) + 1)).astype(np.int32)
            values = [pa.array(start - starts_of(ends)[doc]), pa.array(length), pa.array(period)]
            runs = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(values, fields=list(fields)))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(ends - starts_of(ends)), runs, collapsed(words, ends, start, length, period)],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, runs array<{RUN}>, collapsed string")


def longest(runs: Column) -> Column:
    """The run of greatest length, of the smallest start and then period among equals; null if there is none."""
    return F.get(F.array_sort(runs, lambda a, b: F.when(a["length"] != b["length"], F.sign(b["length"] - a["length"])).when(
        a["start"] != b["start"], F.sign(a["start"] - b["start"])).otherwise(F.sign(a["period"] - b["period"])).cast("int")), 0)


def run_lines(runs: Column) -> Column:
    """One line ``start,length,period`` for each run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
