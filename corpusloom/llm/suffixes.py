"""Suffix-array dedup: bytes of passages that a document with a smaller id has, too, are removed.

A byte goes if it lies in ``MATCH`` (50) bytes that also start in a document with a smaller id. To bring
equal passages together without sorting every suffix in one place:

1. The least hash of the 16-byte strings in a window of 50 bytes stands for the window, and windows
   next to each other mostly share it; such a run is a fragment. Equal windows have equal hashes. Tasks send the
   hashes of their fragments to shards, each hash once if several of their documents hold it.
2. The shards answer which hashes two documents hold. Only those fragments are of interest.
3. Documents and answers meet; the bytes of these fragments go to shards by hash, once for each bucket of
   documents, from the smallest id that has the fragment there: others of the bucket lose all of it.
4. A shard builds the suffix array of its distinct fragments by induced sorting, and its permuted common
   prefixes tell which windows are equal. For each window that gives the smallest document; larger
   documents get the window's place as an answer.
5. Documents and these answers meet, and the places become removed bytes, as do fragments that a smaller
   id of the bucket has.

Documents of equal text are settled by a digest: all but the smallest id lose all windows.

Defined results: a null text counts as empty; ids must be integers; rows with a null id neither lose bytes nor make
others lose any; rows of equal ids don't count as smaller than each other; repeated rows are
answered each; an empty table gives an empty result; other columns pass through, but for columns
named like the result's own, which ``keep_texts`` alone preserves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.batches import pieces, ranges, starts_of, text_bytes
from corpusloom.llm.induced import order_of, permuted_matches, suffix_array
from corpusloom.session import ship, stage

MATCH = 50
GRAM = 16
#: Window starts that are hashed at once; longer texts are hashed in parts of this size.
PART = 1 << 20
PRIME = 2147483647
#: Bytes of text that a task sends hashes of at once.
SENT_BYTES = 4 << 20
#: Shards, and buckets of documents, for each of Spark's shuffle partitions. A task has one of them in memory at a
#: time; a bucket sends a row to every shard that it has something for.
GROUPS_PER_PARTITION = 2
#: Bytes of text in a bucket, about; larger inputs get more groups.
GROUP_BYTES = 32 << 20
#: Bytes of an entry's columns: id, number of the row among those of its id, first window, number of windows.
HEAD = (8, 4, 4, 4)
#: Ordinal of an entry that stands for several documents, which need no answer.
SETTLED = (1 << 32) - 1
_FACTORS = ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (4, 0x165667B19E3779F9), (8, 0x27D4EB2F165667C5))


def window_hashes(raw: np.ndarray) -> np.ndarray:
    """For each start of ``MATCH`` bytes: the least hash of the ``GRAM``-byte strings in them."""
    hashed = raw.astype(np.uint64) + np.uint64(1)
    for reach, factor in _FACTORS:
        hashed = hashed[:-reach] * np.uint64(factor) + hashed[reach:]
        hashed ^= hashed >> np.uint64(29)
    hashed *= np.uint64(0x9FB21C651E98DF25)
    hashed ^= hashed >> np.uint64(32)
    width, reach = MATCH - GRAM + 1, 1
    while 2 * reach <= width:
        hashed = np.minimum(hashed[:-reach], hashed[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(hashed[: len(hashed) - rest], hashed[rest:]) if rest else hashed


def fragments(flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one hash: document, number in it, hash, first window (in ``flat``), number of windows.

    A document's fragments depend on its text alone.
    """
    starts = starts_of(ends)
    docs = np.flatnonzero(ends - starts >= MATCH)
    out: list[tuple[np.ndarray, ...]] = []
    i = 0
    while i < len(docs):
        # Short documents are hashed together, a long one in parts.
        j = i + 1
        while j < len(docs) and ends[docs[j]] - starts[docs[i]] <= PART:
            j += 1
        low, high = starts[docs[i]], ends[docs[j - 1]]
        for a in range(low, high - MATCH + 1, PART) if j == i + 1 else [low]:
            b = min(a + PART, high - MATCH + 1) if j == i + 1 else high - MATCH + 1
            hashes = window_hashes(flat[a : b + MATCH - 1])
            own = docs[i:j]
            if len(own) > 1:
                windows = ends[own] - starts[own] - MATCH + 1
                at = ranges(starts[own] - a, windows)
                doc, hashes = np.repeat(own, windows), hashes[at]
            else:
                at, doc = np.arange(b - a), np.full(b - a, own[0])
            first = np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])]))
            out.append((doc[first], hashes[first], at[first] + a, np.diff(np.append(first, len(hashes)))))
        i = j
    if not out:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.astype(np.uint64), empty, empty
    doc, hashes, first, n = (np.concatenate(x) for x in zip(*out))
    begins = np.concatenate([[True], doc[1:] != doc[:-1]])
    number = np.arange(len(doc)) - np.maximum.accumulate(np.where(begins, np.arange(len(doc)), 0))
    return doc, number, hashes, first, n


def pack(*columns: tuple[np.ndarray, int]) -> bytes:
    """Columns of integers with their widths, byte plane by byte plane, which compresses well."""
    return b"".join(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :w].T).tobytes() for x, w in columns)


def unpack(payload: bytes, *widths: int) -> list[np.ndarray]:
    planes = np.frombuffer(payload, np.uint8).reshape(sum(widths), -1)
    out, at = [], 0
    for width in widths:
        values = np.zeros((planes.shape[1], 8), np.uint8)
        values[:, :width] = planes[at : at + width].T
        out.append(values.view("<u8").ravel().astype(np.uint64))
        at += width
    return out


def gather(payloads: list[bytes], *widths: int) -> list[np.ndarray]:
    parts = [unpack(x, *widths) for x in payloads if x]
    return [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.uint64) for i in range(len(widths))]


def by_key(keys: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The rows of each key."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
    for a, b in zip(first, [*first[1:], len(keys)]):
        yield int(keys[a]), [c[order[a:b]] for c in columns]


def group_count(docs: DataFrame) -> int:
    """How many shards, and buckets, there are: by Spark's partitions, or by the bytes of the texts if these are many."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(GROUPS_PER_PARTITION * partitions, -(-n_bytes // GROUP_BYTES))


def bucket_column(doc_id: Column, n: int) -> Column:
    scattered = F.pmod(F.pmod(doc_id.cast("long"), F.lit(PRIME)) * 48271, F.lit(PRIME))
    return F.coalesce(F.pmod(scattered, F.lit(n)), F.lit(0)).cast("int")


def bucket_of(doc_id: np.ndarray, n: int) -> np.ndarray:
    return doc_id.view(np.int64) % PRIME * 48271 % PRIME % n


def shared_hashes(docs: DataFrame, n_shards: int, n_buckets: int) -> DataFrame:
    """``bucket, payload``: ids and fragment numbers whose hash two documents hold (steps 1 and 2)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, limit=SENT_BYTES):
            if piece.column("doc_id").null_count:
                piece = pa.RecordBatch.from_struct_array(piece.to_struct_array().filter(piece.column("doc_id").is_valid()))
            if not piece.num_rows:
                continue
            ids = piece.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            doc, number, hashes, _, _ = fragments(*text_bytes(piece.column("text")))
            order = np.argsort(hashes, kind="stable")
            hashes, own, number = hashes[order], ids[doc[order]].view(np.uint64), number[order].astype(np.uint64)
            if not len(hashes):
                continue
            first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
            sizes = np.diff(np.append(first, len(hashes)))
            several = np.minimum.reduceat(own, first) != np.maximum.reduceat(own, first)
            in_several = np.repeat(several, sizes)
            # A hash of several documents is one entry; what it holds is known here already.
            hints = pack((own[in_several], 8), (number[in_several], 4))
            sent = ~in_several
            sent[first] = True
            entry = np.where(in_several, np.uint64(SETTLED), number)[sent]
            hashes, own = hashes[sent], own[sent]
            shard = (hashes >> np.uint64(40)) % np.uint64(n_shards)
            rows = [(s, pack((h, 5), (o, 8), (e, 4)), None) for s, (h, o, e) in by_key(shard.astype(np.int64), hashes, own, entry)]
            rows.append((int(ids[0]) % n_shards, None, hints))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int32(), pa.binary(), pa.binary()))],
                names=["shard", "entries", "hints"],
            )

    def answer(rows: pa.Table) -> pa.Table:
        hashes, own, number = gather(rows.column("entries").to_pylist(), 5, 8, 4)
        order = np.argsort(hashes, kind="stable")
        hashes, own, number = hashes[order], own[order], number[order]
        found = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
        if len(hashes):
            first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
            settled = number == SETTLED
            shared = (np.minimum.reduceat(own, first) != np.maximum.reduceat(own, first)) | np.logical_or.reduceat(settled, first)
            told = np.repeat(shared, np.diff(np.append(first, len(hashes)))) & ~settled
            found = [own[told], number[told]]
        known = gather(rows.column("hints").to_pylist(), 8, 4)
        ids, number = (np.concatenate(x) for x in zip(found, known))
        out = [(b, pack((i, 8), (x, 4))) for b, (i, x) in by_key(bucket_of(ids, n_buckets), ids, number)]
        return pa.table({"bucket": pa.array([b for b, _ in out], pa.int32()), "payload": pa.array([p for _, p in out], pa.binary())})

    sent = docs.select("doc_id", "text").mapInArrow(send, "shard int, entries binary, hints binary")
    return sent.groupBy("shard").applyInArrow(answer, "bucket int, payload binary")


def text_copies(docs: DataFrame, n_buckets: int) -> DataFrame:
    """``bucket, copy_id, copy_hash``: documents whose text a smaller id has; the text's hash tells apart rows of one id."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("copy_id"), F.md5(text.cast("binary")).alias("digest"), F.xxhash64(text).alias("copy_hash"))
    least = rows.groupBy("digest").agg(F.min("copy_id").alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # A table of its own, so that Spark sees how small it is, or splits the rows of a text that many have.
    least = stage(least, "least-of-copies")
    copies = rows.join(least, "digest").filter("copy_id > least").select("copy_id", "copy_hash").distinct()
    return copies.select(bucket_column(F.col("copy_id"), n_buckets).alias("bucket"), "copy_id", "copy_hash")


class Documents:
    """The documents of a bucket, in a fixed order."""

    def __init__(self, rows: pa.Table, notes: pa.Table):
        # Rows of one id are told apart by the hash of their text.
        self.rows = rows.take(pa.compute.sort_indices(rows, [("doc_id", "ascending"), ("text_hash", "ascending")]))
        self.flat, self.ends = text_bytes(self.rows.column("text"))
        self.starts = starts_of(self.ends)
        column = self.rows.column("doc_id").combine_chunks()
        self.known = column.is_valid().to_numpy(zero_copy_only=False)
        self.ids = column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        hashes = self.rows.column("text_hash").to_numpy()
        copies = set(zip(*(notes.column(c).drop_null().to_pylist() for c in ("copy_id", "copy_hash"))))
        pairs = zip(self.ids.tolist(), hashes.tolist())
        self.copy = np.array([p in copies for p in pairs], bool) & self.known if copies else np.zeros(len(self.ids), bool)
        # The number of a row among those of its id.
        begins = np.concatenate([[True], self.ids[1:] != self.ids[:-1]]) if len(self.ids) else np.zeros(0, bool)
        first = np.maximum.accumulate(np.where(begins, np.arange(len(self.ids)), 0)) if len(self.ids) else np.zeros(0, np.int64)
        self.variant = np.arange(len(self.ids)) - first


def held_before(held: Documents, doc: np.ndarray, hashes: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A flag for each fragment: a smaller id of the bucket, which is no copy, has the same one. Fragments come by document."""
    out = np.zeros(len(doc), bool)
    taking = np.flatnonzero((held.known & ~held.copy)[doc])
    # Fragments meet by 40 bits of hash and length; their bytes tell them apart.
    keys = ((hashes[taking] ^ n[taking].astype(np.uint64)) * np.uint64(_FACTORS[0][1])) >> np.uint64(24)
    by_key = order_of(keys, (1 << 40) - 1)
    order, keys = taking[by_key], keys[by_key]
    if len(order) < 2:
        return out
    same = keys[1:] == keys[:-1]
    meets, begins = np.append(same, False), np.append(False, same)
    some = np.flatnonzero(meets | begins)
    raw, at = memoryview(held.flat), order[some]
    ends = first[at] + n[at] + MATCH - 1
    least: dict[bytes, int] = {}
    # Documents are in ascending order of id, and so are the fragments of one key.
    for i, new, a, b, own in zip(at.tolist(), (~begins[some]).tolist(), first[at].tolist(), ends.tolist(), held.ids[doc[at]].tolist()):
        if new:
            least.clear()
        out[i] = least.setdefault(bytes(raw[a:b]), own) < own
    return out


def cogroup_rows(docs: DataFrame, notes: DataFrame, run, fields: str) -> DataFrame:
    return docs.groupBy("bucket").cogroup(notes.groupBy("bucket")).applyInArrow(run, fields)


def shared_fragments(docs: DataFrame, notes: DataFrame, n_shards: int) -> DataFrame:
    """``shard, payload, bytes``: the fragments that the answers name (step 3)."""

    def run(rows: pa.Table, hints: pa.Table) -> pa.Table:
        out: list[tuple[int, bytes, bytes]] = []
        ids, number = gather(hints.column("payload").to_pylist(), 8, 4)
        if rows.num_rows and len(ids):
            held = Documents(rows, hints)
            doc, own_number, hashes, first, n = fragments(held.flat, held.ends)
            named = np.unique(ids) if len(ids) else ids
            place = np.searchsorted(named, held.ids.view(np.uint64))
            scale = np.uint64(int(max(number.max(), own_number.max(initial=0))) + 1)
            wanted = np.unique(np.searchsorted(named, ids).astype(np.uint64) * scale + number)
            is_named = held.known & ~held.copy
            is_named &= named[np.minimum(place, len(named) - 1)] == held.ids.view(np.uint64)
            keys = place[doc].astype(np.uint64) * scale + own_number.astype(np.uint64)
            at = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
            chosen = np.flatnonzero((wanted[at] == keys) & is_named[doc])
            chosen = chosen[~held_before(held, doc[chosen], hashes[chosen], first[chosen], n[chosen])]
            doc, hashes, first, n = doc[chosen], hashes[chosen], first[chosen], n[chosen]
            shard = ((hashes >> np.uint64(32)) % np.uint64(n_shards)).astype(np.int64)
            for s, (d, f, m) in by_key(shard, doc, first, n):
                head = pack(*zip((held.ids[d], held.variant[d], f - held.starts[d], m), HEAD))
                out.append((s, head, held.flat[ranges(f, m + MATCH - 1)].tobytes()))
        return pa.table(
            {"shard": pa.array([x[0] for x in out], pa.int32()), "payload": pa.array([x[1] for x in out], pa.binary()), "bytes": pa.array([x[2] for x in out], pa.binary())}
        )

    return cogroup_rows(docs, notes, run, "shard int, payload binary, bytes binary")


def least_documents(raw: np.ndarray, starts: np.ndarray, windows: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window of distinct fragments, one fragment after another: the smallest document that has it.

    Ids, and for each window the number of its id among them. Fragment ``i`` is at ``starts[i]`` of the bytes ``raw`` with ``windows[i]`` windows, and ``least[i]`` is its smallest document.
    """
    lengths = windows + MATCH - 1
    # A symbol below all bytes ends each fragment, so that no window reaches over it.
    text = np.zeros(int(lengths.sum()) + len(starts), np.uint16)
    new_starts = starts_of(np.cumsum(lengths + 1))
    plain = np.zeros(len(text) + 8, np.uint8)
    for part in fragment_parts(lengths):
        places = ranges(new_starts[part], lengths[part])
        plain[places] = raw[ranges(starts[part], lengths[part])]
        text[places] = plain[places] + np.uint16(1)
    order = suffix_array(text, int(text.max(initial=0)) + 1)
    at = np.concatenate([ranges(new_starts[part], windows[part]).astype(np.int32) for part in fragment_parts(windows)])
    same = permuted_matches(plain, order, at, MATCH)
    window_of = np.full(len(text), -1, np.int32)
    del text, plain
    window_of[at] = np.arange(len(at), dtype=np.int32)
    n_windows = len(at)
    del at
    in_order = window_of[order]
    del order, window_of
    in_order = in_order[in_order >= 0]
    # Documents by their rank, which fits in less room.
    documents, rank = np.unique(least, return_inverse=True)
    rank = np.repeat(rank.astype(np.int32), windows)[in_order]
    first = np.flatnonzero(~same[in_order])
    smallest = np.minimum.reduceat(rank, first)
    out = np.empty(n_windows, np.int32)
    out[in_order] = np.repeat(smallest, np.diff(np.append(first, n_windows)))
    return documents, out


def fragment_parts(sizes: np.ndarray) -> Iterator[slice]:
    """Slices of fragments that have ``PART`` bytes, or windows, together, or one fragment."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + PART, side="right")))
        yield slice(start, stop)
        start = stop


def repeated_windows(sent: DataFrame, n_buckets: int) -> DataFrame:
    """``bucket, payload``: ids, variants, first windows and numbers of windows that a smaller id has, too (step 4)."""

    def run(rows: pa.Table) -> pa.Table:
        ids, variant, first, windows = gather(rows.column("payload").to_pylist(), *HEAD)
        ids, windows = ids.view(np.int64), windows.astype(np.int64)
        flat, _ = text_bytes(rows.column("bytes"))
        raw = memoryview(flat)
        starts = starts_of(np.cumsum(windows + MATCH - 1))
        distinct: dict[bytes, int] = {}
        ends = starts + windows + MATCH - 1
        which = np.array([distinct.setdefault(bytes(raw[a:b]), len(distinct)) for a, b in zip(starts.tolist(), ends.tolist())], np.int64)
        del distinct
        order = np.lexsort((ids, which))
        begin = np.flatnonzero(np.concatenate([[True], which[order][1:] != which[order][:-1]]))
        some = order[begin]  # one fragment for each distinct one, of the smallest document
        documents, smallest = least_documents(flat, starts[some], windows[some], ids[some])
        own_rank = np.searchsorted(documents, ids, side="left").astype(np.int32)
        window_starts = starts_of(np.cumsum(windows[some]))
        found: list[tuple[np.ndarray, ...]] = []
        for part in fragment_parts(windows):
            # Every fragment's windows against its own document, runs of removed ones.
            sizes = windows[part]
            fragment = np.repeat(np.arange(part.start, part.stop), sizes)
            removed = smallest[ranges(window_starts[which[part]], sizes)] < own_rank[fragment]
            edge = np.concatenate([[True], (removed[1:] != removed[:-1]) | (fragment[1:] != fragment[:-1])])
            run_first = np.flatnonzero(edge)
            run_n = np.diff(np.append(run_first, len(removed)))
            kept = removed[run_first]
            run_first, run_n = run_first[kept], run_n[kept]
            own = fragment[run_first]
            offset = first[own].astype(np.int64) + run_first - starts_of(np.cumsum(sizes))[own - part.start]
            found.append((ids[own], variant[own], offset, run_n))
        columns = [np.concatenate(x) for x in zip(*found)]
        out = [(b, pack(*zip((i, v, f, n), HEAD))) for b, (i, v, f, n) in by_key(bucket_of(columns[0], n_buckets), *columns)] if found else []
        return pa.table({"bucket": pa.array([b for b, _ in out], pa.int32()), "payload": pa.array([p for _, p in out], pa.binary())})

    return sent.groupBy("shard").applyInArrow(run, "bucket int, payload binary")


def removals(held: Documents, notes: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first byte in it and number of bytes of everything that goes, by row."""
    ids, variant, first, n = gather(notes.column("payload").to_pylist(), *HEAD)
    rows = np.zeros(0, np.int64)
    if len(ids):
        rows = np.searchsorted(held.ids[held.known], ids.view(np.int64)) + variant.astype(np.int64) + np.argmax(held.known)
    doc, _, hashes, own_first, own_n = fragments(held.flat, held.ends)
    again = held_before(held, doc, hashes, own_first, own_n)
    whole = np.flatnonzero(held.copy & (held.ends - held.starts >= MATCH))
    row = np.concatenate([rows, doc[again], whole])
    start = np.concatenate([first.astype(np.int64), (own_first - held.starts[doc])[again], np.zeros(len(whole), np.int64)])
    size = np.concatenate([n.astype(np.int64) + MATCH - 1, own_n[again] + MATCH - 1, (held.ends - held.starts)[whole]])
    order = np.argsort(row, kind="stable")
    return row[order], start[order], size[order]


def cut_documents(held: Documents, notes: pa.Table, whole_characters: bool) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Removed bytes, removed runs and the bytes left of every document, worked out for parts of them at a time."""
    row, start, size = removals(held, notes)
    sizes = held.ends - held.starts
    gone, spans, parts = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    for part in fragment_parts(sizes):
        flat = held.flat[held.starts[part.start] : held.ends[part.stop - 1]]
        starts = held.starts[part] - held.starts[part.start]
        ends = starts + sizes[part]
        a, b = np.searchsorted(row, (part.start, part.stop))
        change = np.zeros(len(flat) + 1, np.int32)
        begin = starts[row[a:b] - part.start] + start[a:b]
        np.add.at(change, begin, 1)
        np.add.at(change, begin + size[a:b], -1)
        removed = np.cumsum(change[:-1], dtype=np.int32) > 0
        if whole_characters:
            removed = whole_only(removed, flat)
        total = running(removed)
        opens = removed.copy()
        opens[1:] &= ~removed[:-1]
        begins = starts[ends > starts]
        opens[begins] = removed[begins]
        opened = running(opens)
        gone[part] = total[ends] - total[starts]
        spans[part] = opened[ends] - opened[starts]
        kept = flat[~removed].tobytes()
        kept_ends = np.cumsum(sizes[part] - gone[part])
        parts += [kept[i:j] for i, j in zip(starts_of(kept_ends).tolist(), kept_ends.tolist())]
    return gone, spans, parts


def running(flags: np.ndarray) -> np.ndarray:
    """How many flags stand before each place, and in all."""
    out = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, dtype=np.int32, out=out[1:])
    return out


def whole_only(removed: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The flags of bytes whose character is flagged in full."""
    if not len(flat):
        return removed
    first = np.flatnonzero((flat & 0xC0) != 0x80)
    first = first if len(first) and first[0] == 0 else np.append(0, first)
    return np.repeat(np.logical_and.reduceat(removed, first), np.diff(np.append(first, len(flat))))


def remove_repeats(docs: DataFrame, whole_characters: bool = False) -> DataFrame:
    """All columns of ``docs`` with ``n_bytes, n_removed, n_spans, kept`` (binary) of every row.

    ``whole_characters`` leaves the bytes of a character that other bytes of it keep from going.
    """
    spark = docs.sparkSession
    ship(spark)
    n = group_count(docs)
    own = ["n_bytes", "n_removed", "n_spans", "kept"]
    columns = [c for c in docs.columns if c not in own]
    docs = docs.select(*columns)
    # Names that the job uses itself may be the input's, too.
    aside = [f"in_{i}" if c not in ("doc_id", "text") else c for i, c in enumerate(columns)]
    every = docs.toDF(*aside)
    # Rows without an id neither lose bytes nor make others lose any, so they go by no group.
    named, nameless = every.filter("doc_id is not null"), every.filter("doc_id is null")
    bucketed = named.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit("")))).withColumn("bucket", bucket_column(F.col("doc_id"), n))
    copies = stage(text_copies(named, n), "text-copies")
    copy_notes = copies.select("bucket", F.lit(None).cast("binary").alias("payload"), "copy_id", "copy_hash")

    def with_copies(answers: DataFrame) -> DataFrame:
        null = F.lit(None).cast("long")
        return answers.select("bucket", "payload", null.alias("copy_id"), null.alias("copy_hash")).unionByName(copy_notes)

    hints = with_copies(shared_hashes(named, n, n))
    windows = with_copies(repeated_windows(shared_fragments(bucketed, hints, n), n))
    kinds = {f.name: f.dataType.simpleString() for f in named.schema}

    def run(rows: pa.Table, notes: pa.Table) -> pa.Table:
        held = Documents(rows, notes)
        gone, spans, parts = cut_documents(held, notes, whole_characters)
        values = [held.ends - held.starts, gone, spans]
        out = [held.rows.column(c) for c in aside] + [pa.array(v, pa.int64()) for v in values] + [pa.array(parts, pa.binary())]
        return pa.table(dict(zip([*aside, *own], out)))

    fields = ", ".join([*(f"`{c}` {kinds[c]}" for c in aside), "n_bytes long, n_removed long, n_spans long, kept binary"])
    found = cogroup_rows(bucketed, windows, run, fields)
    whole = F.coalesce("text", F.lit("")).cast("binary")
    none = F.lit(0).cast("long")
    untouched = nameless.select(*aside, F.octet_length(whole).cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"), whole.alias("kept"))
    return found.unionByName(untouched).toDF(*columns, *own)


def digests(found: DataFrame) -> DataFrame:
    """``doc_id`` and the counts with the digest of the bytes that are kept."""
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def keep_texts(docs: DataFrame) -> DataFrame:
    """``docs`` with texts that lost their removed bytes; a character goes if all of its bytes do. Null stays null."""
    aside = docs.toDF(*[c if c in ("doc_id", "text") else f"in_{i}" for i, c in enumerate(docs.columns)])
    text = F.when(F.col("text").isNotNull(), F.decode("kept", "utf-8")).alias("text")
    return remove_repeats(aside, whole_characters=True).select(*(text if c == "text" else c for c in aside.columns)).toDF(*docs.columns)
