"""Token ids in files of grammar-compressed pieces (Re-Pair).

Documents are laid out in ascending order of id over shards; a shard is cut into pieces of bounded
size, and each piece gets a grammar of its own. A round counts the adjacent pairs of a piece, names the
frequent ones and replaces them where they don't overlap a more frequent one; rounds go on until no
pair is frequent, and count only what the round before left frequent or made. No pair reaches over the end of a document, so a document is a run of symbols, and
with the rules' expansion lengths any ids of it are found without expanding the rest.

A piece is one row of a Parquet file, written and committed by Spark:

==============  =======================================================================
shard, piece    where the piece stands in the order of documents
n_tokens        ids of the piece
doc_ids         the documents, in order
doc_ends        binary, little-endian u32: end of each document in the symbols
rules           binary, u32 pairs: the two symbols of nonterminal ``n_ids``, ``n_ids + 1``, ...
rule_lengths    binary, u32: how many ids each nonterminal expands to
n_ids           smallest nonterminal
width, symbols  binary, ``width`` bytes a symbol, all first bytes, then all second ones, ...
==============  =======================================================================

Defined results: a null text counts as empty, so the document has the end id only; repeated rows and
equal ids stand next to each other, by text; null ids come first; an empty table gives no pieces; other
columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.batches import pieces, ranges, starts_of
from corpusloom.llm.words import KeptUnits, as_bytes, cut_after, cut_units
from corpusloom.session import ship, stage

END_ID = 2
#: Units of words that a task keeps encoded.
KEPT_UNITS = 600_000
#: A pair is frequent if a piece has it so often.
LEAST_COUNT = 8
#: Slots to count pairs in, at most.
SLOT_BITS = 21


class WordBpe:
    """Ids of whole texts by a tokenizer file that drops white space, so words can be encoded one by one."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.n_ids = self.tokenizer.get_vocab_size()
        # Units are letters or punctuation only: one match each, which ends with the one id that has a word end.
        self.ends = np.zeros(self.n_ids, bool)
        for token, rank in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[rank] = token.endswith("</w>")
        self.kept = KeptUnits(self.alone, self.together, KEPT_UNITS)

    def alone(self, words: list[str]) -> list[bytes]:
        return as_bytes(self.tokenizer.encode_batch_fast(words, add_special_tokens=False))

    def together(self, units: list[str]) -> list[bytes]:
        ids = np.array(self.tokenizer.encode(" ".join(units), add_special_tokens=False).ids, "<u4")
        return cut_after(ids, self.ends[ids], len(units))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text ends in them. White space ends a word."""
        units, odd, unit_ends = cut_units(texts)
        coded = units.dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False)
        is_odd = np.zeros(len(coded.dictionary), bool)
        is_odd[which] = odd
        found = self.kept.find(coded.dictionary.to_pylist(), is_odd)
        lengths = np.fromiter(map(len, found), np.int32, len(found)) // 4
        sizes = lengths[which]
        ids = np.frombuffer(b"".join(found), "<u4")[ranges(starts_of(np.cumsum(lengths, dtype=np.int64))[which], sizes)]
        return ids, np.append(0, np.cumsum(sizes, dtype=np.int64))[unit_ends]


@lru_cache(maxsize=1)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def slots_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int32)


def frequent_pairs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pair keys that occur often, and how often, counted exactly."""
    keys = np.sort(keys)
    if not len(keys):
        return keys, keys
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.append(first, len(keys)))
    often = counts >= LEAST_COUNT
    return keys[first[often]], counts[often]


class Chain:
    """Symbols in order, linked to their neighbours, so that replacing some leaves the others in place."""

    def __init__(self, symbols: np.ndarray, ends: np.ndarray):
        n = len(symbols)
        # One place more at the end, which is no symbol, stands for the neighbours that are not there.
        self.symbols = np.append(symbols, 0).astype(np.int32)
        self.after = np.minimum(np.arange(1, n + 2, dtype=np.int32), np.int32(n))
        self.before = np.append(np.int32(n), np.arange(n, dtype=np.int32))
        self.alive = np.ones(n + 1, bool)
        self.last = np.zeros(n + 1, bool)
        self.last[ends - 1] = True
        self.last[n] = True
        self.alive[n] = False
        self.ranks = np.zeros(n + 1, np.int32)

    def chosen(self, at: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """Which of the places ``at``, ascending, are replaced: the more frequent of pairs that overlap, and every other one of a run of equal ones."""
        self.ranks[at] = ranks
        same = self.ranks[self.before[at]] == ranks
        higher = self.ranks[self.before[at]] > ranks
        # A run of equal pairs, each of which overlaps the next one, as places next to each other in ``at``.
        begin = ~same
        number = np.cumsum(begin) - 1
        first = np.flatnonzero(begin)
        offset = np.arange(len(at)) - first[number]
        # Only the last of a run can be less than the pair after it, only the first less than the one before.
        under = higher[first[number]] & (offset == 0)
        fits = (offset - higher[first[number]].astype(np.int64)) % 2 == 0
        out = fits & ~under & (self.ranks[self.after[at]] <= ranks)
        self.ranks[at] = 0
        return out

    def replace(self, places: np.ndarray, names: np.ndarray) -> np.ndarray:
        """Put ``names`` in place of the pairs; the places of pairs that have a new symbol."""
        gone = self.after[places]
        self.symbols[places] = names
        self.last[places] = self.last[gone]
        self.alive[gone] = False
        self.after[places] = self.after[gone]
        self.before[self.after[places]] = places
        return np.concatenate([places, self.before[places]])


def compress(symbols: np.ndarray, ends: np.ndarray, n_ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rules ``(n, 2)``, the symbols left, and where the documents end in them."""
    chain = Chain(symbols, ends)
    rules: list[np.ndarray] = []
    n = n_ids
    # A pair without a new symbol only gets rarer, so a round counts those that were frequent, and new ones.
    open_places = ~chain.last
    while True:
        at = np.flatnonzero(open_places).astype(np.int32)
        keys = chain.symbols[at].astype(np.int64) * n + chain.symbols[chain.after[at]]
        bits = min(SLOT_BITS, max(10, len(at).bit_length() + 1))
        slots = slots_of(keys, bits)
        often = np.bincount(slots, minlength=1 << bits) >= LEAST_COUNT
        often = often[slots]
        at, keys, slots = at[often], keys[often], slots[often]
        pairs, counts = frequent_pairs(keys)
        if not len(pairs):
            break
        # A slot names its most frequent pair; another pair of that slot waits for a later round.
        pairs = pairs[np.lexsort((pairs, counts))]
        named = np.zeros(1 << bits, np.int32)
        named[slots_of(pairs, bits)] = np.arange(1, len(pairs) + 1)
        # Each place's pair by rank (0: none).
        ranks = named[slots]
        known = pairs[ranks - 1] == keys
        known &= ranks > 0
        del keys, slots
        open_places[:] = False
        open_places[at] = True
        places, ranks = at[known], ranks[known]
        taken = chain.chosen(places, ranks)
        places, ranks = places[taken], ranks[taken]
        # A pair that the others leave few places of waits, too; the most frequent one keeps half of its places.
        enough = np.bincount(ranks, minlength=len(pairs) + 1) >= LEAST_COUNT // 2
        taken = enough[ranks]
        places, ranks = places[taken], ranks[taken]
        used = np.flatnonzero(enough)
        number = np.zeros(len(pairs) + 1, np.int64)
        number[used] = np.arange(len(used))
        rules.append(np.stack([pairs[used - 1] // n, pairs[used - 1] % n], 1))
        open_places[chain.replace(places, n + number[ranks])] = True
        open_places &= chain.alive & ~chain.last
        n += len(used)
    left = chain.alive
    return np.concatenate(rules) if rules else np.zeros((0, 2), np.int64), chain.symbols[left], np.flatnonzero(chain.last[left]) + 1


def rule_lengths(rules: np.ndarray, n_ids: int) -> np.ndarray:
    """How many ids each nonterminal stands for; a rule holds earlier symbols only."""
    lengths = np.ones(n_ids + len(rules), np.int64)
    for first, stop in levels(rules, n_ids):
        lengths[n_ids + first : n_ids + stop] = lengths[rules[first:stop]].sum(1)
    return lengths[n_ids:]


def levels(rules: np.ndarray, n_ids: int) -> Iterator[tuple[int, int]]:
    """Runs of rules that hold no rule of their own run."""
    highest = np.maximum.accumulate(rules.max(1)) if len(rules) else np.zeros(0, np.int64)
    first = 0
    while first < len(rules):
        stop = max(first + 1, int(np.searchsorted(highest, n_ids + first)))
        yield first, stop
        first = stop


class Grammar:
    """A piece as it was read."""

    def __init__(self, row: dict):
        self.n_ids = row["n_ids"]
        self.rules = np.frombuffer(row["rules"], "<u4").astype(np.int64).reshape(-1, 2)
        planes = np.frombuffer(row["symbols"], np.uint8).reshape(row["width"], -1)
        self.symbols = sum(plane.astype(np.int64) << (8 * i) for i, plane in enumerate(planes))
        self.doc_ends = np.frombuffer(row["doc_ends"], "<u4").astype(np.int64)
        self.lengths = np.concatenate([np.ones(self.n_ids, np.int64), np.frombuffer(row["rule_lengths"], "<u4").astype(np.int64)])

    @cached_property
    def expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """Where each symbol's ids start, and the ids of all symbols, level by level; an id expands to itself."""
        starts = np.arange(len(self.lengths), dtype=np.int64)
        flat = np.arange(self.n_ids, dtype=np.uint32)
        for first, stop in levels(self.rules, self.n_ids):
            own, parts = slice(self.n_ids + first, self.n_ids + stop), self.rules[first:stop].ravel()
            starts[own] = len(flat) + starts_of(np.cumsum(self.lengths[own]))
            flat = np.concatenate([flat, flat[ranges(starts[parts], self.lengths[parts])]])
        return starts, flat

    def tokens(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each document ends in them."""
        starts, flat = self.expansions
        sizes = self.lengths[self.symbols]
        ends = np.cumsum(sizes)
        return flat[ranges(starts[self.symbols], sizes)], ends[self.doc_ends - 1] if len(ends) else self.doc_ends

    def slice(self, doc: int, first: int, n: int) -> np.ndarray:
        """Ids ``first .. first + n - 1`` of the piece's document number ``doc``, by the rules that these need and no others."""
        symbols, skipped = self.symbols[self.doc_ends[doc - 1] if doc else 0 : self.doc_ends[doc]], max(0, first)
        while True:
            # The lengths tell which symbols hold the wanted ids; the others are never expanded.
            ends = np.cumsum(self.lengths[symbols])
            low, high = np.searchsorted(ends, skipped, side="right"), np.searchsorted(ends, skipped + n, side="left") + 1
            skipped -= int(ends[low - 1]) if low else 0
            symbols = symbols[low:high]
            is_rule = symbols >= self.n_ids
            if not is_rule.any():
                return symbols[skipped : skipped + n].astype(np.uint32)
            parts = np.stack([symbols, np.full(len(symbols), -1)], 1)
            parts[is_rule] = self.rules[symbols[is_rule] - self.n_ids]
            symbols = parts[parts >= 0]


FILE = "shard int, piece int, n_tokens long, doc_ids array<{kind}>, doc_ends binary, rules binary, rule_lengths binary, n_ids int, width int, symbols binary"


def write_ids(docs: DataFrame, path: str, tokenizer: str, n_shards: int | None = None, end_id: int = END_ID) -> None:
    """Write the ids of ``docs(doc_id, text)`` to ``path``; ``n_shards`` defaults to Spark's partitions."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = load(tokenizer)
        n_ids = max(words.n_ids, end_id + 1)
        shard = TaskContext.get().partitionId()
        for number, piece in enumerate(pieces(batches)):
            ids, ends = words.encode(piece.column("text"))
            symbols, ends = np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)
            rules, left, ends = compress(symbols, ends, n_ids)
            width = max(1, (int(n_ids + len(rules)).bit_length() + 7) // 8)
            planes = left.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T
            values = [
                shard, number, len(symbols), piece.column("doc_id").to_pylist(), ends.astype("<u4").tobytes(),
                rules.astype("<u4").tobytes(), rule_lengths(rules, n_ids).astype("<u4").tobytes(), n_ids, width, planes.tobytes(),
            ]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(piece.schema.field("doc_id").type), *[pa.binary()] * 3, pa.int32(), pa.int32(), pa.binary()]
            names = [field.split()[0] for field in FILE.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    ship(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    ordered = rows.repartitionByRange(n_shards, "doc_id") if n_shards else rows.repartitionByRange("doc_id")
    ordered.sortWithinPartitions("doc_id", "text").mapInArrow(run, FILE.format(kind=kind)).write.mode("overwrite").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids binary`` from the files: all ids, and how many stand before them."""
    return _read(spark, path, "ids binary", lambda ids: pa.array(ids, pa.binary()))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``, the checksum taken where the ids are read."""
    return _read(spark, path, "ids_crc32 long", lambda ids: pa.array([zlib.crc32(x) for x in ids], pa.int64()))


def _read(spark: SparkSession, path: str, field: str, column) -> DataFrame:
    name = field.split()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                grammar = Grammar(row.to_pylist()[0])
                tokens, ends = grammar.tokens()
                starts = starts_of(ends)
                raw, base = tokens.astype("<u4").tobytes(), row.column("base")[0].as_py()
                ids = [raw[4 * a : 4 * b] for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [row.column("doc_ids").flatten(), pa.array(base + starts), pa.array(ends - starts), column(ids)],
                    names=["doc_id", "start", "n_tokens", name],
                )

    ship(spark)
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    shards = files.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(earlier.orderBy("shard")), F.lit(0)).alias("shard_base")
    )
    own = F.coalesce(F.sum("n_tokens").over(earlier.partitionBy("shard").orderBy("piece")), F.lit(0))
    bases = files.select("shard", "piece", own.alias("own")).join(shards, "shard")
    # A table of its own, so that Spark sees how small it is and leaves the files where they are.
    bases = stage(bases.select("shard", "piece", (F.col("own") + F.col("shard_base")).alias("base")), "token-bases")
    placed = files.join(bases, ["shard", "piece"])
    return placed.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, {field}")


def read_slices(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """``doc_id, first, n, ids binary`` for every row of ``wanted(doc_id, first, n)``: parts of documents, read at random.

    Only pieces that hold a wanted document are opened, and of them only the rules that the wanted ids need. A document that is
    there more than once answers each time; ids beyond its end are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                grammar, asked = Grammar(row), row["asked"]
                ids = [grammar.slice(x["at"], x["first"], x["n"]).astype("<u4").tobytes() for x in asked]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["doc_id"] for x in asked], batch.schema.field("doc_ids").type.value_type), *[pa.array([x[c] for x in asked], pa.int64()) for c in ("first", "n")], pa.array(ids, pa.binary())],
                    names=["doc_id", "first", "n", "ids"],
                )

    ship(spark)
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    places = files.select("shard", "piece", F.posexplode("doc_ids").alias("at", "doc_id"))
    asked = wanted.select("doc_id", F.col("first").cast("long").alias("first"), F.col("n").cast("long").alias("n"))
    found = places.join(asked, "doc_id").groupBy("shard", "piece").agg(F.collect_list(F.struct("at", "doc_id", "first", "n")).alias("asked"))
    # A table of its own, so that Spark sees how small it is and leaves the files where they are.
    return files.join(stage(found, "wanted-pieces"), ["shard", "piece"]).mapInArrow(run, f"doc_id {kind}, first long, n long, ids binary")
