"""Byte-level BPE encoding and decoding over Arrow batches.

The vocabulary is a file of byte strings with ranks. Its bytes are mapped to printable characters for
the tokenizers library; any two tokens whose joined bytes are a token may merge, at that token's rank,
which is how rank files are meant. A text is cut before each blank that a visible character follows.
The split pattern must never match across such a cut, nor across a lone line end or from letters into
punctuation, as those of the usual rank files don't; so every distinct word is encoded once. Decoding reverses the byte table; the bytes of a character that two tokens share are
joined before they are read as UTF-8, and bytes that are no UTF-8 become U+FFFD in the text form.

Defined results: a null text counts as empty and has no ids; repeated rows are encoded each; an empty
table gives an empty result; other columns are not read. Special tokens' strings are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.batches import pieces, starts_of
from corpusloom.llm.words import Kept, as_bytes, cut_after, letters_and_tail
from corpusloom.session import ship

#: Distinct words that a task keeps encoded, and twice as many units of words.
KEPT_WORDS = 350_000


def byte_characters() -> list[str]:
    """A printable character for each byte: itself if printable, else one from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        table = byte_characters()
        shown = {token: "".join(map(table.__getitem__, token)) for token in ranks}
        merges = [
            (shown[token[:cut]], shown[token[cut:]])
            for token in sorted(ranks, key=ranks.__getitem__)
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        # As in a rank file, a match that is a token itself is not merged at all.
        self.tokenizer = Tokenizer(models.BPE({shown[t]: r for t, r in ranks.items()}, merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        # The byte table the other way round: what each id stands for.
        back = {c: b for b, c in enumerate(table)}
        self.tokens = np.empty(max(ranks.values(), default=-1) + 1, object)
        self.tokens[:] = b""
        for characters, rank in self.tokenizer.get_vocab().items():
            self.tokens[rank] = bytes(map(back.__getitem__, characters))
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        fixed = dict(zip(["\n"], self.alone(["\n"])))
        self.line_end = int(np.frombuffer(fixed["\n"], "<u4")[0])
        self.spaced = Kept(lambda words: self.alone([x if x[0] == "\n" else " " + x for x in words]), self.together, lambda word: self.split(word, " "), KEPT_WORDS, fixed)
        self.plain = Kept(self.alone, self.together, lambda word: self.split(word, ""), KEPT_WORDS, fixed)

    def alone(self, words: list[str]) -> list[bytes]:
        return as_bytes(self.tokenizer.encode_batch_fast(words, add_special_tokens=False))

    def together(self, units: list[str]) -> list[bytes]:
        """Units hold no line end, and the split pattern matches a line end before and after them apart."""
        ids = np.array(self.tokenizer.encode("\n".join(units) + "\n", add_special_tokens=False).ids, "<u4")
        return [x[:-4] for x in cut_after(ids, ids == self.line_end, len(units))]

    @staticmethod
    def split(word: str, lead: str) -> list[str] | None:
        """Letters with the blank or the line end before them, and the punctuation after them."""
        ended = word[:1] == "\n"
        found = letters_and_tail(word[ended:])
        if found is None:
            return None
        first = ["\n", found[0]] if ended else [lead + found[0]]
        return [*first, found[1]] if found[1] else first

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers.

        Texts are cut before each blank, or line end, that a visible character follows. ``spaced`` has the
        ids of such words with their blank, ``plain`` those of what begins a text, or has blanks of its own.
        """
        heads: list[str] = []
        tails: list[list[str]] = []
        for x in texts:
            words = (x or "").replace("\n", " \n").split(" ")
            odd = [i for i, word in enumerate(words) if i and not word[word[:1] == "\n" :][:1].strip()]
            # White space that no visible character follows stays with what stands before it.
            last = odd[-1] + 1 if odd else 1
            heads.append(" ".join(words[:last]).replace(" \n", "\n"))
            tails.append(words[last:])
        plain = self.plain.add(set(heads))
        spaced = self.spaced.add(set().union(*tails))
        get = spaced.__getitem__
        return [plain[head] + b"".join(map(get, words)) for head, words in zip(heads, tails)]

    def decode(self, ids: bytes) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(self.tokens[np.frombuffer(ids, "<u4")])

    def offsets(self, ids: np.ndarray, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First character and end of each id in the text of ``raw``; an id of a part of a character spans it."""
        ends = np.cumsum(self.lengths[ids])
        # Characters that have begun up to each byte, and up to it inclusive.
        begun = np.concatenate([np.zeros(1, np.int64), np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
        starts = starts_of(ends)
        inside = begun[np.minimum(starts + 1, len(raw))] - 1
        return np.maximum(inside, 0), begun[ends]


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids array<int>, char_start array<int>, char_end array<int>`` of ``docs(doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for piece in pieces(batches):
            texts = piece.column("text").to_pylist()
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in bpe.encode(texts)]
            spans = [bpe.offsets(x, (t or "").encode()) for x, t in zip(ids, texts)]
            lists = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(ids, lists), *(pa.array([s[i].astype(np.int32) for s in spans], lists) for i in (0, 1))],
                names=["doc_id", "ids", "char_start", "char_end"],
            )

    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, char_start array<int>, char_end array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, bytes binary, text string`` of ``encoded(doc_id, ids)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batches:
            raw = [bpe.decode(np.array(x or [], "<u4").tobytes()) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(raw, pa.binary()), pa.array([x.decode("utf-8", "replace") for x in raw], pa.string())],
                names=["doc_id", "bytes", "text"],
            )

    ship(encoded.sparkSession)
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, bytes binary, text string")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of the ids, and of what they decode to.

    Both directions run in one pass, so ids don't travel between the JVM and Python.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for piece in pieces(batches):
            ids = bpe.encode(piece.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
