"""Byte-level BPE and token files against the libraries' plain calls."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from corpusloom.llm import byte_bpe, repair

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PARTS = [
    "foo", "Bär", "İx", "ﬃ", "Σίγμας", "'s", "don't", "12", "x9", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x1c", "\x85", "　",
    ".", "?!", "日本", "é", "👩‍💻", "<|endoftext|>", "²", "_a", " \n", "-", "a-b", "Ǆ", "ß", "ͅ", "",
]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(1)
    made = ["".join(draw.choice(PARTS) + draw.choice(["", " "]) for _ in range(draw.randrange(30))) for _ in range(2000)]
    return [*made, "", " ", "x" * 50_000, "word " * 20_000, "\n" * 3000]


def test_byte_bpe_equals_rank_library(texts):
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    bpe = byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    ids = bpe.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [plain.encode_ordinary(x) for x in texts]
    assert [bpe.decode(x).decode() for x in ids] == texts


def test_byte_bpe_starts_anew_when_full(texts, monkeypatch):
    bpe = byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    whole = bpe.encode(texts)
    bpe.spaced.limit = bpe.plain.limit = 50
    assert [y for x in texts for y in bpe.encode([x])] == whole


def test_offsets_cover_split_characters():
    bpe = byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    text = "a 👩‍💻é日本 ﬃ."
    ids = np.frombuffer(bpe.encode([text])[0], "<u4")
    start, end = bpe.offsets(ids, text.encode())
    raw, at = text.encode(), 0
    character_of = [i for i, c in enumerate(text) for _ in c.encode()]
    for i, a, b in zip(ids, start, end):
        token = bpe.tokens[i]
        assert raw[at : at + len(token)] == token
        assert (a, b) == (character_of[at], character_of[at + len(token) - 1] + 1)
        at += len(token)
    assert start[0] == 0 and end[-1] == len(text)
    assert all(start[1:] >= start[:-1]) and all(end[1:] >= end[:-1]) and all(end > start)


ROWS = [(1, "Ab é\n x", "p"), (2, None, "q"), (3, "", "r"), (None, "foo", "s"), (3, "", "r"), (4, "w " * 9000, "t")]


@pytest.fixture
def docs(spark):
    # `ids`, `n_tokens` clash with names of the results.
    return spark.createDataFrame([(*r, 5) for r in ROWS], "doc_id long, text string, ids string, n_tokens int")


def test_encode_and_decode_documents(spark, docs):
    encoded = byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN)
    back = byte_bpe.decode_documents(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t, _ in ROWS)
    trip = byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert all(r.decoded_sha256 in {hashlib.sha256((t or "").encode()).hexdigest() for _, t, _ in ROWS} for r in trip)
    assert byte_bpe.round_trip(docs.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []


def plain_ids(texts):
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    return [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_words_equal_whole_texts(texts):
    ids, ends = repair.load(WORDS).encode(pa.array([*texts, None]))
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == [*plain_ids(texts), []]


@pytest.mark.parametrize("seed", range(6))
def test_grammar_round_trip(seed):
    draw = np.random.default_rng(seed)
    symbols = draw.integers(0, 2 + 3 * seed, 4000 * seed + 1)
    if seed == 5:
        symbols[:] = 1
    ends = np.unique(np.append(draw.integers(1, len(symbols) + 1, 40), len(symbols)))
    rules, left, doc_ends = repair.compress(symbols, ends, 50)
    row = {
        "n_ids": 50, "rules": rules.astype("<u4").tobytes(), "width": 4, "doc_ends": doc_ends.astype("<u4").tobytes(),
        "rule_lengths": repair.rule_lengths(rules, 50).astype("<u4").tobytes(),
        "symbols": left.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(),
    }
    grammar = repair.Grammar(row)
    tokens, token_ends = grammar.tokens()
    assert (tokens == symbols).all() and (token_ends == ends).all()
    for _ in range(50):
        doc = int(draw.integers(len(ends)))
        a, b = (ends[doc - 1] if doc else 0), ends[doc]
        first, n = int(draw.integers(b - a)), int(draw.integers(1, 40))
        assert (grammar.slice(doc, first, n) == symbols[a + first : min(a + first + n, b)]).all()
    if seed:
        assert len(left) + 2 * len(rules) < len(symbols) or seed > 3


def test_files(spark, docs, tmp_path):
    path = str(tmp_path / "ids")
    repair.write_ids(docs, path, WORDS, n_shards=3)
    ordered = sorted(ROWS, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1]))
    want, start = [], 0
    for (i, _, _), ids in zip(ordered, plain_ids([t or "" for _, t, _ in ordered])):
        raw = np.array([*ids, 2], "<u4").tobytes()
        want.append((i, start, len(raw) // 4, zlib.crc32(raw)))
        start += len(raw) // 4
    got = [tuple(r) for r in repair.read_digests(spark, path).orderBy("start").collect()]
    assert got == want
    whole = repair.read_ids(spark, path).orderBy("start").collect()
    assert [zlib.crc32(bytes(r.ids)) for r in whole] == [w[3] for w in want]


def test_no_documents(spark, docs, tmp_path):
    repair.write_ids(docs.limit(0), str(tmp_path / "ids"), WORDS)
    assert repair.read_digests(spark, str(tmp_path / "ids")).collect() == []


def test_many_pieces_keep_their_order(spark, tmp_path, monkeypatch):
    rows = [(i, f"word {i} " * (i % 7)) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    repair.write_ids(frame, str(tmp_path / "a"), WORDS, n_shards=4)
    repair.write_ids(frame, str(tmp_path / "b"), WORDS, n_shards=1)
    a, b = (sorted(map(tuple, repair.read_digests(spark, str(tmp_path / x)).collect())) for x in "ab")
    assert a == b and [r[0] for r in a] == list(range(300))


def test_replacement_goes_on_while_pairs_are_frequent():
    draw = np.random.default_rng(8)
    text = draw.integers(0, 1000, 3000)
    cases = [[text] * 600, [np.full(5000, 7), np.tile([1, 2], 900), np.tile([1, 2, 2], 50)], [draw.integers(0, 3, 400) for _ in range(30)]]
    for docs, most in zip(cases, (600, 40, 4000)):
        symbols, ends = np.concatenate(docs).astype(np.uint32), np.cumsum([len(x) for x in docs])
        rules, left, left_ends = repair.compress(symbols, ends, 1000)
        assert len(left) <= most
        inside = np.ones(len(left), bool)
        inside[left_ends - 1] = False
        _, counts = np.unique(np.stack([left[:-1], left[1:]])[:, inside[:-1]], axis=1, return_counts=True)
        assert counts.max(initial=0) < repair.LEAST_COUNT
        row = {
            "n_ids": 1000, "rules": rules.astype("<u4").tobytes(), "symbols": left.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), "width": 4,
            "doc_ends": left_ends.astype("<u4").tobytes(), "rule_lengths": repair.rule_lengths(rules, 1000).astype("<u4").tobytes(),
        }
        tokens, token_ends = repair.Grammar(row).tokens()
        assert (tokens == symbols).all() and (token_ends == ends).all()


def test_odd_words_equal_whole_texts():
    """Letters of two bytes, case, punctuation, digits, apostrophes, combining marks and blanks that are no blanks here, in any order."""
    draw = random.Random(11)
    pieces = ["a", "B", "é", "É", "ß", "Þ", "×", "÷", "ÿ", "ª", "µ", "é", "中", "İ", "Σ", "'s", "'", ".", ",", "...", "#$%", "/", "_", "7", "42", " ", "\x0b", " ", "don't", "<|endoftext|>", "😀"]
    blanks = [" ", "  ", "\n", "\t", "\r\n"]
    made = ["".join(draw.choice(pieces if draw.random() < 0.75 else blanks) for _ in range(draw.randint(0, 30))) for _ in range(1500)]
    ids, ends = repair.load(WORDS).encode(pa.array(made))
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == plain_ids(made)


def test_units_are_kept_in_bounds(monkeypatch):
    monkeypatch.setattr(repair, "KEPT_UNITS", 40)
    words = repair.WordBpe(WORDS)
    draw = random.Random(12)
    for _ in range(12):
        texts = [" ".join(f"{draw.choice('abcdef')}{draw.choice('ghijkl')}{draw.choice(['', '.', '1'])}" for _ in range(50)) for _ in range(3)]
        ids, ends = words.encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == plain_ids(texts)
        assert len(words.kept.young) <= 20 + 150 and len(words.kept.old) <= 20 + 150
    long = "x1" * 30_000
    monkeypatch.setattr("corpusloom.llm.words.KEPT_BYTES", 1000)
    for _ in range(3):
        ids, ends = words.encode(pa.array([long, "a b"]))
        assert ids.tolist() == sum(plain_ids([long, "a b"]), [])


def test_slices_of_documents(spark, tmp_path):
    rows = [(i, f"word {i % 5} and again word " * (3 * i)) for i in range(40)] + [(7, "another text of this id"), (None, "no id")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    repair.write_ids(frame, str(tmp_path / "ids"), WORDS, n_shards=4)
    wanted = [(30, 100, 7), (30, 0, 3), (7, 2, 100), (0, 0, 5), (39, 10_000, 4), (99, 0, 1)]
    asked = spark.createDataFrame([(*w, "x") for w in wanted], "doc_id long, first int, n int, ids string")
    got = sorted((r.doc_id, r.first, r.n, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in repair.read_slices(spark, str(tmp_path / "ids"), asked).collect())
    want = [(d, a, n, ([*ids, 2])[a : a + n]) for d, a, n in wanted for (i, t) in rows if i == d for ids in plain_ids([t])]
    assert got == sorted(want)


def test_a_slice_expands_no_other_rules():
    symbols = np.tile(np.arange(40), 400).astype(np.uint32)
    rules, left, ends = repair.compress(symbols, np.array([len(symbols)]), 40)
    row = {
        "n_ids": 40, "rules": rules.astype("<u4").tobytes(), "symbols": left.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), "width": 4,
        "doc_ends": ends.astype("<u4").tobytes(), "rule_lengths": repair.rule_lengths(rules, 40).astype("<u4").tobytes(),
    }
    grammar = repair.Grammar(row)
    read = []

    class Rules:
        def __getitem__(self, places):
            read.extend(np.atleast_1d(places).tolist())
            return rules[places]

    grammar.rules = Rules()
    assert grammar.slice(0, 8001, 3).tolist() == [1, 2, 3]
    assert "expansions" not in grammar.__dict__ and len(read) < 4 * np.log2(len(symbols))
