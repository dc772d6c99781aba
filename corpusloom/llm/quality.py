"""Quality rules: fixed limits, then gradient-boosted trees over statistics of a document.

The statistics are counted over Arrow batches with array operations. The trees are fitted on a bounded
sample of labelled documents, kept as flat node arrays and walked for a whole batch at once. Chosen
features are monotonic: more symbols, repeats, capitals or shouting never make a document better.

Defined results: a null text counts as empty, has no words and fails the base rules; repeated rows are
judged each; without labels of both kinds the trees reject nothing; an empty table gives an empty
result; extra columns pass through ``keep_documents`` and are not read by ``document_statistics``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.batches import pieces, starts_of, text_bytes
from corpusloom.session import ship

LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
WINDOW = 8
#: Labelled documents that the trees are fitted on, at most; taken in the order of a hash of their ids.
FIT_ROWS = 20_000
#: A document is kept if its chance to be good is no smaller.
LEAST_CHANCE = 0.5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_shouts", "n_digits", "n_lines", "n_stutters")
#: Features with the direction in which they may move the chance to be good; 0 is free.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbols": -1, "dup_lines": -1, "repeats": -1, "capitals": -1, "shouts": -1, "digits": 0, "stutters": -1,
}

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(b"#*$%&|<>")] = True


def per_document(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many flags each document has."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(flags, dtype=np.int64)])
    return total[ends] - total[starts_of(ends)]


def repeated_words(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each document, the words in windows of ``WINDOW`` words that it has twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return np.zeros(len(ends), np.int64)
    doc = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))
    inside = doc[:n] == doc[WINDOW - 1 :]
    factors = np.random.default_rng(5).integers(1, 2**63, WINDOW + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    code = doc[:n].astype(np.uint64) * factors[WINDOW]
    for j in range(WINDOW):
        code += words[j : n + j].astype(np.uint64) * factors[j]
    places = np.flatnonzero(inside)
    places = places[np.argsort(code[places], kind="stable")]
    same = code[places][1:] == code[places][:-1]
    # Equal codes are compared word by word; codes of unlike windows that meet are told apart by sorting.
    left, right = places[:-1][same], places[1:][same]
    if any((words[left + j] != words[right + j]).any() for j in range(WINDOW)) or (doc[left] != doc[right]).any():
        keys = (*(words[places + j] for j in range(WINDOW)), doc[places])
        places = places[np.lexsort(keys)]
        same = doc[places][1:] == doc[places][:-1]
        for j in range(WINDOW):
            same &= words[places + j][1:] == words[places + j][:-1]
    twice = np.zeros(len(places), bool)
    twice[1:] |= same
    twice[:-1] |= same
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, places[twice], 1)
    np.add.at(change, places[twice] + WINDOW, -1)
    return per_document(np.cumsum(change[:-1]) > 0, ends)


def stutters(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each document, the words that equal the word before them."""
    same = np.zeros(len(words), bool)
    same[1:] = words[1:] == words[:-1]
    same[starts_of(ends)[ends > starts_of(ends)]] = False
    return per_document(same, ends)


def count(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text."""
    flat, ends = text_bytes(texts)
    space = _IS_SPACE[flat]
    raw = flat.tobytes()
    documents = [raw[a:b] for a, b in zip(starts_of(ends).tolist(), ends.tolist())]
    split = [x.split() for x in documents]
    every = list(chain.from_iterable(split))
    number = {word: i for i, word in enumerate(dict.fromkeys(every))}
    words = np.fromiter(map(number.__getitem__, every), np.int64, len(every))
    n_words = np.array([len(x) for x in split], np.int64)
    lines = [[line for line in x.split(b"\n") if line.strip()] for x in documents]
    return {
        "n_words": n_words,
        "word_chars": per_document(((flat & 0xC0) != 0x80) & ~space, ends),
        "n_symbols": per_document(_IS_SYMBOL[flat], ends),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
        "n_repeat_words": repeated_words(words, np.cumsum(n_words)),
        "n_capitals": per_document((flat >= 65) & (flat <= 90), ends),
        "n_shouts": per_document((flat == 33) | (flat == 63), ends),
        "n_digits": per_document((flat >= 48) & (flat <= 57), ends),
        "n_lines": np.array([len(x) for x in lines], np.int64),
        "n_stutters": stutters(words, np.cumsum(n_words)),
    }


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """A row for each document, a column for each of ``FEATURES``."""
    words, chars = np.maximum(counts["n_words"], 1), np.maximum(counts["word_chars"], 1)
    return np.stack(
        [
            np.log1p(counts["n_words"]), counts["word_chars"] / words, counts["n_symbols"] / chars,
            counts["n_dup_lines"] / np.maximum(counts["n_lines"], 1), counts["n_repeat_words"] / words,
            counts["n_capitals"] / chars, counts["n_shouts"] / chars, counts["n_digits"] / chars, counts["n_stutters"] / words,
        ],
        1,
    )


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < LEAST_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED_PERCENT * counts["n_words"])


@dataclass
class Trees:
    """Trees as flat arrays: node ``i`` of tree ``t`` stands at ``first[t] + i``; a leaf points to itself."""

    base: float
    first: list[int] = field(default_factory=list)
    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(0))
    child: np.ndarray = field(default_factory=lambda: np.zeros((0, 2), np.int64))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    depth: int = 0

    def add(self, nodes: list[tuple[int, float, int, int, float]], depth: int) -> None:
        """A tree of (feature, threshold, left, right, value), nodes numbered from 0."""
        start = len(self.value)
        self.first.append(start)
        columns = list(zip(*nodes))
        self.feature = np.append(self.feature, np.array(columns[0], np.int64))
        self.threshold = np.append(self.threshold, columns[1])
        self.child = np.concatenate([self.child, np.array(columns[2:4], np.int64).T + start])
        self.value = np.append(self.value, columns[4])
        self.depth = max(self.depth, depth)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The log odds of each row."""
        total = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for start in self.first:
            node = np.full(len(rows), start)
            for _ in range(self.depth):
                node = self.child[node, (rows[every, self.feature[node]] > self.threshold[node]).astype(np.int64)]
            total += self.value[node]
        return total


def fit_trees(
    rows: np.ndarray, good: np.ndarray, directions: list[int], n_trees: int = 60, depth: int = 4, rate: float = 0.2,
    n_bins: int = 64, least_weight: float = 2.0, shrink: float = 1.0,
) -> Trees:
    """Boost trees for the logistic loss over binned features; monotonic where a direction is not 0."""
    n_good = int(good.sum())
    if not 0 < n_good < len(good):
        return Trees(base=np.inf)
    trees = Trees(base=float(np.log(n_good / (len(good) - n_good))))
    cuts = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, n_bins + 1)[1:-1])) for j in range(rows.shape[1])]
    bins = np.stack([np.searchsorted(cut, rows[:, j], side="left") for j, cut in enumerate(cuts)], 1)
    score = np.full(len(rows), trees.base)
    for _ in range(n_trees):
        chance = 1 / (1 + np.exp(-score))
        slope, weight = good - chance, chance * (1 - chance)
        nodes: list[list] = []

        def leaf(at: np.ndarray, low: float, high: float) -> float:
            return float(np.clip(rate * slope[at].sum() / (weight[at].sum() + shrink), low, high))

        def grow(at: np.ndarray, left_depth: int, low: float, high: float) -> int:
            me = len(nodes)
            nodes.append([0, np.inf, me, me, leaf(at, low, high)])
            best = best_split(at, low, high) if left_depth else None
            if best:
                j, b, middle = best
                goes = bins[at, j] > b
                falls = directions[j] < 0
                rises = directions[j] > 0
                left = grow(at[~goes], left_depth - 1, middle if falls else low, middle if rises else high)
                right = grow(at[goes], left_depth - 1, middle if rises else low, middle if falls else high)
                nodes[me][:4] = [j, float(cuts[j][b]), left, right]
            return me

        def best_split(at: np.ndarray, low: float, high: float):
            total_s, total_w = slope[at].sum(), weight[at].sum()
            best, found = 1e-6, None
            for j, cut in enumerate(cuts):
                s = np.cumsum(np.bincount(bins[at, j], slope[at], len(cut) + 1))[:-1]
                w = np.cumsum(np.bincount(bins[at, j], weight[at], len(cut) + 1))[:-1]
                if not len(s):
                    continue
                gain = s**2 / (w + shrink) + (total_s - s) ** 2 / (total_w - w + shrink) - total_s**2 / (total_w + shrink)
                below = np.clip(rate * s / (w + shrink), low, high)
                above = np.clip(rate * (total_s - s) / (total_w - w + shrink), low, high)
                allowed = (w >= least_weight) & (total_w - w >= least_weight) & (directions[j] * (above - below) >= 0)
                b = int(np.argmax(np.where(allowed, gain, -1)))
                if allowed[b] and gain[b] > best:
                    best, found = gain[b], (j, b, float(below[b] + above[b]) / 2)
            return found

        grow(np.arange(len(rows)), depth, -np.inf, np.inf)
        if len(nodes) == 1:
            break
        trees.add([tuple(x) for x in nodes], depth)
        last = Trees(0.0)
        last.add([tuple(x) for x in nodes], depth)
        score += last.score(rows)
    return trees


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the ``COUNTS`` of ``docs(doc_id, text)``."""
    return _judged(docs.select("doc_id", "text"), None, "doc_id", [])


def _judged(docs: DataFrame, trees: Trees | None, names: str, more: list[str]) -> DataFrame:
    """Columns ``names`` of ``docs`` with the counts, and the verdicts if there are trees."""
    columns = [names] if isinstance(names, str) else names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            counts = count(piece.column("text"))
            out = [*(piece.column(c) for c in columns), *(pa.array(counts[c], pa.int64()) for c in COUNTS)]
            if trees is not None:
                failed = base_failed(counts)
                score = trees.score(features(counts))
                out += [pa.array(failed), pa.array(~failed & (score >= np.log(LEAST_CHANCE / (1 - LEAST_CHANCE)))), pa.array(score)]
            yield pa.RecordBatch.from_arrays(out, names=[*columns, *COUNTS, *more])

    ship(docs.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    kept = ", ".join(f"`{c}` {kinds[c]}" for c in columns)
    types = {"base_failed": "boolean", "kept": "boolean", "score": "double"}
    return docs.mapInArrow(run, ", ".join([kept, *(f"{c} long" for c in COUNTS), *(f"{c} {types[c]}" for c in more)]))


def fit_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Trees:
    """Trees fitted on at most ``fit_rows`` labelled ids, chosen by a hash; ``labels(doc_id, quality)``, 1 is good."""
    chosen = labels.select("doc_id", "quality").dropna().orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(fit_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = document_statistics(rows).dropDuplicates().join(F.broadcast(chosen), "doc_id")
    # The order of the rows must not matter to sums of floats.
    table = found.select(*COUNTS, "quality").toPandas().sort_values([*COUNTS, "quality"])
    counts = {c: table[c].to_numpy(np.int64) for c in COUNTS}
    good = (table["quality"].to_numpy(np.int64) > 0).astype(float)
    return fit_trees(features(counts), good, list(FEATURES.values()))


def judge_documents(docs: DataFrame, trees: Trees) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``kept`` and ``score`` (log odds to be good)."""
    return _judged(docs.select("doc_id", "text"), trees, "doc_id", ["base_failed", "kept", "score"])


def keep_documents(docs: DataFrame, trees: Trees) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    # Names of the result's own are put aside, so columns of the same name pass through.
    columns = docs.columns
    aside = docs.toDF(*[c if c == "text" else f"in_{i}" for i, c in enumerate(columns)])
    judged = _judged(aside, trees, aside.columns, ["base_failed", "kept", "score"]).filter("kept")
    return judged.select(*aside.columns).toDF(*columns)
