"""Suffix arrays by induced sorting, a bucket at a time with array operations."""

from __future__ import annotations

import numpy as np


#: Symbols, or suffixes, that are looked at together where an array operation needs wide copies.
CHUNK = 1 << 18


def order_of(keys: np.ndarray, most: int) -> np.ndarray:
    """The stable order of integers from 0 to ``most``. Sorting keys with their places is much faster than sorting places by keys."""
    bits = max(1, len(keys) - 1).bit_length()
    if most.bit_length() + bits > 64:
        return np.argsort(keys, kind="stable").astype(np.int32)
    packed = keys.astype(np.uint64) << np.uint64(bits)
    packed |= np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    packed &= np.uint64((1 << bits) - 1)
    return packed.astype(np.int32)


def counts_of(text: np.ndarray, size: int) -> np.ndarray:
    """How often each symbol occurs."""
    return sum((np.bincount(text[i : i + CHUNK], minlength=size) for i in range(0, len(text), CHUNK)), np.zeros(size, np.int64))


def is_smaller(text: np.ndarray) -> np.ndarray:
    """For each suffix whether it is smaller than the next one; the end is smaller than any symbol."""
    smaller = np.append(text[:-1] < text[1:], False)
    # Suffixes that begin with two equal symbols are as the last one of their run of equals.
    equal = np.flatnonzero(text[:-1] == text[1:]).astype(np.int32)
    if len(equal):
        last = np.flatnonzero(np.append(np.diff(equal) != 1, True))
        smaller[equal] = np.repeat(smaller[equal[last] + 1], np.diff(np.append(-1, last)))
    return smaller


def induce(text: np.ndarray, smaller: np.ndarray, starts: np.ndarray, larger_of: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the leftmost smaller ones in order.

    ``starts[c]`` is where bucket ``c`` begins; its ``larger_of[c]`` larger suffixes come first. Buckets
    are swept upwards to place the larger suffixes and downwards to place the smaller ones. What a
    sweep finds in a bucket while it is in it makes another wave of that bucket.
    """
    n, size = len(text), len(larger_of)
    order = np.full(n, -1, np.int32)
    seed_symbols = text[seeds]
    seed_ends = np.cumsum(np.bincount(seed_symbols, minlength=size))
    seed_starts = np.append(0, seed_ends)[:-1]
    seeds = seeds[np.argsort(seed_symbols, kind="stable")]
    head = starts[:-1].copy()

    def place(found: np.ndarray, edge: np.ndarray, step: int) -> None:
        """The suffixes go to the free edge of their buckets, one after another."""
        if len(found) == 1:
            symbol = text[found[0]]
            order[edge[symbol] - (step < 0)] = found[0]
            edge[symbol] += step
            return
        symbols = text[found]
        by_symbol = np.argsort(symbols, kind="stable")
        found, symbols = found[by_symbol], symbols[by_symbol]
        counts = np.bincount(symbols, minlength=size)
        rank = np.arange(len(found)) - (np.cumsum(counts) - counts)[symbols]
        order[edge[symbols] + rank if step > 0 else edge[symbols] - 1 - rank] = found
        edge += step * counts

    def before(at: np.ndarray, kind: bool) -> np.ndarray:
        found = at[at > 0] - 1
        return found[smaller[found] == kind]

    place(np.array([n - 1], np.int32), head, 1)
    for c in range(size):
        done = starts[c]
        while done < head[c]:
            wave = order[done : head[c]]
            done = head[c]
            if len(found := before(wave, False)):
                place(found, head, 1)
        own = seeds[seed_starts[c] : seed_ends[c]]
        if len(own) and len(found := before(own, False)):
            place(found, head, 1)
    tail = starts[1:].copy()
    for c in range(size - 1, -1, -1):
        done = starts[c + 1]
        while done > tail[c]:
            wave = order[tail[c] : done][::-1]
            done = tail[c]
            if len(found := before(wave, True)):
                place(found, tail, -1)
        larger = order[starts[c] : starts[c] + larger_of[c]][::-1]
        if len(larger) and len(found := before(larger, True)):
            place(found, tail, -1)
    return order


def group_starts(values: np.ndarray) -> np.ndarray:
    """Flags of places where sorted values begin anew."""
    return np.concatenate([[True], values[1:] != values[:-1]])


def order_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names: names of neighbours make pairs, and pairs of pairs in turn.

    The alphabet is about as large as the string, so there are no buckets to sweep. A suffix's rank is
    the place where its group of equals begins; groups are taken apart by the ranks that follow, at twice
    the reach each time, until all are alone. What follows the string's end is least.
    """
    n = len(names)
    order = order_of(names, n)
    place = np.arange(n, dtype=np.int32)
    begins = group_starts(names[order])
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(begins, place, 0))
    alone = begins & np.append(begins[1:], True)
    together, reach = order[~alone], 1
    while len(together):
        own = rank[together]
        keys = own.astype(np.int64) * (n + 1)
        inside = np.flatnonzero(together.astype(np.int64) + reach < n).astype(np.int32)
        keys[inside] += rank[together[inside] + reach] + 1
        del inside
        by_key = order_of(keys, (n + 1) ** 2)
        together, own, keys = together[by_key], own[by_key], keys[by_key]
        del by_key
        index = np.arange(len(together), dtype=np.int32)
        at = own + index - np.maximum.accumulate(np.where(group_starts(own), index, 0))
        begins = group_starts(keys)
        rank[together] = np.maximum.accumulate(np.where(begins, at, 0))
        together = together[~(begins & np.append(begins[1:], True))]
        reach *= 2
    order[rank] = place
    return order


def name_substrings(text: np.ndarray, sorted_first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Names of leftmost-smaller substrings in sorted order; equal neighbours share one.

    ``lengths[i]`` belongs to the substring that begins at ``sorted_first[i]``.
    """
    left, right = sorted_first[:-1], sorted_first[1:]
    differs = lengths[1:] != lengths[:-1]
    open_pairs = np.flatnonzero(~differs).astype(np.int32)
    at = 0
    while len(open_pairs):
        unequal = text[left[open_pairs] + at] != text[right[open_pairs] + at]
        differs[open_pairs[unequal]] = True
        at += 1
        open_pairs = open_pairs[~unequal & (lengths[1:][open_pairs] > at)]
    return np.append(np.int32(0), np.cumsum(differs, dtype=np.int32))


def suffix_array(text: np.ndarray, size: int) -> np.ndarray:
    """The starts of all suffixes of ``text`` (symbols below ``size``) in order."""
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    text = text.astype(np.uint8 if size <= 1 << 8 else np.uint16 if size <= 1 << 16 else np.int64, copy=False)
    smaller = is_smaller(text)
    counts = counts_of(text, size)
    starts = np.append(0, np.cumsum(counts))
    larger_of = counts - counts_of(text[smaller], size)
    first = (np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1).astype(np.int32)
    if len(first) > 1:
        rough = induce(text, smaller, starts, larger_of, first)
        leftmost = np.zeros(n, bool)
        leftmost[first] = True
        in_order = rough[leftmost[rough]]
        del rough, leftmost
        # A substring reaches to the next leftmost smaller suffix; the last one reaches to the end and is like no other.
        at = np.zeros(n, np.int32)
        at[first] = np.append(first[1:] - first[:-1] + 1, n - first[-1] + 1)
        lengths = at[in_order]
        lengths[np.flatnonzero(in_order == first[-1])] = n + 1
        at[in_order] = name_substrings(text, in_order, lengths)
        names = at[first]
        del at, in_order, lengths
        first = first[order_names(names)]
    return induce(text, smaller, starts, larger_of, first)


def permuted_matches(raw: np.ndarray, order: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For suffixes at ``starts`` whether they share ``length`` bytes with the suffix that precedes them in ``order``.

    The predecessors are laid out by place in the text (the permuted form of common prefixes), and the
    common prefixes are compared eight bytes at a time, up to ``length``. ``raw`` must go on for
    ``length`` bytes after every start.
    """
    previous = np.full(len(order), -1, np.int32)
    previous[order[1:]] = order[:-1]
    valid = np.zeros(len(order), bool)
    valid[starts] = True
    offsets = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]
    words = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))
    out = np.zeros(len(starts), bool)
    for i in range(0, len(starts), CHUNK):
        own = starts[i : i + CHUNK]
        other = previous[own]
        same = np.flatnonzero((other >= 0) & valid[other])
        for offset in offsets:
            same = same[words[own[same] + offset] == words[other[same] + offset]]
        out[i + same] = True
    return out
