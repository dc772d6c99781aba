"""Encoding texts word by word with the tokenizers library, each distinct word once."""

from __future__ import annotations

from collections.abc import Callable, Collection

import numpy as np
import pyarrow as pa

from corpusloom.llm.batches import ranges, starts_of, text_bytes

#: Words of one call, joined by a separator.
JOINED = 1000
#: Bytes of words, and of their ids, that are kept at most; a piece of text needs its own words in any case.
KEPT_BYTES = 48 << 20
#: Punctuation after a word; an apostrophe is none, since it may begin a match of its own with letters.
TAIL = ".,;:!?|%$&*#()[]{}-+/"


def letters_and_tail(part: str) -> tuple[str, str] | None:
    """Letters and the punctuation after them; None for anything else, and beyond Latin letters.

    Split patterns that take a run of letters, and a run of other visible characters, match both apart.
    """
    core = part.rstrip(TAIL)
    if not core.isalpha():
        return None
    if not core.isascii():
        try:
            core.encode("latin-1")
        except UnicodeEncodeError:
            return None
    return core, part[len(core) :]


class Kept:
    """Ids of words, as little-endian unsigned 32-bit integers, made from the ids of their units.

    ``split`` gives the units of a word, which are encoded together, or None for a word that is encoded
    alone. ``limit`` words and twice as many units are kept at most; at their limit they start anew,
    with the ``fixed`` units.
    """

    def __init__(self, encode_alone, encode_units, split, limit: int, fixed: dict[str, bytes] | None = None):
        self.encode_alone, self.encode_units, self.split, self.limit = encode_alone, encode_units, split, limit
        self.fixed = fixed or {}
        self.words: dict[str, bytes] = {}
        self.units: dict[str, bytes] = dict(self.fixed)
        self.held = 0

    def add(self, distinct: Collection[str]) -> dict[str, bytes]:
        """The table of ids, holding at least the words of ``distinct``."""
        words = self.words
        new: Collection[str] = [word for word in distinct if word not in words]
        self.held += sum(map(len, new))
        if len(self.words) + len(new) > self.limit or self.held > KEPT_BYTES:
            # Long words are units of their own, so both stores begin anew.
            if self.held > KEPT_BYTES:
                self.units = dict(self.fixed)
            self.words, new = {}, distinct
            self.held = sum(map(len, new))
        split = self.split
        parts = {word: split(word) for word in new}
        alone = [word for word, units in parts.items() if units is None]
        self.words.update(zip(alone, self.encode_alone(alone)))
        units = {unit for found in parts.values() if found for unit in found} - self.units.keys()
        if len(self.units) + len(units) > 2 * self.limit:
            self.units = dict(self.fixed)
            units = {unit for found in parts.values() if found for unit in found} - self.units.keys()
        listed = list(units)
        for start in range(0, len(listed), JOINED):
            part = listed[start : start + JOINED]
            self.units.update(zip(part, self.encode_units(part)))
        get = self.units.__getitem__
        for word, found in parts.items():
            if found is not None:
                self.words[word] = b"".join(map(get, found)) if len(found) > 1 else get(found[0])
        return self.words


def as_bytes(encodings) -> list[bytes]:
    return [np.array(x.ids, "<u4").tobytes() for x in encodings]


def cut_after(ids: np.ndarray, last: np.ndarray, n: int) -> list[bytes]:
    """The ids in ``n`` groups, each up to and with a place where ``last`` is true."""
    ends = np.flatnonzero(last) + 1
    if len(ends) != n or (n and ends[-1] != len(ids)):
        raise ValueError("units were not encoded apart")
    raw = ids.astype("<u4").tobytes()
    return [raw[4 * a : 4 * b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


LETTER, TAILING, BLANK, OTHER = range(4)


def byte_classes() -> np.ndarray:
    """The class of each byte that is a character of its own."""
    classes = np.full(256, OTHER, np.uint8)
    classes[[b for b in range(128) if chr(b).isalpha()]] = LETTER
    classes[list(TAIL.encode())] = TAILING
    classes[list(b" \t\n\r")] = BLANK
    return classes


CLASSES = byte_classes()
#: Second bytes of the two-byte characters from U+00C0 on that are letters, and of those the upper-case ones.
LATIN = np.array([b >= 0x80 and b < 0xC0 and chr(0xC0 + b - 0x80).isalpha() for b in range(256)])
LATIN_UPPER = np.array([b >= 0x80 and b < 0x9F and chr(0xC0 + b - 0x80).isalpha() for b in range(256)])


def cut_units(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The units of all texts, one after another, which of them are odd, and where each text's units end.

    A word, between blanks, of letters and the punctuation after them makes two units, the letters in lower case; one of
    such punctuation only makes one. Any other word is one odd unit, as it is.
    """
    flat, ends = text_bytes(column)
    classes = CLASSES[flat]
    lower = np.where((flat >= 65) & (flat <= 90), flat | 32, flat).astype(np.uint8)
    lead = np.flatnonzero(flat[:-1] == 0xC3)
    lead = lead[LATIN[flat[lead + 1]]]
    classes[lead] = classes[lead + 1] = LETTER
    lead = lead[LATIN_UPPER[flat[lead + 1]]] + 1
    lower[lead] += 32
    before = np.empty_like(classes)
    before[1:] = classes[:-1]
    before[starts_of(ends)[ends > starts_of(ends)]] = BLANK
    first = np.flatnonzero((classes != BLANK) & (before == BLANK))
    bad = np.flatnonzero((classes == OTHER) | ((classes == LETTER) & (before == TAILING)))
    is_odd = np.zeros(len(first), bool)
    is_odd[np.searchsorted(first, bad, side="right") - 1] = True
    tails = np.flatnonzero((classes == TAILING) & (before == LETTER))
    tails = tails[~is_odd[np.searchsorted(first, tails, side="right") - 1]]
    visible = classes != BLANK
    place = np.zeros(len(flat) + 1, np.int32)
    np.cumsum(visible, dtype=np.int32, out=place[1:])
    # An odd word's bytes as they are.
    stops = np.append(first[1:], len(flat))
    at = ranges(first[is_odd], (stops - first)[is_odd])
    lower[at] = flat[at]
    starts = np.sort(np.concatenate([first, tails]))
    odd = np.zeros(len(starts), bool)
    odd[np.searchsorted(starts, first[is_odd])] = True
    offsets = np.append(place[starts], place[-1]).astype(np.int32)
    data = np.ascontiguousarray(lower[visible])
    units = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return units, odd, np.searchsorted(starts, ends)


class KeptUnits:
    """Ids of units, as bytes. Two generations are kept: units that are met again move on when the older one is dropped."""

    def __init__(self, encode_alone: Callable, encode_units: Callable, limit: int):
        self.encode_alone, self.encode_units, self.limit = encode_alone, encode_units, limit
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.held = 0

    def find(self, units: list[bytes], odd: np.ndarray) -> list[bytes]:
        """The ids of each of these distinct units."""
        if len(self.young) > self.limit // 2 or self.held > KEPT_BYTES // 2:
            self.old, self.young, self.held = self.young, {}, 0
        found = list(map(self.young.get, units))
        for i in [i for i, x in enumerate(found) if x is None]:
            ids = self.old.get(units[i])
            if ids is not None:
                found[i] = self.young[units[i]] = ids
                self.held += len(units[i]) + len(ids)
        new = [i for i, x in enumerate(found) if x is None]
        plain, alone = [i for i in new if not odd[i]], [i for i in new if odd[i]]
        for start in range(0, len(plain), JOINED):
            part = plain[start : start + JOINED]
            for i, ids in zip(part, self.encode_units([units[i].decode() for i in part])):
                found[i] = ids
        for i, ids in zip(alone, self.encode_alone([units[i].decode() for i in alone])):
            found[i] = ids
        for i in new:
            self.young[units[i]] = found[i]
            self.held += len(units[i]) + len(found[i])
        return found
