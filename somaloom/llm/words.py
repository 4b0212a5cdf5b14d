"""Words of many texts at once, as byte positions and 64-bit hashes in numpy arrays.

A text is taken as its UTF-8 bytes with A-Z lower-cased, so a class of ASCII
separators decides what a word is and every other code point is a letter. A hash is a
sum over the bytes of a random value of the byte times a random value of its place in the
word, finished by a mixer: the same for equal words in every text, process and run, and for two given
different words equal with a chance of about 2**-60, whatever their make (places have no algebra that words could
cancel in). Work arrays are held for one block of bytes at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
SHINGLE = 5

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C13)
_SPOTS = _RNG.integers(1, 2**63, 1 << 14, dtype=np.uint64) * np.uint64(2) + np.uint64(1)  # values of the first places of a word

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _bytes_where(test) -> np.ndarray:
    return np.array([test(b) for b in range(256)], dtype=bool)


#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of a text with A-Z lower-cased
ALNUM = _bytes_where(lambda b: b >= 128 or 48 <= b <= 57 or 97 <= b <= 122)
#: words [^\x20\x09-\x0D]+
NON_SPACE = _bytes_where(lambda b: not (b == 32 or 9 <= b <= 13))
#: every byte but the line feed: paragraphs
LINE = _bytes_where(lambda b: b != 10)


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a hash: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for ascending spans without overlap; equal bytes have equal hashes wherever they stand."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        origin = starts[first]
        last = max(int(np.searchsorted(starts, origin + BLOCK, "left")), first + 1)
        s, e = starts[first:last] - origin, ends[first:last] - origin
        size = int(e[-1])
        lengths = e - s
        cuts = np.cumsum(lengths)
        place = np.arange(cuts[-1]) - np.repeat(cuts - lengths, lengths)
        own = data[origin : origin + size] if cuts[-1] == size else data[origin : origin + size][place + np.repeat(s, lengths)]
        terms = _BYTE[own] * _spot(place)
        full = lengths > 0
        out[first:last] = 0
        if full.any():
            out[first:last][full] = np.add.reduceat(terms, (cuts - lengths)[full])
        first = last
    return mix(out)


def _spot(place: np.ndarray) -> np.ndarray:
    """Random odd value of each place; those of far places are products of two."""
    size = len(_SPOTS)
    out = _SPOTS[place % size] if place.max(initial=0) >= size else _SPOTS[place]
    far = np.flatnonzero(place >= size)
    if len(far):
        out[far] *= mix((place[far] // size).astype(np.uint64) * _BASE) | np.uint64(1)
    return out


@dataclass
class Words:
    data: np.ndarray  # lower-cased bytes of all texts
    offsets: np.ndarray  # byte offsets of the texts, one more than there are texts
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray  # which text a word belongs to
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=len(self.offsets) - 1)

    @property
    def firsts(self) -> np.ndarray:
        """Index of the first word of each text, then the number of words."""
        return np.concatenate([[0], np.cumsum(self.counts)])


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary array without nulls."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(column: pa.Array, kind: np.ndarray = ALNUM, hashed: bool = True, apart: tuple[np.ndarray, np.ndarray] | None = None) -> Words:
    """The words of every text of an Arrow string array without nulls.

    ``apart`` names two classes of bytes between which a word is cut too.
    """
    raw, offsets = raw_bytes(column)
    data = LOWER[raw]
    inside = kind[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    if apart is not None and len(data) > 1:
        one, other = apart[0][data], apart[1][data]
        edge[1:-1] |= (one[1:] & other[:-1]) | (one[:-1] & other[1:])
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    doc = np.searchsorted(offsets, starts, "right") - 1
    return Words(data, offsets, starts, ends, doc, span_hash(data, starts, ends) if hashed else np.zeros(0, np.uint64))


def shingles(group: np.ndarray, hashes: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(group, hash) of every run of ``size`` words inside a group (text or paragraph).

    A group of fewer words has one shingle, all of its words. Groups stand in ascending order.
    """
    n = len(group)
    if not n:
        return group, hashes
    total = hashes * _PLACE[0]
    full = np.ones(n, bool)
    for j in range(1, size):
        if j < n:
            same = group[j:] == group[:-j]
            total[:-j] += np.where(same, hashes[j:] * _PLACE[j], np.uint64(0))
            full[:-j] &= same
        full[max(n - j, 0) :] = False
    first = np.ones(n, bool)
    first[1:] = group[1:] != group[:-1]
    keep = full | (first & ~full)
    return group[keep], mix(total[keep])


def tally(group: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, value) in ascending order, with how often each stands; groups ascend already."""
    order = np.lexsort((values, group))
    group, values = group[order], values[order]
    new = np.ones(len(group), bool)
    new[1:] = (group[1:] != group[:-1]) | (values[1:] != values[:-1])
    at = np.flatnonzero(new)
    return group[at], values[at], np.diff(np.append(at, len(group)))


def whole_hash(group: np.ndarray, hashes: np.ndarray, n_groups: int) -> np.ndarray:
    """One hash for the word sequence of each group; 0 for a group without words."""
    out = np.zeros(n_groups, np.uint64)
    if len(group):
        first = np.searchsorted(group, np.arange(n_groups), "left")
        place = np.arange(len(group)) - first[group]
        terms = mix(hashes + mix(place.astype(np.uint64) * _BASE + np.uint64(1)))
        np.add.at(out, group, terms)
        some = np.bincount(group, minlength=n_groups) > 0
        out[some] = mix(out[some]) | np.uint64(1)
    return out
