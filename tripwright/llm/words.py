"""Whole batches of texts to 64-bit word and word n-gram hashes with numpy.

A word is a maximal run of UTF-8 bytes of one class; A-Z fold to a-z first. Its hash depends on
its bytes alone, so equal words have equal hashes in every task. Two different words share a hash
with a chance of about 2**-64 each; an operator that cannot live with that checks the words.

Null texts count as empty. Memory is about 40 bytes a byte of the slice worked on: slices are cut
between texts at ``SLICE_BYTES``, so only one text longer than that needs more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1_000_000
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEPS = np.array(
    [pow(0xD6E8FEB86659FD93, j + 1, 1 << 64) for j in range(32)], dtype=_U
)  # one odd multiplier for each place in an n-gram


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    h = h ^ (h >> _U(31))
    h = h * _U(0x7FB5D329728EA185)
    h = h ^ (h >> _U(27))
    h = h * _U(0x81DADEF4BC2DD44D)
    return h ^ (h >> _U(33))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _BASE)
_FOLDS = np.arange(256)
_FOLDS[65:91] += 32
_FOLDED = _BYTE[_FOLDS]


def _word_class(excluded: list[tuple[int, int]]) -> np.ndarray:
    table = np.ones(256, bool)
    for low, high in excluded:
        table[low : high + 1] = False
    table[65:91] = table[97:123]  # upper case counts as its lower case
    return table


#: ``[^\x20\x09-\x0D]+``
UNSPACED = _word_class([(0x20, 0x20), (0x09, 0x0D)])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after folding
ALPHANUMERIC = _word_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


class _Powers:
    """Powers of the base and of its inverse, kept as long as the longest slice so far."""

    up = np.ones(1, _U)
    down = np.ones(1, _U)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                table = np.full(n, base, _U)
                table[0] = 1
                setattr(cls, name, np.cumprod(table, dtype=_U))
        return cls.up, cls.down


class Words:
    """Word hashes of some texts: those of text ``i`` are ``hashes[starts[i]:starts[i + 1]]``."""

    def __init__(self, first: int, hashes: np.ndarray, starts: np.ndarray):
        self.first, self.hashes, self.starts = first, hashes, starts
        self.counts = np.diff(starts)

    @property
    def owner(self) -> np.ndarray:
        """For each word the number of its text, counted from the slice's first."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the n words from each word on, and whether all n lie in its text."""
        return ngrams(self.hashes, self.starts, n)


def ranges(hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the words of each range."""
    up, down = _Powers.to(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, _U)
    np.cumsum(hashes * up[: len(hashes)], dtype=_U, out=sums[1:])
    return mix((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(_U) * _BASE)


def _length_mark(n: int) -> np.ndarray:
    return np.array([n * int(_BASE) & 0xFFFFFFFFFFFFFFFF], _U)


def ngrams(hashes: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    total = len(hashes)
    out = np.full(total, _length_mark(n), _U)
    for j in range(min(n, total)):
        out[: total - j] += hashes[j:] * _STEPS[j]
    whole = np.ones(total, bool)
    room = starts[1:] - np.minimum(n - 1, np.diff(starts))
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, room, 1)
    np.add.at(edge, starts[1:], -1)
    whole[np.cumsum(edge)[:total] > 0] = False
    return mix(out), whole


def shingles(words: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's n-word shingles in order, and where each text's begin.

    A text with some words but fewer than n has its whole sequence as its only shingle.
    """
    hashes, whole = words.ngrams(n)
    counts = np.where(words.counts >= n, words.counts - n + 1, (words.counts > 0).astype(np.int64))
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    for i in short:
        at = words.starts[i]
        own = words.hashes[at : words.starts[i + 1]]
        value = (own * _STEPS[: len(own)]).sum(dtype=_U, keepdims=True) + _length_mark(len(own))
        hashes[at], whole[at] = mix(value)[0], True
    return hashes[whole], np.concatenate([[0], np.cumsum(counts)])


def slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(n, max(at + 1, end))
        yield at, end
        at = end


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, null as empty, and the offset of each."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def run_hashes(
    data: np.ndarray, begins: np.ndarray, ends: np.ndarray, values: np.ndarray = _BYTE
) -> np.ndarray:
    """A hash of the bytes of each run, from ``values`` of the bytes."""
    n = len(data)
    up, down = _Powers.to(n + 1)
    sums = np.zeros(n + 1, _U)
    np.cumsum(values[data] * up[:n], dtype=_U, out=sums[1:])
    hashes = (sums[ends] - sums[begins]) * down[begins]
    return mix(hashes + (ends - begins).astype(_U) * _BASE)


def words(texts: pa.Array, kind: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[Words]:
    """The word hashes of the texts, slice by slice in order."""
    if not len(texts):
        return
    raw, offsets = text_bytes(texts)
    for low, high in slices(offsets, limit):
        data = raw[offsets[low] : offsets[high]]
        bounds = offsets[low : high + 1] - offsets[low]
        n = len(data)
        if not n:
            yield Words(low, np.zeros(0, _U), np.zeros(high - low + 1, np.int64))
            continue
        inside = kind[data]
        before = np.empty(n, bool)
        before[0] = False
        before[1:] = inside[:-1]
        cuts = bounds[:-1][bounds[:-1] < n]
        before[cuts] = False
        begins = np.flatnonzero(inside & ~before)
        after = np.empty(n, bool)
        after[-1] = False
        after[:-1] = inside[1:]
        after[cuts[cuts > 0] - 1] = False
        ends = np.flatnonzero(inside & ~after) + 1
        hashes = run_hashes(data, begins, ends, _FOLDED)
        yield Words(low, hashes, np.searchsorted(begins, bounds).astype(np.int64))
