"""Words and word n-grams of whole texts as 64-bit hashes, in numpy.

A word is a run of bytes other than space, tab, newline, vertical tab, form feed and return,
in ASCII lower case. Its hash is a polynomial over random 64-bit values per byte, taken for
all words of a block at once from one running sum.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that are hashed at a time; a block ends at the next white space.
BLOCK = 1 << 20
#: Bytes of text whose words are held at a time, but for a longer text.
PORTION = 1 << 22

WHITE = (0x20, *range(0x09, 0x0E))
_BASE = 0x9E3779B97F4A7C15


def portions(texts: pa.Array) -> Iterator[slice]:
    """Stretches of rows whose texts have about ``PORTION`` bytes in all."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    low = 0
    while low < len(sizes):
        before = int(sizes[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(sizes, before + PORTION, "right")))
        yield slice(low, high)
        low = high


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Spreads every bit over all bits."""
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return hashes ^ (hashes >> np.uint64(32))


#: With these as white space too, words are runs of ASCII letters, digits and bytes beyond ASCII.
SIGNS = tuple(byte for byte in range(128) if not chr(byte).isalnum())


def _tables(white_bytes: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    white = np.zeros(256, bool)
    white[list(white_bytes)] = True
    return values, white


class Spans(NamedTuple):
    """Words in the bytes of several texts; ``offsets`` and ``bounds`` tell each text's bytes and words."""

    data: np.ndarray
    offsets: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    prefixes: np.ndarray
    bounds: np.ndarray


class Words:
    """Hashes the words of text columns; keeps its tables between batches."""

    def __init__(self, white: Sequence[int] = WHITE):
        self.values, self.white = _tables(white)
        self.powers = self.inverses = np.ones(0, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) < size:
            steps = np.full(size, _BASE, np.uint64)
            back = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
            steps[0] = back[0] = 1
            self.powers, self.inverses = np.cumprod(steps), np.cumprod(back)

    def _block(self, data: np.ndarray, fresh: np.ndarray, prefix: int) -> tuple[np.ndarray, ...]:
        """Begins, ends, hashes and prefix hashes of the words; ``fresh`` marks where a text begins."""
        self._grow(len(data) + 1)
        white = self.white[data]
        after_gap = np.ones(len(data) + 1, bool)
        after_gap[1:-1] = white[:-1] | fresh[1:]
        begins = np.flatnonzero(~white & after_gap[:-1])
        ends = np.flatnonzero(~white & (np.append(white[1:], True) | after_gap[1:])) + 1
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=sums[1:])

        def hashed(upto: np.ndarray) -> np.ndarray:
            return mixed((sums[upto] - sums[begins]) * self.inverses[begins])

        return begins, ends, hashed(ends), hashed(np.minimum(ends, begins + prefix)) if prefix else begins[:0]

    def spans(self, texts: pa.Array, prefix: int = 0) -> Spans:
        """The words of all texts, one after the other; ``prefix`` bytes are also hashed on their own."""
        texts = pc.fill_null(texts, "").cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        fresh = np.zeros(len(data) + 1, bool)
        fresh[offsets] = True
        parts, at = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2], 0
        while at < len(data):
            end = min(at + BLOCK, len(data))
            while end < len(data) and not (fresh[end] or self.white[data[end]]):
                end += 1
            begins, ends, hashes, prefixes = self._block(data[at:end], fresh[at:end], prefix)
            parts.append((begins + at, ends + at, hashes, prefixes if prefix else hashes[:0]))
            at = end
        begins, ends, hashes, prefixes = (np.concatenate(p) for p in zip(*parts, strict=True))
        return Spans(data, offsets, begins, ends, hashes, prefixes, np.searchsorted(begins, offsets))

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of all texts in a row, and where each text's words begin (and the end)."""
        found = self.spans(texts)
        return found.hashes, found.bounds


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for i in range(size):
        total = (total + words[i : count + i]) * np.uint64(0xA0761D6478BD642F)
        total ^= total >> np.uint64(29)
    return mixed(total)


def shingle_sets(texts: pa.Array, size: int, words: Words) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text; of fewer words, one of them all; none without words."""
    for rows in portions(texts):
        hashes, bounds = words.of(texts[rows])
        every = grams(hashes, size)
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if high - low >= size:
                found = np.sort(every[low : high - size + 1])
                yield found[np.append(True, found[1:] != found[:-1])]
            else:
                yield grams(hashes[low:high], high - low) if high > low else np.zeros(0, np.uint64)
