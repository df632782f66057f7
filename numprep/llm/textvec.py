"""Words and their hashes over whole batches of texts, in numpy, without a Python loop over words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer text is worked on alone.
SLICE_BYTES = 1 << 19

#: Longest range of values whose equality is judged by `run_hashes` alone where `digests` is used.
LONG = 256

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _random_table(seed: int) -> np.ndarray:
    return mix64((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_ODD) + np.uint64(seed))


_BYTES = _random_table(7)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse, modulo 2^64."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        made = []
        for base in (_ODD, pow(_ODD, -1, 1 << 64)):
            row = np.ones(size, np.uint64)
            row[1:] = np.uint64(base)
            made.append(np.multiply.accumulate(row))
        if size > 8 * SLICE_BYTES:
            return made[0], made[1]
        _powers = (made[0], made[1])
    return _powers


def classes(separators: bytes) -> np.ndarray:
    """For each byte whether it belongs to a word."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


#: Words are runs of bytes other than blank, tab, line feed, VT, FF and CR. These are never part of a longer character.
WORD_BYTES = classes(b" \t\n\x0b\x0c\r")


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each starts (one more at the end); missing texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


@dataclass
class Words:
    """Words of some texts: byte range of each, and for each text the range of its words."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    last: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return self.last - self.first

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first)), self.counts)


def find_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = WORD_BYTES) -> Words:
    """The words of texts; a word never goes on in the next text."""
    n = len(data)
    inside = table[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    opens[cuts] = inside[cuts]
    closes[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(opens)
    ends = np.flatnonzero(closes) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets[:-1]), np.searchsorted(starts, offsets[1:]))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each range of 64-bit values: equal ranges have equal hashes wherever they are."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range."""
    return run_hashes(_BYTES[data], starts, ends)


def digests(values: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hashes of ranges, with those of ranges over ``LONG`` values replaced by a digest of the values themselves.

    Sums of powers modulo 2^64 are equal for some long ranges of two values that are no chance pairs, whatever the values; ranges
    up to this length are too short for these.
    """
    hashes = hashes.copy()
    for i in np.flatnonzero(ends - starts > LONG).tolist():
        raw = hashlib.blake2b(values[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        hashes[i] = int.from_bytes(raw, "little")
    return hashes


def fold(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z."""
    return _FOLD[data]


def counts_within(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many flags are set in each of the neighbouring ranges that ``bounds`` delimits."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` neighbours; runs across texts are for the caller to leave out."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out *= np.uint64(_ODD)
        out += hashes[i : i + n]
    return mix64(out)


def window_fits(words: Words, size: int) -> np.ndarray:
    """For each word, short of the last ``size`` - 1, whether the run that starts there stays in its text."""
    n = len(words.starts) - size + 1
    if n <= 0:
        return np.zeros(0, bool)
    last = np.repeat(words.last, words.counts)
    return np.arange(n) + size <= last[:n]


def sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over each run of ``size`` neighbours."""
    span, out = 1, values
    while span < size:
        step = min(span, size - span)
        out = pick(out[: len(out) - step], out[step:])
        span += step
    return out


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at ``starts`` and have ``counts`` numbers."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)
