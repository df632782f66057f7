"""Suffix arrays by induced sorting, and permuted common prefixes, with each step done for whole buckets in numpy."""

from __future__ import annotations

import numpy as np


def classify(symbols: np.ndarray) -> np.ndarray:
    """For each suffix whether it is smaller than the next one (S-type); the last suffix is not."""
    n = len(symbols)
    out = np.zeros(n, bool)
    if n > 1:
        # In a run of equal symbols all suffixes compare as the one that ends the run does.
        rises, differs = symbols[:-1] < symbols[1:], symbols[:-1] != symbols[1:]
        ends = np.where(differs, np.arange(n - 1), n)
        ends = np.minimum.accumulate(ends[::-1])[::-1]
        inside = ends < n
        out[:-1][inside] = rises[ends[inside]]
    return out


def leftmost(smaller: np.ndarray) -> np.ndarray:
    """Positions of leftmost S-type suffixes: those behind a suffix of the other type."""
    return np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1


def _scatter(order: np.ndarray, symbols: np.ndarray, found: np.ndarray, fronts: np.ndarray, step: int) -> np.ndarray:
    """Append suffixes, in the order found, at the front of their buckets; buckets are filled upwards or downwards."""
    keys = symbols[found]
    by = np.argsort(keys, kind="stable")
    found, keys = found[by], keys[by]
    heads = np.flatnonzero(np.diff(keys, prepend=-1))
    counts = np.diff(np.append(heads, len(keys)))
    rank = np.arange(len(keys)) - np.repeat(heads, counts)
    order[fronts[keys] + step * rank] = found
    fronts[keys[heads]] += step * counts
    return keys


def induce(symbols: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, alphabet: int) -> np.ndarray:
    """Order of all suffixes (or of their leading substrings) from the order of the leftmost S-type ones, ``seeds``.

    Buckets are taken by symbol. All suffixes of a bucket that are known send the suffix before them to its bucket at
    once; those that land in the same bucket are a further batch, as often as a symbol repeats in a row.
    """
    n = len(symbols)
    sizes = np.bincount(symbols, minlength=alphabet)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    order = np.full(n, -1, np.int64)
    grouped = seeds[np.argsort(symbols[seeds], kind="stable")]
    seed_ends = np.cumsum(np.bincount(symbols[seeds], minlength=alphabet))

    fronts = starts.copy()
    order[fronts[symbols[n - 1]]] = n - 1  # the last suffix precedes all others of its symbol
    fronts[symbols[n - 1]] += 1
    present = np.flatnonzero(sizes)
    for c in present:
        done = starts[c]
        while done < fronts[c]:
            batch = order[done : fronts[c]] - 1
            done = fronts[c]
            batch = batch[batch >= 0]
            batch = batch[~smaller[batch]]
            if len(batch):
                _scatter(order, symbols, batch, fronts, 1)
        batch = grouped[seed_ends[c] - (seed_ends[c] - (seed_ends[c - 1] if c else 0)) : seed_ends[c]] - 1
        batch = batch[batch >= 0]
        if len(batch):
            _scatter(order, symbols, batch, fronts, 1)
    larger_ends = fronts.copy()

    fronts = ends - 1
    for c in present[::-1]:
        done = ends[c] - 1
        while done > fronts[c]:
            batch = order[fronts[c] + 1 : done + 1][::-1] - 1
            done = fronts[c]
            batch = batch[batch >= 0]
            batch = batch[smaller[batch]]
            if len(batch):
                _scatter(order, symbols, batch, fronts, -1)
        batch = order[starts[c] : larger_ends[c]][::-1] - 1
        batch = batch[batch >= 0]
        batch = batch[smaller[batch]]
        if len(batch):
            _scatter(order, symbols, batch, fronts, -1)
    return order


def _names(symbols: np.ndarray, positions: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the leftmost substrings, in text order: equal ones share a name, and names are in their order."""
    n = len(symbols)
    place = np.full(n, -1, np.int64)
    place[positions] = np.arange(len(positions))
    ranked = place[order]
    ranked = ranked[ranked >= 0]  # substrings by order
    stop = np.append(positions[1:], n - 1)  # a substring reaches to the start of the next one
    length = stop - positions + 1
    a, b = ranked[:-1], ranked[1:]
    same = length[a] == length[b]
    left = np.flatnonzero(same)
    at = 0
    while len(left):
        x, y = positions[a[left]] + at, positions[b[left]] + at
        equal = symbols[x] == symbols[y]
        same[left[~equal]] = False
        at += 1
        left = left[equal & (at < length[a[left]])]
    # The last substring ends with the text, which no other does.
    if len(positions):
        last = len(positions) - 1
        same[(a == last) | (b == last)] = False
    names = np.empty(len(positions), np.int64)
    names[ranked] = np.concatenate([[0], np.cumsum(~same)])
    return names, int(names.max()) + 1 if len(names) else 0


def _order_of_names(names: np.ndarray, count: int, depth: int) -> np.ndarray:
    """Order of the suffixes of the reduced string by their first ``depth`` names at least.

    Its alphabet is as large as itself, so that buckets hold few suffixes each; it is sorted by pairs of neighbouring
    names, which are then names themselves, over and over.
    """
    n = len(names)
    rank = names
    step = 1
    order = np.argsort(rank, kind="stable")
    while count < n and step < depth:
        following = np.zeros(n, np.int64)
        following[: n - step] = rank[step:] + 1
        key = rank * (n + 2) + following
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        fresh = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        count = int(fresh[-1]) + 1
        step *= 2
    return order


def suffix_array(symbols: np.ndarray, alphabet: int, depth: int | None = None) -> np.ndarray:
    """All suffixes in order, or in the order of their first ``depth`` symbols at least."""
    n = len(symbols)
    if n < 2:
        return np.arange(n)
    symbols = symbols.astype(np.int64)
    smaller = classify(symbols)
    positions = leftmost(smaller)
    if not len(positions):
        return induce(symbols, smaller, positions, alphabet)
    order = induce(symbols, smaller, positions, alphabet)
    names, count = _names(symbols, positions, order)
    seeds = positions[_order_of_names(names, count, n if depth is None else depth)]
    return induce(symbols, smaller, seeds, alphabet)


def _shared(packed: np.ndarray, one: np.ndarray, other: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common prefix of each two suffixes, up to ``limit``, four packed symbols at a time."""
    length = np.full(len(one), limit, np.int64)
    left, at = np.arange(len(one)), 0
    while len(left) and at < limit:
        odd = packed[one[left] + at] ^ packed[other[left] + at]
        parted = odd != 0
        low = odd[parted]
        low &= ~low + np.uint64(1)  # the lowest differing bit
        length[left[parted]] = at + (np.frexp(low.astype(np.float64))[1] - 1) // 16
        left = left[~parted]
        at += 4
    return np.minimum(length, limit)


def common_prefixes(symbols: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """For each suffix, by rank, the length of the prefix it shares with the one before it, up to ``limit``.

    In text order the length falls by at most one from suffix to suffix, and by exactly one where the symbols before both
    suffixes agree. So only the others, the irreducible ones, are compared, and those whose forerunner was cut at the limit.
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.zeros(n + limit + 8, np.uint64)
    padded[:n] = symbols.astype(np.uint64) + np.uint64(1)
    packed = padded[:-3] | padded[1:-2] << np.uint64(16) | padded[2:-1] << np.uint64(32) | padded[3:] << np.uint64(48)
    own = np.arange(n)
    irreducible = before <= 0
    irreducible[0] = True
    check = np.flatnonzero(~irreducible)
    irreducible[check] = symbols[check - 1] != symbols[before[check] - 1]
    length = np.zeros(n, np.int64)
    compared = np.flatnonzero(irreducible & (before >= 0))
    length[compared] = _shared(packed, compared, before[compared], limit)
    last = np.maximum.accumulate(np.where(irreducible, own, 0))
    out = length[last] - (own - last)
    again = np.flatnonzero(~irreducible & (length[last] == limit))
    out[again] = _shared(packed, again, before[again], limit)
    return out[order]
