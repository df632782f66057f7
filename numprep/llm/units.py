"""Texts cut at blanks into units that a tokenizer treats alone, each different unit looked at once per batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from numprep.llm import textvec

#: Results of units in each of the two generations that a worker remembers. It changes the time taken, nothing else.
REMEMBERED = 100_000


#: Kinds that a ``FlatMemory`` keeps; a kind takes about 40 bytes there.
KEPT = 150_000


@dataclass
class Units:
    """Units of some texts: ``kinds`` are the different ones, ``which`` the kind of each unit, ``offsets`` by text."""

    kinds: list[str] | pa.Array
    which: np.ndarray
    offsets: np.ndarray


def cut(texts: pa.Array, blank: str, whole: Callable[[pa.Array], pa.Array], split: Callable[[str], list[str]]) -> Units:
    """Cut at every ``blank``, which belongs to the unit after it; texts that ``whole`` marks are cut by ``split``."""
    units = cut_flat(texts, blank, whole, split)
    return Units(units.kinds.to_numpy(zero_copy_only=False).tolist(), units.which, units.offsets)


def cut_flat(
    texts: pa.Array, blank: str, whole: Callable[[pa.Array], pa.Array], split: Callable[[str], list[str]]
) -> Units:
    """As ``cut``, with the kinds as an Arrow column."""
    texts = texts.fill_null("")
    odd = np.flatnonzero(whole(texts).to_numpy(zero_copy_only=False))
    plain = texts
    if len(odd):
        mask = np.zeros(len(texts), bool)
        mask[odd] = True
        plain = pc.if_else(pa.array(mask), "", texts)
    parts = pc.split_pattern(plain, blank)
    offsets = np.asarray(parts.offsets).astype(np.int64)
    coded = pc.dictionary_encode(parts.flatten())
    which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words = coded.dictionary
    offsets = offsets - offsets[0]
    n = len(words)
    heads = offsets[:-1]
    which[heads] += n  # the first unit of a text has no blank before it
    used = np.zeros(2 * n, bool)
    used[which] = True
    behind, first = np.flatnonzero(used[:n]), np.flatnonzero(used[n:])
    kinds = pa.concat_arrays(
        [pc.binary_join_element_wise(blank, words.take(pa.array(behind)), ""), words.take(pa.array(first))]
    )
    which = (np.cumsum(used) - 1)[which]
    if len(odd):
        pieces = [split(texts[int(i)].as_py()) for i in odd]
        number: dict[str, int] = {}
        for piece in pieces:
            for unit in piece:
                number.setdefault(unit, len(number))
        rows = [which[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        for i, piece in zip(odd, pieces, strict=True):
            rows[i] = np.array([number[u] + len(kinds) for u in piece], np.int64)
        which = np.concatenate(rows)
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        kinds = pa.concat_arrays([kinds, pa.array(list(number), kinds.type)])
    return Units(kinds, which, offsets)


class Memory:
    """Results of kinds met lately: when the newer generation is full it becomes the older one, which is forgotten."""

    def __init__(self, compute: Callable[[list[str]], list], remembered: int = REMEMBERED):
        self.compute = compute
        self.remembered = remembered
        self.newer: dict = {}
        self.older: dict = {}

    def results(self, kinds: list[str]) -> list:
        """The result of each kind, computed only for those that are not remembered."""
        newer, older = self.newer, self.older
        out = [newer.get(k) for k in kinds]
        for i in [i for i, r in enumerate(out) if r is None]:
            if (found := older.get(kinds[i])) is not None:
                out[i] = newer[kinds[i]] = found
        missing = [i for i, r in enumerate(out) if r is None]
        names = [kinds[i] for i in missing]
        fresh = self.compute(names)
        for i, found in zip(missing, fresh, strict=True):
            out[i] = found
        if len(newer) + len(names) > self.remembered:
            self.older, self.newer = newer, {}
        self.newer.update(zip(names, fresh, strict=True))
        return out


class FlatMemory:
    """Identifiers of kinds met lately, as columns: of too many kinds, those that were not met for longest are forgotten.

    ``compute`` gives the identifiers of a column of kinds, one after the other, and how many each kind has.
    """

    def __init__(self, compute: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], kept: int = KEPT):
        self.compute = compute
        self.kept = kept
        self.kinds = pa.array([], pa.string())
        self.flat, self.counts, self.met = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.time = 0

    def results(self, kinds: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Identifiers, and for each kind where its own start among them and how many they are."""
        self.time += 1
        at = pc.index_in(kinds, value_set=self.kinds).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        known = at >= 0
        self.met[at[known]] = self.time
        fresh = kinds.filter(pa.array(~known))
        found, sizes = self.compute(fresh)
        at[~known] = len(self.kinds) + np.arange(len(fresh))
        self.kinds = pa.concat_arrays([self.kinds, fresh])
        self.flat = np.concatenate([self.flat, found])
        self.counts = np.concatenate([self.counts, sizes])
        self.met = np.concatenate([self.met, np.full(len(fresh), self.time)])
        flat, counts = self.flat, self.counts
        starts = np.cumsum(counts) - counts
        if len(counts) > self.kept:
            stay = np.sort(np.argsort(-self.met, kind="stable")[: self.kept])
            self.kinds = self.kinds.take(pa.array(stay))
            self.flat, self.counts, self.met = flat[textvec.ranges(starts[stay], counts[stay])], counts[stay], self.met[stay]
        return flat, starts[at], counts[at]
