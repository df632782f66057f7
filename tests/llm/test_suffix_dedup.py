import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from numprep.llm import suffix_dedup
from numprep.llm.suffix_array import common_prefixes, suffix_array
from numprep.llm.suffix_dedup import remove_repeats


@pytest.mark.parametrize("depth", [None, 9])
def test_suffix_array(depth):
    draw = np.random.default_rng(2)
    for trial in range(300):
        n, kinds = int(draw.integers(0, 60)), int(draw.integers(1, 6))
        symbols = draw.integers(0, kinds, n)
        if trial % 3 == 0 and n:
            symbols = np.tile(symbols[: max(1, n // 7)], 9)
        text = symbols.tolist()
        order = suffix_array(symbols, kinds, depth)
        got = [text[i:][:depth] for i in order.tolist()]
        assert sorted(order.tolist()) == list(range(len(text))) and got == sorted(got)
        limit = depth or 1000
        for rank, shared in enumerate(common_prefixes(symbols, order, limit).tolist()):
            a, b = (text[order[rank - 1] :], text[order[rank] :]) if rank else ([], [])
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared == min(same, limit)


def check(documents, rows):
    raw = [(t or "").encode() for _, t in rows]
    starts = Counter(b[i : i + 400] for b in raw for i in range(len(b) - 399))
    expected = []
    for (doc_id, _), b in zip(rows, raw, strict=True):
        gone = bytearray(len(b) + 1)
        for i in range(len(b) - 399):
            if starts[b[i : i + 400]] > 1:
                gone[i : i + 400] = b"\1" * 400
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(gone[i] and not gone[i - 1] for i in range(len(b)))
        expected.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    got = remove_repeats(documents(rows)).collect()
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got]
    assert sorted(found, key=str) == sorted(expected, key=str)
    return sum(x[2] for x in expected)


def random_rows(seed):
    draw = random.Random(seed)

    def text(n):
        return "".join(draw.choices("abcde é\n漢", k=n))

    passages = [text(n) for n in (320, 399, 400, 401, 450, 700, 1500)] + ["ab" * 400, "x" * 900]
    rows = [(i, "".join(draw.choice([text(draw.randint(0, 300)), draw.choice(passages)]) for _ in range(4))) for i in range(120)]
    base = text(2500)
    for i in range(40):  # near copies
        words = list(base)
        for k in draw.sample(range(len(words)), 4):
            words[k] = "Z"
        rows.append((1000 + i, "".join(words)))
    return rows + [(2000, base), (2001, base), (None, None), (None, ""), (3, "short"), (3, "short"), (4, "y" * 399), (5, "y" * 399)]


@pytest.mark.parametrize(("shard", "rows"), [(8_000, 4_000_000), (5, 0)])
def test_against_brute_force(documents, monkeypatch, shard, rows):
    """Whole shards and broadcasts; and anchors split over many shards, with joins by shuffle."""
    monkeypatch.setattr(suffix_dedup, "SHARD", shard)
    monkeypatch.setattr(suffix_dedup, "BROADCAST_ROWS", rows)
    assert check(documents, random_rows(shard)) > 100_000


def test_long_text_in_chunks(documents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1000)
    draw = random.Random(6)
    long = "".join(draw.choices("abcdef", k=9000))
    check(documents, [(1, long), (2, long[3000:5000] + "!" + long[2500:3600]), (3, "q" + long[8000:])])


def test_nothing_repeats_and_empty(documents):
    assert check(documents, [(1, "a" * 400), (2, None)]) == 0
    assert remove_repeats(documents([])).collect() == []
