import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from numprep.llm import dart_minhash, textvec
from numprep.llm.components import components
from numprep.llm.dart_minhash import block_similarities, classes, keep_one, signatures, similarities

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(text or "")
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def similarity(a, b):
    shared = sum((a & b).values())
    return shared / max(1, sum(a.values()) + sum(b.values()) - shared)


def brute(rows):
    """Classes of row numbers: rows that a chain of links connects."""
    cells = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    having = defaultdict(list)
    for i, c in enumerate(cells):
        for k in c:
            having[k].append(i)
    pairs = {p for rows_of in having.values() for p in combinations(rows_of, 2)}
    for i, j in pairs:
        if root(i) != root(j) and similarity(cells[i], cells[j]) >= 0.8:
            parent[root(i)] = root(j)
    return [root(i) for i in range(len(rows))]


def check(documents, rows):
    """Rows have distinct doc_ids."""
    got = {r.doc_id: r for r in classes(documents(rows)).collect()}
    assert len(got) == len(rows)
    by = defaultdict(list)
    for (doc_id, _), root in zip(rows, brute(rows), strict=True):
        by[root].append(doc_id)
    for members in by.values():
        assert {got[d].class_id for d in members} == {min(members)}
        assert {got[d].class_size for d in members} == {len(members)}
        assert [d for d in members if got[d].kept] == [min(members)]
    assert sorted(r.doc_id for r in keep_one(documents(rows)).collect()) == sorted(min(m) for m in by.values())


def text(draw, n):
    return ["".join(draw.choices("abcdefgh", k=5)) for _ in range(n)]


def changed(draw, words, n):
    out = list(words)
    for k in draw.sample(range(len(out)), n):
        out[k] = "".join(draw.choices("xyz", k=5))
    return out


def test_sample(documents, sample):
    check(documents, [(i, t) for i, t, _ in sample])


@pytest.mark.parametrize("block", [64, 8])
def test_groups_at_the_threshold(documents, monkeypatch, block):
    monkeypatch.setattr(dart_minhash, "BLOCK", block)
    draw = random.Random(block)
    rows, number = [], 0
    for _ in range(12):
        base = text(draw, draw.randint(60, 200))
        for _ in range(draw.randint(1, 40)):
            rows.append((number, " ".join(changed(draw, base, draw.randint(0, max(1, len(base) // 25))))))
            number += 1
    chain = text(draw, 150)
    for _ in range(30):  # each is like the one before it only
        chain = changed(draw, chain, 3)
        rows.append((number, " ".join(chain)))
        number += 1
    draw.shuffle(rows)
    check(documents, rows)


def test_odd_texts(documents):
    rows = [(1, None), (2, ""), (3, " \n"), (4, None), (5, "one"), (6, "one"), (7, "one two"), (8, "a b c d e"), (9, "a  b\nc d e")]
    rows += [(10, "x " * 5000), (11, "x " * 4500), (12, "x " * 3000)]
    check(documents, rows)
    got = {r.doc_id: r.class_id for r in classes(documents(rows)).collect()}
    assert got[11] == 10 and got[12] == 12 and got[9] == 8 and got[4] == 4
    assert classes(documents([])).collect() == [] and keep_one(documents([])).collect() == []


def test_repeated_rows_and_missing_ids(documents):
    rows = [(None, "some text of a few words")] * 3 + [(1, "some text of a few words")] * 2 + [(None, "")] * 2
    got = classes(documents(rows)).collect()
    assert sum(r.kept for r in got) == 3 and {r.class_id for r in got} == {1, None}
    assert sorted(r.text for r in keep_one(documents(rows)).collect()) == ["", "", "some text of a few words"]


def test_signatures_estimate_similarity():
    draw = random.Random(1)
    base = text(draw, 400) + ["again and again and again"] * 5
    texts = [" ".join(base)] + [" ".join(changed(draw, base, k)) for k in (1, 4, 8, 16, 40)] + ["", "word"]
    made, full = signatures(*textvec.utf8(pa.array(texts)))
    assert full.tolist() == [True] * 6 + [False, True]
    exact = [similarity(shingles(texts[0]), shingles(t)) for t in texts]
    assert np.abs((made[:6] == made[0]).mean(axis=1) - exact[:6]).max() < 0.15
    assert np.allclose(similarities(pa.array(texts[:1] * 8), pa.array(texts)), exact)
    assert np.allclose(block_similarities(pa.array(texts[:2]), pa.array(texts))[0], exact)


def test_shortened_signatures_agree_where_whole_ones_do():
    draw = random.Random(3)
    base = text(draw, 300)
    texts = [" ".join(base)] + [" ".join(changed(draw, base, draw.randint(0, 60))) for _ in range(200)]
    made, _ = signatures(*textvec.utf8(pa.array(texts)))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(made))), pa.array([row.tobytes() for row in made], pa.binary())], names=["node", "signature"]
    )
    (short,) = dart_minhash._shortening([batch])
    values = short.column("value")
    assert set(map(len, values.to_pylist())) == {128}
    n = len(made)
    pairs = pa.RecordBatch.from_arrays(
        [pa.array([0] * n), pa.array(range(n)), pa.array([values[0].as_py()] * n, pa.binary()), values],
        names=["a", "b", "left", "right"],
    )
    found = {b for x in dart_minhash._agreeing([pairs]) for b in x.column("b").to_pylist()}
    whole = {i for i in range(n) if (made[0] == made[i]).mean() >= dart_minhash.LEAST_AGREEMENT}
    assert whole <= found and len(found - whole) <= 5 and 20 < len(whole) < n


def test_components_of_chains_stars_and_single_links(spark):
    draw = random.Random(5)
    names = list(range(400))
    draw.shuffle(names)
    pairs = [(names[i], names[i + 1]) for i in range(120)]
    pairs += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 4000 + i) for i in range(50)] + [(7, 7), (4001, 4002)]
    pairs += [tuple(draw.sample(names[150:], 2)) for _ in range(150)]
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in pairs:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    links = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {i: root(i) for i in parent}
    assert components(links.limit(0)).collect() == []
