import re
from collections import defaultdict

import pytest

from numprep.llm.mixing import EPOCHS, WEIGHTS, measured, mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Shares by weight; what is above twice a source is shared again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(order)}
    budget, out = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in out]
        total = sum(weight[s] for s in rest)
        share = (budget - sum(out.values())) / total if rest else 0
        over = [s for s in rest if weight[s] * share >= 2 * sizes[s]]
        if not over:
            return out | {s: weight[s] * share for s in rest}
        out |= {s: 2 * sizes[s] for s in over}


def check(rows, got):
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    expected, taken = targets(sizes), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source])
        assert 0 <= r.taken <= EPOCHS * r.size
        assert abs(r.copies * r.size - r.taken) <= r.size / 2 or r.size == 0
        taken[r.source] += r.taken
    for source, words in taken.items():
        assert words == round(expected[source] + 1e-9) or abs(words - expected[source]) <= 0.5


def run(docs):
    return mix(measured(docs, "mix")).collect()


def test_sample(documents, sample):
    got = run(documents(sample))
    check(sample, got)
    again = {r.doc_id: r.taken for r in run(documents(sample).repartition(5))}
    assert again == {r.doc_id: r.taken for r in got}


def test_odd_sources(documents):
    rows = [(i, "w " * (i % 50), "é") for i in range(400)] + [(None, None, None), (1, "", "b"), (2, "one", None)]
    rows += [(5, "same words here", "B")] * 40 + [(6, "ab " * 3000, "a")]
    check(rows, run(documents(rows)))
    assert run(documents([])) == []
    assert [r.taken for r in run(documents([(1, None, None)]))] == [0]


def test_better_documents_come_first(documents):
    rows = [(i, ("good words " if i % 2 else "### %% 123 ") * 5, "a") for i in range(2000)]
    taken = [0, 0]
    for r in run(documents(rows)):
        taken[r.doc_id % 2] += r.copies > 1
    assert taken[1] > 1.3 * taken[0]
