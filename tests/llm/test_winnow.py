import hashlib
import random
import re

from numprep.llm.common import merge_runs
from numprep.llm.winnow import clean, report

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    own = words(text)
    hit, found = set(), set()
    for item_id, item in items:
        w = words(item)
        n = min(10, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(own) - n + 1):
            if n and tuple(own[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add("" if item_id is None else str(item_id))
    return len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def check(spark, documents, rows, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = report(documents(rows), benchmark).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == brute(texts[r.doc_id], items), r
    kept = sorted(r.doc_id for r in clean(documents(rows), benchmark).collect() if r.doc_id is not None)
    assert kept == sorted(d for d, t in rows if d is not None and not brute(t, items)[4])


def test_random_passages(spark, documents):
    draw = random.Random(2)
    vocabulary = ["a", "B", "ça", "d1", "e", "漢字", "f"]

    def text(n):
        return "".join(draw.choice(vocabulary) + draw.choice([" ", "  ", "-", "\n", "'"]) for _ in range(n))

    items = [(i, text(draw.choice([1, 3, 9, 10, 11, 25, 60]))) for i in range(25)]
    items += [(100, None), (101, " - "), (102, items[5][1]), (103, "repeat " * 30)]
    rows = []
    for i in range(150):
        own = text(draw.randint(0, 60))
        if i % 3 == 0:
            piece = draw.choice(items)[1] or ""
            own += piece[draw.randint(0, 5) : draw.randint(20, 400)].upper() + " " + text(5)
        rows.append((i, own))
    rows += [(200, None), (201, ""), (202, "x " * 5000 + items[6][1] + " y" * 5000), (203, "repeat " * 100)]
    check(spark, documents, rows, items)


def test_long_items_only_and_no_items(spark, documents):
    draw = random.Random(8)
    text = [" ".join("".join(draw.choices("abc", k=3)) for _ in range(40)) for _ in range(12)]
    rows = [(i, text[i] + " " + text[(i * 5) % 12][: 10 * i]) for i in range(12)] + [(None, "none at all")]
    check(spark, documents, rows, [(i, text[i][20:120]) for i in range(4)])
    check(spark, documents, rows, [])
    check(spark, documents, [], [(1, text[0])])


def test_repeated_rows(spark, documents):
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    rows = [(1, "zero one two three")] * 3 + [(1, "other text")] * 2
    got = report(documents(rows), benchmark).collect()
    assert sorted(r.n_hit for r in got) == [0, 0, 3, 3, 3]
    assert clean(documents(rows), benchmark).count() == 2


def test_runs_merged_as_by_brute_force(spark):
    draw = random.Random(12)
    rows = []
    for i in range(200):
        starts = sorted(draw.randrange(200) for _ in range(draw.randint(0, 30)))
        rows.append((i, sorted((a, a + draw.randint(1, 12)) for a in starts)))
    # Many separate runs of one text take no longer each than a few.
    rows.append((1000, [(3 * i, 3 * i + 2) for i in range(300_000)]))
    df = spark.createDataFrame(rows, "id long, runs array<struct<start: int, stop: int>>")
    for r in merge_runs(df).collect():
        covered = {x for a, b in dict(rows)[r.id] for x in range(a, b)}
        edges = sorted(x for x in covered if x - 1 not in covered), sorted(x + 1 for x in covered if x + 1 not in covered)
        assert [tuple(x) for x in r.runs] == list(zip(*edges, strict=True))
    assert merge_runs(df.limit(0)).collect() == []
