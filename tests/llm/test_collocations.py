import re
import time
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from numprep.llm import collocations as module
from numprep.llm.collocations import Wanted, collocations, frequent_phrases
from numprep.llm.queries import ORACLES, QUERIES

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def _counts(docs, longest=4):
    counts, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    return counts, n


def _by_hand(docs, support=30, longest=4, absorbed=80, top=2000):
    counts, n = _counts(docs, longest)
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= support}
    longer = defaultdict(int)
    for (lang, words), b in candidates.items():
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                if j - i < len(words):
                    longer[lang, words[i:j]] = max(longer[lang, words[i:j]], b)
    rows = defaultdict(list)
    for (lang, words), a in candidates.items():
        if 100 * longer[lang, words] >= absorbed * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        rows[lang].append((-score, -a, " ".join(words).encode(), left, right))
    out = []
    for lang, found in rows.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def _docs(seed, n=120):
    rng = np.random.default_rng(seed)
    words = ["the", "The", "of", "a", "é", "ÄB", "x y", "new", "york", "new  york", "new\tyork", "city", "$$", "|", "ü "]
    docs = []
    for i in range(n):
        size = int(rng.integers(0, 60))
        picked = [words[j] for j in rng.zipf(1.4, size) % len(words)]
        text = " ".join(w + ("." if rng.random() < 0.1 else ",\n" if rng.random() < 0.05 else "") for w in picked)
        docs.append((None if i % 29 == 0 else text, [None, "und", "en", "de"][i % 4]))
    return docs + [("New York is new york. " * 200, "en"), ("a " * 700, "fr"), ("", "en"), (" \t ", "en"), (".,;", None)] + [("w x y z", "en")] * 40


def _frame(spark, docs):
    return spark.createDataFrame([(t, g, 1, "x") for t, g in docs], "text string, lang string, f int, phrase string")


@pytest.mark.parametrize(("seed", "support", "longest", "top"), [(0, 30, 4, 2000), (1, 5, 4, 7), (2, 2, 3, 50), (3, 30, 2, 3)])
def test_against_counting_by_hand(spark, seed, support, longest, top):
    docs = _docs(seed)
    found = collocations(_frame(spark, docs), support=support, longest=longest, top=top)
    assert found.columns == COLUMNS
    expected = _by_hand(docs, support, longest, top=top)
    assert expected and sorted(map(tuple, found.collect())) == expected


@pytest.mark.parametrize(("slice_bytes", "per_range", "sent"), [(64, 50, 4), (1 << 20, 10, 10_000), (1, 10_000, 0)])
def test_slices_ranges_and_shuffled_candidates(spark, monkeypatch, slice_bytes, per_range, sent):
    for name, value in (("SLICE_BYTES", slice_bytes), ("HELD", slice_bytes), ("WORDS_PER_RANGE", per_range), ("BROADCAST_ROWS", sent)):
        monkeypatch.setattr(module, name, value)
    docs = _docs(7)
    expected = {k: a for k, a in _counts(docs)[0].items() if a >= 12}
    phrases, n = frequent_phrases(_frame(spark, docs), support=12)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in phrases.collect()} == expected
    assert {r.lang: r.n for r in n.collect() if r.n} == {k: v for k, v in _counts(docs)[1].items() if v}


def test_keys_shared_by_all_phrases_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(module.textvec, "span_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    docs = _docs(9, 40)
    rows = []
    for batch in _batches(docs):
        rows += list(module._occurrences(4, 1, None)(iter([batch])))
    total = Counter()
    for batch in rows:
        for lang, phrase, size, f, _ in zip(*(c.to_pylist() for c in batch.columns)):
            assert len(phrase.split(" ")) == size
            total[lang, tuple(phrase.split(" "))] += f
    assert total == _counts(docs)[0]


def _batches(docs):
    import pyarrow as pa

    yield pa.RecordBatch.from_arrays(
        [pa.array([t or "" for t, _ in docs]), pa.array([g or "und" for _, g in docs]), pa.array([0] * len(docs))],
        names=["text", "lang", "shard"],
    )


def test_many_of_one_phrase_in_a_slice(spark):
    docs = [("so it goes " * 1000, "en")]
    assert sorted(map(tuple, collocations(_frame(spark, docs)).collect())) == _by_hand(docs)


def test_counts_beyond_64_bits(spark):
    big = 4 * 10**18
    row = spark.sql(f"select {big}L as a, {big}L as l, {big}L as r").select(module._whole_division(2_000_000).alias("s")).first()
    assert row.s == 2_000_000 * big // (2 * big)


def test_wanted_keys():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 40, 1000).astype(np.uint64))
    asked = np.concatenate([keys[::3], rng.integers(0, 1 << 40, 5000).astype(np.uint64)])
    assert (Wanted(keys).has(asked) == np.isin(asked, keys)).all()
    assert not Wanted(keys[:0]).has(asked).any()


def test_marked_keys():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 40, 20_000).astype(np.uint64))
    marked = module.Marked([keys[:7], keys[7:]])
    others = np.setdiff1d(rng.integers(0, 1 << 40, 100_000).astype(np.uint64), keys)
    assert marked.has(keys).all() and marked.has(others).mean() < 0.01 and len(marked.marks) <= 3 * len(keys) + 9
    assert not module.Marked([]).has(others).any()


def test_a_round_sends_marked_phrases_of_its_keys_only():
    batch = next(_batches(_docs(11)))

    def rows(candidates, share):
        found = Counter()
        for part in module._occurrences(4, 1, candidates, share)(iter([batch])):
            for lang, phrase, _, f, key in zip(*(c.to_pylist() for c in part.columns)):
                assert share is None or share[0] <= key < share[1]
                found[lang, phrase, key] += f
        return found

    every = rows(None, None)
    first, second = (rows(None, x) for x in ((0, 1 << 31), (1 << 31, 1 << 32)))
    assert first and second and not first.keys() & second.keys() and first + second == every
    keys = np.array(sorted({key for (_, _, key), f in every.items() if f >= 30}), np.uint64)

    class Sent:
        value = module.Marked([keys])

    marked = rows(Sent, None)
    assert all(marked[k] == f for k, f in every.items() if f >= 30) and len(marked) < len(every) / 10


def test_numbers_of_phrases_beyond_64_bits():
    exact = np.array([5, 1, 5, 1, 5, 2, 5, 1, 5, 1])
    numbers = module._phrase_numbers(exact, np.arange(7), 4, 1 << 30)
    windows = [tuple(exact[i : i + 4]) for i in range(7)]
    assert len(set(zip(numbers.tolist(), windows))) == len(set(numbers.tolist())) == len(set(windows)) == 6


@pytest.mark.parametrize(("marked", "rounds"), [(60, 12), (1, 3)])
def test_candidates_counted_in_rounds(spark, monkeypatch, marked, rounds):
    for name, value in (("BROADCAST_ROWS", 4), ("MARKED_ROWS", marked), ("ROUNDS", rounds), ("WORDS_PER_RANGE", 1000)):
        monkeypatch.setattr(module, name, value)
    docs = _docs(13)
    expected = {k: a for k, a in _counts(docs)[0].items() if a >= 12}
    assert len(expected) > 60
    phrases, _ = frequent_phrases(_frame(spark, docs), support=12)
    found = [((r.lang, tuple(r.phrase.split(" "))), r.f) for r in phrases.collect()]
    assert len(found) == len(expected) and dict(found) == expected


def _shuffled(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [files.apply(i) for i in range(files.size())]
    return {f.getPath(): f.length() for f in files if f.getName().startswith("shuffle_") and f.getName().endswith(".data")}


@pytest.mark.parametrize("sent", [0, 1000])
def test_what_was_shuffled_is_removed(spark, monkeypatch, sent):
    monkeypatch.setattr(module, "BROADCAST_ROWS", sent)
    setting = spark.conf.get(module._CLEANUP, None)
    before = _shuffled(spark)
    frequent_phrases(_frame(spark, _docs(15, 1000)), support=12)
    for _ in range(50):
        left = sum(size for path, size in _shuffled(spark).items() if path not in before)
        if left < 10_000:
            break
        time.sleep(0.2)
    assert left < 10_000  # words of shards; keys and phrases take over 100,000
    assert spark.conf.get(module._CLEANUP, None) == setting


def test_nothing_to_find(spark):
    assert collocations(_frame(spark, [("x", "en")]).where("false")).collect() == []
    assert collocations(_frame(spark, [(None, None), ("", "en")])).collect() == []


def test_query_against_sql(spark, tables):
    connection = duckdb.connect()
    connection.sql(f"create view documents as select * from '{tables}/documents.parquet'")
    expected = connection.sql(f"select {', '.join(COLUMNS)} from ({ORACLES['op13_collocations']})").fetchall()
    found = QUERIES["op13_collocations"](spark, tables)
    assert found.columns == COLUMNS and [t for _, t in found.dtypes if t not in ("string", "bigint")] == []
    assert expected and sorted(map(tuple, found.collect())) == sorted(expected)
