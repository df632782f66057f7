import random
import zlib

import pytest

from numprep.llm.kd_shards import shard


def check(rows, got, shards):
    assert len(got) == len(rows)
    expected = sorted((i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == expected
    sizes = [0] * shards
    for s in range(shards):
        own = [r for r in got if r.shard == s]
        sizes[s] = sum(r.size for r in own)
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert sum(sizes) == sum(r.size for r in got)
    assert all(r.law == "bytes" and r.grown_shard is None for r in got)
    return sizes


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_even_sizes(documents, sample, shards):
    got = shard(documents(sample), ["n_chars", "doc_id", "source", "lang"], shards=shards).collect()
    sizes = check(sample, got, shards)
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in got)


def test_ties_nulls_and_repeated_rows(documents):
    draw = random.Random(4)
    rows = [(None, None, None)] * 50 + [(7, "same text", "hot")] * 300 + [(i, "x" * draw.randint(0, 40), "abc"[i % 3]) for i in range(300)]
    got = shard(documents(rows), ["n_chars", "doc_id", "source", "lang"], shards=16).collect()
    sizes = check(rows, got, 16)
    assert max(sizes) - min(sizes) <= 2 * 42


def test_fewer_rows_than_shards_and_empty(documents):
    rows = [(1, "a"), (2, "b"), (3, None)]
    check(rows, shard(documents(rows), ["doc_id"], shards=16).collect(), 16)
    assert shard(documents([]), ["doc_id"], shards=16).collect() == []


def test_target_bytes(documents, sample):
    got = shard(documents(sample), ["doc_id"], target_bytes=50_000).collect()
    sizes = check(sample, got, max(r.shard for r in got) + 1)
    assert max(sizes) <= 50_000 + max(r.size for r in got)


def test_one_heavy_document(documents):
    rows = [(0, "y" * 100_000)] + [(i, "z" * 10) for i in range(1, 200)]
    check(rows, shard(documents(rows), ["n_chars", "doc_id"], shards=8).collect(), 8)
