import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from numprep.llm import pfor, token_files
from numprep.llm.token_count import PairMerger, PieceCounter, count_tokens
from numprep.llm.token_files import ByteLevelEncoder, read_index, write_tokens
from numprep.llm.units import FlatMemory

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = ["a", "the", "  ", " ", "\n", "\t", " ", "　", " ", "x.", "'s", "12", "é", "漢字", "🙂", "\0", "▁", "<s>",
    "<|endoftext|>", "\x0b", "\x1c", "\x85", "\r\n", "…", "ing", "ﬁ", "<0x0A>", "​"]


def odd_texts(n=4000):
    draw = random.Random(3)
    texts = ["".join(draw.choices(ALPHABET, k=draw.randint(0, 14))) for _ in range(n)]
    return texts + ["", " ", "   ", "\n", " a ", "a  ", "x" * 5000, " " * 3000, "word " * 3000]


def test_counts_as_the_library_does():
    texts = odd_texts()
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counter = PieceCounter(Path(PIECES).read_bytes())
    assert counter.count(pa.array(texts)).tolist() == [len(x) for x in library.encode(texts)]
    assert counter.count(pa.array([None, "a"], pa.string())).tolist()[0] == 0


def test_merging_by_hand():
    merger = PairMerger({c: 99.0 for c in "abc"} | {"ab": 1.0, "bc": 0.0, "abc": 2.0, "aa": 3.0, "aaaa": 4.0})
    assert merger.count("abc") == 1  # b and c first, then a with both
    assert merger.count("aaaaa") == 2 and merger.count("") == 0 and merger.count("é") == 2 and merger.count("aéb") == 4


def test_token_count_query(documents, sample):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = [(i, t) for i, t, _ in sample] + [(None, None), (-1, ""), (-2, "z " * 4096), (-2, "z " * 4096)]
    got = count_tokens(documents(rows), PIECES, limit=4096).collect()
    expected = [(i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in rows]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == sorted(expected, key=str)
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got) and any(r.over_limit for r in got)
    assert count_tokens(documents([]), PIECES, limit=1).collect() == []


def test_encodes_as_the_library_does():
    texts = odd_texts()
    library = Tokenizer.from_file(BYTES)
    ids, bounds = ByteLevelEncoder(Path(BYTES).read_bytes()).encode(pa.array(texts))
    expected = [e.ids + [0] for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == expected


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
@pytest.mark.parametrize("top", [1, 2, 300, 50257, 2**32])
def test_blocks_round_trip(n, top):
    draw = np.random.default_rng(n + top)
    ids = draw.integers(0, top, n).astype(np.uint32)
    ids[draw.random(n) < 0.03] = top - 1
    for percentile in (0.5, 0.9, 1.0):
        packed = pfor.encode(ids, percentile)
        assert (pfor.decode(packed) == ids).all() and len(packed) < 120 + 6 * n
        assert (pfor.decode(packed, 100, 201) == ids[100:201]).all()


@pytest.mark.parametrize("segment", [1 << 18, 50])
def test_files_round_trip(spark, documents, sample, tmp_path, monkeypatch, segment):
    monkeypatch.setattr(token_files, "SEGMENT", segment)
    rows = [(i, t) for i, t, _ in sample] + [(10**6 + i, t) for i, t in enumerate(["", None, "a  b", "<|endoftext|> x"])]
    path = str(tmp_path / "tokens")
    write_tokens(documents(rows).repartition(7), BYTES, path)
    got = read_index(spark, path).orderBy("doc_id").collect()
    library, start = Tokenizer.from_file(BYTES), 0
    assert len(got) == len(rows)
    for r, (doc_id, text) in zip(got, sorted(rows), strict=True):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_files_of_named_documents_and_clashing_columns(spark, documents, tmp_path):
    rows = [(i, f"text {i} " * i) for i in range(30)]
    docs = documents(rows).selectExpr("concat('d', doc_id) as doc_id", "text", "'x' as ids", "'y' as _text", "1 as part")
    write_tokens(docs, BYTES, str(tmp_path / "named"))
    got = read_index(spark, str(tmp_path / "named")).orderBy("start").collect()
    library = Tokenizer.from_file(BYTES)
    expected = {f"d{i}": len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows}
    assert [(r.doc_id, r.n_tokens) for r in got] == sorted(expected.items())


def test_files_of_repeated_rows_missing_ids_and_none(spark, documents, tmp_path):
    rows = [(None, "x y")] * 3 + [(1, "z")] * 2 + [(1, "other")]
    write_tokens(documents(rows), BYTES, str(tmp_path / "a"))
    got = read_index(spark, str(tmp_path / "a")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] * 3 + [1] * 3
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got[:-1]]).tolist()
    write_tokens(documents([]), BYTES, str(tmp_path / "b"))
    assert read_index(spark, str(tmp_path / "b")).collect() == []


def plain_texts(n=3000):
    draw = random.Random(5)
    letters = [chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0x250)) if c not in (0xD7, 0xF7)]
    ends = ["", "", ",", ".", "'", "...", "|>", "_", ".\n", "\n", "'\n", "\n\n", "7", "'s", "×"]

    def word():
        return "".join(draw.choices(letters if draw.random() < 0.5 else "aeinst", k=draw.randint(1, 9))) + draw.choice(ends)

    return [draw.choice([" ", " ", "\n"]).join(word() for _ in range(draw.randint(1, 9))) for _ in range(n)]


def test_plain_units_are_only_merged(monkeypatch):
    """The library's own cutting costs as much as its merging, so it sees few units whose pieces are plain."""
    texts = plain_texts()
    encoder = ByteLevelEncoder(Path(BYTES).read_bytes())
    apart, seen = encoder._taken_apart, []
    monkeypatch.setattr(encoder, "_taken_apart", lambda kinds: seen.extend(kinds) or apart(kinds))
    ids, bounds = encoder.encode(pa.array(texts))
    expected = [e.ids + [0] for e in Tokenizer.from_file(BYTES).encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == expected
    assert all(any(odd in k for odd in ("\n\n", "7", "'s", "×")) or k[-1:] == "\n" or k[:1] == "\n" for k in seen)
    assert encoder.encode(pa.array([" a b", "the cat's, 12."]))[0].tolist() == [
        i for t in (" a b", "the cat's, 12.") for i in [*Tokenizer.from_file(BYTES).encode(t).ids, 0]
    ]


def test_what_a_worker_remembers_is_bounded():
    asked = []

    def compute(kinds):
        asked.extend(kinds.to_pylist())
        sizes = np.array([len(k) for k in kinds.to_pylist()], np.int64)
        return np.repeat(np.arange(len(sizes), dtype=np.uint32) * 0 + 9, sizes), sizes

    memory = FlatMemory(compute, kept=10)
    for step in range(50):
        kinds = ["always", *(f"k{step * 7 + i}" for i in range(7))]
        flat, starts, counts = memory.results(pa.array(kinds))
        assert counts.tolist() == [len(k) for k in kinds] and (flat[starts] == 9).all()
        assert len(memory.kinds) == len(memory.counts) == len(memory.met) <= 10 and len(memory.flat) == memory.counts.sum()
    assert asked.count("always") == 1 and len(asked) == 351
