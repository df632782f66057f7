import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from numprep.llm.alignment import Aligner, align_tokens, byte_characters
from numprep.llm.queries import QUERIES

MODELS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _by_hand(texts):
    """Whole texts, by the bytes of their identifiers alone."""
    a = Tokenizer.from_file(MODELS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=MODELS[1])
    characters = byte_characters()
    rows = []
    for text in texts:
        empty = (0, 0, [], "")
        if not text:
            rows.append(empty)
            continue
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(characters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [
            bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
            for i in ids_b
        ]
        whole = b" " + text.encode()
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            rows.append(empty)
            continue
        groups, links, i, j, at_a, at_b, done_a, done_b = [], [], 0, 0, 0, 0, 0, 0
        while i < len(ids_a) or j < len(ids_b):
            if at_a <= at_b:
                at_a += len(bytes_a[i])
                i += 1
            else:
                at_b += len(bytes_b[j])
                j += 1
            if at_a == at_b:
                groups.append(f"{','.join(map(str, ids_a[done_a:i]))}|{','.join(map(str, ids_b[done_b:j]))}")
                links.append((ids_a[i - 1], ids_b[j - 1]))
                done_a, done_b = i, j
        rows.append((len(ids_a), len(ids_b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = Counter(link for row in rows for link in row[2])
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return [
        (n_a, n_b, len(links), len(links), sum(count[k] == best[k[1]] for k in links), sum(count[k] for k in links), digest)
        for n_a, n_b, links, digest in rows
    ]


TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "plain words here", "two  blanks", "line\nbreak", "break\n blank", "tab\t x", "é",
    "𝔘𝔫𝔦 code 𝔘", "日本語 の テキスト", "a▁b", "▁", "x\x00y", "<s> </s> <unk> <0x41> <|endoftext|>", "﷽﷽ ﷽", "　 wide",
    "\xa0x", "é ‍👩‍👩‍👧", "don't we'll", "plain words here", "word " * 300, "\n\n\n", "ÄÖÜ ß ſ ﬁ", "ﾊﾝｶｸ", "12 345,678.9",
    "a" * 5000, "ж" * 500 + " б", "\u0085 x", "x  ", "﻿bom", "ᄀᄁ", "\U0010ffff \U0010fffe",
]


def _rows(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert df.columns == names
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] is None, r))


def test_edge_texts(spark, documents):
    found = _rows(align_tokens(documents(list(enumerate(TEXTS))), *MODELS))
    assert [r[1:] for r in found] == _by_hand(TEXTS)


def test_query(spark, tables, sample):
    found = _rows(QUERIES["op11_token_alignment"](spark, tables))
    ordered = sorted(sample)
    assert [r[0] for r in found] == [r[0] for r in ordered]
    assert [r[1:] for r in found] == _by_hand([r[1] for r in ordered])


def test_repeated_keys_and_clashing_columns(spark):
    rows = [(None, "a b", 1, "x"), (None, "a b", 1, "x"), ("k", "c", 2, "y"), ("k", None, 2, "y")]
    df = spark.createDataFrame(rows, "doc_id string, text string, _row int, _pairs string")
    found = _rows(align_tokens(df, *MODELS))
    expected = [(r[0], *x) for r, x in zip(rows, _by_hand([r[1] for r in rows]))]
    assert found == sorted(expected, key=lambda r: (r[0] is None, r))


def test_empty_table(spark, documents):
    assert align_tokens(documents([(1, "x")]).where("false"), *MODELS).collect() == []


def test_pairs_are_bounded_by_the_vocabularies():
    aligner = Aligner(*(open(path, "rb").read() for path in MODELS))
    ends = Counter(t for t in aligner.bytes_b if t)
    known = set(aligner.bytes_a)
    shorter_b = sum(ends[t[i:]] for t in aligner.bytes_a for i in range(len(t)))
    shorter_a = sum(t[i:] in known for t in aligner.bytes_b for i in range(1, len(t)))
    assert shorter_a + shorter_b <= 2 * (aligner.sizes_a.sum() + aligner.sizes_b.sum())


@pytest.mark.parametrize("size", [1, 3])
def test_words_joined_or_alone(monkeypatch, size):
    from numprep.llm import alignment

    aligner = Aligner(*(open(path, "rb").read() for path in MODELS))
    words = ["the", "größe", "日本", "x\x00", "𝔘", "ends.", "a,b", "don't"]
    joined = aligner._words(words)
    monkeypatch.setattr(alignment, "JOINED", size)
    assert aligner._words(words) == joined


def test_plan_broadcasts_only_pairs(spark, documents):
    plan = align_tokens(documents([(1, "a b")]), *MODELS)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
