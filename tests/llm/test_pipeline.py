from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from test_dart_minhash import brute as classes_of
from test_line_quality import WORD, failed
from test_mixing import targets
from test_winnow import brute as hits_in
from tokenizers import Tokenizer

import corpus_pipeline


@pytest.fixture(scope="module")
def stages(spark, tables, tmp_path_factory):
    """The documents, and what each stage makes of them."""
    folder = str(tmp_path_factory.mktemp("stages"))
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, tables)
        if name != "token_files":
            assert made.columns == docs.columns and made.dtypes == docs.dtypes
        made.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs.collect())
    return out


def pairs(rows):
    return sorted((r.doc_id, r.text) for r in rows)


def test_quality_rules(stages):
    # No line of so few documents is common, so that no text is changed.
    assert pairs(stages[1]) == sorted((r.doc_id, r.text) for r in stages[0] if not failed(r.text))


def test_near_duplicates(stages):
    rows = sorted((r.doc_id, r.text) for r in stages[1])
    first = {}
    for (doc_id, _), root in zip(rows, classes_of(rows), strict=True):
        first.setdefault(root, doc_id)
    assert [i for i, _ in pairs(stages[2])] == sorted(first.values())


def test_decontamination(spark, tables, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    assert pairs(stages[3]) == sorted((r.doc_id, r.text) for r in stages[2] if not hits_in(r.text, items)[4])


def test_mixing(stages):
    sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in stages[3]:
        n = len(WORD.findall(r.text))
        sizes[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    assert max(Counter(r.doc_id for r in stages[4]).values()) <= 2
    assert set(pairs(stages[4])) <= set(pairs(stages[3]))
    for r in stages[4]:
        taken[r.source] += len(WORD.findall(r.text))
    for source, target in targets(sizes).items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1


def test_token_files(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = sorted((r.doc_id, r.text) for r in stages[4])
    got = sorted(stages[5], key=lambda r: r.start)
    sizes = [len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for _, t in texts]
    assert [(r.doc_id, r.n_tokens) for r in got] == [(i, n) for (i, _), n in zip(texts, sizes, strict=True)]
    assert [r.start for r in got] == np.cumsum([0, *sizes[:-1]]).tolist()


def test_run(spark, tables, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, tables).collect())) == sorted(map(tuple, stages[5]))


def test_empty_documents_and_clashing_columns(spark, tables, documents):
    names = ("size", "target", "taken", "copies", "class_id", "kept", "row", "rows", "node", "bands", "window", "n_words", "shard")
    names += ("_id", "_none", "_key", "_host", "_text_key", "_removed", "_doc", "_runs", "doc", "host", "removed", "text_key")
    docs = documents([(1, " ".join(map(str, range(50))))]).selectExpr("*", *[f"'x' as {n}" for n in names])
    for rows in (docs, docs.limit(0)):
        made = rows
        for _, stage in corpus_pipeline.STAGES[:4]:
            made = stage(spark, made, tables)
            assert made.columns == docs.columns
        assert stage(spark, rows, tables).count() <= 2


def test_queries_are_registered():
    import __spark_entry__ as driver

    found = [q for q in driver.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in found) == list(range(1, 14))
    assert "pipeline" in driver.queries()
