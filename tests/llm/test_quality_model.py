import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from numprep.llm import quality_model as module
from numprep.llm import textvec
from numprep.llm.queries import QUERIES
from numprep.llm.quality_model import FEATURES, REACH, ROWS, SIZE, Network, score_quality, train, word_vectors

COLUMNS = ["doc_id", "held_out", "score", "predicted"]
TEXTS = ["one two, two three\nfour", "", "one one one", "  \t ", "ÄÖ b***", "one two, two three\nfour", "a"]


def _tokens(text):
    found = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[\n\x0b\x0c\r]+|[^0-9A-Za-z\x80-\xff \t\n\x0b\x0c\r]+", text.encode())
    data = np.frombuffer(b"".join(found), np.uint8)
    ends = np.cumsum([len(f) for f in found]).astype(np.int64)
    hashes = textvec.span_hashes(data, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends) if found else []
    return [int(textvec.mix64(np.array([h]))[0]) % ROWS for h in hashes]


def _vectors_by_hand(texts):
    places, signs = module.index_vectors()
    sums, counts = np.zeros((ROWS, SIZE)), np.zeros(ROWS)
    for text in texts:
        rows = _tokens(text or "")
        for i, row in enumerate(rows):
            counts[row] += 1
            for j in range(max(0, i - REACH), min(len(rows), i + REACH + 1)):
                if j != i:
                    np.add.at(sums[row], places[rows[j]], signs[rows[j]])
    vectors = sums / np.maximum(counts, 1)[:, None] - sums.sum(0) / max(counts.sum(), 1)
    vectors[counts == 0] = 0
    return vectors / np.maximum(np.sqrt((vectors**2).sum(1, keepdims=True)), 1e-300)


@pytest.mark.parametrize("size", [1, 20, 1 << 19])
def test_vectors_and_pools(spark, documents, monkeypatch, size):
    monkeypatch.setattr(textvec, "SLICE_BYTES", size)
    expected = _vectors_by_hand(TEXTS)
    found = word_vectors(documents([*enumerate(TEXTS), (9, None)]).repartition(3))
    assert np.abs(found - expected).max() < 1e-5
    pooled = module._pooled(pa.array([*TEXTS, None]), found)
    assert pooled.shape == (len(TEXTS) + 1, FEATURES)
    for text, row in zip([*TEXTS, ""], pooled, strict=True):
        rows = _tokens(text)
        if not rows:
            assert not row.any()
            continue
        words = found[rows].astype(float)
        like = [
            sum(float(words[i] @ words[i - d]) for i in range(d, len(rows))) / max(len(rows) - d, 1) for d in (1, 2)
        ]
        mean = words.mean(0)
        assert np.allclose(row, [*mean, *words.std(0), *like, np.linalg.norm(mean), np.log1p(len(rows))], atol=1e-3)


def test_held_out_accuracy(spark, tables):
    """The labels of the small tables are few; those of the next size show what is learnt."""
    folder = tables.replace("sf0.001", "sf0.01")
    found = QUERIES["op12_quality_classifier"](spark, folder)
    assert found.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = {r.doc_id: r for r in found.collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    asked = [(rows[x.doc_id], x.quality) for x in labels if rows[x.doc_id].held_out]
    assert len(asked) > 50
    assert np.mean([r.predicted == q for r, q in asked]) > 0.95
    loss = -np.mean([np.log(max(r.score if q else 1 - r.score, 1e-9)) for r, q in asked])
    assert loss < 0.15  # calibrated: the share of label 1 alone gives 0.4


def _corpus(spark, n=400):
    rng = np.random.default_rng(0)
    words = np.array(["red", "green", "blue", "tree", "house", "river", "stone"])
    rows = []
    for i in range(n):
        picked = list(words[rng.integers(0, len(words), 30)])
        rows.append((i, " ".join(picked if i % 3 else [w + "***" for w in picked]), int(i % 3 > 0)))
    return rows


def test_labels_held_out_change_nothing_and_reruns_agree(spark, documents):
    rows = _corpus(spark)
    docs = documents([(i, t) for i, t, _ in rows])
    scores = []
    for flip in (False, True):
        labels = [(i, 1 - q if flip and zlib.crc32(str(i).encode()) % 3 == 1 else q) for i, _, q in rows]
        df = spark.createDataFrame(labels, "doc_id long, quality int")
        scores.append(sorted(map(tuple, score_quality(docs, df).collect())))
    assert scores[0] == scores[1]
    assert all(r[3] == int(r[0] % 3 > 0) for r in scores[0])


def test_odd_rows(spark):
    rows = _corpus(spark)
    odd = [(None, "red"), (1000, None), (1001, ""), (1001, ""), (1002, "green " * 60_000)]
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in [*[r[:2] for r in rows], *odd]], "doc_id long, text string, key int, label string, draw int")
    labels = [(i, q) for i, _, q in rows] + [(None, 0), (3, None), (3, 1), (3, 1), (77_777, 0)]
    found = score_quality(df, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert found.columns == COLUMNS
    got = found.collect()
    assert len(got) == len(rows) + len(odd)
    by_key = {}
    for r in got:
        by_key.setdefault(r.doc_id, []).append(r)
        assert 0 <= r.score <= 1 and r.held_out is not None
    assert by_key[None][0].held_out is False
    assert by_key[1001][0] == by_key[1001][1] and by_key[1000][0].score == by_key[1001][0].score


def test_nothing_to_learn(spark, documents):
    docs = documents([(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in score_quality(docs, none).collect()] == [0.5, 0.5]
    assert score_quality(docs.where("false"), none).collect() == []


def test_training_separates_and_calibrates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 5))
    chance = 1 / (1 + np.exp(-(2 * x[:, 0] * x[:, 1])))
    y = (rng.random(4000) < chance).astype(np.int64)
    model = train(x[:3000], y[:3000])
    scores = model.scores(x[3000:])
    assert np.corrcoef(scores, chance[3000:])[0, 1] > 0.9
    for low in np.arange(0.1, 0.9, 0.2):
        inside = (scores >= low) & (scores < low + 0.2)
        assert abs(scores[inside].mean() - y[3000:][inside].mean()) < 0.12
    assert Network(np.zeros(1), np.ones(1), [], constant=0.3).scores(x).tolist() == [0.3] * 4000


def test_temperature_mends_outputs_that_are_too_sure():
    rng = np.random.default_rng(2)
    z = rng.normal(size=5000) * 2
    y = (rng.random(5000) < 1 / (1 + np.exp(-z))).astype(float)
    assert abs(module._temperature(5 * z, y) - 5) < 0.5


def test_bounded_sample(spark, documents):
    rows = _corpus(spark)
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    found = score_quality(documents([(i, t) for i, t, _ in rows]), labels, sample_rows=100).collect()
    assert np.mean([r.predicted == int(r.doc_id % 3 > 0) for r in found]) > 0.9
