"""Quality of documents: random-indexing word vectors, pooled per document, and a small network with calibrated output."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from numprep.llm import textvec
from numprep.llm.common import ship

#: Rows of the table of word vectors; words share a row by hash. Numbers of a vector.
ROWS = 1 << 14
SIZE = 64
#: Numbers of an index vector that are not 0, each 1 or -1.
NONZERO = 4
#: Neighbours on either side that make a word's vector.
REACH = 2
#: Labelled documents that the network is trained on, at most; those of least hash.
SAMPLE_ROWS = 20_000
#: Rows of the table that are sent together.
BLOCK = 256
_PARTS = 64
#: The network: hidden units, rounds, rows of a step, rate, decay of weights, rounds without gain before it stops.
HIDDEN, ROUNDS, STEP_ROWS, RATE, DECAY, PATIENCE = 32, 60, 256, 3e-3, 1e-4, 10
#: Of the sample, one in so many rows is kept for stopping and for the temperature.
KEPT_BACK = 5

# Kinds of bytes: blank, part of a word, mark, end of line. A token is a run of one kind, blanks apart.
_KINDS = np.full(256, 2, np.uint8)
_KINDS[list(b" \t")] = 0
_KINDS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KINDS[list(b"\n\x0b\x0c\r")] = 3


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row of each token of some texts in the table of vectors, and where each text's tokens start (one more at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kinds = _KINDS[data]
    turns = np.ones(len(data), bool)
    turns[1:] = kinds[1:] != kinds[:-1]
    turns[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(turns)
    ends = np.append(starts[1:], len(data))
    real = kinds[starts] > 0
    starts, ends = starts[real], ends[real]
    rows = textvec.mix64(textvec.span_hashes(data, starts, ends)) % np.uint64(ROWS)
    return rows.astype(np.int64), np.searchsorted(starts, offsets)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the numbers that are not 0 in the index vector of each row. A rule, so every task has the same."""
    drawn = textvec.mix64(np.arange(1, ROWS * NONZERO + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (drawn % np.uint64(SIZE)).astype(np.int64).reshape(ROWS, -1), (1 - 2 * (drawn >> np.uint64(63)).astype(np.int64)).reshape(ROWS, -1)


def add_contexts(table: np.ndarray, rows: np.ndarray, starts: np.ndarray) -> None:
    """Add to each token's vector (and count, in the last column) the index vectors of its neighbours in its text."""
    places, signs = index_vectors_once()
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    flat = table.reshape(-1)
    width = SIZE + 1
    flat[SIZE::width] += np.bincount(rows, minlength=ROWS)
    for distance in range(1, REACH + 1):
        near = text[distance:] == text[:-distance]
        left, right = rows[:-distance][near], rows[distance:][near]
        for one, other in ((left, right), (right, left)):
            at = (one[:, None] * width + places[other]).ravel()
            flat += np.bincount(at, signs[other].ravel(), len(flat)).astype(np.int64)


_index: tuple[np.ndarray, np.ndarray] | None = None


def index_vectors_once() -> tuple[np.ndarray, np.ndarray]:
    global _index
    if _index is None:
        _index = index_vectors()
    return _index


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of a task to the sums of its contexts, in blocks of rows."""
    table = np.zeros((ROWS, SIZE + 1), np.int64)
    for batch in batches:
        data, offsets = textvec.utf8(batch.column(0))
        for a, b in textvec.slices(offsets):
            add_contexts(table, *tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
    part = TaskContext.get().partitionId() % _PARTS
    yield from _blocks({i: table[i * BLOCK : (i + 1) * BLOCK] for i in range(ROWS // BLOCK)}, part)


def _blocks(sums: dict[int, np.ndarray], part: int) -> Iterator[pa.RecordBatch]:
    for block, rows in sums.items():
        if rows.any():
            columns = [pa.array([block]), pa.array([part]), pa.array([rows.astype(np.int64).tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "part", "sums"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the blocks that come to a task, which are never more than the table has."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, found in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
            rows = np.frombuffer(found.as_buffer(), np.int64).reshape(BLOCK, -1)
            sums[block] = sums[block] + rows if block in sums else rows
    yield from _blocks(sums, 0)


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Vectors of all words of all documents: a table of ROWS x SIZE numbers, whatever the number of documents.

    A word's vector is the sum of its neighbours' index vectors, less what an average word's would be, at length 1; a word that
    does not occur has a vector of zeros. Each task sends the sums over its texts; these are whole numbers, so the order of
    addition does not matter, and they are added in two rounds, so no task adds those of all.
    """
    ship(docs.sparkSession)
    schema = "block long, part long, sums binary"
    sums = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).mapInArrow(_contexts, schema)
    for keys in (["block", "part"], ["block"]):
        sums = sums.repartition(*keys).mapInArrow(_added, schema)
    table = np.zeros((ROWS, SIZE + 1), np.int64)
    for row in sums.collect():
        table[row.block * BLOCK : (row.block + 1) * BLOCK] += np.frombuffer(row.sums, np.int64).reshape(BLOCK, -1)
    counts = table[:, SIZE:].astype(float)
    vectors = table[:, :SIZE] / np.maximum(counts, 1) - table[:, :SIZE].sum(0) / max(counts.sum(), 1)
    vectors[counts[:, 0] == 0] = 0
    length = np.sqrt((vectors**2).sum(1, keepdims=True))
    return (vectors / np.where(length > 0, length, 1)).astype(np.float32)


FEATURES = 2 * SIZE + REACH + 2


def pool(vectors: np.ndarray, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One row per text: mean and spread of its words' vectors, likeness of neighbours, length of the mean, words.

    A text without a word is all zeros.
    """
    counts = np.diff(starts)
    out = np.zeros((len(counts), FEATURES), np.float32)
    full = counts > 0
    if not full.any():
        return out
    first, number = starts[:-1][full], counts[full][:, None].astype(np.float32)
    words = vectors[rows]
    mean = np.add.reduceat(words, first, axis=0) / number
    out[full, :SIZE] = mean
    out[full, SIZE : 2 * SIZE] = np.sqrt(np.maximum(np.add.reduceat(words * words, first, axis=0) / number - mean * mean, 0))
    text = np.repeat(np.arange(len(counts)), counts)
    for distance in range(1, REACH + 1):
        near = text[distance:] == text[:-distance]
        like = np.einsum("ij,ij->i", words[distance:], words[:-distance]) * near
        sums = np.bincount(text[distance:], like, len(counts))
        out[:, 2 * SIZE + distance - 1] = sums / np.maximum(counts - distance, 1)
    out[full, -2] = np.sqrt((mean * mean).sum(1))
    out[full, -1] = np.log1p(number[:, 0])
    return out


def _pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    data, offsets = textvec.utf8(texts)
    parts = [np.zeros((0, FEATURES), np.float32)]
    for a, b in textvec.slices(offsets):
        parts.append(pool(vectors, *tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])))
    return np.concatenate(parts)


def _sample_features(sent: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r.tobytes() for r in _pooled(batch.column(0), sent.value)]
            columns = [pa.array(rows, pa.binary()), batch.column(1), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, names=["pooled", "label", "draw"])

    return run


@dataclass
class Network:
    """Two layers; the output is divided by the temperature. ``constant`` is the score where nothing could be learnt."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    temperature: float = 1.0
    constant: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return _sigmoid(self.logits(x.astype(np.float64)) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def train(x: np.ndarray, y: np.ndarray) -> Network:
    """Fit the network by Adam on four fifths of the rows; the rest say when to stop, and which temperature fits best.

    With fewer than 10 rows of either label every score is the share of label 1, drawn towards a half.
    """
    if min((y == 1).sum(), (y == 0).sum()) < 10:
        return Network(np.zeros(1), np.ones(1), [], constant=float((y.sum() + 1) / (len(y) + 2)))
    x, y = x.astype(np.float64), y.astype(np.float64)
    back = np.arange(len(y)) % KEPT_BACK == 0
    mean, spread = x[~back].mean(0), x[~back].std(0)
    model = Network(mean, np.where(spread > 1e-6, spread, 1.0), [])
    rng = np.random.default_rng(0)
    model.weights = [
        rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1),
    ]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in model.weights]
    best, kept, waited, step = np.inf, None, 0, 0
    fitted, known = (x[~back] - mean) / model.scale, y[~back]
    for _ in range(ROUNDS):
        order = rng.permutation(len(known))
        for i in range(0, len(order), STEP_ROWS):
            a, t = fitted[order[i : i + STEP_ROWS]], known[order[i : i + STEP_ROWS]]
            w1, b1, w2, b2 = model.weights
            h = np.tanh(a @ w1 + b1)
            d = (_sigmoid(h @ w2 + b2) - t) / len(t)
            dh = np.outer(d, w2) * (1 - h * h)
            slopes = [a.T @ dh + DECAY * w1, dh.sum(0), h.T @ d + DECAY * w2, d.sum(keepdims=True)]
            step += 1
            for w, g, m in zip(model.weights, slopes, moments, strict=True):
                m[0] = 0.9 * m[0] + 0.1 * g
                m[1] = 0.999 * m[1] + 0.001 * g * g
                w -= RATE * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
        loss = _loss(model.logits(x[back]), y[back])
        waited += 1
        if loss < best - 1e-5:
            best, kept, waited = loss, [w.copy() for w in model.weights], 0
        if waited >= PATIENCE:
            break
    model.weights = kept
    model.temperature = _temperature(model.logits(x[back]), y[back])
    return model


def _temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the outputs with the least loss: by golden section, over its logarithm, from 1/20 to 20."""
    low, high, ratio = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(60):
        one, two = high - ratio * (high - low), low + ratio * (high - low)
        if _loss(z / np.exp(one), y) < _loss(z / np.exp(two), y):
            high = two
        else:
            low = one
    return float(np.exp((low + high) / 2))


def _scoring(sent: Broadcast, model: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(_pooled(batch.column(2), sent.value)).astype(np.float64)
            columns = [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "held_out", "score", "predicted"])

    return run


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    key: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per document: key, held_out, score (0 to 1, higher: label 1 is likelier) and predicted (score of 0.5 or more).

    A document is held out if crc32 of its key's text leaves 1 when divided by 3. The network learns from the labels of other
    documents: of all that have a text in ``docs`` and a label, the ``sample_rows`` of least hash of the key. Scores depend on
    texts alone: word vectors come from the texts of all documents (`word_vectors`), and are pooled per document. The table of
    vectors and the network have fixed sizes, and only they are broadcast; the sample and the sums of blocks are all that the
    driver gets. Keys are shuffled to find the sample; texts never are.

    A missing text is empty, and an empty one has a score too. A document with labels of both kinds has the more frequent one,
    or 1. Labels that are missing, or whose key is, are left out. With too few labels (`train`) all scores are equal. A missing
    key is not held out. Repeated rows have a row each, and a repeated document of the sample counts once for each. Other
    columns, whatever their names, are not read. An empty table gives an empty one. A very long text is pooled alone, in
    memory in proportion to it.
    """
    spark = docs.sparkSession
    ship(spark)
    vectors = word_vectors(docs, text)
    sent = spark.sparkContext.broadcast(vectors)
    kind = docs.schema[key].dataType.simpleString()
    rest = F.crc32(F.col("key").cast("string").cast("binary")) % 3
    narrow = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    known = (
        labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"))
        .where(F.col("label").isNotNull() & F.col("key").isNotNull())
        .where(rest != 1)
        .groupBy("key")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
        .join(narrow.select("key"), "key", "left_semi")
        .withColumn("draw", F.xxhash64("key"))
        .orderBy("draw", F.col("key").cast("string"))
        .limit(sample_rows)
    )
    sample = narrow.join(F.broadcast(known), "key").select("text", "label", "draw")
    rows = sample.mapInArrow(_sample_features(sent), "pooled binary, label int, draw long").collect()
    rows.sort(key=lambda r: (r.draw, r.label, r.pooled))
    x = np.frombuffer(b"".join([r.pooled for r in rows]), np.float32).reshape(-1, FEATURES)
    model = train(x, np.array([r.label for r in rows], np.int64))
    asked = narrow.select("key", F.coalesce(rest == 1, F.lit(False)).alias("held_out"), "text")
    scored = asked.mapInArrow(_scoring(sent, model), f"key {kind}, held_out boolean, score double, predicted int")
    return scored.select(F.col("key").alias(key), "held_out", "score", "predicted")
