"""Quality rules: word and repetition counts of a document, and lines that too many documents of a host share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from numprep.llm import textvec
from numprep.llm.common import few, give_back, left_by, ship, stored, text_key, text_of
from numprep.llm.dart_minhash import bucket_members, signature_column
from numprep.llm.dart_minhash import text_classes as classes

#: Words of a window that counts as repeated in its text.
REPEAT_WINDOW = 8
#: A line that more distinct documents of a host have is removed. Near copies of one document share its lines, and are to
#: be kept for near-duplicate detection, so they count once.
MAX_DOCUMENTS = 20
#: A document that lost lines is rejected if fewer words are left, or a smaller share of its words.
LEAST_WORDS = 20
LEAST_SHARE = 0.2
#: Share of repeated words, in percent, above which a document fails by itself.
MAX_REPEATED = 30

_SYMBOLS = ~textvec.classes(b"#*$%&|<>")
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _duplicates(texts: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each (text, hash) how often it is there, and whether an equal one comes before it."""
    keys = textvec.mix64(hashes + textvec.mix64(texts.astype(np.uint64)))
    _, first, inverse, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    again = np.ones(len(keys), bool)
    again[first] = False
    return counts[inverse], again


def _equal_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits that tell ranges of bytes apart, of any length and contents."""
    return textvec.digests(data, textvec.span_hashes(data, starts, ends), starts, ends)


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each line of texts cut at line feeds."""
    feeds = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
    ends = np.sort(np.concatenate([feeds, offsets[1:]]), kind="stable")
    # A text that begins where a line feed ended the one before sorts behind it, as its end does.
    lines = np.diff(np.searchsorted(feeds, offsets)) + 1
    return starts, ends, np.repeat(np.arange(len(lines)), lines)


def normal_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each line: start, end, text, number of words, and the hash of its words with A-Z folded."""
    starts, ends, text = line_spans(data, offsets)
    folded = textvec.fold(data)
    words = textvec.find_words(folded, offsets)
    hashes = _equal_bytes(folded, words.starts, words.ends)
    first, last = np.searchsorted(words.starts, starts), np.searchsorted(words.starts, ends)
    return starts, ends, text, last - first, textvec.digests(hashes, textvec.run_hashes(hashes, first, last), first, last)


def _measure(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The counts of ``_COUNTS`` for each text."""
    words = textvec.find_words(data, offsets)
    hashes = _equal_bytes(data, words.starts, words.ends)
    characters = textvec.counts_within(textvec.WORD_BYTES[data] & ((data & 0xC0) != 0x80), offsets)
    symbols = textvec.counts_within(_SYMBOLS[data], offsets)
    starts, ends, line_text = line_spans(data, offsets)
    full = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends, line_text = starts[full], ends[full], line_text[full]
    _, again = _duplicates(line_text, _equal_bytes(data, starts, ends))
    dup_lines = np.bincount(line_text[again], minlength=len(offsets) - 1)
    fits = textvec.window_fits(words, REPEAT_WINDOW)
    at = np.flatnonzero(fits)
    repeated = np.zeros(len(words.starts) + 1, np.int64)
    if len(at):
        windows = textvec.window_hashes(hashes, REPEAT_WINDOW)[at]
        counts, _ = _duplicates(words.text_of_word()[at], windows)
        at = at[counts > 1]
        np.add.at(repeated, at, 1)
        np.add.at(repeated, at + REPEAT_WINDOW, -1)
    covered = np.cumsum(repeated)[:-1] > 0
    bounds = np.concatenate([words.first, [len(words.starts)]])
    return [words.counts, characters, symbols, dup_lines, textvec.counts_within(covered, bounds)]


def _measuring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key columns ..., text) to the key columns, the counts, the signature, and hash and words of each different line."""
    give_back()
    for batch in batches:
        data, offsets = textvec.utf8(batch.column(batch.num_columns - 1))
        for a, b in textvec.slices(offsets):
            part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            _, _, text, words, hashes = normal_lines(part, own)
            full = words > 0
            text, words, hashes = text[full], words[full], hashes[full]
            order = np.lexsort((hashes, text))
            text, words, hashes = text[order], words[order], hashes[order]
            head = np.ones(len(text), bool)
            head[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
            heads = np.flatnonzero(head)
            total = np.add.reduceat(words, heads) if len(heads) else words
            ends = np.searchsorted(text[heads], np.arange(b - a + 1)).astype(np.int32)
            lines = pa.StructArray.from_arrays(
                [pa.array(textvec.signed(hashes[heads])), pa.array(total.astype(np.int64))], names=["line", "words"]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).slice(a, b - a) for i in range(batch.num_columns - 1)]
                + [pa.array(x.astype(np.int64)) for x in _measure(part, own)]
                + [signature_column(part, own), pa.ListArray.from_arrays(pa.array(ends), lines)],
                names=[*batch.schema.names[:-1], *_COUNTS, "signature", "lines"],
            )


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """Stored rows (row, doc_id, host, text_key, counts ..., signature, lines) of all documents; ``row`` tells them apart."""
    ship(docs.sparkSession)
    keyed = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.col(host).alias("host"),
        text_key().alias("text_key"),
        text_of().alias("_text"),
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    host_kind = docs.schema[host].dataType.simpleString()
    counts = ", ".join(f"{name} long" for name in _COUNTS)
    schema = (
        f"row long, doc_id {kind}, host {host_kind}, text_key binary, {counts}, "
        "signature binary, lines array<struct<line: long, words: long>>"
    )
    return stored(keyed.mapInArrow(_measuring, schema), "lines")


def common_lines(measured: DataFrame, docs: DataFrame, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """Rows (host, line) that more than ``max_documents`` distinct documents of the host have.

    Equal texts are one document, and so are near copies: texts of one class of near-duplicates, among all texts that have
    a line of more than ``max_documents`` texts of a host. Only these are compared, so a chain of near copies is not
    followed through a text that has no such line. Rows are counted with partial sums before each shuffle, so a line that
    a third of all documents have is never in one task.

    A text that shares no bucket with another is a class of its own, so a line of enough such texts is common, without any
    comparison. Only if other lines are left, classes are found, by the signatures at hand; of the texts, those of likely
    pairs are read.
    """
    seen = measured.select("row", "host", "text_key", F.explode("lines.line").alias("line"))
    texts = seen.groupBy("host", "line", "text_key").agg(F.lit(1).alias("one"))
    often = texts.groupBy("host", "line").agg(F.count("*").alias("texts")).where(F.col("texts") > max_documents)
    often = stored(often.select("host", "line"), "often")
    having = left_by(seen, often, ["host", "line"], "left_semi")
    having = stored(having.groupBy("host", "line", "text_key").agg(F.min("row").alias("row")), "having")
    nodes = stored(having.groupBy("text_key").agg(F.min("row").alias("node")), "nodes")
    rows = measured.select(F.col("row").alias("node"), "signature")
    signed = stored(rows.join(few(nodes.select("node")), "node", "left_semi"), "signed")
    members, values = bucket_members(signed)
    alone = nodes.join(values.select("node"), "node", "left_anti")
    enough = having.join(alone, "text_key").groupBy("host", "line").agg(F.count("*").alias("documents"))
    enough = stored(enough.where(F.col("documents") > max_documents).select("host", "line"), "enough")
    unclear = stored(left_by(often, enough, ["host", "line"], "left_anti"), "unclear")
    if unclear.isEmpty():
        return enough
    copies = stored(classes(members, values, nodes, docs), "classes")
    lines = _spread(left_by(having, unclear, ["host", "line"], "left_semi"), copies, "class")
    return enough.union(stored(lines.where(F.col("documents") > max_documents).select("host", "line"), "common"))


def _spread(having: DataFrame, parts: DataFrame, part: str) -> DataFrame:
    """Rows (host, line, documents) of rows (host, line, text_key): in how many parts of the texts a line is."""
    documents = having.join(parts, "text_key").groupBy("host", "line", part).agg(F.lit(1).alias("one"))
    return documents.groupBy("host", "line").agg(F.count("*").alias("documents"))


def judge_documents(docs: DataFrame, host: str = "source", max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """One row per document: doc_id, host, text_key, counts, base_failed, kept, words_left, removed (its common lines).

    A document fails by itself with fewer than ``LEAST_WORDS`` words or over ``MAX_REPEATED`` percent of its words in
    repeated windows. Of the others, those are rejected that lost common lines and have too little left. A missing text is
    empty, a missing host is a host, and repeated rows come back repeated.
    """
    measured = measure(docs, host)
    common = common_lines(measured, docs, max_documents)
    lines = measured.select("row", "host", F.explode("lines").alias("l")).select("row", "host", "l.line", "l.words")
    lost = (
        left_by(lines, common, ["host", "line"], "left_semi")
        .groupBy("row")
        .agg(F.sum("words").alias("lost"), F.collect_list("line").alias("removed"))
    )
    joined = measured.drop("lines", "signature").join(lost, "row", "left")
    left = F.col("n_words") - F.coalesce("lost", F.lit(0))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    depleted = F.col("lost").isNotNull() & ((left < LEAST_WORDS) | (left < F.col("n_words") * LEAST_SHARE))
    return joined.select(
        "doc_id",
        "host",
        "text_key",
        *_COUNTS,
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
        left.alias("words_left"),
        "removed",
    )


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text, removed) to (doc, text) without the lines whose hash is in ``removed``."""
    give_back()
    for batch in batches:
        texts, removed = batch.column("text"), batch.column("removed")
        out = texts.to_pylist()
        for i in np.flatnonzero(removed.is_valid().to_numpy(zero_copy_only=False)):
            data, offsets = textvec.utf8(texts.slice(i, 1))
            starts, ends, _, words, hashes = normal_lines(data, offsets)
            gone = np.isin(textvec.signed(hashes), np.array(removed[int(i)].as_py(), np.int64)) & (words > 0)
            raw = data.tobytes()
            out[i] = b"\n".join(raw[a:b] for a, b in zip(starts[~gone], ends[~gone], strict=True)).decode()
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(out, pa.string())], names=["doc", "text"])


def keep_good(docs: DataFrame, host: str = "source", max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """The kept documents with all their columns, whatever their names, and without their common lines.

    ``n_chars``, if there, is counted anew. Missing and empty texts are rejected: they have too few words. Repeated rows
    come back repeated, and an empty table stays empty. A text is read whole, however long.
    """
    keys = ["doc_id", "host", "text_key"]
    verdicts = judge_documents(docs, host, max_documents).where("kept")
    wanted = verdicts.groupBy(*keys).agg(F.first("removed").alias("removed"))
    others = [f for f in docs.schema if f.name != "text"]
    packed = docs.select(
        "doc_id",
        F.col(host).alias("host"),
        text_key().alias("text_key"),
        F.struct(*[F.col(f"`{f.name}`") for f in others]).alias("doc"),
        text_of().alias("text"),
    )
    joined = left_by(packed, wanted, keys, "inner").select("doc", "text", "removed")
    cut = joined.mapInArrow(_without, T.StructType([T.StructField("doc", T.StructType(others)), docs.schema["text"]]))
    own = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return cut.select(*[own.get(n, F.col(f"doc.`{n}`")).alias(n) for n in docs.columns])
