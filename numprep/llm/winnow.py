"""Benchmark decontamination: winnowed fingerprints of documents and items are joined, and hits grown to whole windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from numprep.llm import textvec
from numprep.llm.common import left_by, merge_runs, ship, stored, text_key, text_of

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs of letters, digits and everything beyond ASCII, after A-Z became a-z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a window: every shared run of so many words is found.
WINDOW = 10
#: Words of a fingerprint. One is kept of each WINDOW - GRAM + 1 neighbours, so each window keeps at least one.
GRAM = 5
#: Fingerprints of the benchmark up to this count go to all tasks (16 bytes each); beyond it both sides are shuffled.
BROADCAST_ROWS = 1_000_000

_BYTES = textvec.classes(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(WORD), 0)


def winnowed(hashes: np.ndarray, fits: np.ndarray, span: int) -> np.ndarray:
    """Positions of the least hash of each run of ``span`` hashes that ``fits`` allows to start; ties all stay."""
    least = np.where(fits[: len(hashes) - span + 1], textvec.sliding(hashes, span, np.minimum), np.uint64(0))
    padded = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    highest = textvec.sliding(padded, span, np.maximum)
    return np.flatnonzero((hashes == highest) & (highest > 0))


def _fingerprints(lengths: list[int]):
    """Batches (key columns ..., text) to rows (key columns ..., size, at, print).

    ``size`` 0 marks winnowed grams; a length in ``lengths`` marks all runs of so many words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textvec.utf8(batch.column(batch.num_columns - 1))
            for first, last in textvec.slices(offsets):
                part = textvec.fold(data[offsets[first] : offsets[last]])
                words = textvec.find_words(part, offsets[first : last + 1] - offsets[first], _BYTES)
                hashes = textvec.span_hashes(part, words.starts, words.ends)
                found = []
                if len(hashes) >= WINDOW:
                    grams = textvec.window_hashes(hashes, GRAM)
                    at = winnowed(grams, textvec.window_fits(words, WINDOW), WINDOW - GRAM + 1)
                    found.append((0, at, grams[at]))
                for size in lengths:
                    at = np.flatnonzero(textvec.window_fits(words, size))
                    found.append((size, at, textvec.window_hashes(hashes, size)[at]))
                text = words.text_of_word()
                for size, at, prints in found:
                    if len(at):
                        row = text[at]
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(i).take(pa.array(row + first)) for i in range(batch.num_columns - 1)]
                            + [
                                pa.array(np.full(len(at), size, np.int32)),
                                pa.array((at - words.first[row]).astype(np.int32)),
                                pa.array(textvec.signed(prints)),
                            ],
                            names=[*batch.schema.names[:-1], "size", "at", "print"],
                        )

    return run


def _fingerprint_rows(df: DataFrame, keys: list[str], lengths: list[int]) -> DataFrame:
    ship(df.sparkSession)
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return df.select(*keys, "_text").mapInArrow(_fingerprints(lengths), f"{kinds}, size int, at int, print long")


def _window_text(words: str, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(F.col(words), start + 1, size), " ")


def windows_of(items: DataFrame) -> DataFrame:
    """Distinct (item_id, size, window) of items (item_id, text): each run of ``WINDOW`` words, or all words if fewer."""
    listed = items.select("item_id", words_of(text_of()).alias("_words")).where(F.size("_words") > 0)
    size = F.least(F.size("_words"), F.lit(WINDOW))
    starts = F.sequence(F.lit(0), F.size("_words") - size)
    made = F.transform(starts, lambda s: _window_text("_words", s, size))
    return listed.select("item_id", size.alias("size"), F.explode(made).alias("window")).distinct()


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Hits of items (item_id, text) in documents (doc_id, text): one row per document that has any.

    Columns: doc_id, _text_key, n_hit (words inside any occurrence of a window), spans (maximal runs of hit words, as
    start and length), n_items and items_sha256 (items with an occurring window, their identifiers in string order).

    Winnowed fingerprints of both sides are joined, so that only passages that share one are looked at. Each hit is then
    grown: all windows around it are cut from the text and joined on their full words with the items' windows, which
    confirms them exactly. Items of fewer words than a window are found by their whole run of words.
    Items without a word and documents without a hit give no row; equal rows of documents share one row.
    """
    benchmark = windows_of(items)
    shorter = [r["size"] for r in benchmark.where(F.col("size") < WINDOW).select("size").distinct().collect()]
    wanted = benchmark.select("size", "window").distinct()
    cut = wanted.select(F.col("size").alias("of"), F.col("window").alias("_text"))
    prints = _fingerprint_rows(cut, ["of"], sorted(shorter))
    sought = prints.where(((F.col("of") == WINDOW) & (F.col("size") == 0)) | (F.col("of") == F.col("size")))
    sought = sought.select(F.col("size").alias("_size"), F.col("print").alias("_print")).distinct()
    keyed = docs.select("doc_id", text_key().alias("_text_key"), text_of().alias("_text"))
    found = _fingerprint_rows(keyed, ["doc_id", "_text_key"], sorted(shorter))
    few = sought.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    hits = found.join(
        F.broadcast(sought) if few else sought, (F.col("size") == F.col("_size")) & (F.col("print") == F.col("_print")), "left_semi"
    )
    # A winnowed gram lies in the windows that start up to WINDOW - GRAM words before it.
    reach = F.when(F.col("size") == 0, F.greatest(F.col("at") - (WINDOW - GRAM), F.lit(0))).otherwise(F.col("at"))
    length = F.when(F.col("size") == 0, F.lit(WINDOW)).otherwise(F.col("size"))
    starts = hits.groupBy("doc_id", "_text_key").agg(
        F.collect_set(F.struct(length.alias("size"), reach.alias("lo"), F.col("at").alias("hi"))).alias("_hits")
    )
    grown = left_by(keyed, starts, ["doc_id", "_text_key"], "inner").select(
        "doc_id", "_text_key", words_of(F.col("_text")).alias("_words"), "_hits"
    )
    cuts = F.array_distinct(
        F.flatten(
            F.transform(
                "_hits",
                lambda h: F.transform(F.sequence(h["lo"], h["hi"]), lambda s: F.struct(h["size"].alias("size"), s.alias("start"))),
            )
        )
    )
    pieces = (
        grown.select("doc_id", "_text_key", "_words", F.explode(cuts).alias("c"))
        .where(F.col("c.start") + F.col("c.size") <= F.size("_words"))
        .select(
            "doc_id", "_text_key", "c.start", "c.size", _window_text("_words", F.col("c.start"), F.col("c.size")).alias("window")
        )
        .distinct()
    )
    occurring = stored(pieces.join(wanted, ["size", "window"], "left_semi"), "hits")
    spans = occurring.groupBy("doc_id", "_text_key").agg(
        F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("stop")))).alias("spans")
    )
    spans = merge_runs(spans).withColumn(
        "n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda n, r: n + (r["stop"] - r["start"]))
    )
    by_item = (
        occurring.join(benchmark, ["size", "window"])
        .select("doc_id", "_text_key", F.col("item_id").cast("string").alias("item"))
        .distinct()
        .groupBy("doc_id", "_text_key")
        .agg(F.sort_array(F.collect_list(F.coalesce("item", F.lit("")))).alias("_items"))
        .select(
            "doc_id",
            "_text_key",
            F.size("_items").cast("long").alias("n_items"),
            F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
        )
    )
    return left_by(spans.select("doc_id", "_text_key", "n_hit", "spans"), by_item, ["doc_id", "_text_key"])


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """All documents with n_words, n_hit, n_items, items_sha256 and contaminated; zeros and the hash of nothing without a hit.

    Missing texts have no words. Repeated rows come back repeated.
    """
    keyed = docs.select(
        "doc_id",
        text_key().alias("_text_key"),
        F.regexp_count(text_of(), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long").alias("n_words"),
    )
    joined = left_by(keyed, contaminated(docs, items), ["doc_id", "_text_key"])
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without a hit, with all their columns, whatever their names.

    Missing texts and empty ones have no hit. Repeated rows all stay or all go. Without items, or without documents, all stay.
    """
    keyed = docs.select("doc_id", text_key().alias("_text_key"), F.struct("*").alias("_doc"))
    hit = contaminated(docs, items).select("doc_id", "_text_key")
    return left_by(keyed, hit, ["doc_id", "_text_key"], "left_anti").select("_doc.*")
