"""Phrases whose words go together: frequent phrases by partitioned mining, exact counts, and scores."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from numprep.llm import textvec
from numprep.llm.common import shared_folder, ship, stored

#: Parts of the corpus that are mined by themselves. A part is spread over all ranges of hashes, so it has no size limit.
SHARDS = 10
#: Words of text for which there is one range of hashes.
WORDS_PER_RANGE = 2_000_000
#: Candidates that are sent to all tasks as keys (8 bytes each). More are sent as marks (3 bytes each), so many at once;
#: beyond, phrases are counted in rounds. Where that took more than ``ROUNDS``, so many count all phrases of their keys.
BROADCAST_ROWS = 4_000_000
MARKED_ROWS = 16_000_000
ROUNDS = 12
#: Text that is worked on at once, and phrases that are counted together before they are sent.
SLICE_BYTES = 1 << 20
HELD = 4_000_000
_SALTS = 64

#: Bytes that end a piece, and bytes between words of a piece.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_BLANKS = b" \t"
_WORD = textvec.classes(_ENDS + _BLANKS)
_PIECE = textvec.classes(_ENDS)
_KEY_BITS = 32
_NONE = np.zeros(0, np.uint64)
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass
class Run:
    """Words of some texts in order: hash, language and piece of each, and the lower-cased bytes."""

    data: np.ndarray
    words: textvec.Words
    hashes: np.ndarray
    language: np.ndarray
    piece: np.ndarray

    def fits(self, size: int) -> np.ndarray:
        """Whether the ``size`` words from each one on stand in one piece."""
        n = max(len(self.piece) - size + 1, 0)
        return self.piece[:n] == self.piece[size - 1 :][:n]


def _runs(texts: pa.Array, languages: np.ndarray, salts: np.ndarray) -> Iterator[tuple[int, int, Run]]:
    """Slices of the texts with their words. ``languages`` numbers each text's, ``salts`` are the hashes of these."""
    data, offsets = textvec.utf8(texts)
    for a, b in textvec.slices(offsets, SLICE_BYTES):
        raw = textvec.fold(data[offsets[a] : offsets[b]])
        at = offsets[a : b + 1] - offsets[a]
        words = textvec.find_words(raw, at, _WORD)
        ends = np.concatenate([[0], np.cumsum(~_PIECE[raw])])
        text = words.text_of_word()
        piece = ends[words.starts] + text  # grows with every end of a piece and every text
        language = languages[a:b][text]
        hashes = textvec.mix64(textvec.span_hashes(raw, words.starts, words.ends) ^ salts[language])
        yield a, b, Run(raw, words, hashes, language, piece)


def _numbered(languages: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages of a batch, the number of each text's, and a hash of each."""
    coded = languages.dictionary_encode()
    names = coded.dictionary.to_pylist()
    data, offsets = textvec.utf8(coded.dictionary)
    return names, coded.indices.to_numpy(zero_copy_only=False), textvec.span_hashes(data, offsets[:-1], offsets[1:])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, lang, shard) to the number of words of each language and shard in the batch."""
    for batch in batches:
        names, numbers, salts = _numbered(batch.column(1))
        shards = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
        counts = np.zeros(batch.num_rows, np.int64)
        for a, b, run in _runs(batch.column(0), numbers, salts):
            counts[a:b] = run.words.counts
        kinds, named = np.unique(numbers * SHARDS + shards, return_inverse=True)
        sums = np.bincount(named, counts, len(kinds)).astype(np.int64)
        columns = [pa.array([names[k // SHARDS] for k in kinds], pa.string()), pa.array(kinds % SHARDS), pa.array(sums)]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "shard", "words"])


def _phrase_hashes(run: Run, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each number of words: where phrases start, and their hashes."""
    for size in range(1, longest + 1):
        starts = np.flatnonzero(run.fits(size))
        yield size, starts, textvec.window_hashes(run.hashes, size)[starts]


def _bits(ranges: int) -> int:
    return _KEY_BITS + ranges.bit_length() - 1


def _keys(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Range (a power of two of them) and 32 bits within it, as one ascending number."""
    return hashes >> np.uint64(64 - _bits(ranges))


def _local_counts(longest: int, ranges: int):
    """(text, lang, shard) to one row per range and shard: different phrase keys in it, ascending, with their counts.

    A count is a byte; a key that occurs more often is repeated. Rows are sent for every ``HELD`` phrases.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            _, numbers, salts = _numbered(batch.column(1))
            shards = batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint64) << np.uint64(_bits(ranges))
            for a, b, words in _runs(batch.column(0), numbers, salts):
                shard_of = shards[a:b][words.words.text_of_word()]
                for _, starts, hashes in _phrase_hashes(words, longest):
                    held.append(_keys(hashes, ranges) | shard_of[starts])
                    size += len(starts)
                if size >= HELD:
                    yield _packed(np.concatenate(held), ranges)
                    held, size = [], 0
        if size:
            yield _packed(np.concatenate(held), ranges)

    return run


def _packed(keys: np.ndarray, ranges: int) -> pa.RecordBatch:
    keys, counts = np.unique(keys, return_counts=True)
    more = (counts - 1) // 255
    if more.any():
        keys = np.repeat(keys, more + 1)
        last = np.cumsum(more + 1) - 1
        rest = np.full(len(keys), 255, np.uint8)
        rest[last] = counts - 255 * more
        counts = rest
    cells = keys >> np.uint64(_KEY_BITS)  # shard and range
    bounds = np.concatenate([[0], np.flatnonzero(cells[1:] != cells[:-1]) + 1, [len(cells)]])
    low, counts = (keys & np.uint64((1 << _KEY_BITS) - 1)).astype(np.uint32), counts.astype(np.uint8)
    used = cells[bounds[:-1]].astype(np.int64)
    columns = [
        pa.array(used % ranges),
        pa.array(used // ranges),
        pa.array([low[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
        pa.array([counts[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["range", "shard", "keys", "counts"])


def _mine(supports: dict[int, int], support: int):
    """All rows of one range to its candidates: keys that a shard has as often as its support demands.

    A key counts every phrase that shares it, so one that all shards together have less than ``support`` times stands for no
    frequent phrase, and is left out.
    """

    def run(group: pa.Table) -> pa.Table:
        shards = group["shard"].to_numpy()
        found, everything = [], []
        for shard in np.unique(shards).tolist():
            rows = group.filter(pa.array(shards == shard))
            keys = np.frombuffer(b"".join(rows["keys"].to_pylist()), np.uint32)
            counts = np.frombuffer(b"".join(rows["counts"].to_pylist()), np.uint8)
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order].astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            keys, counts = keys[first], np.add.reduceat(counts, first)
            found.append(keys[counts >= supports[shard]])
            everything.append((keys, counts))
        candidates = np.unique(np.concatenate(found))
        total = np.zeros(len(candidates), np.int64)
        for keys, counts in everything:
            at = np.searchsorted(keys, candidates)
            there = at < len(keys)
            there[there] = keys[at[there]] == candidates[there]
            total[there] += counts[at[there]]
        candidates = candidates[total >= support].astype(np.int64)
        return pa.table({"key": candidates + (group["range"][0].as_py() << _KEY_BITS)})

    return run


def _occurrences(longest: int, ranges: int, candidates: Broadcast | None, share: tuple[int, int] | None = None):
    """(text, lang, shard) to phrases with their words and counts in the slice: those with a candidate's key, or all.

    ``candidates`` are `Wanted` or `Marked` keys. ``share`` are the least key and the one after the last; phrases of other keys
    are left out. Phrases are told apart by their words, not by hashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if candidates is None else candidates.value
        for batch in batches:
            names, numbers, salts = _numbered(batch.column(1))
            for _, _, words in _runs(batch.column(0), numbers, salts):
                exact, spelled = _exact_words(words)
                for size, starts, hashes in _phrase_hashes(words, longest):
                    keys = _keys(hashes, ranges)
                    if share is not None:
                        mine = (keys >= np.uint64(share[0])) & (keys < np.uint64(share[1]))
                        starts, keys = starts[mine], keys[mine]
                    if wanted is not None:
                        keep = wanted.has(keys)
                        starts, keys = starts[keep], keys[keep]
                    code = _phrase_numbers(exact, starts, size, len(spelled))
                    _, first, counts = np.unique(code, return_index=True, return_counts=True)
                    if len(first):
                        at = starts[first]
                        parts = [spelled.take(pa.array(exact[at + i])) for i in range(size)]
                        phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if size > 1 else parts[0]
                        columns = [
                            pa.array(names, pa.string()).take(pa.array(words.language[at])),
                            phrase.cast(pa.string()),
                            pa.array(np.full(len(at), size, np.int32)),
                            pa.array(counts),
                            pa.array(keys[first].astype(np.int64)),
                        ]
                        yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "size", "f", "key"])

    return run


def _phrase_numbers(exact: np.ndarray, starts: np.ndarray, size: int, kinds: int) -> np.ndarray:
    """A number for each phrase of ``size`` words, the same for the same words. ``exact`` numbers words below ``kinds``."""
    code, most = exact[starts], kinds
    for i in range(1, size):
        if most * kinds > np.iinfo(np.int64).max:
            different, code = np.unique(code, return_inverse=True)
            most = len(different)
        code, most = code * kinds + exact[starts + i], most * kinds
    return code


class Marked:
    """Three marks in 24 bits for each key: it has all of the keys, and two of a thousand others."""

    def __init__(self, parts: list[np.ndarray]):
        self.size = np.uint64(24 * sum(map(len, parts)) + 64)
        self.marks = np.zeros(int(self.size) // 8 + 1, np.uint8)
        for keys in parts:
            for i in range(3):
                at = self._places(keys, i)
                for bit in range(8):
                    self.marks[at[(at & np.uint64(7)) == bit] >> np.uint64(3)] |= np.uint8(1 << bit)

    def _places(self, keys: np.ndarray, i: int) -> np.ndarray:
        spread = textvec.mix64(keys + np.uint64(i << 62))
        return ((spread >> np.uint64(32)) * self.size) >> np.uint64(32)

    def _has(self, keys: np.ndarray, i: int) -> np.ndarray:
        at = self._places(keys, i)
        return (self.marks[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = self._has(keys, 0)
        for i in (1, 2):
            found[found] = self._has(keys[found], i)
        return found


class Wanted:
    """Ascending keys, with marks that most other keys lack."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.marked = Marked([keys])

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = self.marked.has(keys)
        maybe = keys[found]
        at = np.minimum(np.searchsorted(self.keys, maybe), max(len(self.keys) - 1, 0))
        found[found] = self.keys[at] == maybe
        return found


def _exact_words(run: Run) -> tuple[np.ndarray, pa.Array]:
    """Number of each word among the different (language, word) of the slice, and the words."""
    sizes = run.words.ends - run.words.starts
    letters = run.data[textvec.ranges(run.words.starts, sizes)]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(letters))
    coded = words.dictionary_encode()
    both = run.language.astype(np.int64) * max(len(coded.dictionary), 1) + coded.indices.to_numpy(zero_copy_only=False)
    kinds, number = np.unique(both, return_inverse=True)
    return number, coded.dictionary.take(pa.array(kinds % max(len(coded.dictionary), 1)))


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What a query shuffles is removed when it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def frequent_phrases(
    docs: DataFrame, support: int = 30, longest: int = 4, text: str = "text", lang: str = "lang"
) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``longest`` words that a language has ``support`` times, and the words of each language.

    Partitioned mining: documents are dealt into shards by a hash of the text. A phrase that all shards together have
    ``support`` times is in some shard at least ``support`` times the shard's share of all words; what no shard has that
    often is no candidate. Shards are mined completely. Tasks send the different phrases of a slice of text as 32-bit keys
    within ranges of hashes, and the group of a range mines its part of every shard; there is a range for each
    ``WORDS_PER_RANGE`` words, so a group's size does not depend on the corpus. A phrase of a third of all words is one key of
    a slice. Then every occurrence of a candidate is counted exactly, by its words: false candidates of shared keys go here.

    Many candidates are sent as marks, which a few other phrases have too: these are counted exactly, and are not frequent.
    More than can be sent at once are counted in rounds, each for a share of the keys, and what a round has shuffled is removed
    before the next. There are ``ROUNDS`` of them at most, so the time taken stays in proportion to the text.
    """
    spark = docs.sparkSession
    ship(spark)
    words = F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    narrow = docs.select(
        words,
        F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"),
        F.pmod(F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))), F.lit(SHARDS)).alias("shard"),
    )
    counted = narrow.mapInArrow(_count_words, "lang string, shard long, words long")
    with _shuffles_removed(spark):
        by_shard = stored(counted.groupBy("lang", "shard").agg(F.sum("words").alias("words")), "words")
    totals = {r.shard: r.words for r in by_shard.groupBy("shard").agg(F.sum("words").alias("words")).collect()}
    n = max(sum(totals.values()), 1)
    supports = {shard: max(1, -(-support * count // n)) for shard, count in totals.items()}
    ranges = 1 << max(0, (n // WORDS_PER_RANGE).bit_length())
    local = narrow.mapInArrow(_local_counts(longest, ranges), "range long, shard long, keys binary, counts binary")
    mined = local.groupBy("range").applyInArrow(_mine(supports, support), "key long")
    with _shuffles_removed(spark):
        candidates = stored(mined, "candidates")
    many = candidates.count()
    needed = 1 if many <= BROADCAST_ROWS else -(-many // MARKED_ROWS)
    rounds = min(needed, ROUNDS)
    path = f"{shared_folder(spark)}/phrases-{uuid.uuid4().hex}"
    for i in range(rounds):
        share = tuple((ranges << _KEY_BITS) * k // rounds for k in (i, i + 1))
        sent = None
        if needed <= ROUNDS:
            of_round = candidates.where((F.col("key") >= share[0]) & (F.col("key") < share[1]))
            keys = [part.to_numpy().astype(np.uint64) for part in of_round.toArrow()["key"].chunks]
            few = many <= BROADCAST_ROWS
            sent = spark.sparkContext.broadcast(Wanted(np.sort(np.concatenate([*keys, _NONE]))) if few else Marked(keys))
        schema = "lang string, phrase string, size int, f long, key long"
        found = narrow.mapInArrow(_occurrences(longest, ranges, sent, share if rounds > 1 else None), schema)
        exact = found.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).where(F.col("f") >= support)
        with _shuffles_removed(spark):
            exact.write.mode("append").parquet(path, compression="snappy")
        if sent is not None:
            sent.destroy()
    return spark.read.schema(exact.schema).parquet(path), by_shard.groupBy("lang").agg(F.sum("words").alias("n"))


def _part(first: int, last: int) -> Column:
    """Words number ``first`` to ``last`` of a phrase, which has no other blanks."""
    return F.concat_ws(" ", F.slice(F.split("phrase", " "), first + 1, last - first))


def collocations(
    docs: DataFrame,
    support: int = 30,
    longest: int = 4,
    scale: int = 2_000_000,
    absorbed: int = 80,
    top: int = 2000,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """The best phrases of 2 to ``longest`` words of each language: lang, rank, phrase, a, l, r, n, score.

    A-Z is lower-cased, pieces end at ``.,;:!?`` and line ends, words are what blanks and tabs leave, and phrases stay within
    a piece. ``a`` is how often the language has the phrase, at least ``support`` times; cut after its first words, its parts
    have counts ``l`` and ``r``, and the score is ``scale`` times a/(l+r), rounded down: of all cuts the lowest, of equal
    ones that with the shortest first part. A phrase is left out if a longer one that contains it, left out itself or not,
    has at least ``absorbed`` percent of its count. Order: score, then ``a``, both descending, then the phrase by bytes.

    Counts are exact (`frequent_phrases`), and scores are computed in decimals. Parts and containing phrases are found by
    joins on (lang, phrase), which is unique on one side; containing phrases shrink to one row per phrase and task first.
    The first ``top`` of a language are found in two rounds, so no language meets in one task.

    A missing text is empty; an empty one, one without a word and an empty table give nothing. A missing language is ``und``,
    together with documents that say so. Repeated rows count each. Other columns, whatever their names, are not read. A very
    long text is counted alone, in memory in proportion to it.
    """
    phrases, n = frequent_phrases(docs, support, longest, text, lang)
    cuts = phrases.where("size > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "size", F.col("f").alias("a"), "k",
        _part(F.lit(0), F.col("k")).alias("head"), _part(F.col("k"), F.col("size")).alias("tail"),
    )
    parts = phrases.where(F.col("size") < longest)
    for part, count in (("head", "l"), ("tail", "r")):
        known = parts.select("lang", F.col("phrase").alias(part), F.col("f").alias(count))
        cuts = cuts.join(known, ["lang", part])
    wide = "decimal(30,0)"
    cuts = cuts.withColumn("score", _whole_division(scale))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("lowest")
    scored = cuts.groupBy("lang", "phrase", "size", "a").agg(lowest).select("lang", "phrase", "a", "lowest.*")
    inner = [(i, j) for size in range(2, longest) for i in range(longest) for j in (i + size,) if j <= longest]
    longer = phrases.where("size > 2").withColumn(
        "inner",
        F.array_compact(
            F.array(*[F.when((F.lit(j - i) < F.col("size")) & (F.lit(j) <= F.col("size")), _part(F.lit(i), F.lit(j))) for i, j in inner])
        ),
    )
    within = longer.select("lang", F.explode("inner").alias("phrase"), F.col("f").alias("b"))
    within = within.groupBy("lang", "phrase").agg(F.max("b").alias("b"))
    free = scored.join(within, ["lang", "phrase"], "left").where(
        F.col("b").isNull() | (F.col("b").cast(wide) * 100 < F.col("a").cast(wide) * absorbed)
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]

    def first(df: DataFrame, *groups: str) -> DataFrame:
        place = F.row_number().over(W.Window.partitionBy(*groups).orderBy(*order))
        return df.withColumn("rank", place).where(F.col("rank") <= top)

    best = first(first(free.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))), "lang", "salt"), "lang")
    return best.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _whole_division(scale: int) -> Column:
    """``scale`` * a / (l + r) without a rest, exact for any counts."""
    above = F.col("a").cast("decimal(20,0)") * F.lit(scale).cast("decimal(10,0)")
    return F.call_function("div", above, F.col("l").cast("decimal(20,0)") + F.col("r").cast("decimal(20,0)"))
