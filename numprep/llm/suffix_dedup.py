"""Exact substring deduplication: suffix arrays, by induced sorting, of the passages that may occur twice."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from numprep.llm import textvec
from numprep.llm.common import left_by, merge_runs, ship, stored, text_key, text_of
from numprep.llm.suffix_array import common_prefixes, suffix_array

#: A string of so many bytes is removed wherever it is, if it starts at more than one place.
LENGTH = 400
#: Bytes of an anchor. Every string of LENGTH bytes has one: the run of so many bytes with the least hash.
ANCHOR = 300
REACH = LENGTH - ANCHOR
#: Contexts of one shard's suffix array.
SHARD = 4_000
#: Rows and bytes up to which one side of a join is sent to all tasks; beyond, both sides are shuffled.
BROADCAST_ROWS = 4_000_000
BROADCAST_BYTES = 64 << 20
#: Starts that are looked at together in one very long text.
CHUNK = 4 << 20
_PLACE = np.uint64((1 << 24) - 1)
_DIGIT = 255
#: Bytes are symbols 1 to 256, digits of the anchor's number the next ones, and 0 ends a context.
ALPHABET = 257 + _DIGIT
#: Symbols of a whole string: its bytes without those of the anchor, which is a symbol of three digits.
NEEDED = REACH + 3


def _anchors_within(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, place, first, last) of the anchors of texts that lie in ``data``: places are in ``data``.

    ``first`` to ``last`` are the starts of the strings whose anchor it is, which is the leftmost least one.
    """
    count = len(data) - LENGTH + 1
    if count <= 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    at = np.arange(len(data) - ANCHOR + 1)
    hashes = textvec.span_hashes(data, at, at + ANCHOR)
    keyed = (hashes & ~_PLACE) | at.astype(np.uint64)
    least = textvec.sliding(keyed, REACH + 1, np.minimum)[:count]
    ends = np.repeat(offsets[1:], np.diff(offsets))[:count]
    starts = np.flatnonzero(np.arange(count) + LENGTH <= ends)
    place = (least[starts] & _PLACE).astype(np.int64)
    heads = np.flatnonzero(np.diff(place, prepend=-1))
    last = starts[np.append(heads[1:], len(starts)) - 1] if len(starts) else starts
    return hashes[place[heads]], place[heads], starts[heads], last


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, hash, place, first, last) of all anchors of all texts; places count from the start of the text."""
    found = []
    for a, b in textvec.slices(offsets):
        low, high = int(offsets[a]), int(offsets[b])
        for start in range(low, max(high - LENGTH + 1, low + 1), CHUNK):
            stop = min(high, start + CHUNK + LENGTH - 1)
            own = np.clip(offsets[a : b + 1], start, stop) - start
            hashes, place, first, last = _anchors_within(data[start:stop], own)
            text = np.searchsorted(offsets, place + start, "right") - 1
            base = offsets[text] - start
            found.append((text, hashes, place - base, first - base, last - base))
    if not found:
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, np.uint64), none, none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text_key, text) to text_key, the hashes of its anchors and their places."""
    for batch in batches:
        data, offsets = textvec.utf8(batch.column("_text"))
        text, hashes, place, _, _ = anchors(data, offsets)
        ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(text, minlength=batch.num_rows))]).astype(np.int32))
        columns = [pa.array(textvec.signed(hashes)), pa.array(place.astype(np.int32))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("text_key"), *[pa.ListArray.from_arrays(ends, c) for c in columns]],
            names=["text_key", "anchors", "places"],
        )


def _contexts(whole: bool):
    """(text_key, text, places) to one row per wanted anchor: what surrounds it, by hash and, if ``whole``, in full."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textvec.utf8(batch.column("_text"))
            wanted = batch.column("places")
            sizes = np.diff(np.asarray(wanted.offsets))
            keys = np.repeat(np.arange(batch.num_rows), sizes) << 40 | np.asarray(wanted.flatten()).astype(np.int64)
            for a, b in textvec.slices(offsets):
                part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                text, hashes, place, first, last = anchors(part, own)
                chosen = np.flatnonzero(np.isin((text + a) << 40 | place, keys))
                if not len(chosen):
                    continue
                text, hashes, place, first, last = (x[chosen] for x in (text, hashes, place, first, last))
                base = own[text]
                left = textvec.span_hashes(part, base + first, base + place)
                right = textvec.span_hashes(part, base + place + ANCHOR, base + last + LENGTH)
                context = textvec.mix64(left + textvec.mix64(right))
                columns = [
                    batch.column("text_key").take(pa.array(text + a)),
                    pa.array(textvec.signed(hashes)),
                    pa.array(textvec.signed(context)),
                    pa.array(place.astype(np.int32)),
                    pa.array(first.astype(np.int32)),
                    pa.array(last.astype(np.int32)),
                ]
                names = ["text_key", "anchor", "context", "place", "first", "last"]
                if whole:
                    raw = part.tobytes()
                    for name, lows, highs in (
                        ("before", base + first, base + place),
                        ("after", base + place + ANCHOR, base + last + LENGTH),
                    ):
                        columns.append(pa.array([raw[x:y] for x, y in zip(lows.tolist(), highs.tolist(), strict=True)], pa.binary()))
                        names.append(name)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def shard_classes(anchor: np.ndarray, before: list[bytes], after: list[bytes], many: np.ndarray) -> tuple[np.ndarray, ...]:
    """(context, start, class, twice) of all strings of a shard's contexts; ``start`` counts from the context's first.

    The contexts are one text: the bytes before the anchor, the anchor's number, the bytes after it, an end. Strings are
    equal if the suffixes at their starts agree in ``NEEDED`` symbols, and so are neighbours in the suffix array.
    ``twice`` tells whether a string starts at two places, be it in two contexts or in one of which there are ``many``.
    """
    numbers = np.unique(anchor, return_inverse=True)[1]
    sizes = np.array([len(x) for x in before]), np.array([len(x) for x in after])
    lengths = sizes[0] + 3 + sizes[1] + 1
    ends = np.cumsum(lengths)
    begins = ends - lengths
    symbols = np.zeros(int(ends[-1]), np.int64)
    symbols[textvec.ranges(begins, sizes[0])] = np.frombuffer(b"".join(before), np.uint8).astype(np.int64) + 1
    behind = begins + sizes[0] + 3
    symbols[textvec.ranges(behind, sizes[1])] = np.frombuffer(b"".join(after), np.uint8).astype(np.int64) + 1
    for i in range(3):
        symbols[begins + sizes[0] + i] = 257 + numbers // _DIGIT ** (2 - i) % _DIGIT
    order = suffix_array(symbols, ALPHABET, NEEDED + 1)
    shared = common_prefixes(symbols, order, NEEDED)
    classes = np.empty(len(symbols), np.int64)
    classes[order] = np.cumsum(shared < NEEDED)
    count = sizes[0] + sizes[1] - REACH + 1  # strings that lie in the context
    starts = textvec.ranges(begins, count)
    context = np.repeat(np.arange(len(begins)), count)
    own = classes[starts]
    members = np.bincount(own, weights=np.where(many, 2, 1)[context])
    return context, starts - begins[context], own, members[own] > 1


def _runs(flags: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of the maximal runs of set flags within neighbours of one group."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at
    cut = (np.diff(at) > 1) | (np.diff(groups[at]) != 0)
    return at[np.append(True, cut)], at[np.append(cut, True)]


def _resolve(shard: pd.DataFrame) -> pd.DataFrame:
    """Rows (anchor, context, from, to, name): runs of starts found twice, and names of other strings of split anchors."""
    many = shard["n"].to_numpy() > 1
    context, start, own, twice = shard_classes(
        shard["anchor"].to_numpy(), shard["before"].tolist(), shard["after"].tolist(), many
    )
    a, b = _runs(twice, context)
    found = pd.DataFrame({"row": context[a], "from": start[a], "to": start[b], "name": None})
    split = shard["split"].to_numpy()[context]
    if split.any():
        # The anchor has contexts in other shards too. One string of each class is named, by all its bytes.
        at = np.flatnonzero(split)
        rows = []
        named: dict[int, bytes] = {}
        before, after = shard["before"].tolist(), shard["after"].tolist()
        for i in at.tolist():
            kind = int(own[i])
            if kind not in named:
                c, s = int(context[i]), int(start[i])
                head = before[c][s:]
                named[kind] = hashlib.md5(head + b"|" + str(len(head)).encode() + b"|" + after[c][: REACH - len(head)]).digest()
            rows.append(named[kind])
        names = pd.DataFrame({"row": context[at], "from": start[at], "to": start[at], "name": rows})
        found = pd.concat([found, names], ignore_index=True)
    row = found["row"].to_numpy().astype(np.int64)
    found["anchor"], found["context"] = shard["anchor"].to_numpy()[row], shard["context"].to_numpy()[row]
    return found[["anchor", "context", "from", "to", "name"]].astype({"from": "int32", "to": "int32"})


def _small(df: DataFrame, rows: int, size: int) -> DataFrame:
    """The table, marked to be sent to all tasks if its measured rows and bytes allow it."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else df


def repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows (text_key, runs): for each text that has any, the byte ranges that are to go, merged and ascending.

    1. Each string of ``LENGTH`` bytes has an anchor, which its content alone decides. Anchors are counted; strings whose
       anchor occurs once occur once.
    2. Of the anchors that occur again, the surroundings are compared by hash: where they are equal, so are all strings.
    3. Of the rest, one of each different surroundings goes to a shard's suffix array. All strings with an anchor are in
       one shard, unless the anchor has more than ``SHARD`` surroundings: these are split, and the shards' classes of equal
       strings, one row each, are then joined by content.
    """
    ship(docs.sparkSession)
    keyed = docs.select(text_key(text).alias("text_key"), text_of(text).alias("_text"))
    long = keyed.where(F.octet_length("_text") >= LENGTH)
    listed = stored(long.mapInArrow(_listing, "text_key binary, anchors array<long>, places array<int>"), "anchors")
    again = listed.select(F.explode("anchors").alias("anchor")).groupBy("anchor").agg(F.count("*").alias("n"))
    again = stored(again.where("n > 1").select("anchor"), "again")
    rows = again.count()
    pairs = listed.select("text_key", F.explode(F.arrays_zip("anchors", "places")).alias("x"))
    pairs = pairs.select("text_key", F.col("x.anchors").alias("anchor"), F.col("x.places").alias("place"))
    hits = pairs.join(_small(again, rows, rows * 16), "anchor", "left_semi")
    wanted = stored(hits.groupBy("text_key").agg(F.collect_set("place").alias("places")), "places")

    def cut(places: DataFrame, whole: bool) -> DataFrame:
        size = places.agg(F.count("*").alias("n"), F.sum(F.size("places")).alias("places")).first()
        near = long.join(_small(places, size["n"], size["n"] * 48 + (size["places"] or 0) * 4), "text_key")
        schema = "text_key binary, anchor long, context long, place int, first int, last int"
        return near.mapInArrow(_contexts(whole), schema + (", before binary, after binary" if whole else ""))

    contexts = stored(cut(wanted, False), "contexts")
    one = F.min(F.struct("text_key", "place")).alias("one")
    kinds = stored(contexts.groupBy("anchor", "context").agg(F.count("*").alias("n"), one), "kinds")
    groups = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
    groups = groups.where("kinds > 1 and least = 1").select("anchor", "kinds")
    open_kinds = stored(kinds.join(groups, "anchor"), "open")
    chosen = open_kinds.select(F.col("one.text_key").alias("text_key"), F.col("one.place").alias("place"))
    full = cut(chosen.groupBy("text_key").agg(F.collect_set("place").alias("places")), True)
    # Of copies of a text all rows are cut alike; of equal surroundings one is enough.
    full = full.groupBy("anchor", "context").agg(F.min("before").alias("before"), F.min("after").alias("after"))
    parts = F.ceil(F.col("kinds") / SHARD)
    shards = max(1, -(-open_kinds.count() // SHARD))
    spread = F.pmod(F.xxhash64("anchor", F.when(parts > 1, F.pmod(F.xxhash64("context"), parts)).otherwise(0)), F.lit(shards))
    work = full.join(open_kinds.select("anchor", "context", "n", "kinds"), ["anchor", "context"]).select(
        "anchor", "context", "n", (parts > 1).alias("split"), "before", "after", spread.alias("shard")
    )
    schema = "anchor long, context long, `from` int, `to` int, name binary"
    resolved = stored(work.groupBy("shard").applyInPandas(lambda shard: _resolve(shard), schema), "resolved")
    named = resolved.where("name is not null")
    twice = named.join(
        named.select("name", "anchor", "context").distinct().groupBy("anchor", "name").agg(F.count("*").alias("n")).where("n > 1"),
        ["anchor", "name"],
    )
    starts = resolved.where("name is null").select("anchor", "context", "from", "to").union(
        twice.select("anchor", "context", "from", "to")
    )
    partly = left_by(contexts, starts, ["anchor", "context"], "inner").select(
        "text_key", (F.col("first") + F.col("from")).alias("a"), (F.col("first") + F.col("to") + LENGTH).alias("b")
    )
    equal = kinds.where("n > 1").select("anchor", "context")
    wholly = contexts.join(equal, ["anchor", "context"], "left_semi").select(
        "text_key", F.col("first").alias("a"), (F.col("last") + LENGTH).alias("b")
    )
    runs = F.sort_array(F.collect_set(F.struct("a", "b"))).alias("runs")
    found = partly.union(wholly).groupBy("text_key").agg(runs)
    return stored(merge_runs(found), "runs")


def _removing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text, runs) to (key, n_bytes, n_removed, n_spans, kept)."""
    for batch in batches:
        raw = batch.column("_text").cast(pa.binary()).to_pylist()
        runs = batch.column("runs").to_pylist()
        spans = [[(run["a"], run["b"]) for run in r or ()] for r in runs]
        kept = []
        for text, own in zip(raw, spans, strict=True):
            edges = [0, *[x for s in own for x in s], len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if own else text)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(t) for t in raw], pa.int64()),
                pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
                pa.array([len(s) for s in spans], pa.int64()),
                pa.array(kept, pa.binary()),
            ],
            names=[batch.schema.names[0], "n_bytes", "n_removed", "n_spans", "kept"],
        )


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_bytes, n_removed, n_spans (maximal removed runs) and kept, the bytes that stay.

    Texts are UTF-8 bytes, missing ones empty, and no string reaches over the end of its document. Every byte goes that a
    string of ``LENGTH`` bytes covers which starts anywhere else too, in the same document or another, so that nothing
    of copies of a long document stays. What stays may be cut inside a character.
    """
    kind = docs.schema[key].dataType.simpleString()
    found = repeats(docs, text)
    size = found.agg(F.count("*").alias("n"), F.sum(F.size("runs")).alias("runs")).first()
    found = _small(found, size["n"], size["n"] * 48 + (size["runs"] or 0) * 24)
    keyed = docs.select(key, text_key(text).alias("text_key"), text_of(text).alias("_text"))
    joined = keyed.join(found, "text_key", "left").select(key, "_text", "runs")
    return joined.mapInArrow(_removing, f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
