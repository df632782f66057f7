"""Near-duplicate classes: DartMinHash signatures of weighted word shingles, banded joining, exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from numprep.llm import textvec
from numprep.llm.common import WORD, few, give_back, ship, stored, text_key, text_of
from numprep.llm.components import components

#: Words of a shingle; a text of fewer words is one shingle.
SHINGLE = 5
#: Two texts are linked if the weighted Jaccard similarity of their shingles, counted as often as they occur, is so high.
SIMILARITY = 0.8
#: Coordinates of a signature, and how many of them make a band. Texts with similarity s share no band with
#: probability (1 - s^4)^32: 5e-8 at 0.8.
COORDINATES = 128
BAND = 4
#: Candidates whose signatures agree in a smaller share are not looked at. At similarity 0.8 this is 5.8 standard
#: deviations below the mean, 1e-8.
LEAST_AGREEMENT = 0.6
#: Darts thrown at a text at first: with so many, few coordinates stay empty; those texts get twice as many again.
DARTS = COORDINATES * np.log(COORDINATES) + 2 * COORDINATES
#: Members of a bucket that are compared with each other in one go; of larger ones, blocks of texts are.
BLOCK, TEXT_BLOCK = 64, 32

_STEP = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_LOW = np.uint64(0xFFFFFFFF)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells (text, hash) of all texts, sorted: the n-th occurrence of a shingle in its text is a cell of its own.

    A shingle that occurs n times has the weight n, that is, n cells of weight 1.
    """
    words = textvec.find_words(data, offsets)
    hashes = textvec.span_hashes(data, words.starts, words.ends)
    fits = textvec.window_fits(words, SHINGLE)
    text = words.text_of_word()[: len(fits)][fits]
    runs = textvec.window_hashes(hashes, SHINGLE)[fits]
    few = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    if len(few):
        text = np.concatenate([text, few])
        runs = np.concatenate([runs, textvec.run_hashes(hashes, words.first[few], words.last[few])])
    order = np.lexsort((runs, text))
    text, runs = text[order], runs[order]
    if not len(runs):
        return text, runs
    head = np.ones(len(runs), bool)
    head[1:] = (runs[1:] != runs[:-1]) | (text[1:] != text[:-1])
    heads = np.flatnonzero(head)
    occurrence = np.arange(len(runs)) - np.repeat(heads, np.diff(np.append(heads, len(runs))))
    return text, textvec.mix64(runs + occurrence.astype(np.uint64) * np.uint64(_STEP))


def _throw(text: np.ndarray, cells: np.ndarray, reach: np.ndarray, earliest: np.ndarray) -> None:
    """Throw darts at all cells, up to the rank that ``reach`` has for their text, and note the earliest per coordinate.

    Ranks of a cell's darts are a Poisson process of rate 1 that depends on nothing but the cell's hash, so that a cell
    which two texts share gets the same darts in both. ``earliest`` has, by text and coordinate, the rank's bits above
    those of the dart's name: the bits of a positive float are in its order.
    """
    rank = np.zeros(len(cells))
    number = 1
    while len(cells):
        name = textvec.mix64(cells + np.uint64(number * _STEP & _MASK))
        rank = rank - np.log(((name >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        inside = np.flatnonzero(rank <= reach[text])
        text, cells, rank = text[inside], cells[inside], rank[inside]
        value = textvec.mix64(name[inside] ^ np.uint64(_STEP))
        dart = (rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (value & _LOW)
        coordinate = (value >> np.uint64(32)) % np.uint64(COORDINATES)
        np.minimum.at(earliest, text * COORDINATES + coordinate.astype(np.int64), dart)
        number += 1


def signatures(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text the name of the earliest dart per coordinate, and whether the text has a word."""
    n = len(offsets) - 1
    out = np.zeros((n, COORDINATES), np.uint32)
    text, cells = shingles(data, offsets)
    weight = np.bincount(text, minlength=n)
    todo = weight > 0
    full = todo.copy()
    darts = DARTS
    while todo.any():
        # Renumber the texts at hand, and throw so many darts at each, whatever its weight.
        own = np.flatnonzero(todo)
        place = np.cumsum(todo) - 1
        mine = todo[text]
        earliest = np.full(len(own) * COORDINATES, _MASK, np.uint64)
        _throw(place[text[mine]], cells[mine], darts / weight[own], earliest)
        earliest = earliest.reshape(len(own), COORDINATES)
        done = (earliest != np.uint64(_MASK)).all(axis=1)
        out[own[done]] = (earliest[done] & _LOW).astype(np.uint32)
        todo[own[done]] = False
        darts *= 2
    return out, full


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """One hash per band; hashes of different bands never count as equal but by chance."""
    parts = signature.reshape(len(signature), -1, BAND).astype(np.uint64)
    out = np.arange(parts.shape[1], dtype=np.uint64)[None, :] * np.uint64(_STEP)
    for i in range(BAND):
        out = textvec.mix64(out + parts[:, :, i])
    return out


def signature_column(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The signature of each text as bytes, missing for texts without a word."""
    made, full = signatures(data, offsets)
    return pa.array([row.tobytes() if ok else None for row, ok in zip(made, full, strict=True)], pa.binary())


def _signing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    give_back()
    for batch in batches:
        data, offsets = textvec.utf8(batch.column(batch.num_columns - 1))
        for a, b in textvec.slices(offsets):
            made = signature_column(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).slice(a, b - a) for i in range(batch.num_columns - 1)] + [made],
                names=[*batch.schema.names[:-1], "signature"],
            )


def _banding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, signature) to rows (node, bucket), one for each band."""
    for batch in batches:
        bands = band_hashes(_rows(batch.column("signature")))
        node = np.repeat(batch.column("node").to_numpy(), bands.shape[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(node), pa.array(textvec.signed(bands.reshape(-1)))], names=["node", "bucket"]
        )


def _shortening(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, signature) to (node, value): the last byte of each coordinate."""
    for batch in batches:
        short = np.ascontiguousarray(_rows(batch.column("signature")).astype(np.uint8))
        values = pa.array([row.tobytes() for row in short], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("node"), values], names=["node", "value"])


def _agreement(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left == right).sum(axis=1) / COORDINATES


def _rows(column: pa.Array, kind: type = np.uint32) -> np.ndarray:
    """Signatures of a binary column."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, kind).reshape(-1, COORDINATES)


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, left, right) to the pairs (a, b) whose shortened signatures agree enough: all that agree enough in full."""
    for batch in batches:
        left, right = (_rows(batch.column(name), np.uint8) for name in ("left", "right"))
        keep = _agreement(left, right) >= LEAST_AGREEMENT
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))


def _crossing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(members), lists of (node, component, value), to agreeing pairs of different components."""
    for batch in batches:
        column = batch.column("members")
        flat = column.flatten()
        offsets = np.asarray(column.offsets).astype(np.int64)
        offsets -= offsets[0]
        node, part = np.asarray(flat.field(0)), np.asarray(flat.field(1))
        value = _rows(flat.field(2), np.uint8)
        for row in range(batch.num_rows):
            i, j = (x + offsets[row] for x in np.triu_indices(offsets[row + 1] - offsets[row], 1))
            apart = part[i] != part[j]
            i, j = i[apart], j[apart]
            alike = _agreement(value[i], value[j]) >= LEAST_AGREEMENT
            i, j = i[alike], j[alike]
            if len(i):
                low, high = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
                yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], names=["a", "b"])


def block_similarities(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of each text of one block with each of another, by a product of their cell tables."""
    sides = [shingles(*textvec.utf8(x)) for x in (left, right)]
    common = np.intersect1d(sides[0][1], sides[1][1])
    tables, sizes = [], []
    for (text, cells), texts in zip(sides, (left, right), strict=True):
        at = np.searchsorted(common, cells)
        known = at < len(common)
        known[known] = common[at[known]] == cells[known]
        table = np.zeros((len(texts), len(common)), np.float32)
        table[text[known], at[known]] = 1
        tables.append(table)
        sizes.append(np.bincount(text, minlength=len(texts)))
    shared = (tables[0] @ tables[1].T).astype(np.float64)
    return shared / np.maximum(sizes[0][:, None] + sizes[1][None, :] - shared, 1)


def _alike_texts(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Which texts of one block are similar enough to which of another."""
    return block_similarities(left, right) >= SIMILARITY - 1e-12


def _crossing_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(one, other), lists of (node, component, value), to links of different components.

    A node is linked once to each component of the other block: more links would connect nothing more.
    """
    give_back()
    for batch in batches:
        for row in range(batch.num_rows):
            sides = [batch.column(name)[row].values for name in ("one", "other")]
            (a, ca), (b, cb) = ((np.asarray(s.field(0)), np.asarray(s.field(1))) for s in sides)
            i, j = np.nonzero(_alike_texts(sides[0].field(2), sides[1].field(2)) & (ca[:, None] != cb[None, :]))
            if len(i):
                _, first = np.unique(np.stack([i, cb[j]]), axis=1, return_index=True)
                low, high = np.minimum(a[i], b[j])[first], np.maximum(a[i], b[j])[first]
                yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], names=["a", "b"])


def similarities(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of the shingles of two texts each; 0 if neither has a word."""
    out = np.zeros(len(left))
    sides = [textvec.utf8(x) for x in (left, right)]
    first = 0
    for a, b in textvec.slices(sides[0][1] + sides[1][1]):
        own = [shingles(d[o[a] : o[b]], o[a : b + 1] - o[a]) for d, o in sides]
        n = b - a
        keys = [textvec.mix64(c + textvec.mix64(t.astype(np.uint64))) for t, c in own]
        both = np.isin(keys[0], keys[1])
        shared = np.bincount(own[0][0][both], minlength=n)
        total = np.bincount(own[0][0], minlength=n) + np.bincount(own[1][0], minlength=n) - shared
        out[first : first + n] = shared / np.maximum(total, 1)
        first += n
    return out


def _confirming(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, left, right) to the pairs (a, b) whose texts are similar enough."""
    give_back()
    for batch in batches:
        keep = similarities(batch.column("left"), batch.column("right")) >= SIMILARITY - 1e-12
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))


def _with_values(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """(a, b, left, right) of pairs (a, b) and values (node, value)."""
    left = values.select(F.col("node").alias("a"), F.col("value").alias("left"))
    right = values.select(F.col("node").alias("b"), F.col("value").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")


def _texts(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Stored (node, value) of the nodes wanted, with their texts."""
    keys = few(stored(wanted.distinct().join(nodes.select("node", "text_key"), "node"), "wanted"))
    texts = docs.select(text_key().alias("text_key"), text_of().alias("value"))
    return stored(texts.join(keys, "text_key").groupBy("node").agg(F.min("value").alias("value")), "texts", "zstd")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b"))


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs whose texts (node, value) are similar enough."""
    return _with_values(pairs, texts).mapInArrow(_confirming, "a long, b long")


def _crowded(members: DataFrame, values: DataFrame) -> DataFrame:
    """Links (a, b) between components, of rows (main, node, component) of buckets too large for one task.

    Buckets with the same largest component are taken together, so that no pair is compared once per band. Members
    outside that component are compared with all members, in blocks, by their texts (node, value).
    """

    def blocks(rows: DataFrame, name: str) -> DataFrame:
        counts = rows.groupBy("main").agg(F.ceil(F.count("*") / TEXT_BLOCK).alias("blocks"))
        full = rows.join(counts, "main").join(values, "node")
        number = F.pmod(F.xxhash64("node"), "blocks").alias(f"{name}_block")
        row = F.struct("node", "component", "value")
        return full.groupBy("main", number).agg(F.collect_list(row).alias(name))

    outside = blocks(members.where("component != main"), "one")
    pairs = outside.join(blocks(members, "other"), "main").select("one", "other")
    return pairs.mapInArrow(_crossing_blocks, "a long, b long")


def bucket_members(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored rows (node, bucket, n) of the buckets that several of the nodes (node, signature) have, n tells how many; and
    stored (node, value) of the nodes in them, with their signatures shortened to what tells whether they agree."""
    members = signed.select("node", "signature").mapInArrow(_banding, "node long, bucket long")
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(members.join(shared, "bucket"), "members")
    near = few(stored(members.select("node").distinct(), "near"))
    values = signed.select("node", "signature").join(near, "node", "left_semi")
    return members, stored(values.mapInArrow(_shortening, "node long, value binary"), "values")


def links(members: DataFrame, values: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) of distinct texts that connect all that are similar, without making all pairs of a bucket.

    First each member of a bucket is compared with the bucket's centre, the text that shares most buckets with others:
    of copies with small changes, that is the one they were made from. The confirmed links make components. Then, in
    buckets with more than one component, pairs of different components are compared: by their signatures, and those
    that agree by their texts; in large buckets by their texts at once, in blocks, and only the members outside the largest
    component with all members. So every two texts that share a band are compared, or already connected. Only texts of
    such pairs are read.
    """
    # A node has at most one row for each band.
    scored = members.withColumn("score", F.sum("n").over(W.Window.partitionBy("node")))
    centres = (
        scored.groupBy("bucket")
        .agg(F.max(F.struct("score", F.negative("node").alias("last"))).alias("best"))
        .select("bucket", (-F.col("best.last")).alias("centre"))
    )
    star = members.join(centres, "bucket").where("node != centre")
    star = star.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    likely = stored(_with_values(star, values).mapInArrow(_agreeing, "a long, b long"), "pairs")
    found = stored(_confirmed(likely, _texts(_ends(likely), nodes, docs)), "links")

    names = components(found)
    named = members.join(names, "node", "left").withColumn("component", F.coalesce("component", "node"))
    parts = named.groupBy("bucket", "component").agg(F.count("*").alias("size"))
    mixed = parts.groupBy("bucket").agg(
        F.max(F.struct("size", "component")).alias("main"), F.sum("size").alias("n"), F.count("*").alias("parts")
    )
    mixed = mixed.where("parts > 1").select("bucket", F.col("main.component").alias("main"), "n")
    seen = stored(named.drop("n").join(mixed, "bucket"), "mixed")
    row = F.struct("node", "component", "value")
    small = seen.where(F.col("n") <= BLOCK).join(values, "node")
    small = small.groupBy("bucket").agg(F.collect_list(row).alias("members")).select("members")
    # A pair may share several buckets.
    crossing = stored(small.mapInArrow(_crossing, "a long, b long").distinct(), "pairs")
    crowded = stored(seen.where(F.col("n") > BLOCK).select("main", "node", "component").distinct(), "crowded")
    texts = _texts(_ends(crossing).union(crowded.select("node")), nodes, docs)
    further = _confirmed(crossing, texts)
    if not crowded.isEmpty():
        further = further.union(_crowded(crowded, texts))
    return found.union(stored(further, "links"))


def text_classes(members: DataFrame, values: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows (text_key, class) of distinct texts: nodes (node, text_key), and what ``bucket_members`` made of them."""
    names = components(links(members, values, nodes, docs))
    return nodes.join(names, "node", "left").select("text_key", F.coalesce("component", "node").alias("class"))


def classes(docs: DataFrame) -> DataFrame:
    """One row per document (doc_id, text): doc_id, class_id, class_size and kept, and text_key and row beside them.

    Documents are of one class if a chain of links connects them: equal texts, or texts whose word shingles are similar.
    ``class_id`` is the least doc_id of the class; ``kept`` marks one document of it, which has that doc_id. Texts
    without a word, and missing ones, are in no class but their own. Repeated rows are copies of each other; missing
    doc_ids come last.
    """
    ship(docs.sparkSession)
    keyed = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", text_key().alias("text_key"), text_of().alias("_text")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, text_key binary, signature binary"
    rows = stored(keyed.mapInArrow(_signing, schema), "signatures")
    worded = rows.where("signature is not null")
    nodes = stored(worded.groupBy("text_key").agg(F.min("row").alias("node")), "nodes")
    signed = rows.join(nodes.select(F.col("node").alias("row")), "row", "left_semi").withColumnRenamed("row", "node")
    classed = text_classes(*bucket_members(signed), nodes, docs)
    placed = rows.select("row", "doc_id", "text_key").join(classed, "text_key", "left")
    placed = placed.withColumn("class", F.coalesce("class", "row"))
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row")
    heads = placed.groupBy("class").agg(F.min(order).alias("head"), F.count("*").alias("class_size"))
    return placed.join(heads, "class").select(
        "doc_id",
        F.col("head.doc_id").alias("class_id"),
        "class_size",
        (F.col("row") == F.col("head.row")).alias("kept"),
        "text_key",
        "row",
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class, with all its columns, whatever their names; of equal rows one.

    Documents without a word, and with a missing text, all stay. An empty table stays empty.
    """
    worded = F.coalesce(F.regexp_like("text", F.lit(WORD)), F.lit(False))
    # Keys that are never NULL: copies of a text are dealt by their doc_id too, and the join's partitions serve the last step.
    keys = {"_id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "_none": F.col("doc_id").isNull()}
    kept = classes(docs).where("kept").select(*[c.alias(n) for n, c in keys.items()], F.col("text_key").alias("_key"))
    packed = F.struct("*").alias("_doc")
    keyed = docs.where(worded).select(*[c.alias(n) for n, c in keys.items()], text_key().alias("_key"), packed)
    names = ["_id", "_none", "_key"]
    single = keyed.join(kept.distinct(), names, "left_semi").dropDuplicates(names).select("_doc.*")
    return single.union(docs.where(~worded))
