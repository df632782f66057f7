"""Alignment of two tokenizers over the same bytes: common cuts, groups between them, and counts of linked identifiers."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from numprep.llm import textvec
from numprep.llm.common import ship, stored
from numprep.llm.units import Memory

SLICE_BYTES = 4 << 20
#: Words that are encoded as one text.
JOINED = 256
#: Results of words that a worker remembers, in each of two generations.
REMEMBERED = 100_000
BLANK = "▁"
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
#: Texts with blanks that are not between two words, and with what the second tokenizer writes for a blank.
_ODD = rf"(^|{_SPACE}) | ({_SPACE}|\z)|{BLANK}"
#: Identifiers of the second tokenizer are below this, so that a pair is one number.
_RADIX = 1 << 32


def byte_characters() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: itself if it can be seen, else one from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


#: One text: tokens of either side, groups as text, and the linked pairs as numbers (bytes of int64). Workers remember
#: many of these, and plain tuples of plain values cost the garbage collector nothing.
Aligned = tuple[int, int, str, bytes]


class Aligner:
    """Aligns a byte-level model (A, over a blank and the text) with a piece model (B, which adds the blank).

    Spans of the libraries give coarse cuts: places where a token of either side ends and the next one begins. Spans know
    whole characters only; where a character of several bytes lies between two coarse cuts, the bytes of the identifiers
    themselves tell whether tokens of both sides end inside it.
    """

    def __init__(self, byte_model: bytes, piece_model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer, processors

        self.a = Tokenizer.from_str(byte_model.decode())
        self.a.encode_special_tokens = True
        self.a.post_processor = processors.ByteLevel(trim_offsets=False)
        self.a.no_truncation()
        self.a.no_padding()
        self.b = b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        characters = byte_characters()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            known = all(c in characters for c in token)
            self.bytes_a[number] = bytes(characters[c] for c in token) if known else token.encode()
        pieces = [b.id_to_piece(i) for i in range(b.vocab_size())]
        self.bytes_b = [
            bytes([int(p[1:-1], 16)]) if b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)
        ]
        self.sizes_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.sizes_b = np.array([len(t) for t in self.bytes_b], np.int64)
        #: Each identifier as it stands inside a group, and as the last of its side.
        self.written_a = np.array([f"{i}{mark}" for i in range(len(self.bytes_a)) for mark in ",|"], object)
        self.written_b = np.array([f"{i}{mark}" for i in range(len(self.bytes_b)) for mark in ",;"], object)
        #: No piece has a blank behind another character: what lies between two blanks is merged by itself.
        self.divisible = not any(
            BLANK in p.lstrip(BLANK) for i, p in enumerate(pieces) if not (b.is_control(i) or b.is_unknown(i))
        )
        self.memory = Memory(self._words, REMEMBERED)

    def _encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray] | None]:
        """For each text the identifiers of A and of B and the bytes after which tokens of both end; None if bytes differ."""
        coded_a = self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)
        coded_b = self.b.encode(texts, return_type="proto", num_threads=1)
        return [self._cuts(*x) for x in zip(texts, coded_a, coded_b, strict=True)]

    def _cuts(self, text: str, coded_a, proto) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        whole = b" " + text.encode()
        ids_a = np.array(coded_a.ids, np.int64)
        pieces = list(proto.pieces)
        ids_b = np.array([p.id for p in pieces], np.int64)
        if b"".join([self.bytes_a[i] for i in ids_a.tolist()]) != whole:
            return None
        if b"".join([self.bytes_b[i] for i in ids_b.tolist()]) != whole:
            return None
        # Coarse cuts. A counts characters with the blank in front, B counts bytes without it.
        spans_a = np.fromiter(chain.from_iterable(coded_a.offsets), np.int64, 2 * len(ids_a)).reshape(-1, 2)
        ascii_only = len(whole) == len(text) + 1
        if not ascii_only:
            points = np.frombuffer((" " + text).encode("utf-32-le"), np.uint32)
            width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
            spans_a = np.concatenate([[0], np.cumsum(width)])[spans_a]
        spans_b = np.array([[p.begin for p in pieces], [p.end for p in pieces]], np.int64).T + 1
        spans_b[0, 0] = 0
        cuts = _common(_ends(spans_a), _ends(spans_b), len(whole))
        if ascii_only:
            return ids_a, ids_b, cuts
        # Refined cuts, between coarse ones that have a character of several bytes between them.
        ends = _common(np.cumsum(self.sizes_a[ids_a]), np.cumsum(self.sizes_b[ids_b]), len(whole))
        wide = np.concatenate([[0], np.cumsum(np.frombuffer(whole, np.uint8) > 0x7F)])
        bounds = np.concatenate([[0], cuts])
        segment = np.searchsorted(cuts, ends, "left")
        inside = segment < len(cuts)
        ends, segment = ends[inside], segment[inside]
        return ids_a, ids_b, np.union1d(cuts, ends[wide[bounds[segment + 1]] > wide[bounds[segment]]])

    def _groups(self, ids_a: np.ndarray, ids_b: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[str], bytes]:
        """For each cut the tokens of either side before it; the written tokens, group by group; the pairs that are linked.

        A written token has behind it what separates it from the next: of A a comma or, last in its group, a bar, of B a
        comma or a semicolon.
        """
        to_a = np.searchsorted(np.cumsum(self.sizes_a[ids_a]), cuts, "right")
        to_b = np.searchsorted(np.cumsum(self.sizes_b[ids_b]), cuts, "right")
        pairs = (ids_a[to_a - 1] * _RADIX + ids_b[to_b - 1]).tobytes()
        code_a, code_b = 2 * ids_a[: to_a[-1]], 2 * ids_b[: to_b[-1]]
        code_a[to_a - 1] += 1
        code_b[to_b - 1] += 1
        # Before a token of A stand those of B of the groups before, before one of B also those of A of its own group.
        written = np.empty(len(code_a) + len(code_b), object)
        before = np.concatenate([[0], to_b[:-1]])
        written[np.arange(len(code_a)) + np.repeat(before, np.diff(to_a, prepend=0))] = self.written_a[code_a]
        written[np.arange(len(code_b)) + np.repeat(to_a, np.diff(to_b, prepend=0))] = self.written_b[code_b]
        return to_a, to_b, written.tolist(), pairs

    def text(self, text: str) -> Aligned | None:
        """A whole text; None if the bytes of its tokens are not those of a blank and the text."""
        found = self._encode([text])[0]
        if found is None or not len(found[2]):
            return None
        _, _, written, pairs = self._groups(*found)
        return len(found[0]), len(found[1]), "".join(written)[:-1], pairs

    def _words(self, words: list[str]) -> list[Aligned | bool]:
        """Words, as if each stood behind a blank: many are encoded as one text and told apart by their bytes.

        False stands for a word whose tokens have other bytes.
        """
        groups = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        out: list[Aligned | bool] = []
        for group, found in zip(groups, self._encode([" ".join(g) for g in groups]), strict=True):
            made = None if found is None else self._parted(group, *found)
            out += made if made is not None else [self.text(word) or False for word in group]
        return out

    def _parted(self, words: list[str], ids_a: np.ndarray, ids_b: np.ndarray, cuts: np.ndarray) -> list[Aligned] | None:
        stops = np.cumsum([len(w.encode()) + 1 for w in words])
        at = np.searchsorted(cuts, stops)
        if at[-1] >= len(cuts) or (cuts[at] != stops).any():
            return None
        to_a, to_b, written, pairs = self._groups(ids_a, ids_b, cuts)
        ends = (to_a[at], to_b[at], to_a[at] + to_b[at], 8 * (at + 1))
        out, a, b, first, start = [], 0, 0, 0, 0
        for x, y, last, stop in zip(*(e.tolist() for e in ends), strict=True):
            out.append((x - a, y - b, "".join(written[first:last])[:-1], pairs[start:stop]))
            a, b, first, start = x, y, last, stop
        return out

    def batch(self, texts: pa.Array) -> list[tuple[list[Aligned | bool | None], np.ndarray, np.ndarray]]:
        """Different parts, the part at each place, and where each text's parts start (one more at the end)."""
        texts = texts.fill_null("")
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        if not self.divisible:
            odd = np.ones(len(texts), bool)
        odd &= np.asarray(pc.binary_length(texts)) > 0
        parts = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " ")
        coded = pc.dictionary_encode(parts.flatten())
        found: list = self.memory.results(coded.dictionary.to_pylist())
        found += [self.text(texts[int(i)].as_py()) or False for i in np.flatnonzero(odd)]
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = np.asarray(parts.offsets).astype(np.int64)
        offsets -= offsets[0]
        which[offsets[:-1][odd]] = len(found) - odd.sum() + np.arange(odd.sum())
        return found, which, offsets


def _ends(spans: np.ndarray) -> np.ndarray:
    """Ends of spans behind which the next span begins."""
    keep = np.ones(len(spans), bool)
    keep[:-1] = spans[1:, 0] >= spans[:-1, 1]
    return spans[keep, 1]


def _common(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    """The places, of 0 to ``size``, that are in both lists, ascending."""
    either = np.zeros((2, size + 1), bool)
    either[0, left] = True
    either[1, right] = True
    return np.flatnonzero(either[0] & either[1])


_aligners: dict[int, Aligner] = {}
_DIGESTS = ("n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "_row long, _pairs array<long>, _times array<int>")


def _aligning(byte_model: bytes, piece_model: bytes):
    """(key, _text) to the key, the counts, the digest and the different pairs with how often the text links them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = hash((byte_model, piece_model))
        if name not in _aligners:
            _aligners.clear()
            _aligners[name] = Aligner(byte_model, piece_model)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column(1)
            _, bounds = textvec.utf8(texts)
            for a, b in textvec.slices(bounds, SLICE_BYTES):
                yield _digests(_aligners[name], batch.column(0).slice(a, b - a), texts.slice(a, b - a), row)
                row += b - a

    return run


def _digests(aligner: Aligner, keys: pa.Array, texts: pa.Array, row: int) -> pa.RecordBatch:
    found, which, offsets = aligner.batch(texts)
    n = len(texts)
    # A text without tokens has no groups, and neither has one with a part whose bytes differ.
    bad = np.array([not f for f in found], bool)
    has = np.asarray(pc.fill_null(pc.binary_length(texts), 0)) > 0
    has &= np.add.reduceat(bad[which], offsets[:-1]) == 0 if n else has
    keep = np.repeat(has, np.diff(offsets))
    text_of = np.repeat(np.arange(n), np.diff(offsets))[keep]
    which = which[keep]
    nothing = (0, 0, "", b"")
    found = [f or nothing for f in found]
    sizes = np.array([[f[0] for f in found], [f[1] for f in found], [len(f[3]) // 8 for f in found]], np.int64).T
    n_a, n_b, links = (np.bincount(text_of, sizes[which, i], n).astype(np.int64) for i in range(3))
    flat = np.frombuffer(b"".join([f[3] for f in found]), np.int64)
    counts = sizes[which, 2]
    first = np.cumsum(sizes[:, 2]) - sizes[:, 2]
    pairs = flat[textvec.ranges(first[which], counts)]
    # Different pairs of a text: sorted by text and pair.
    named, kinds = pd.factorize(pairs)
    both, times = np.unique(np.repeat(text_of, counts) * max(len(kinds), 1) + named, return_counts=True)
    starts = np.searchsorted(both, np.arange(n + 1) * max(len(kinds), 1)).astype(np.int32)
    groups = np.array([f[2] for f in found] + [""], object)[which].tolist()
    bounds = np.concatenate([[0], np.cumsum(np.where(has, np.diff(offsets), 0))]).tolist()
    digests = [
        hashlib.sha256(";".join(groups[a:b]).encode()).hexdigest() if b > a else "" for a, b in zip(bounds[:-1], bounds[1:])
    ]
    lists = [
        pa.ListArray.from_arrays(pa.array(starts), pa.array(values))
        for values in (kinds[both % max(len(kinds), 1)] if len(both) else np.zeros(0, np.int64), times.astype(np.int32))
    ]
    columns = [keys, *(pa.array(x) for x in (n_a, n_b, links, links)), pa.array(digests, pa.string())]
    columns += [pa.array(np.arange(n, dtype=np.int64) + row), *lists]
    return pa.RecordBatch.from_arrays(columns, names=["key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256",
        "_row", "_pairs", "_times"])


def align_tokens(docs: DataFrame, byte_model: str, piece_model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: how the tokens of a byte-level model (A) and of a piece model (B) lie over the same bytes.

    A encodes a blank and the text, B the text, to which it adds the blank; nothing in a text is a special token. Where
    tokens of both end, the text is cut into groups, and the two tokens that end there are linked. Columns: the key, n_a
    and n_b (tokens), n_groups, n_links, n_best (links whose pair of identifiers is linked as often in all documents as
    any pair of its B identifier), count_sum (over links, how often all documents link their pair), groups_sha256 (of
    ``a1,a2|b1;a3|b2,b3``).

    A document is read once: texts are cut at single blanks, which no token of either model reaches over, and each
    different word is aligned once per worker, as far as it remembers. Texts with other blanks are aligned whole. The
    different pairs of each document are written to the shared folder and counted by Spark. Of two linked identifiers the
    bytes of one end with those of the other, so there are at most as many pairs as 2 x the bytes of both vocabularies
    together: that table, and it alone, is broadcast, and it does not grow with the documents.

    A missing or empty text, and one whose token bytes are not a blank and the text (U+2581 in it), has no tokens: zeros
    and an empty digest. Repeated rows, also of one key, each have a row and count each; keys may be NULL and of any type;
    other columns, whatever their names, are not read. An empty table gives an empty one. A very long text is aligned alone,
    in memory in proportion to it. Ties are links of equal count, all of which are best.
    """
    ship(docs.sparkSession)
    models = Path(byte_model).read_bytes(), Path(piece_model).read_bytes()
    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    read = stored(narrow.mapInArrow(_aligning(*models), f"key {kind}, {_DIGESTS}"), "alignment")
    linked = read.select(F.inline(F.arrays_zip("_pairs", "_times")))
    counts = linked.groupBy("_pairs").agg(F.sum("_times").alias("_count"))
    b_id = (F.col("_pairs") % F.lit(_RADIX)).alias("_b")
    best = counts.groupBy(b_id).agg(F.max("_count").alias("_best"))
    known = counts.join(F.broadcast(best), b_id == F.col("_b")).select(
        F.col("_pairs").alias("_pair"), "_count", (F.col("_count") == F.col("_best")).alias("_is_best")
    )
    each = read.select("_row", F.inline(F.arrays_zip("_pairs", "_times"))).join(
        F.broadcast(known), F.col("_pairs") == F.col("_pair")
    )
    sums = each.groupBy("_row").agg(
        F.sum(F.when(F.col("_is_best"), F.col("_times"))).alias("_n_best"),
        F.sum(F.col("_times") * F.col("_count")).alias("_count_sum"),
    )
    return read.join(sums, "_row", "left").select(
        F.col("key").alias(key),
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("_n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("_count_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups_sha256",
    )
