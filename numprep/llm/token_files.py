"""Token files: identifiers of all documents in key order, in block-packed segments, and their reader."""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from numprep.llm import pfor, textvec
from numprep.llm.common import give_back, ship, text_of
from numprep.llm.units import FlatMemory, cut_flat

#: Identifier behind the last one of each document.
END = 0
#: A segment closes with the first document that takes it to so many identifiers.
SEGMENT = 1 << 18
SLICE_BYTES = 2 << 20
#: Units that are encoded as one text: those that the library takes apart, and those whose pieces are told to it.
JOINED, PARTED = 512, 32
#: A row is a segment: which it is, where it starts in its part, its documents and where each ends, and the blocks.
FILE_SCHEMA = "part int, segment int, start long, doc_id array<{kind}>, stop array<long>, ids binary"
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
#: Units of words or numbers, each with ASCII marks behind it, that single line feeds part. Their pieces are plain to see: the
#: byte-level pattern cuts before and after the marks and the line feeds, and there only.
_LETTERS, _MARKS = r"A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}", r"!-/:-@\[-`{-~"
_PLAIN_WORD = rf"(?:[{_LETTERS}]+|[0-9]+)[{_MARKS}]*"
_PLAIN = rf"\A ?{_PLAIN_WORD}(?:\n{_PLAIN_WORD})*\z"
_CUTS = rf"([{_MARKS}]+|\n)"


def _byte_characters() -> np.ndarray:
    """The character that a byte-level model writes for each byte, and for the byte 0 a blank, which it has for none."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = np.zeros(256, np.uint32)
    out[own] = own
    rest = np.setdiff1d(np.arange(256), own)
    out[rest] = 256 + np.arange(len(rest))
    out[0] = 32
    return out


_CHARACTERS = _byte_characters()


class ByteLevelEncoder:
    """Identifiers as the tokenizers library gives them, from a byte-level model without a normaliser.

    Its pre-tokenizer cuts before every blank that does not stand between two white spaces, so what lies between two
    such blanks can be encoded by itself, and each different piece only once. Texts with such a blank, or with the text
    of an added token, are encoded as a whole.
    """

    def __init__(self, model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_str(model.decode())
        cutter = self.tokenizer.pre_tokenizer and json.loads(self.tokenizer.pre_tokenizer.__getstate__())
        self.divisible = (
            self.tokenizer.normalizer is None
            and (cutter or {}).get("type") == "ByteLevel"
            and cutter.get("use_regex", True)
            and not cutter.get("add_prefix_space")
        )
        #: The same model, which takes pieces that blanks part as they are.
        self.merger = Tokenizer(self.tokenizer.model)
        self.merger.pre_tokenizer = CharDelimiterSplit(" ")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        #: Bytes of each identifier: a byte-level token has a character for each, an added one its own text.
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.sizes[number] = len(token.encode()) if token in self.special else len(token)
        self.memory = FlatMemory(self._encode)

    def whole(self, texts: pa.Array) -> pa.Array:
        if not self.divisible:
            return pa.array(np.ones(len(texts), bool))
        found = pc.match_substring_regex(texts, rf"{_SPACE} ({_SPACE}|\z)")
        for content in self.special:
            found = pc.or_(found, pc.match_substring(texts, content))
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of all texts, each followed by ``END``, and where each text starts (one more at the end)."""
        units = cut_flat(texts, " ", self.whole, lambda text: [text])
        flat, first, counts = self.memory.results(units.kinds)
        which = np.insert(units.which, units.offsets[1:], len(first))
        first, counts = np.append(first, len(flat)), np.append(counts, 1)
        counts = counts[which]
        total = np.concatenate([[0], np.cumsum(counts)])
        ids = np.append(flat, np.uint32(END))[textvec.ranges(first[which], counts)]
        return ids, total[units.offsets + np.arange(len(units.offsets))]

    def _encode(self, kinds: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of all kinds, and how many each has."""
        plain = np.zeros(len(kinds), bool)
        if self.divisible:
            plain = pc.match_substring_regex(kinds, _PLAIN).to_numpy(zero_copy_only=False)
        parted = self._parted(kinds.filter(pa.array(plain)))
        if parted is None:
            plain[:], parted = False, (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        rest = self._taken_apart(kinds.filter(pa.array(~plain)).to_pylist())
        counts = np.zeros(len(kinds), np.int64)
        counts[plain] = parted[1]
        counts[~plain] = [len(ids) for ids in rest]
        starts = np.cumsum(counts) - counts
        flat = np.empty(int(counts.sum()), np.uint32)
        flat[textvec.ranges(starts[plain], counts[plain])] = parted[0]
        flat[textvec.ranges(starts[~plain], counts[~plain])] = np.concatenate([np.zeros(0, np.uint32), *rest])
        return flat, counts

    def _parted(self, kinds: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """Identifiers of plain units, and how many each has: the library gets their pieces, and only merges.

        Units are told apart by the bytes of each identifier; nothing if that is not possible.
        """
        _, offsets = textvec.utf8(kinds)
        parts = pc.binary_join_element_wise(pc.replace_substring_regex(kinds, _CUTS, "\0\\1\0"), "", "\0")
        data, at = textvec.utf8(parts)
        text = _CHARACTERS[data].tobytes().decode("utf-32-le")
        bounds = [*at[:-1:PARTED].tolist(), len(text)]
        texts = [text[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        found = self.merger.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, np.uint32), *[np.array(e.ids, np.uint32) for e in found]])
        reached = np.concatenate([[0], np.cumsum(self.sizes[ids])])
        cuts = np.searchsorted(reached, offsets)
        if reached[-1] != offsets[-1] or (reached[cuts] != offsets).any():
            return None
        return ids, np.diff(cuts)

    def _taken_apart(self, kinds: list[str]) -> list[np.ndarray]:
        """Units that start with one blank are encoded many at a time, and told apart by the bytes of each identifier."""
        out: list[np.ndarray | None] = [None] * len(kinds)
        joined = [i for i, k in enumerate(kinds) if len(k) > 1 and k[0] == " " and not k[1].isspace()]
        groups = [joined[i : i + JOINED] for i in range(0, len(joined), JOINED)]
        texts = [[kinds[i] for i in group] for group in groups]
        found = self.tokenizer.encode_batch_fast(["".join(t) for t in texts], add_special_tokens=False)
        for group, text, encoding in zip(groups, texts, found, strict=True):
            ids = np.array(encoding.ids, np.uint32)
            reached = np.concatenate([[0], np.cumsum(self.sizes[ids])])
            wanted = np.concatenate([[0], np.cumsum([len(k.encode()) for k in text])])
            cuts = np.searchsorted(reached, wanted)
            if reached[-1] == wanted[-1] and (reached[cuts] == wanted).all():
                for i, a, b in zip(group, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    out[i] = ids[a:b]
        rest = [i for i, done in enumerate(out) if done is None]
        found = self.tokenizer.encode_batch_fast([kinds[i] for i in rest], add_special_tokens=False)
        for i, encoding in zip(rest, found, strict=True):
            out[i] = np.array(encoding.ids, np.uint32)
        return out


_encoders: dict[int, ByteLevelEncoder] = {}


def _segments(model: bytes):
    """Sorted (doc_id, _text) of one part to segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = hash(model)
        give_back()
        if name not in _encoders:
            _encoders.clear()
            _encoders[name] = ByteLevelEncoder(model)
        part, segment, start = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        keys: list = []
        stops: list[int] = []
        held = 0
        kind = pa.int64()

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([segment], pa.int32()),
                    pa.array([start], pa.int64()),
                    pa.array([keys], pa.list_(kind)),
                    pa.array([stops], pa.list_(pa.int64())),
                    pa.array([pfor.encode(np.concatenate(ids))], pa.binary()),
                ],
                names=["part", "segment", "start", "doc_id", "stop", "ids"],
            )

        for batch in batches:
            texts, named, kind = batch.column("_text"), batch.column("doc_id").to_pylist(), batch.column("doc_id").type
            sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            for a, b in textvec.slices(offsets, SLICE_BYTES):
                flat, bounds = _encoders[name].encode(texts.slice(a, b - a))
                done = 0  # documents of the slice that are in closed segments
                while done < b - a:
                    full = int(np.searchsorted(bounds, bounds[done] + SEGMENT - held, "left"))
                    upto = max(done + 1, min(full, b - a))
                    ids.append(flat[bounds[done] : bounds[upto]])
                    keys += named[a + done : a + upto]
                    stops += (bounds[done + 1 : upto + 1] - bounds[done] + held).tolist()
                    held += int(bounds[upto] - bounds[done])
                    done = upto
                    if held >= SEGMENT:
                        yield close()
                        segment, start, held, ids, keys, stops = segment + 1, start + held, 0, [], [], []
        if keys:
            yield close()

    return run


def write_tokens(docs: DataFrame, model_path: str, path: str) -> None:
    """Write the identifiers of all documents (doc_id, text), each with ``END`` behind it, to a folder of files.

    Parts ascend by doc_id, missing ones first, and documents of the same doc_id by a hash of their text. Only texts are
    shuffled, once, into ranges; each task encodes its range and writes segments of about ``SEGMENT`` identifiers as
    rows of Parquet, so lost tasks are written again and half-written files never count. A missing text is empty. A
    doc_id may be of any type that has an order; a whole number is kept as a long. Repeated rows are written repeated,
    other columns are not written, and an empty table gives files without a row.
    """
    ship(docs.sparkSession)
    model = Path(model_path).read_bytes()
    kind = docs.schema["doc_id"].dataType
    doc_id = F.col("doc_id").cast("long") if isinstance(kind, T.IntegralType) else F.col("doc_id")
    keyed = docs.select(doc_id.alias("doc_id"), F.xxhash64(text_of()).alias("_text_key"), text_of().alias("_text"))
    ranged = keyed.repartitionByRange("doc_id", "_text_key").sortWithinPartitions("doc_id", "_text_key")
    schema = FILE_SCHEMA.format(kind=keyed.schema["doc_id"].dataType.simpleString())
    ranged.select("doc_id", "_text").mapInArrow(_segments(model), schema).write.parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments to rows (part, doc_id, at, n_tokens, ids_crc32)."""
    for batch in batches:
        for row in range(batch.num_rows):
            part, start, stops, payload = (batch.column(n)[row].as_py() for n in ("part", "start", "stop", "ids"))
            keys = batch.column("doc_id")[row].values
            ids = pfor.decode(payload).astype("<u4")
            bounds = np.concatenate([[0], np.array(stops, np.int64)])
            view = memoryview(ids).cast("B")
            sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(keys), part, np.int32)),
                    keys,
                    pa.array(bounds[:-1] + start),
                    pa.array(np.diff(bounds)),
                    pa.array(sums, pa.int64()),
                ],
                names=["part", "doc_id", "at", "n_tokens", "ids_crc32"],
            )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens and the CRC of its identifiers, all unpacked.

    ``start`` is the identifiers of all documents before it: those of the parts before, one number per part, and those
    of its part, which the file has.
    """
    ship(spark)
    files = spark.read.parquet(path)
    kind = files.schema["doc_id"].dataType.elementType.simpleString()
    sizes = files.groupBy("part").agg(F.sum(F.element_at("stop", -1)).alias("n"))
    before = F.sum("n").over(W.Window.orderBy("part").rowsBetween(W.Window.unboundedPreceding, -1))
    parts = sizes.select(F.col("part").alias("_part"), F.coalesce(before, F.lit(0)).alias("_before"))
    documents = files.mapInArrow(_documents, f"part int, doc_id {kind}, at long, n_tokens long, ids_crc32 long")
    joined = documents.join(parts, F.col("part") == F.col("_part"))
    return joined.select("doc_id", (F.col("at") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32")
