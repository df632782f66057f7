"""Token counts by byte-pair merging with a heap and a linked list, without making identifiers."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from numprep.llm import textvec
from numprep.llm.common import ship
from numprep.llm.units import Memory, cut

BLANK = "▁"
SLICE_BYTES = 8 << 20


class PairMerger:
    """Counts the pieces a byte-pair model cuts a text into; ``ranks`` orders the pieces, the lowest merges first."""

    def __init__(self, ranks: dict[str, float]):
        self.ranks = ranks

    def count(self, text: str) -> int:
        """Initial symbols minus merges; a symbol the model lacks counts as its UTF-8 bytes."""
        ranks = self.ranks
        n = len(text)
        symbols = list(text)
        heap = []
        for i in range(n - 1):
            rank = ranks.get(text[i : i + 2])
            if rank is not None:
                heap.append((rank, i, i + 1, 2))
        lacking = sum(len(c.encode()) - 1 for c in symbols if c not in ranks)
        if not heap:
            return n + lacking
        heapq.heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        merges = 0
        while heap:
            _, left, right, size = heapq.heappop(heap)
            # Outdated if a symbol of the pair has since grown or gone.
            if not symbols[left] or after[left] != right or len(symbols[left]) + len(symbols[right]) != size:
                continue
            if lacking:
                for symbol in (symbols[left], symbols[right]):
                    if symbol not in ranks:
                        lacking -= len(symbol.encode()) - 1
            symbols[left] += symbols[right]
            symbols[right] = ""
            merges += 1
            follower = after[left] = after[right]
            if follower < n:
                before[follower] = left
                rank = ranks.get(symbols[left] + symbols[follower])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, follower, len(symbols[left]) + len(symbols[follower])))
            leader = before[left]
            if leader >= 0:
                rank = ranks.get(symbols[leader] + symbols[left])
                if rank is not None:
                    heapq.heappush(heap, (rank, leader, left, len(symbols[leader]) + len(symbols[left])))
        return n - merges + lacking


class PieceCounter:
    """Counts as a sentencepiece byte-pair model: normalised text, a blank in front, unknown characters as bytes."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.processor = processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        ranks = {
            processor.id_to_piece(i): -processor.get_score(i)
            for i in range(processor.vocab_size())
            if not (processor.is_byte(i) or processor.is_control(i) or processor.is_unknown(i))
        }
        self.merger = PairMerger(ranks)
        #: No piece has a blank behind another character, so no merge reaches over the start of a run of blanks.
        self.divisible = not any(BLANK in piece.lstrip(BLANK) for piece in ranks)
        self.memory = Memory(lambda kinds: [self.merger.count(k) for k in kinds])

    def split(self, text: str) -> list[str]:
        return re.findall(f"{BLANK}*[^{BLANK}]+|{BLANK}+", text) if self.divisible else [text]

    def whole(self, texts: pa.Array) -> pa.Array:
        if not self.divisible:
            return pa.array(np.ones(len(texts), bool))
        return pc.or_(pc.match_substring(texts, BLANK * 2), pc.ends_with(texts, BLANK))

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        normal = pa.array(self.processor.normalize(texts.fill_null("").to_pylist()), pa.string())
        units = cut(normal, BLANK, self.whole, self.split)
        counts = self.memory.results(units.kinds)
        total = np.concatenate([[0], np.cumsum(np.array(counts, np.int64)[units.which])])
        return total[units.offsets[1:]] - total[units.offsets[:-1]]


_counters: dict[int, PieceCounter] = {}


def _counting(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = hash(model)
        if name not in _counters:
            _counters.clear()
            _counters[name] = PieceCounter(model)
        for batch in batches:
            texts = batch.column("_text")
            _, offsets = textvec.utf8(texts)
            counts = [
                _counters[name].count(texts.slice(a, b - a)) for a, b in textvec.slices(offsets, SLICE_BYTES)
            ]
            counts = np.concatenate([np.zeros(0, np.int64), *counts])
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts)], names=[*batch.schema.names[:-1], "n_tokens"])

    return run


def count_tokens(docs: DataFrame, model_path: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_bytes, n_tokens and over_limit (more than ``limit`` tokens).

    A missing text is empty and has no bytes and no tokens. Whole texts are counted, without begin or end tokens; what
    looks like a special token in a text is text. The model file is read once and sent along with the tasks. A text is
    cut where no merge can reach across, and each different unit is merged once per worker as far as it remembers it.
    Nothing is shuffled; repeated rows are counted each.
    """
    ship(docs.sparkSession)
    model = Path(model_path).read_bytes()
    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(
        key, F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.coalesce(text, F.lit("")).alias("_text")
    )
    counted = narrow.mapInArrow(_counting(model), f"`{key}` {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
