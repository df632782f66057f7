"""Patched frame-of-reference blocks of token identifiers: minimum, packed differences, a list of exceptions."""

from __future__ import annotations

import struct

import numpy as np

from numprep.llm.textvec import ranges

#: Identifiers of a block.
BLOCK = 128
#: Share of a block's values that the packed width must hold; the others are exceptions.
PERCENTILE = 0.9
MAGIC = b"PFB1"
#: Magic, block length, blocks, identifiers.
HEADER = struct.Struct("<4sHxxIQ")
#: For each block: where its bytes start, its minimum, the packed width and the number of exceptions.
INDEX = np.dtype([("start", "<u4"), ("least", "<u4"), ("width", "u1"), ("exceptions", "u1")])
#: Place in the block and difference from the minimum.
EXCEPTION = np.dtype([("place", "u1"), ("value", "<u4")])


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit length of each value."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def encode(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """Pack identifiers below 2^32. Header, block index, then per block the packed bits and its exceptions."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    padded = np.empty(blocks * BLOCK, np.uint32)
    padded[:n] = ids
    if n:
        padded[n:] = padded[n - 1]
    rows = padded.reshape(blocks, BLOCK)
    least = rows.min(axis=1) if blocks else np.zeros(0, np.uint32)
    deltas = rows - least[:, None]
    bits = _bits(deltas)
    place = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    width = np.partition(bits, place, axis=1)[:, place] if blocks else np.zeros(0, np.uint8)
    odd = bits > width[:, None]
    exceptions = odd.sum(axis=1)
    sizes = width.astype(np.int64) * (BLOCK // 8) + exceptions * EXCEPTION.itemsize
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(starts[-1]), np.uint8)
    low = np.where(odd, np.uint32(0), deltas)
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            spread = ((low[own][:, :, None] >> np.arange(w, dtype=np.uint32)) & np.uint32(1)).astype(np.uint8)
            packed = np.packbits(spread.reshape(len(own), -1), axis=1, bitorder="little")
            out[starts[own][:, None] + np.arange(packed.shape[1])] = packed
    block, at = np.nonzero(odd)
    if len(block):
        listed = np.empty(len(block), EXCEPTION)
        listed["place"], listed["value"] = at, deltas[block, at]
        target = (starts[:-1] + width.astype(np.int64) * (BLOCK // 8))[exceptions > 0]
        spots = ranges(target, exceptions[exceptions > 0] * EXCEPTION.itemsize)
        out[spots] = listed.view(np.uint8)
    index = np.empty(blocks, INDEX)
    index["start"], index["least"], index["width"], index["exceptions"] = starts[:-1], least, width, exceptions
    return HEADER.pack(MAGIC, BLOCK, blocks, n) + index.tobytes() + out.tobytes()


def decode(payload: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Identifiers ``first`` to ``last`` (not included; by default all). Only the blocks that hold them are unpacked."""
    magic, block, blocks, n = HEADER.unpack_from(payload)
    if magic != MAGIC or block != BLOCK:
        raise ValueError("not a block file")
    last = n if last is None else min(last, n)
    if first >= last:
        return np.zeros(0, np.uint32)
    low, high = first // BLOCK, -(-last // BLOCK)
    index = np.frombuffer(payload, INDEX, blocks, HEADER.size)[low:high]
    data = np.frombuffer(payload, np.uint8, offset=HEADER.size + blocks * INDEX.itemsize)
    starts, width = index["start"].astype(np.int64), index["width"]
    rows = np.zeros((len(index), BLOCK), np.uint32)
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            packed = data[starts[own][:, None] + np.arange(int(w) * (BLOCK // 8))]
            spread = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(own), BLOCK, w)
            values = np.zeros((len(own), BLOCK), np.uint32)
            for bit in range(w):
                values |= spread[:, :, bit].astype(np.uint32) << np.uint32(bit)
            rows[own] = values
    odd = np.flatnonzero(index["exceptions"])
    if len(odd):
        counts = index["exceptions"][odd].astype(np.int64)
        spots = ranges(starts[odd] + width[odd].astype(np.int64) * (BLOCK // 8), counts * EXCEPTION.itemsize)
        listed = np.ascontiguousarray(data[spots]).view(EXCEPTION)
        rows[np.repeat(odd, counts), listed["place"]] = listed["value"]
    return (rows + index["least"][:, None]).reshape(-1)[first - low * BLOCK : last - low * BLOCK]
