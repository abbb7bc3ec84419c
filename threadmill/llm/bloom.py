"""Split-block Bloom filters of bounded size, built by Spark and probed with numpy.

A filter is an array of blocks of eight 32-bit lanes; a 64-bit hash picks a block by its high
half and sets one bit in each lane by its low half. A missing bit proves that a key was never
added; a false positive only costs the work of the exact step that follows. The size is a
number of bits per key up to ``MAX_BITS``: beyond it the filter stays as large and passes more.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Upper bound of a filter that is sent to every executor: 16 MB.
MAX_BITS = 1 << 27
BITS_PER_KEY = 16
# One odd multiplier per lane: the fixed salts of the Parquet split-block filter format.
_SALTS = np.array([0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31], np.uint32)
_LOW = np.uint64(0xFFFFFFFF)


def blocks_for(keys: int, bits_per_key: int = BITS_PER_KEY, max_bits: int = MAX_BITS) -> int:
    return max(1, min(keys * bits_per_key, max_bits) // 256)


def place(h: np.ndarray, blocks, first=0) -> np.ndarray:
    """Block of each hash: ``first`` plus its high half scaled to ``blocks`` (both may be arrays)."""
    return ((h >> np.uint64(32)) * np.asarray(blocks, np.uint64) >> np.uint64(32)).astype(np.int64) + first


def _bit(h: np.ndarray, lane: int) -> np.ndarray:
    return np.uint32(1) << (((h & _LOW).astype(np.uint32) * _SALTS[lane]) >> np.uint32(27))


def contains(words: np.ndarray, h: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Indices of the hashes whose eight bits are all set; most others leave at the first lanes."""
    at = np.arange(len(h))
    for lane in range(8):
        hit = (words[block[at] * 8 + lane] & _bit(h[at], lane)) != 0
        at = at[hit]
        if not len(at):
            break
    return at


#: Blocks of the filter that one task builds and that travel to the driver as one row: 64 KB.
SEGMENT = 2048


def build(keys: DataFrame, placed, blocks: int) -> np.ndarray:
    """The filter of ``keys``; ``placed`` turns a batch of them into (hashes, blocks).

    Keys are routed by the part of the filter they fall into, so each part is built once and
    the driver receives the filter itself, one row a part.
    """
    schema = pa.schema([("segment", pa.int64()), ("block", pa.int64()), ("h", pa.int64())])

    def route(batches):
        for b in batches:
            h, block = placed(b)
            yield pa.RecordBatch.from_arrays([pa.array(block // SEGMENT), pa.array(block), pa.array(h.view(np.int64))], schema=schema)

    def unite(key, keys):
        bits = np.zeros(SEGMENT * 8, np.uint32)
        h, at = keys["h"].to_numpy().view(np.uint64), (keys["block"].to_numpy() % SEGMENT) * 8
        for lane in range(8):
            np.bitwise_or.at(bits, at + lane, _bit(h, lane))
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([bits.tobytes()], pa.binary())})

    parts = keys.mapInArrow(route, "segment long, block long, h long").groupBy("segment").applyInArrow(unite, "segment long, bits binary")
    words = np.zeros(-(-blocks // SEGMENT) * SEGMENT * 8, np.uint32)
    for segment, bits in parts.collect():
        words[segment * SEGMENT * 8:(segment + 1) * SEGMENT * 8] = np.frombuffer(bits, np.uint32)
    return words
