"""Substring dedup by Relative Lempel-Ziv parsing against an index of reference blocks.

A window is ``window`` consecutive words. Every document is cut into blocks by its anchors: the
anchor of a window is the smallest hash of ``seed`` words in it (the last of equals), so equal
windows have equal anchors at equal places, and the consecutive windows of one anchor form a
block of at most ``2 * window`` words. The distinct blocks are the reference; an index holds,
for every anchor that several documents share, the first document of each block.

Parsing a document against this index takes whole blocks greedily: a block that an earlier
document holds is one factor, as long as the block. Where the block itself is new, but its
anchor is not, the factor ends inside it; there - at the boundaries of factors - each window
is looked up in the index of the windows of such blocks. Only the first document of a block
has to look; its copies take the whole block. Factors of at least ``window`` words are the
duplicate spans: exactly the windows that also start in a document with a smaller id.

Rows sent are one per anchor, a few per hundred words, and windows only where a shared
passage ends. An anchor in a third of all documents is pre-aggregated before each shuffle, and
lookups join written tables, whose skewed partitions AQE splits. Hashes of words are 64-bit, of
blocks and windows 128-bit together with their anchor.

Defined results: null text has no words. A null id takes no part in comparisons and keeps all
its words; rows that repeat an id are one document in comparisons, with a result each; places in
a text go by the id and the text's hash, as such rows may have different texts. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import Scratch, WordIds, mix64, rolling, signed, text_bytes

WINDOW = 50
SEED_WORDS = 8
_B1, _B2 = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1


def anchors(ids: np.ndarray, window: int, seed: int):
    """Per block: anchor hash, anchor's place, first window, number of windows."""
    n = len(ids) - window + 1
    if n <= 0:
        return (np.empty(0, np.uint64),) + (np.empty(0, np.int64),) * 3
    h = rolling(ids, seed, _B1)
    span = window - seed + 1                      # seeds in a window
    # last place of the smallest hash in every span, by doubling
    best, step = np.arange(len(h)), 1
    done, at = None, 0
    while True:
        if span & step:
            if done is None:
                done, at = best, step
            else:
                m = len(best) - at
                a, b = done[:m], best[at:]
                done, at = np.where(h[b] <= h[a], b, a), at + step
        if step * 2 > span:
            break
        a, b = best[:-step], best[step:]
        best = np.where(h[b] <= h[a], b, a)
        step *= 2
    done = done[:n]
    first = np.flatnonzero(np.r_[True, done[1:] != done[:-1]])
    return h[done[first]], done[first], first, np.diff(np.r_[first, n])


def block_codes(ids: np.ndarray, place, first, count, window: int) -> np.ndarray:
    """A hash of each block's words, length and anchor place."""
    ids = mix64(ids ^ np.uint64(_B2))
    powers = np.ones(len(ids) + 1, np.uint64)
    powers[1:] = np.uint64(_B2)
    powers = np.multiply.accumulate(powers)
    inverse = np.ones(len(ids) + 1, np.uint64)
    inverse[1:] = np.uint64(pow(_B2, -1, 1 << 64))
    inverse = np.multiply.accumulate(inverse)
    sums = np.r_[np.uint64(0), np.add.accumulate(ids * powers[:-1])]
    end = first + count + window - 1
    code = (sums[end] - sums[first]) * inverse[first]
    return mix64(code ^ mix64((count * 4096 + place - first).astype(np.uint64)))


def window_codes(ids: np.ndarray, window: int):
    return rolling(ids, window, _B1), rolling(mix64(ids ^ np.uint64(_B2)), window, _B2)


_BLOCK = pa.schema([("doc_id", pa.int64()), ("version", pa.int64()), ("anchor", pa.int64()), ("block", pa.int64()), ("first", pa.int32()), ("count", pa.int32())])
_BLOCKS = "doc_id long, version long, anchor long, block long, first int, count int"


def _blocks(window: int, seed: int):
    def run(batches):
        words = WordIds()
        for b in batches:
            doc_ids, versions, bodies = (b.column(i).to_pylist() for i in range(3))
            for a in range(0, len(bodies), 256):
                cols = []
                for doc_id, version, body in zip(doc_ids[a:a + 256], versions[a:a + 256], bodies[a:a + 256]):
                    ids = words.of(body.split())
                    anchor, place, first, count = anchors(ids, window, seed)
                    if len(anchor):
                        cols.append((np.full(len(anchor), doc_id), np.full(len(anchor), version), signed(anchor),
                                     signed(block_codes(ids, place, first, count, window)), first.astype(np.int32), count.astype(np.int32)))
                if cols:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), t) for c, t in zip(zip(*cols), _BLOCK.types)], schema=_BLOCK)
    return run


def _windows(window: int):
    """Windows of the listed blocks: (w1, w2, doc_id, version, at)."""
    schema = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("doc_id", pa.int64()), ("version", pa.int64()), ("at", pa.int32())])

    def run(batches):
        words = WordIds()
        for b in batches:
            cols = []
            for doc_id, version, body, spans in zip(*(b.column(i).to_pylist() for i in range(4))):
                w1, w2 = window_codes(words.of(body.split()), window)
                at = np.concatenate([np.arange(s["first"], s["first"] + s["count"]) for s in spans])
                cols.append((signed(w1[at]), signed(w2[at]), np.full(len(at), doc_id), np.full(len(at), version), at.astype(np.int32)))
            if cols:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), t) for c, t in zip(zip(*cols), schema.types)], schema=schema)
    return run


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])


def _remove(window: int, texts: bool):
    """Cut the words that the found factors cover."""
    def run(batches):
        for b in batches:
            rows = []
            for doc_id, body, spans in zip(*(b.column(i).to_pylist() for i in range(3))):
                words = body.split()
                kept = words
                if spans:
                    edge = np.zeros(len(words) + 1, np.int64)
                    first = np.array([s["first"] for s in spans])
                    np.add.at(edge, first, 1)
                    np.add.at(edge, first + np.array([s["count"] for s in spans]) + window - 1, -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()]
                joined = b" ".join(kept)
                rows.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode() if texts else None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _RESULT.types)], schema=_RESULT)
    return run


def _source(docs: DataFrame) -> DataFrame:
    """doc_id, version (the hash that tells texts of one id apart), body."""
    body = text_bytes()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(body).alias("version"), body.alias("body"))


def duplicate_factors(docs: DataFrame, scratch: Scratch, window: int = WINDOW, seed: int = SEED_WORDS) -> DataFrame:
    """doc_id, version, first, count: runs of windows that an earlier document holds."""
    src = _source(docs).where("doc_id is not null")
    blocks = src.mapInArrow(_blocks(window, seed), _BLOCKS)
    # anchors in more than one document; "mixed" ones stand in several different blocks
    shared = blocks.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.min("block").alias("x"), F.max("block").alias("y"))
    shared = scratch.write(shared.where("a < b").select("anchor", (F.col("x") < F.col("y")).alias("mixed")), "anchors")
    found = scratch.write(blocks.join(shared, "anchor"), "blocks")
    index = scratch.write(found.groupBy("anchor", "block").agg(F.min("doc_id").alias("holder")), "index")
    parsed = scratch.write(found.join(index, ["anchor", "block"]), "parsed")
    copied = parsed.where("holder < doc_id").select("doc_id", "version", "first", "count")
    # boundaries: windows of the first holders of blocks that differ around a shared anchor
    span = F.struct("first", "count")
    lists = parsed.where("holder = doc_id and mixed").groupBy("doc_id", "version").agg(F.collect_list(span).alias("spans"))
    lists = scratch.write(lists, "boundaries")
    first_rows = src.join(lists, ["doc_id", "version"]).select("doc_id", "version", "body", "spans")
    windows = scratch.write(first_rows.mapInArrow(_windows(window), "w1 long, w2 long, doc_id long, version long, at int"), "windows")
    held = scratch.write(windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("w1", "w2", "a"), "held")
    edges = windows.join(held, ["w1", "w2"]).where("a < doc_id").select("doc_id", "version", F.col("at").alias("first"), F.lit(1).alias("count"))
    return copied.unionByName(edges)


def substring_dedup(docs: DataFrame, window: int = WINDOW, seed: int = SEED_WORDS, texts: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 and, with ``texts``, the kept text."""
    scratch = Scratch(docs.sparkSession, "substring_dedup")
    factors = duplicate_factors(docs, scratch, window, seed)
    spans = scratch.write(factors.groupBy("doc_id", "version").agg(F.collect_list(F.struct("first", "count")).alias("spans")), "factors")
    j = _source(docs).join(spans, ["doc_id", "version"], "left").select("doc_id", "body", "spans")
    return j.mapInArrow(_remove(window, texts), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
