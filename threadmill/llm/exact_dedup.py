"""Exact dedup with Patricia-trie owners.

Every map task first inserts its normalised texts into a compressed radix trie, so that the
copies of one text inside a task become one row. These rows are partitioned by length and
content hash; each partition inserts the full byte strings into tries again, whose terminal
nodes hold the owner (most code points, then smallest id). A trie that outgrows its budget
spills its largest subtree: the terminals leave as partial owners, and the last aggregation,
by length and SHA-256, unites the partial owners of one text. Documents then look up the
owners of texts that occur at least twice. No task holds a group of copies, whatever its size.

Defined results: null text is empty; all empty texts are equal. A null id sorts after every
other id. Rows that repeat an id count in ``group_size``; ``kept`` tells whether the row's id
is the owner's. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import SPACE, Scratch, byte_slices, releasing, text_bytes, text_length, text_version

#: Bytes of edges that one trie holds before it spills a subtree.
TRIE_BYTES = 48 << 20


class _Node:
    __slots__ = ("edge", "kids", "owner", "count")

    def __init__(self, edge: bytes, owner=None, count: int = 0):
        self.edge, self.kids, self.owner, self.count = edge, {}, owner, count


def _shared(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of ``a`` and ``b[at:]``, by halving."""
    lo, hi = 0, min(len(a), len(b) - at)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[at + lo:at + mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class PatriciaOwners:
    """Radix trie over byte strings; a terminal keeps its smallest owner key and a count."""

    NODE_BYTES = 400

    def __init__(self, budget: int = TRIE_BYTES):
        self.root, self.budget, self.held = _Node(b""), budget, 0

    def insert(self, key: bytes, owner: tuple, count: int = 1) -> None:
        node, at = self.root, 0
        while at < len(key):
            kid = node.kids.get(key[at])
            if kid is None:
                kid = node.kids[key[at]] = _Node(key[at:])
                self.held += len(kid.edge) + self.NODE_BYTES
                node = kid
                break
            if key.startswith(kid.edge, at):
                node, at = kid, at + len(kid.edge)
                continue
            n = _shared(kid.edge, key, at)
            upper = _Node(kid.edge[:n])
            kid.edge = kid.edge[n:]
            upper.kids[kid.edge[0]] = kid
            node.kids[key[at]] = upper
            self.held += self.NODE_BYTES
            node, at = upper, at + n
        node.owner = owner if node.owner is None else min(node.owner, owner)
        node.count += count

    @staticmethod
    def _terminals(node: _Node, prefix: bytes):
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            key = prefix + node.edge
            if node.owner is not None:
                yield key, node.owner, node.count
            stack.extend((k, key) for k in node.kids.values())

    @staticmethod
    def _bytes(node: _Node) -> int:
        total, stack = 0, [node]
        while stack:
            node = stack.pop()
            total += len(node.edge) + PatriciaOwners.NODE_BYTES
            stack.extend(node.kids.values())
        return total

    def spill(self):
        """Terminals of the largest subtrees, until half of the budget is free."""
        if self.held <= self.budget:
            return
        sizes = sorted(((self._bytes(k), b) for b, k in self.root.kids.items()))
        while sizes and self.held > self.budget // 2:
            size, b = sizes.pop()
            yield from self._terminals(self.root.kids.pop(b), b"")
            self.held -= size
        if not self.root.kids:
            self.held = 0

    def drain(self):
        yield from self._terminals(self.root, b"")
        self.root, self.held = _Node(b""), 0


def _owner(n_chars: int, doc_id):
    return (-n_chars, doc_id is None, 0 if doc_id is None else doc_id)


_PARTIAL = "body binary, n_chars long, doc_id long, copies long"
_DIGEST = "n_bytes long, text_sha256 string, n_chars long, doc_id long, copies long"


def _batches(rows, schema: pa.Schema, size: int, body: int | None):
    """Record batches of at most ``size`` rows or 8 MB of bodies."""
    out, held = [], 0
    for r in rows:
        out.append(r)
        held += len(r[body]) if body is not None else 0
        if len(out) >= size or held > 8 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)


def _combine(budget: int):
    schema = pa.schema([("body", pa.binary()), ("n_chars", pa.int64()), ("doc_id", pa.int64()), ("copies", pa.int64())])

    def rows(batches):
        trie = PatriciaOwners(budget)
        row = lambda t: (t[0], -t[1][0], None if t[1][1] else t[1][2], t[2])
        for b in batches:
            for s in byte_slices(b, [1]):
                for doc_id, raw, n in zip(*(s.column(i).to_pylist() for i in range(3))):
                    trie.insert(raw.translate(None, SPACE), _owner(n, doc_id))
                    yield from map(row, trie.spill())
        yield from map(row, trie.drain())

    return lambda batches: _batches(rows(batches), schema, 4096, 0)


def _own(budget: int):
    schema = pa.schema([("n_bytes", pa.int64()), ("text_sha256", pa.string()), ("n_chars", pa.int64()), ("doc_id", pa.int64()), ("copies", pa.int64())])

    def rows(batches):
        trie = PatriciaOwners(budget)
        row = lambda t: (len(t[0]), hashlib.sha256(t[0]).hexdigest(), -t[1][0], None if t[1][1] else t[1][2], t[2])
        for b in batches:
            for s in byte_slices(b, [0]):
                for key, n, doc_id, copies in zip(*(s.column(i).to_pylist() for i in range(4))):
                    trie.insert(key, _owner(n, doc_id), copies)
                    yield from map(row, trie.spill())
        yield from map(row, trie.drain())

    return lambda batches: _batches(rows(batches), schema, 16384, None)


def owners(docs: DataFrame, budget: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct normalised text: length, digest, owner's size and id, copies."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("body"), text_length().alias("n"))
    part = src.mapInArrow(releasing(_combine(budget)), _PARTIAL)
    dealt = part.repartition(F.length("body"), F.xxhash64("body"))
    found = dealt.mapInArrow(releasing(_own(budget)), _DIGEST)
    best = F.min(F.struct((-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("c")))
    return (found.groupBy("n_bytes", "text_sha256").agg(best.alias("o"), F.sum("copies").alias("copies"))
            .select("n_bytes", "text_sha256", (-F.col("o.a")).alias("owner_chars"), F.col("o.c").alias("owner_id"), "copies"))


def exact_dedup(docs: DataFrame, budget: int = TRIE_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, and the text's code_points and version."""
    scratch = Scratch(docs.sparkSession, "exact_dedup")
    # only texts with copies are looked up; written, so that AQE may split or broadcast either side
    many = scratch.write(owners(docs, budget).where("copies > 1").withColumnRenamed("n_bytes", "_n").withColumnRenamed("text_sha256", "_h"), "owners")
    norm = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), SPACE.decode(), "")
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(norm).cast("long").alias("n_bytes"),
                        F.sha2(norm.cast("binary"), 256).alias("text_sha256"), text_length().alias("n"), text_version().alias("version"))
    j = every.join(many, (F.col("n_bytes") == F.col("_n")) & (F.col("text_sha256") == F.col("_h")), "left")
    keep = F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("owner_id"))
    return j.select("doc_id", keep.alias("keep_id"), F.coalesce("copies", F.lit(1)).cast("long").alias("group_size"),
                    F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256", F.col("n").alias("code_points"), "version")
