"""MinHash near-dedup with fast similarity sketching, banding and exact verification.

Sketch: every distinct shingle is thrown into one of ``bands * rows`` bins by a fresh hash,
round after round, and a bin keeps the smallest hash of the first round that reaches it. After
as many rounds as bins, each further round fills one bin with the smallest hash of all
shingles, so that no bin stays empty; the share of equal bins is concentrated around the
Jaccard similarity. Bands of ``rows`` bins are bucket codes: a pair at similarity 0.75 misses
all 24 bands of 3 with probability 2e-6.

Texts with equal shingle sets are one class, represented by the text of its smallest id. Buckets are
verified in two steps, with full shingle sets, and without listing the pairs of a bucket:

1. Each member is compared with its bucket's leader, the member whose buckets are the most
   crowded (in a group of near copies, the text they were made from). Verified links make
   components.
2. Only members of different components are left. For each, its shingles fall into those it
   shares with the leader (known from step 1), those that no other text left has, and the rest.
   Two members can only share the smaller of their first parts and the smaller of their rests;
   only pairs that could still reach the threshold by this bound are compared.

So every bucket pair is either compared, in one component already, or proven to be no link.
Components grow by propagating the smallest label with pointer jumping until nothing changes.

Defined results: null text, and text without words, has an empty set and is its own component.
Fewer than five words are one shingle. A null id takes no part: null component, kept. Rows that
repeat an id are compared each by its own text; where their components differ, so do their
rows. Shingles are 64-bit hashes. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import Scratch, WordIds, byte_slices, mix64, releasing, rolling, signed, text_bytes, text_version

SHINGLE = 5
BANDS, ROWS = 24, 3
_BASE = 0x9E3779B97F4A7C15 | 1


def shingles(body: bytes, words: WordIds, width: int = SHINGLE) -> np.ndarray:
    """The distinct hashed shingles of a text, sorted."""
    ids = words.of(body.lower().split())
    if not len(ids):
        return ids
    return np.unique(rolling(ids, min(width, len(ids)), _BASE))


#: Shingles that are hashed at once, and words that a task remembers.
STEP, WORDS = 1 << 17, 50_000


def sketch(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """One row of ``bins`` values for each non-empty set, of all sets at once."""
    n = len(sets)
    out = np.zeros((n, bins), np.uint64)
    empty = np.ones((n, bins), bool)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    high = np.uint64(0xFFFFFFFFFFFFFFFF)
    for i in range(2 * bins):
        best, salt = np.full(n * bins, high), mix64(np.array([i + 1], np.uint64))
        for a in range(0, len(flat), STEP):
            h = mix64(flat[a:a + STEP] ^ salt)
            into = ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64) if i < bins else i - bins
            # the low half orders, the high half chose the bin: put the low half first
            np.minimum.at(best, owner[a:a + STEP] * bins + into, (h << np.uint64(32)) | (h >> np.uint64(32)))
        best = best.reshape(n, bins)
        new = empty & (best != high)
        out[new] = mix64(best[new] + np.uint64(i))
        empty &= ~new
        open_rows = empty.any(1)
        if not open_rows.any():
            break
        live = open_rows[owner]
        flat, owner = flat[live], owner[live]
    return out


def band_codes(sk: np.ndarray, bands: int, rows: int) -> np.ndarray:
    code = np.zeros((len(sk), bands), np.uint64) + mix64(np.arange(1, bands + 1, dtype=np.uint64))
    for r in range(rows):
        code = mix64(code * np.uint64(_BASE) + sk[:, r::rows])
    return code


_SKETCH = "doc_id long, version long, n long, c1 long, c2 long, bands array<long>"


def _sketches(bands: int, rows: int, width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("version", pa.int64()), ("n", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches):
        words = WordIds(limit=WORDS)
        for batch in batches:
            for b in byte_slices(batch, [1]):
                sets = [shingles(x, words, width) for x in b.column(1).to_pylist()]
                full = [s for s in sets if len(s)]
                codes = iter(signed(band_codes(sketch(full, bands * rows), bands, rows)) if full else ())
                c1 = [int(signed(mix64(s).sum(keepdims=True))[0]) if len(s) else 0 for s in sets]
                c2 = [int(signed(mix64(s ^ np.uint64(_BASE)).sum(keepdims=True))[0]) if len(s) else 0 for s in sets]
                yield pa.RecordBatch.from_arrays([
                    b.column(0), b.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(c1, pa.int64()), pa.array(c2, pa.int64()),
                    pa.array([next(codes) if len(s) else [] for s in sets], pa.list_(pa.int64()))], schema=schema)
    return run


def _verify(width: int, percent: int):
    """For each pair (a, b): the size of the intersection of the full sets, and whether it reaches the threshold."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("shared", pa.int64()), ("linked", pa.bool_())])

    def run(batches):
        words, last, left = WordIds(limit=WORDS), None, None
        for batch in batches:
            for rows in byte_slices(batch, [2, 3]):
                out = []
                for a, b, x, y in zip(*(rows.column(i).to_pylist() for i in range(4))):
                    if a != last:
                        last, left = a, shingles(x, words, width)
                    right = shingles(y, words, width)
                    both = len(np.intersect1d(left, right, assume_unique=True))
                    out.append((a, b, both, bool(both) and 100 * both >= percent * (len(left) + len(right) - both)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
    return run


def compared(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) of ids with the shingles their full texts share, and whether that makes a link."""
    left = texts.select(F.col("rep").alias("a"), F.col("body").alias("x"))
    right = texts.select(F.col("rep").alias("b"), F.col("body").alias("y"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(
        releasing(_verify(width, percent)), "a long, b long, shared long, linked boolean")


#: Bits of one bitmap of Spark's, and bitmaps that are broadcast at most (4 KB each, so 16 MB).
MAP_BITS, MAPS = 32_768, 4_096


def among(src: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows of ``src`` whose version may be a ``key`` of ``wanted``, by one bit of a broadcast bitmap.

    It spares the exact join that follows from shuffling most other texts. There are 16 bits to a
    key while they fit ``MAPS``; beyond, more rows pass, which only costs work.
    """
    maps = min(MAPS, max(1, -(-16 * wanted.count() // MAP_BITS)))
    slot = lambda c: F.pmod(F.col(c), F.lit(maps * MAP_BITS))
    bits = wanted.select(F.floor(slot(key) / MAP_BITS).alias("_map"), (slot(key) % MAP_BITS).alias("_bit"))
    bits = bits.groupBy("_map").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    at = slot("version") % MAP_BITS
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = (F.floor(slot("version") / MAP_BITS) == F.col("_map")) & (F.getbit(byte, (at % 8).cast("int")) == 1)
    return src.join(F.broadcast(bits), held, "left_semi")


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, label) of every node of the edges (a, b): the smallest id it reaches."""
    both = scratch.write(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), f"{name}_edges")
    labels = scratch.write(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), f"{name}_0")
    step = 0
    while True:
        step += 1
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("m"))
        moved = scratch.write(labels.join(near, F.col("node") == F.col("a")).select("node", F.least("label", "m").alias("label"), F.col("label").alias("old")), f"{name}_{step}m")
        up = moved.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
        jumped = scratch.write(moved.join(up, F.col("label") == F.col("_n")).select("node", F.least("label", "_l").alias("label"), "old"), f"{name}_{step}")
        changed = not jumped.where("label <> old").isEmpty()
        labels = jumped.select("node", "label")
        if not changed:
            return labels


def _own_shingles(width: int):
    schema = pa.schema([("shingle", pa.int64()), ("rep", pa.int64())])

    def run(batches):
        words = WordIds(limit=WORDS)
        for b in batches:
            for s in byte_slices(b, [1]):
                ids = s.column(0).to_pylist()
                sets = [shingles(x, words, width) for x in s.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(sets)), pa.int64()),
                                                  pa.array(np.repeat(np.array(ids, np.int64), [len(x) for x in sets]), pa.int64())], schema=schema)
    return run


def minhash_dedup(docs: DataFrame, percent: int = 75, width: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept, the version (hash) of its text, and its group.

    A group is the number of the component, null for a text that is alone: components that share
    their smallest id, because it has several texts, differ in it.
    """
    scratch = Scratch(docs.sparkSession, "minhash_dedup")
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("body"), text_version().alias("version"))
    sketches = scratch.write(src.mapInArrow(releasing(_sketches(bands, rows, width)), _SKETCH), "sketches")
    # classes of equal sets, numbered; equal sets have equal bands, and one row's text stands for all
    first = F.min(F.struct("doc_id", "version", "bands"))
    classes = sketches.where("n > 0 and doc_id is not null").groupBy("c1", "c2", "n").agg(first.alias("r"), F.count("*").alias("size"))
    classes = scratch.write(classes.select("c1", "c2", "n", F.monotonically_increasing_id().alias("rep"), F.col("r.doc_id").alias("first"),
                                           F.col("r.version").alias("version"), F.col("r.bands").alias("bands"), "size"), "classes")
    dealt = classes.select("rep", "n", F.explode("bands").alias("code"))
    crowd = scratch.write(dealt.groupBy("code").agg(F.min("rep").alias("x"), F.max("rep").alias("y"), F.count("*").alias("crowd")).where("x < y").select("code", "crowd"), "crowd")
    members = scratch.write(dealt.join(crowd, "code"), "members")
    busy = scratch.write(members.groupBy("rep").agg(F.sum("crowd").alias("busy")).withColumnRenamed("rep", "_rep"), "busy")
    shown = scratch.write(classes.join(busy, F.col("rep") == F.col("_rep"), "left_semi").select(F.col("first").alias("_id"), F.col("version").alias("_v"), "rep"), "shown")
    texts = among(src, shown, "_v").join(shown, (F.col("doc_id") == F.col("_id")) & (F.col("version") == F.col("_v")))
    texts = scratch.write(texts.select("rep", "body").dropDuplicates(["rep"]), "texts")

    # step 1: everyone in a bucket against its leader
    ranked = members.join(busy, F.col("rep") == F.col("_rep")).select("code", "rep", "n", "busy")
    lead = scratch.write(ranked.groupBy("code").agg(F.max(F.struct("busy", (-F.col("rep")).alias("m"), F.col("n").alias("ln"))).alias("s"))
                         .select("code", (-F.col("s.m")).alias("leader"), F.col("s.ln").alias("leader_n")), "leaders")
    others = scratch.write(members.join(lead, "code").where("rep <> leader"), "others")
    # i shared of m + n - i reach the threshold when (100 + percent) * i >= percent * (m + n)
    need = lambda i, total: (100 + percent) * i >= percent * total
    pairs = others.where(need(F.least("n", "leader_n"), F.col("n") + F.col("leader_n"))).select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    met = scratch.write(compared(pairs, texts, width, percent), "met")
    links = met.where("linked").select("a", "b")
    labels = components(links, scratch, "labels_1")

    # step 2: members of different components, but for leaders, which have met everyone
    lab = labels.withColumnRenamed("node", "_node")
    left = scratch.write(others.join(lab, F.col("rep") == F.col("_node"), "left")
                         .select("code", "leader", "rep", "n", F.coalesce("label", "rep").alias("label")), "labelled")
    split = left.groupBy("code").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.min("n").alias("least")).where("x < y")
    left = scratch.write(left.join(scratch.write(split.select("code", "least"), "split"), "code"), "left")
    ids = scratch.write(left.select(F.explode(F.array("rep", "leader")).alias("_rep")).distinct(), "left_ids")
    some = texts.join(ids, F.col("rep") == F.col("_rep"), "left_semi")
    alone = some.mapInArrow(releasing(_own_shingles(width)), "shingle long, rep long").groupBy("shingle").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
    alone = scratch.write(alone.where("a = b").groupBy("a").agg(F.count("*").alias("alone")).withColumnRenamed("a", "_a"), "alone")
    bound = left.join(alone, F.col("rep") == F.col("_a"), "left").withColumn("most", F.col("n") - F.coalesce("alone", F.lit(0)))
    bound = bound.where(need(F.col("most"), F.col("n") + F.col("least")))
    first = met.select(F.col("a").alias("_l"), F.col("b").alias("_b"), "shared")
    bound = bound.join(first, (F.col("leader") == F.col("_l")) & (F.col("rep") == F.col("_b")), "left")
    # members too unlike their leader in size were not compared with it: no part of theirs is known
    bound = scratch.write(bound.select("code", "rep", "n", "label", "most", F.coalesce("shared", "most").alias("core"),
                                       (F.col("most") - F.coalesce("shared", F.lit(0))).alias("rest")), "bounded")
    # a pair that meets in several buckets is taken in the one with the smallest code
    codes = scratch.write(bound.groupBy(F.col("rep").alias("_c")).agg(F.collect_set("code").alias("codes")), "codes")
    bound = bound.join(codes, F.col("rep") == F.col("_c"))
    p, q = bound.alias("p"), bound.alias("q")
    total = F.col("p.n") + F.col("q.n")
    open_pairs = p.join(q, (F.col("p.code") == F.col("q.code")) & (F.col("p.rep") < F.col("q.rep")) & (F.col("p.label") != F.col("q.label"))
                        & need(F.least("p.most", "q.most"), total) & need(F.least("p.core", "q.core") + F.least("p.rest", "q.rest"), total)
                        & (F.col("p.code") == F.array_min(F.array_intersect("p.codes", "q.codes"))))
    open_pairs = open_pairs.select(F.col("p.rep").alias("a"), F.col("q.rep").alias("b"))
    more = scratch.write(compared(open_pairs, texts, width, percent).where("linked").select("a", "b"), "links_2")
    if not more.isEmpty():
        labels = components(links.union(more), scratch, "labels_2")

    # every row of a class has the component of its class, named by the smallest id in it; classes that stay alone need no lookup
    lab = scratch.write(classes.join(labels.withColumnRenamed("node", "_node"), F.col("rep") == F.col("_node"), "left")
                        .where("size > 1 or label is not null").select(F.col("c1").alias("_c1"), F.col("c2").alias("_c2"), F.col("n").alias("_n"), "first", F.coalesce("label", "rep").alias("_label")), "labelled_classes")
    name = lab.groupBy("_label").agg(F.min("first").alias("component"))
    known = scratch.write(lab.join(name, "_label").select("_c1", "_c2", "_n", "_label", "component"), "known")
    scratch.drop("texts", "members", "others", "met", "labelled", "left", "bounded", "codes", "alone")
    same = (F.col("c1") == F.col("_c1")) & (F.col("c2") == F.col("_c2")) & (F.col("n") == F.col("_n"))
    j = sketches.select("doc_id", "version", "n", "c1", "c2").join(known, same, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return j.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                    F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "version",
                    F.when(F.col("doc_id").isNotNull(), F.col("_label")).alias("group"))
