"""Phrase collocation mining by multikey quicksort of suffix pointers.

Phrases of up to four words are counted in three steps:

1. Every pair of neighbouring words is routed by the hash of its language and words, after an
   aggregation inside each chunk of text. Pairs below the minimum are abandoned here: no longer
   phrase that holds one can reach it. The other hashes fill a Bloom filter of bounded size; a
   false positive keeps a suffix too many, never one too few.
2. Every word starts a suffix, cut to four words, to its piece, and before the first pair that
   the filter does not hold. Equal suffixes of a chunk become one weighted row, and rows are
   routed by language and leading two words. A bucket of more than ``HOT_ROWS`` rows is routed
   by whole suffixes instead.
3. A partition sorts pointers to its suffixes by multikey three-way quicksort to the maximum
   depth. The weight of an equal part is the count of the phrase that leads to it; a part below
   the minimum is abandoned as a whole. Single words, and the leading parts of hot buckets, are
   spread over partitions: their counts are never abandoned before the last aggregation unites
   them.

Scores, the rule on longer phrases and the ranking are joins and aggregations on the frequent
phrases, in exact decimal arithmetic.

Defined results: null text is empty; a null language is ``und``, as a language of that name is.
A language without candidates has no rows; an empty table gives none. Repeated rows and ids
count each; ids are not read, nor are other columns. A very long text is one task's work and is
cut into chunks at the ends of pieces.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadmill.llm import bloom
from threadmill.llm.common import Scratch, mix64, signed, text_bytes

DEPTH = 4
MINIMUM = 30
TOP = 2000
#: Words of one chunk, suffix rows of one sorting partition, and of a bucket that is split.
CHUNK_WORDS, PART_ROWS, HOT_ROWS = 1 << 18, 200_000, 100_000

_CUTS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(bytes(range(65, 91)) + _CUTS + b"\t", bytes(range(97, 123)) + b"\n" * len(_CUTS) + b" ")
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xC2B2AE3D27D4EB4F)


class _Ids(dict):
    """Numbers in order of first use; 0 is the end of a piece."""

    def __missing__(self, word):
        v = self[word] = len(self)
        return v


def _hashes(words) -> np.ndarray:
    return np.fromiter((int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little") for w in words), np.uint64)


class _Chunk:
    """Words of some texts as numbers, with the language of each."""

    def __init__(self, flat: list, spans: list):
        self.vocab = _Ids({b"\n": 0})
        self.tok = np.zeros(len(flat) + DEPTH, np.int64)
        self.tok[:len(flat)] = np.fromiter(map(self.vocab.__getitem__, flat), np.int64, len(flat))
        self.langs = sorted({lang for lang, _ in spans})
        code = {lang: i for i, lang in enumerate(self.langs)}
        self.lang = np.repeat(np.array([code[lang] for lang, _ in spans], np.int64), [n for _, n in spans])
        self.at = np.flatnonzero(self.tok[:len(flat)])

    def pairs(self):
        """Positions whose word has a neighbour in its piece, and the hash of language and pair."""
        at = self.at[self.tok[self.at + 1] != 0]
        h, lh = _hashes(self.vocab), _hashes(x.encode("utf-8", "surrogatepass") for x in self.langs)
        return at, mix64(h[self.tok[at]] * _FIRST + h[self.tok[at + 1]] * _SECOND + lh[self.lang[at]])


def _chunks(batches, limit: int):
    """Chunks of about ``limit`` words from (lang, body) batches; a text is cut only between pieces."""
    flat, spans = [], []
    for b in batches:
        for a in range(0, b.num_rows, 256):
            s = b.slice(a, 256)
            for lang, body in zip(s.column(0).to_pylist(), s.column(1).to_pylist()):
                body, done = body.translate(_FOLD), 0
                while done < len(body):
                    end = len(body)
                    if end - done > 8 * limit:
                        end = body.find(b"\n", done + 8 * limit) + 1 or end
                    words = list(filter(None, body[done:end].replace(b"\n", b" \n ").split(b" ")))
                    words.append(b"\n")
                    flat += words
                    spans.append((lang, len(words)))
                    done = end
                    if len(flat) >= limit:
                        yield _Chunk(flat, spans)
                        flat, spans = [], []
    if flat:
        yield _Chunk(flat, spans)


def _pair_counts(limit: int):
    schema = pa.schema([("pair", pa.int64()), ("c", pa.int64())])

    def run(batches):
        for chunk in _chunks(batches, limit):
            _, h = chunk.pairs()
            key, c = np.unique(h, return_counts=True)
            for a in range(0, len(key), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(signed(key[a:a + (1 << 16)])), pa.array(c[a:a + (1 << 16)])], schema=schema)
    return run


_SUFFIX = "lang string, phrase binary, words int, weight long"


def _suffixes(filt, blocks: int, depth: int, limit: int):
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("words", pa.int32()), ("weight", pa.int64())])

    def rows(langs, lang, vocab, cols, weight):
        n = sum((c > 0).astype(np.int32) for c in cols)
        for a in range(0, len(lang), 1 << 15):
            z = slice(a, a + (1 << 15))
            parts = [pc.take(vocab, pa.array(c[z], mask=c[z] == 0)) for c in cols]
            phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()), null_handling="skip")
            yield pa.RecordBatch.from_arrays([pc.take(langs, pa.array(lang[z])), phrase, pa.array(n[z]), pa.array(weight[z])], schema=schema)

    def run(batches):
        table = filt.value
        for chunk in _chunks(batches, limit):
            at, h = chunk.pairs()
            live = np.zeros(len(chunk.tok) + depth, bool)
            live[at[bloom.contains(table, h, bloom.place(h, blocks))]] = True
            langs, vocab = pa.array(chunk.langs, pa.string()), pa.array(list(chunk.vocab), pa.binary())
            n = np.bincount(chunk.lang[chunk.at], minlength=len(langs))
            yield pa.RecordBatch.from_arrays([langs, pa.array([b""] * len(langs), pa.binary()), pa.array([0] * len(langs), pa.int32()), pa.array(n)], schema=schema)
            # suffixes of one word
            short = chunk.at[~live[chunk.at]]
            key, c = np.unique(chunk.lang[short] * len(vocab) + chunk.tok[short], return_counts=True)
            yield from rows(langs, key // len(vocab), vocab, [key % len(vocab)], c)
            # longer ones: equal rows of the chunk become one
            long, open_ = chunk.at[live[chunk.at]], True
            cols = [chunk.tok[long]]
            for d in range(1, depth):
                open_ = open_ & live[long + d - 1]
                cols.append(np.where(open_, chunk.tok[long + d], 0))
            lang = chunk.lang[long]
            order = np.lexsort((*cols[::-1], lang))
            cols, lang = [c[order] for c in cols], lang[order]
            first = np.ones(len(lang), bool)
            if len(lang):
                first[1:] = (lang[1:] != lang[:-1]) | np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
            start = np.flatnonzero(first)
            yield from rows(langs, lang[start], vocab, [c[start] for c in cols], np.diff(np.r_[start, len(lang)]))
    return run


def multikey_counts(tok: np.ndarray, ptr: np.ndarray, weight: np.ndarray, depth: int, minimum: int, free: int = 0):
    """Counts of all prefixes, by multikey three-way quicksort of the pointers ``ptr`` into ``tok``.

    0 ends a suffix. Yields (pointers, length, counts) of the equal parts found in a round: one
    pointer of each part and the weight of all. Parts of weight below ``minimum`` are abandoned,
    but for those that agree in fewer than ``free`` leading words, whose counts are partial.
    All parts of a round are split at once, each by its own pivot (median of three).
    """
    size = np.array([len(ptr)], np.int64)
    deep = np.zeros(1, np.int64)
    if not len(ptr):
        return
    while len(ptr):
        lo = np.cumsum(size) - size
        seg = np.repeat(np.arange(len(size)), size)
        value = tok[ptr + deep[seg]]
        a, b, c = value[lo], value[lo + size // 2], value[lo + size - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))
        side = 1 + np.sign(value - pivot[seg])
        part = seg * 3 + side
        parts = np.bincount(part, minlength=3 * len(size))
        heavy = np.bincount(part, weights=weight, minlength=3 * len(size)).astype(np.int64)
        offset = np.cumsum(parts) - parts
        to = np.empty(len(ptr), np.int64)
        for s in range(3):
            at = np.flatnonzero(side == s)
            n = parts[s::3]
            to[at] = offset[part[at]] + np.arange(len(at)) - (np.cumsum(n) - n)[seg[at]]
        moved, heft = np.empty_like(ptr), np.empty_like(weight)
        moved[to], heft[to] = ptr, weight
        equal = np.arange(3 * len(size)) % 3 == 1
        new_deep = np.repeat(deep, 3) + equal
        at_depth = np.repeat(deep, 3)
        equal, word = np.arange(3 * len(size)) % 3 == 1, np.repeat(pivot, 3) != 0
        some, heavy_enough = parts > 0, heavy >= minimum
        found = some & equal & word & (heavy_enough | (at_depth < free))
        for d in np.unique(at_depth[found]):
            z = found & (at_depth == d)
            yield moved[offset[z]], int(d) + 1, heavy[z]
        deeper = word & (at_depth + 1 < depth) & (heavy_enough | (at_depth + 1 < free))
        go = some & np.where(equal, deeper, heavy_enough | (at_depth < free))
        new_deep = at_depth + equal
        keep = np.repeat(go, parts)
        ptr, weight, size, deep = moved[keep], heft[keep], parts[go], new_deep[go]


def _sorted_counts(depth: int, minimum: int):
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("f", pa.int64())])

    def run(batches):
        langs, vocab = _Ids(), _Ids({b"": 0})
        kept = {True: ([], []), False: ([], [])}
        for b in batches:
            lang = np.fromiter(map(langs.__getitem__, b.column(0).to_pylist()), np.int64, b.num_rows) + 1
            rows = np.zeros((b.num_rows, depth + 2), np.int64)   # language, words, end
            rows[:, 0] = lang
            words = pc.split_pattern(b.column(1), b" ")
            n = pc.list_value_length(words).to_numpy()
            coded = pc.list_flatten(words).dictionary_encode()
            ids = np.fromiter(map(vocab.__getitem__, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))[coded.indices.to_numpy()]
            rows[np.repeat(np.arange(len(n)), n), np.arange(len(ids)) - np.repeat(np.cumsum(n) - n, n) + 1] = ids
            hot, weight = b.column(3).to_numpy(zero_copy_only=False), b.column(2).to_numpy()
            for h in (True, False):
                if (hot == h).any():
                    kept[h][0].append(rows[hot == h].astype(np.int32))
                    kept[h][1].append(weight[hot == h])
        names, text = pa.array(list(langs), pa.string()), pa.array(list(vocab), pa.binary())
        for hot, (rows, weight) in kept.items():
            if not rows:
                continue
            tok = np.concatenate(rows).ravel().astype(np.int64)
            ptr = np.arange(0, len(tok), depth + 2)
            # the language and the first word lead suffixes of several partitions; in hot buckets every part does
            for at, d, count in multikey_counts(tok, ptr, np.concatenate(weight), depth + 1, minimum, depth + 1 if hot else 2):
                if d < 2:
                    continue
                for a in range(0, len(at), 1 << 15):
                    z = at[a:a + (1 << 15)]
                    parts = [pc.take(text, pa.array(tok[z + i])) for i in range(1, d)]
                    phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()))
                    yield pa.RecordBatch.from_arrays([pc.take(names, pa.array(tok[z] - 1)), phrase, pa.array(count[a:a + (1 << 15)])], schema=schema)
    return run


def frequent_phrases(docs: DataFrame, scratch: Scratch, depth: int = DEPTH, minimum: int = MINIMUM, chunk_words: int = CHUNK_WORDS,
                     part_rows: int = PART_ROWS, hot_rows: int = HOT_ROWS, max_bits: int = bloom.MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of every phrase of 1 to ``depth`` words with f >= ``minimum``, and (lang, n)."""
    sc = docs.sparkSession.sparkContext
    src = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_bytes().alias("body"))
    pairs = src.mapInArrow(_pair_counts(chunk_words), "pair long, c long").groupBy("pair").agg(F.sum("c").alias("c"))
    pairs = scratch.write(pairs.where(F.col("c") >= minimum).select("pair"), "pairs")
    blocks = bloom.blocks_for(pairs.count(), max_bits=max_bits)

    def placed(b):
        h = b.column(0).to_numpy().view(np.uint64)
        return h, bloom.place(h, blocks)

    filt = sc.broadcast(bloom.build(pairs, placed, blocks))
    rows = scratch.write(src.mapInArrow(_suffixes(filt, blocks, depth, chunk_words), _SUFFIX)
                         .select("lang", F.col("phrase").cast("string").alias("phrase"), "words", "weight"), "suffixes")
    many = rows.where("words > 1")
    total = many.count()
    buckets = max(1 << 16, total // 64)
    bucket = F.pmod(F.xxhash64("lang", F.substring_index("phrase", " ", 2)), F.lit(buckets))
    many = many.select("lang", "phrase", "weight", bucket.alias("bucket"))
    load = scratch.write(many.groupBy(F.col("bucket").alias("_b")).count().where(F.col("count") > hot_rows).select("_b"), "hot")
    dealt = many.join(load, F.col("bucket") == F.col("_b"), "left").withColumn("hot", F.col("_b").isNotNull())
    route = F.when(F.col("hot"), F.xxhash64("lang", "phrase")).otherwise(F.col("bucket"))
    parts = max(1, -(-total // part_rows))
    dealt = dealt.withColumn("route", route).repartition(parts, "route").select("lang", F.col("phrase").cast("binary").alias("phrase"), "weight", "hot")
    counts = dealt.mapInArrow(_sorted_counts(depth, minimum), "lang string, phrase binary, f long").select("lang", F.col("phrase").cast("string").alias("phrase"), "f")
    single = rows.where("words = 1").select("lang", "phrase", F.col("weight").alias("f"))
    freq = counts.unionByName(single).groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= minimum)
    sizes = rows.where("words = 0").groupBy("lang").agg(F.sum("weight").alias("n"))
    return scratch.write(freq, "frequent"), scratch.write(sizes, "sizes")


def mine_collocations(docs: DataFrame, depth: int = DEPTH, minimum: int = MINIMUM, top: int = TOP, **options) -> DataFrame:
    """Per language the first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    scratch = Scratch(docs.sparkSession, "collocations")
    freq, sizes = frequent_phrases(docs, scratch, depth, minimum, **options)
    exact = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731  (products of these never leave 38 digits)
    within = lambda lo, n: F.array_join(F.slice("w", lo, n), " ")
    cand = freq.withColumn("w", F.split("phrase", " ")).where(F.size("w") > 1).select("lang", "phrase", F.col("f").alias("a"), "w")
    cuts = cand.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", within(F.lit(1), F.col("k")).alias("head"), within(F.col("k") + 1, F.size("w") - F.col("k")).alias("tail"))
    # both parts occur at least as often as the phrase, so the frequent phrases hold them
    cuts = cuts.join(freq.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(freq.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    cuts = cuts.withColumn("score", F.expr("(cast(2000000 as decimal(19,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    # the most frequent longer candidate around each run of words
    spot = F.transform(F.sequence(F.lit(2), F.size("w") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " ")))
    inner = cand.where(F.size("w") > 2).select("lang", F.explode(F.array_distinct(F.flatten(spot))).alias("phrase"), F.col("a").alias("longer"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = best.join(inner, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * exact("longer") < 80 * exact("a")))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.select("lang", "phrase", "a", "b.l", "b.r", "b.score").withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
