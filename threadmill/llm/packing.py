"""Packing by first-fit decreasing with a tournament tree, in randomised groups.

A document is its token ids and one end id. It is cut at every ``seq_len`` ids; the pieces
(narrow rows: position, length, checksum) are dealt at random, by a hash of document and
position, into groups of bounded size. Inside a group the pieces are placed longest first,
each into the first open sequence with room: a tournament tree over the free space of the
sequences finds it in O(log n). Texts and ids never leave the task that tokenises them.

Tokenising remembers the ids of each run between single spaces or line feeds; new runs go
through ``tiktoken`` with the ranks of the ``tokenizers`` file, which gives the same ids. Cutting there
is exact for this byte-level vocabulary, whose pre-tokens take a leading space and never
reach over it; texts with other white space beside a separator, or with a special token's
string, go to the tokenizer whole.

Defined results: null text is empty (one end id). Rows that repeat an id are separate
documents whose pieces may share sequences. An empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import Scratch, releasing

SEQ_LEN = 2048
END_ID = 1
GROUP_PIECES = 8192


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class _Runs(dict):
    """Run of text -> its ids as little-endian uint32 bytes."""

    LIMIT = 150_000

    def __init__(self, encode, lead: str):
        super().__init__()
        self.encode, self.lead = encode, lead

    def __missing__(self, run: str) -> bytes:
        ids = self.encode(self.lead + run)
        out = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) >= self.LIMIT:
            self.clear()
        self[run] = out
        return out


def _ranks(tok) -> dict[bytes, int]:
    """The vocabulary as byte strings. Byte-level files spell a byte as itself where it prints, else as one of the characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
    special = {t.content for t in tok.get_added_tokens_decoder().values()}
    return {bytes(byte[c] for c in t): i for t, i in tok.get_vocab().items() if t not in special}


_ODD = re.compile(r"\s[ \n]|[ \n]\s|^\s|\s$")
_LOADED: dict = {}


class Encoder:
    """Ids of whole texts by a byte-level tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        # the same vocabulary and merges by rank, three times as fast on single runs
        import public_tokenizers
        import tiktoken
        runs = tiktoken.Encoding("runs", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(self.tok), special_tokens={})
        probe = "".join(t for t in list(self.tok.get_vocab())[::97] if t.isalpha() and t.isascii())
        if runs.encode_ordinary(probe) != self.tok.encode(probe, add_special_tokens=False).ids:
            raise ValueError(f"{path}: its ids don't follow the order of its merges")
        self.first, self.rest = _Runs(runs.encode_ordinary, ""), _Runs(runs.encode_ordinary, " ")
        self.feed = np.array(self.tok.encode("\n", add_special_tokens=False).ids, "<u4").tobytes()

    @classmethod
    def at(cls, path: str) -> "Encoder":
        if path not in _LOADED:               # one per Python worker
            _LOADED[path] = cls(path)
        return _LOADED[path]

    def plain(self, text: str) -> bool:
        return not _ODD.search(text) and not any(s in text for s in self.special)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        first, rest, out = self.first, self.rest, []
        for t in texts:
            if not self.plain(t):
                out.append(np.array(self.tok.encode(t, add_special_tokens=False).ids, "<u4"))
                continue
            lines = (x.split(" ") for x in t.split("\n"))
            parts = (b"".join((first[w[0]] if w[0] else b"", *map(rest.__getitem__, w[1:]))) for w in lines)
            out.append(np.frombuffer(self.feed.join(parts), "<u4"))
        return out


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_FIELDS = ("row", "doc_id", "start", "length", "ids_crc32", "doc_tokens")


def _pieces(path: str, seq_len: int, end_id: int):
    schema = pa.schema([(n, pa.int64()) for n in _FIELDS])

    def cuts(rows, doc_ids, texts):
        for row, doc_id, ids in zip(rows, doc_ids, Encoder.at(path).encode(texts)):
            ids = np.append(ids, np.array([end_id], "<u4"))
            for a in range(0, len(ids), seq_len):
                cut = ids[a:a + seq_len]
                yield row, doc_id, a, len(cut), zlib.crc32(cut.tobytes()), len(ids)

    def run(batches):
        for b in batches:
            held, at = 0, 0
            rows, ids, texts = (b.column(i).to_pylist() for i in range(3))
            for i, t in enumerate(texts):
                held += len(t)
                if held > 1 << 21 or i + 1 == len(texts):
                    cols = list(zip(*cuts(rows[at:i + 1], ids[at:i + 1], texts[at:i + 1])))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=schema)
                    held, at = 0, i + 1

    return run


class TournamentTree:
    """Free space of bins in order of opening; finds the first with room for a piece."""

    def __init__(self, n: int, capacity: int):
        self.size = 1 << max(0, (n - 1).bit_length())
        self.capacity, self.most = capacity, [capacity] * (2 * self.size)

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset in it) of the first bin with ``length`` free; takes that space."""
        most, i = self.most, 1
        while i < self.size:
            i *= 2
            if most[i] < length:              # the winner of the left half has too little room
                i += 1
        at = self.capacity - most[i]
        most[i] -= length
        slot = i - self.size
        while i > 1:
            i //= 2
            best = max(most[2 * i], most[2 * i + 1])
            if most[i] == best:
                break
            most[i] = best
        return slot, at


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; pieces go longest first, ties in the given order."""
    tree = TournamentTree(len(lengths), capacity)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        bins[i], offsets[i] = tree.place(int(lengths[i]))
    return bins, offsets


def pack(docs: DataFrame, seq_len: int = SEQ_LEN, end_id: int = END_ID, path: str | None = None,
         group_pieces: int = GROUP_PIECES, seed: int = 17) -> DataFrame:
    """One row per piece: where it lies in its document, and in which sequence and where there.

    Pieces are dealt to groups by the number of their row, so that rows equal in everything spread too.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    pieces = scratch.write(src.mapInArrow(releasing(_pieces(path or vocabulary(), seq_len, end_id)), "row long, " + _PIECES), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("_g", F.pmod(F.xxhash64(F.lit(seed), "row", "doc_id", "start"), F.lit(groups)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "start", "row"], kind="stable")
        bins, offsets = first_fit_decreasing(pdf["length"].to_numpy(), seq_len)
        return pdf.assign(sequence_id=pdf["_g"] * (1 << 32) + bins, offset=offsets).drop(columns=["_g", "row"])

    return dealt.groupBy("_g").applyInPandas(run, _PIECES + ", sequence_id long, offset long")
