"""WARC archives with a two-level capture index.

Writing: tasks append one gzip member per record to archive files in the shared folder, rolled
by size, and return a capture (key, file, offset, length) for each. Spark commits the table of
captures, so a file of a lost or repeated attempt is in no capture and is never read. Equal
payloads of at least ``least_bytes`` are stored once: the rest are revisit records.

Index: captures are range-partitioned and sorted by key, the reversed host and the path of the
URL with the page id behind it. Every ``block_rows`` lines become a compressed block in an
index file; the sparse directory holds the first key of each block, cut to ``KEY_BYTES``, and
where the block lies. Blocks grow with the table beyond ``MAX_BLOCKS`` of them, so that the
directory, the only part sent to all executors, has a fixed bound.

Reading: keys are range-partitioned too, looked up by binary search in the directory and inside
the block, read by its byte range; captures are then grouped by file and region, sorted by
offset, and neighbouring records are read in one range.

Files are opened by ``pyarrow.fs`` from the URI of the folder that ``spark.checkpoint.dir``
names (local and shared folders, HDFS and object stores).

Defined results: null html is an empty payload, a null or relative URL keeps its text as key
(null: empty). Rows that repeat a page id are captures of their own; all rows with the smallest
id of a group of equal payloads are responses. A null id sorts after all others. An empty table
gives no files and no rows. Other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import struct
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.common import Scratch

LEAST_BYTES = 100
FILE_BYTES, REGION_BYTES, GAP_BYTES = 64 << 20, 8 << 20, 64 << 10
BLOCK_ROWS, MAX_BLOCKS, KEY_BYTES = 3000, 50_000, 200
DATE = "1970-01-01T00:00:00Z"


def surt(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then port, path and query (lower-case host, no scheme)."""
    url = url or ""
    m = re.match(r"(?is)[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(:\d*)?(.*)", url)
    if not m:
        return url
    host, port, rest = m.groups()
    port = "" if port in (None, ":", ":80", ":443") else port
    return ",".join(reversed(host.lower().split("."))) + port + ")" + (rest.split("#")[0] or "/")


def capture_key(url: str | None, page_id: int | None) -> bytes:
    """The URL's sort key, then the page id in an order that bytes keep (null last)."""
    tail = b"\xff" * 9 if page_id is None else struct.pack(">BQ", 0, page_id + (1 << 63))
    return surt(url).encode("utf-8", "surrogatepass") + b"\x00" + tail


def _header(value: str) -> str:
    return quote(value, safe="!#$%&'()*+,/:;=?@[]~-._")


def _urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id, url, payload: bytes | None, digest: str, size: int, refers_to=None) -> bytes:
    """A WARC/1.1 response record, or a revisit without its payload when ``payload`` is None."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {_header(url or '')}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response",
            f"Content-Length: {len(block)}"]
    if payload is None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of one record; raises where lengths or the digest of a payload disagree."""
    head, rest = raw.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC/1.1 record")
    f = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    n = int(f["Content-Length"])
    block, end = rest[:n], rest[n:]
    if len(block) != n or end != b"\r\n\r\n":
        raise ValueError("record length differs from its header")
    http, payload = block.split(b"\r\n\r\n", 1)
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest, kind = f["WARC-Payload-Digest"].removeprefix("sha256:"), f["WARC-Type"]
    if kind == "response":
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("payload differs from its digest")
    ident = lambda k: None if f[k] == "<urn:page:>" else int(f[k][10:-1])
    return {"page_id": ident("WARC-Record-ID"), "uri": f["WARC-Target-URI"], "payload_bytes": size, "payload_digest": digest, "record_type": kind,
            "refers_to": ident("WARC-Refers-To") if kind == "revisit" else None, "payload": payload if kind == "response" else None}


def _open(uri: str):
    """File system and path of a URI (an absolute path counts as file:)."""
    return pafs.FileSystem.from_uri(uri if ":" in uri.split("/")[0] else f"file://{uri}")


class _Appender:
    """Appends byte strings to files of one folder, rolled by size; names are never reused."""

    def __init__(self, folder: str, suffix: str, limit: int):
        self.fs, self.root = _open(folder)
        self.suffix, self.limit, self.out, self.at = suffix, limit, None, 0

    def append(self, data: bytes) -> tuple[str, int, int]:
        if self.out is not None and self.at + len(data) > self.limit:
            self.close()
        if self.out is None:
            self.name, self.at = uuid.uuid4().hex + self.suffix, 0
            self.fs.create_dir(self.root, recursive=True)
            self.out = self.fs.open_output_stream(f"{self.root}/{self.name}", compression=None)
        self.out.write(data)
        self.at += len(data)
        return self.name, self.at - len(data), len(data)

    def close(self):
        if self.out is not None:
            self.out.close()
            self.out = None


def _table(rows, schema: pa.Schema, size: int = 8192):
    out = []
    for r in rows:
        out.append(r)
        if len(out) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)


_CAPTURE = pa.schema([("key", pa.binary()), ("file", pa.string()), ("at", pa.int64()), ("size", pa.int64())])
_CAPTURE_DDL = "key binary, file string, at long, size long"


def _writer(folder: str, file_bytes: int):
    def rows(batches):
        out = _Appender(folder, ".warc.gz", file_bytes)
        for b in batches:
            for i in range(0, b.num_rows, 64):
                for page_id, url, body, digest, revisit, refers in zip(*(b.slice(i, 64).column(c).to_pylist() for c in range(6))):
                    raw = record(page_id, url, None if revisit else body, digest, len(body), refers)
                    z = zlib.compressobj(6, zlib.DEFLATED, 31)
                    yield (capture_key(url, page_id), *out.append(z.compress(raw) + z.flush()))
        out.close()                     # before the last captures leave: a capture always names a closed file
    return lambda batches: _table(_held(rows(batches)), _CAPTURE)


def _held(rows):
    """All rows of a task, passed on once its files are closed (four short fields a record)."""
    yield from list(rows)


def write_archives(pages: DataFrame, scratch: Scratch, folder: str, least_bytes: int = LEAST_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of (page_id, url, html); the captures (key, file, at, size)."""
    body = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b""))
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("body"))
    src = src.withColumn("digest", F.sha2("body", 256))
    # groups of equal payloads, from narrow rows; only those with more than one id are looked up
    narrow = src.select("page_id", "digest").where(F.length("body") >= least_bytes)
    group = narrow.groupBy(F.col("digest").alias("_d")).agg(F.min("page_id").alias("_first"), F.max("page_id").alias("_last"), F.count_if(F.col("page_id").isNull()).alias("_nulls"))
    many = scratch.write(group.where("_first < _last or (_first is not null and _nulls > 0)").select("_d", "_first"), "groups")
    typed = src.join(many, (F.col("digest") == F.col("_d")) & (F.length("body") >= least_bytes), "left")
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    typed = typed.select("page_id", "url", "body", "digest", revisit.alias("revisit"), F.when(revisit, F.col("_first")).alias("refers"))
    return scratch.write(typed.mapInArrow(_writer(folder, file_bytes), _CAPTURE_DDL), "captures")


_LINE = struct.Struct(">IHqq")          # length of the key, of the file name, offset, size


def _pack(rows: list) -> bytes:
    return zlib.compress(b"".join(_LINE.pack(len(k), len(f), at, n) + k + f.encode() for k, f, at, n in rows), 6)


def _unpack(data: bytes) -> list:
    raw, at, out = zlib.decompress(data), 0, []
    while at < len(raw):
        k, f, pos, n = _LINE.unpack_from(raw, at)
        at += _LINE.size
        out.append((raw[at:at + k], raw[at + k:at + k + f].decode(), pos, n))
        at += k + f
    return out


class CaptureIndex:
    """The sparse directory of an index: first keys in order, and where each block lies."""

    def __init__(self, folder: str, entries: list):
        self.folder = folder
        entries = sorted(entries)
        self.first = [e[0] for e in entries]
        self.where = [e[1:] for e in entries]

    def blocks_of(self, key: bytes) -> range:
        """Blocks that can hold a key: more than one only where cut first keys are equal."""
        last = bisect.bisect_right(self.first, key)
        return range(max(0, bisect.bisect_left(self.first, key[:KEY_BYTES]) - 1), last)


def build_index(captures: DataFrame, scratch: Scratch, folder: str, block_rows: int = BLOCK_ROWS) -> CaptureIndex:
    """Sort the captures into compressed blocks under ``folder``; the directory of their first keys."""
    total = captures.count()
    size = max(block_rows, -(-total // MAX_BLOCKS))
    parts = max(1, -(-total // (50 * size)))
    schema = pa.schema([("first", pa.binary()), ("file", pa.string()), ("at", pa.int64()), ("size", pa.int64())])

    def run(batches):
        def rows():
            out, held = _Appender(folder, ".idx", FILE_BYTES), []
            for b in batches:
                held += zip(*(b.column(c).to_pylist() for c in range(4)))
                while len(held) >= size:
                    yield (held[0][0][:KEY_BYTES], *out.append(_pack(held[:size])))
                    held = held[size:]
            if held:
                yield (held[0][0][:KEY_BYTES], *out.append(_pack(held)))
            out.close()
        return _table(_held(rows()), schema)

    ordered = captures.repartitionByRange(parts, "key", "file", "at").sortWithinPartitions("key", "file", "at")
    directory = scratch.write(ordered.mapInArrow(run, "first binary, file string, at long, size long"), "directory")
    return CaptureIndex(folder, [tuple(r) for r in directory.collect()])


class _Files:
    """Opened files of one folder; one at a time, as reads come sorted."""

    def __init__(self, folder: str):
        self.fs, self.root = _open(folder)
        self.name, self.file = None, None

    def read(self, name: str, at: int, n: int) -> bytes:
        if name != self.name:
            self.close()
            self.name, self.file = name, self.fs.open_input_file(f"{self.root}/{name}")
        data = self.file.read_at(n, at)
        if len(data) != n:
            raise EOFError(f"{name}: {n} bytes at {at} end early")
        return data

    def close(self):
        if self.file is not None:
            self.file.close()
            self.file = None


def look_up(keys: DataFrame, index: CaptureIndex) -> DataFrame:
    """Captures (key, file, at, size) of every key of ``keys`` (one binary column) that the index holds."""
    shared = keys.sparkSession.sparkContext.broadcast(index)
    blocks = len(index.first)
    parts = max(1, min(blocks, -(-blocks // 20)))

    def run(batches):
        def rows():
            directory = shared.value
            files, held, lines, names = _Files(directory.folder), None, [], []
            for b in batches:
                for key in b.column(0).to_pylist():
                    for i in directory.blocks_of(key):
                        if i != held:
                            held, lines = i, _unpack(files.read(*directory.where[i]))
                            names = [x[0] for x in lines]
                        for j in range(bisect.bisect_left(names, key), len(lines)):
                            if names[j] != key:
                                break
                            yield lines[j]
            files.close()
        return _table(rows(), _CAPTURE)

    col = keys.columns[0]
    dealt = keys.distinct().repartitionByRange(parts, col).sortWithinPartitions(col)
    return dealt.mapInArrow(run, _CAPTURE_DDL)


_RECORD = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                     ("refers_to", pa.int64()), ("uri", pa.string()), ("payload", pa.binary())])


def read_records(captures: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records at the captures; each payload is checked against its length and digest."""
    keep = _RECORD if payloads else pa.schema([f for f in _RECORD if f.name != "payload"])

    def run(batches):
        def ranges():
            name, start, end, held = None, 0, 0, []
            for b in batches:
                for f, at, n in zip(*(b.column(c).to_pylist() for c in range(3))):
                    if held and f == name and at <= end + GAP_BYTES and at + n - start <= REGION_BYTES:
                        held.append((at, n))
                        end = max(end, at + n)
                        continue
                    if held:
                        yield name, start, end, held
                    name, start, end, held = f, at, at + n, [(at, n)]
            if held:
                yield name, start, end, held

        def rows():
            files = _Files(folder)
            for name, start, end, held in ranges():
                data = files.read(name, start, end - start)
                for at, n in held:
                    r = parse(zlib.decompress(data[at - start:at - start + n], 31))
                    yield tuple(r[f] for f in keep.names)
            files.close()
        return _table(rows(), keep, 256 if payloads else 8192)

    dealt = captures.select("file", "at", "size").repartition("file", F.floor(F.col("at") / REGION_BYTES)).sortWithinPartitions("file", "at")
    ddl = ", ".join(f"{f.name} {'long' if pa.types.is_integer(f.type) else 'binary' if pa.types.is_binary(f.type) else 'string'}" for f in keep)
    return dealt.mapInArrow(run, ddl)


def _keys(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(map(capture_key, b.column(0).to_pylist(), b.column(1).to_pylist()), pa.binary())], names=["key"])


def archive_round_trip(pages: DataFrame, least_bytes: int = LEAST_BYTES, block_rows: int = BLOCK_ROWS, payloads: bool = False) -> DataFrame:
    """Write all pages, index them, look every page up and read its record back."""
    scratch = Scratch(pages.sparkSession, "warc")
    captures = write_archives(pages, scratch, f"{scratch.root}/archives", least_bytes)
    index = build_index(captures, scratch, f"{scratch.root}/index", block_rows)
    asked = pages.select(F.col("url").cast("string"), F.col("page_id").cast("long").alias("page_id")).mapInArrow(_keys, "key binary")
    return read_records(look_up(asked, index), f"{scratch.root}/archives", payloads)
