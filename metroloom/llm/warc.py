"""WARC archives with a two-level capture index (operator 4).

Writing: equal payloads of at least MIN_REVISIT bytes are found by SHA-256 and length; the row with the
largest identifier keeps the payload, the others become revisit records that refer to it. Every task writes
its rows, sorted by identifier, as gzip members of its own volumes, so a task that runs again writes the
same bytes; a file appears under its name only when it is whole.

Index: captures are sorted by reversed-host key over range partitions. A part holds compressed
blocks of BLOCK_LINES lines and a sparse directory with the first key of each block. The first and
last keys of the parts - a row a part - travel with the lookup; a task searches them, then the
part's directory, by bisection, reads one block's range and takes the key's lines. Captures found are
sorted by volume and offset, and neighbouring ranges are read together.

Edge cases: null html is an empty payload; a null url has an empty key; signs that would end a header
line are percent-encoded in urls and keys, so urls that differ in that alone share a key; rows that tie on the largest identifier of a payload all keep it; rows
repeated in full are records of their own; an empty table makes an empty archive.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _shared as sh

MIN_REVISIT, BLOCK_LINES, VOLUME_BYTES, READ_BYTES = 1000, 2048, 1 << 28, 1 << 22
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def surt(url: str | None) -> str:
    """Reversed-host key of a url: ``com,example,blog)/path?query``; scheme, user, port 80/443 and fragment go.

    It is encoded here, once, so all that sorts, compares or counts keys sees the same ones."""
    url = (url or "").strip()
    if not url:
        return ""
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    host, path = rest[:cut].rpartition("@")[2].lower(), rest[cut:] or "/"
    host, _, port = host.partition(":")
    key = ",".join(reversed(host.removeprefix("www.").split("."))) + (f":{port}" if port not in ("", "80", "443") else "")
    return clean(key + ")" + (path if path.startswith("/") else "/" + path))


def clean(value: str) -> str:
    return quote(value, safe="".join(chr(i) for i in range(33, 127)))


def record_id(number: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{number}')}>"


def record(page: int | None, url: str, payload: bytes, sha1: str, refers_to: int | None, date: str) -> bytes:
    """One record, as a gzip member. A revisit has no payload; its length and digest stand in the header."""
    head = HTTP.format(len(payload)).encode()
    body = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page)}", f"WARC-Date: {date}", f"WARC-Target-URI: {url}"]
    lines += [f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}", f"X-Payload-Length: {len(payload)}", f"X-Page: {'' if page is None else page}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header and payload of one unpacked record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


class Output:
    """A file that gets its name when it is whole."""

    def __init__(self, root: str, name: str) -> None:
        self.fs, base = fs.FileSystem.from_uri(root)
        self.fs.create_dir(base, recursive=True)
        self.path, self.size = f"{base}/{name}", 0
        self.part = f"{self.path}.{uuid.uuid4().hex}"
        self.stream = self.fs.open_output_stream(self.part, compression=None)

    def write(self, data: bytes) -> int:
        at = self.size
        self.stream.write(data)
        self.size += len(data)
        return at

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.part, self.path)


class Ranges:
    """Reads ranges of files under a root; the last file stays open."""

    def __init__(self, root: str) -> None:
        self.fs, self.base = fs.FileSystem.from_uri(root)
        self.name, self.file = None, None

    def read(self, name: str, at: int, n: int) -> bytes:
        if name != self.name:
            if self.file:
                self.file.close()
            self.name, self.file = name, self.fs.open_input_file(f"{self.base}/{name}")
        return self.file.read_at(n, at)

    def whole(self, name: str) -> bytes:
        with self.fs.open_input_file(f"{self.base}/{name}") as f:
            return f.read()


@dataclass
class Archive:
    root: str
    parts: list[tuple[str, str, str]]  # first key, last key, name; sorted


def decide(df: DataFrame, page: str, html: str) -> DataFrame:
    """Adds sha1 and refers_to (null: the row keeps its payload)."""
    body = F.coalesce(F.col(html), F.lit(""))
    big = F.octet_length(body) >= MIN_REVISIT
    # small payloads get keys of their own, which spreads them
    key = F.when(big, F.sha2(body, 256)).otherwise(F.xxhash64(F.col(page)).cast("string"))
    same = df.filter(F.octet_length(html) >= MIN_REVISIT).select(F.sha2(body, 256).alias("same"), F.octet_length(body).alias("n"), F.col(page).alias("p"))
    winners = same.groupBy("same", "n").agg(F.max("p").alias("winner"), F.count("*").alias("rows")).filter("rows > 1").select("same", "winner")
    joined = df.withColumn("same", key).join(winners, "same", "left")
    return joined.select(F.col(page).alias("page"), "url", body.alias("html"), F.when(F.col("winner") != F.col(page), F.col("winner")).alias("refers_to"))


def write_archive(df: DataFrame, root: str, page: str = "page_id", url: str = "url", html: str = "html", date: str = "2024-01-01T00:00:00Z") -> Archive:
    """Writes the volumes and the index of all rows under ``root``."""

    def volumes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        out, count = None, 0
        for b in batches:
            rows = []
            for p, u, text, refers in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if out is None or out.size >= VOLUME_BYTES:
                    if out:
                        out.close()
                    name = f"pages-{task:06d}-{count:04d}.warc.gz"
                    out, count = Output(root, name), count + 1
                payload = text.encode()
                packed = record(p, clean(u or ""), payload, hashlib.sha1(payload).hexdigest(), refers, date)
                rows.append((surt(u), name, out.write(packed), len(packed)))
            if rows:
                k, v, o, n = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(v), pa.array(o, pa.int64()), pa.array(n, pa.int64())], ["key", "volume", "offset", "length"])
        if out:
            out.close()

    rows = decide(df.select(F.col(page), F.col(url).alias("url"), F.col(html)), page, html).sortWithinPartitions("page", "url")
    captures = sh.materialise(rows.mapInArrow(volumes, "key string, volume string, offset long, length long"), "captures")
    return build_index(captures, root)


def build_index(captures: DataFrame, root: str) -> Archive:
    """The index of captures whose keys are encoded as ``surt`` gives them."""

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        name, out = f"captures-{task:06d}", None
        held: list[str] = []
        directory: list[str] = []
        first = last = ""

        def close() -> None:
            packed = zlib.compress("\n".join(held).encode(), 6)
            directory.append(f"{held[0].split(chr(9), 1)[0]}\t{out.write(packed)}\t{len(packed)}")
            held.clear()

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                key = row[0]
                if out is None:
                    out, first = Output(root, name + ".blocks"), key
                last = key
                held.append("\t".join([key, *map(str, row[1:])]))
                if len(held) >= BLOCK_LINES:
                    close()
        if out:
            if held:
                close()
            out.close()
            listing = Output(root, name + ".directory")
            listing.write("\n".join(directory).encode())
            listing.close()
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (first, last, name)], ["first", "last", "name"])

    order = ["key", "volume", "offset"]
    parts = captures.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(blocks, "first string, last string, name string")
    rows = sh.materialise(parts, "parts").collect()  # a row a part
    return Archive(root, sorted((r["first"], r["last"], r["name"]) for r in rows))


class Index:
    """Looks keys up in an archive's parts; keeps the last directory and the last block."""

    def __init__(self, archive: Archive) -> None:
        self.parts, self.ranges = archive.parts, Ranges(archive.root)
        self.firsts, self.lasts = [p[0] for p in archive.parts], [p[1] for p in archive.parts]
        self.at, self.block = None, None

    def directory(self, name: str) -> tuple[list[str], list[tuple[int, int]]]:
        if self.at is None or self.at[0] != name:
            lines = [x.split("\t") for x in self.ranges.whole(name + ".directory").decode().split("\n")]
            self.at = name, [x[0] for x in lines], [(int(x[1]), int(x[2])) for x in lines]
        return self.at[1], self.at[2]

    def lines(self, name: str, where: tuple[int, int]) -> list[str]:
        if self.block is None or self.block[0] != (name, where):
            self.block = (name, where), zlib.decompress(self.ranges.read(name + ".blocks", *where)).decode().split("\n")
        return self.block[1]

    def find(self, key: str) -> Iterator[tuple[str, int, int]]:
        """Volume, offset and length of every capture of a key."""
        key = clean(key)
        p = bisect.bisect_left(self.lasts, key)
        while p < len(self.parts) and self.firsts[p] <= key:
            heads, where = self.directory(self.parts[p][2])
            k = max(0, bisect.bisect_left(heads, key) - 1)
            while k < len(heads) and heads[k] <= key:
                lines = self.lines(self.parts[p][2], where[k])
                i = bisect.bisect_left(lines, key + "\t")
                while i < len(lines) and lines[i].startswith(key + "\t"):
                    volume, offset, length = lines[i].split("\t")[1:]
                    yield volume, int(offset), int(length)
                    i += 1
                k += 1
            p += 1


def keys_of(df: DataFrame, url: str = "url") -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([surt(u) for u in b.column(0).to_pylist()], pa.string())], ["key"])

    return df.select(url).mapInArrow(run, "key string").distinct()


def lookup(archive: Archive, keys: DataFrame) -> DataFrame:
    """All captures of each distinct key: key, volume, offset, length."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(archive)

        def pack(rows: list) -> pa.RecordBatch:
            k, v, o, n = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(k), pa.array(v), pa.array(o, pa.int64()), pa.array(n, pa.int64())], ["key", "volume", "offset", "length"])

        rows = []
        for b in batches:
            for key in b.column(0).to_pylist():
                for found in index.find(key):
                    rows.append((key, *found))
                    if len(rows) >= 10_000:
                        yield pack(rows)
                        rows = []
        if rows:
            yield pack(rows)

    return keys.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(run, "key string, volume string, offset long, length long")


def read_records(archive: Archive, captures: DataFrame) -> DataFrame:
    """The records at the captures: page, url, type, payload, its length and SHA-1 (from the header where a revisit has none), page referred to."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = Ranges(archive.root)
        for b in batches:
            rows = list(zip(*(b.column(i).to_pylist() for i in range(3)), strict=True))
            i, out, held = 0, [], 0
            while i < len(rows):
                volume, at, n = rows[i]
                j, stop = i + 1, at + n
                while j < len(rows) and rows[j][0] == volume and rows[j][1] <= stop + 65536 and rows[j][1] + rows[j][2] - at <= READ_BYTES:
                    stop = rows[j][1] + rows[j][2]
                    j += 1
                chunk = ranges.read(volume, at, stop - at)
                for _, o, length in rows[i:j]:
                    head, payload = parse(zlib.decompress(chunk[o - at : o - at + length], 31))
                    kept = head["WARC-Type"] == "response"
                    sha1 = hashlib.sha1(payload).hexdigest() if kept else base64.b32decode(head["WARC-Payload-Digest"][5:]).hex()
                    size = len(payload) if kept else int(head["X-Payload-Length"])
                    out.append((int(head["X-Page"]) if head["X-Page"] else None, head["WARC-Target-URI"], head["WARC-Type"], payload if kept else None, size, sha1, int(head["X-Refers-To-Page"]) if "X-Refers-To-Page" in head else None))
                    held += len(payload)
                    if held > 1 << 24:
                        yield pack(out)
                        out, held = [], 0
                i = j
            if out:
                yield pack(out)

    names = ["page", "url", "type", "payload", "payload_bytes", "payload_sha1", "refers_to"]
    types = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]

    def pack(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    placed = captures.select("volume", "offset", "length").repartitionByRange("volume", "offset").sortWithinPartitions("volume", "offset")
    return placed.mapInArrow(run, "page long, url string, type string, payload binary, payload_bytes long, payload_sha1 string, refers_to long")


def new_root(spark: SparkSession) -> str:
    return sh.scratch(spark, "archive")
