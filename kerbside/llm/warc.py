"""WARC archives with a two-level capture index.

Writing: every page becomes a WARC/1.1 record, one gzip member each, in archives of bounded size in a folder
that all executors share. Among records with equal payloads of at least MIN_REVISIT bytes, the one with the
smallest page_id is the response and the others are revisit records that name it. Each task writes files of
its own names and reports the records of the files it has finished, so a task that is run again leaves only
files that nothing refers to.

Index: the captures' keys (reversed host and path of the URL, then page_id) are sorted globally; each sorted
partition is written as blocks of BLOCK_LINES lines, one gzip member each, and a sparse directory with the
first key and place of each block. A manifest has one row for each partition: its first and last key and its
files.

Reading: a key is found by binary search in the manifest, then in that partition's directory; one range read
gives the block, another the record in its archive. Keys to look up are sorted first, so neighbours share a
block. Digest and length are computed from the payload that was read.

Definitions: null html is an empty payload; a null url gives the key '' and no target header; a null page_id
is always a response. Rows that share the smallest page_id of a payload are all responses. Line breaks in a
url are percent-encoded. Repeated rows are written and read each. An empty table writes no archive. Other
columns are ignored.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.common import local_path, scratch, stored, text_batches

#: Payloads from this size can be revisits. Bytes after which a task begins another archive. Lines of a block.
MIN_REVISIT, ARCHIVE_BYTES, BLOCK_LINES = 100, 256 << 20, 500
#: Lines of an index partition, about.
INDEX_LINES = 50_000
DATE = "2024-01-01T00:00:00Z"
RECORD_ID = "<urn:page:{}>"
# Fixed value: profile of revisit records.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ENTRY = "surt string, page_id string, record_type string, archive string, offset long, length long"


def surt(url: str | None) -> str:
    """Key of a URL with its host reversed: com,example)/path?query."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return quote(url, safe="/:?&=,)#%")
    path = parts.path or "/"
    key = ",".join(reversed(host.removeprefix("www.").split("."))) + (f":{port}" if port else "") + ")" + path
    return quote(key + (f"?{parts.query}" if parts.query else ""), safe="/:?&=,)%")


def record(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One gzip member with a response or, if it refers to another page, a revisit record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (b"" if refers_to else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}",
            f"WARC-Record-ID: {RECORD_ID.format('' if page_id is None else page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {RECORD_ID.format(refers_to)}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def parse(member: bytes) -> dict:
    """Fields of a record: headers by lower-case name, ``http`` headers and ``payload``."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    fields["http"] = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode().split("\r\n")[1:])}
    fields["payload"] = payload
    return fields


def with_roles(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, refers_to (null: response)."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    hashed = pages.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    large = F.octet_length("html") >= MIN_REVISIT
    first = stored(hashed.where(large & F.col("page_id").isNotNull()).groupBy("digest")
                   .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
                   .where("first < last").select("digest", "first"), "warc-repeats")
    joined = hashed.join(first, "digest", "left")
    return joined.select(F.col("page_id").cast("string").alias("page_id"), "url", "html", "digest",
                         F.when(F.col("first") < F.col("page_id"), F.col("first")).cast("string").alias("refers_to"))


def write_archives(pages: DataFrame, root: str) -> DataFrame:
    """Writes all pages below ``root``; returns the captures, one row per record, stored."""
    text_batches(pages.sparkSession)
    target = local_path(root)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(target)
        store.create_dir(f"{base}/archives", recursive=True)
        out, size, name = None, 0, ""
        rows: list[tuple] = []
        try:
            for frame in frames:
                for page_id, url, page, digest, refers in zip(
                        frame["page_id"], frame["url"], frame["html"], frame["digest"], frame["refers_to"]):
                    if out is None:
                        name, size = f"archives/{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    member = record(page_id, url, page.encode("utf-8", "replace"), digest, refers)
                    out.write(member)
                    rows.append((surt(url), page_id, "revisit" if refers else "response", name, size, len(member)))
                    size += len(member)
                    if size >= ARCHIVE_BYTES:
                        out.close()
                        out = None
                        yield captures(rows)
                        rows = []
        finally:
            if out is not None:
                out.close()
        yield captures(rows)

    def captures(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["surt", "page_id", "record_type", "archive", "offset", "length"])

    return stored(with_roles(pages).mapInPandas(run, ENTRY), "warc-captures")


def write_index(captures: DataFrame, root: str) -> DataFrame:
    """Sorted, blocked index below ``root``; returns the manifest, stored."""
    target = local_path(root)
    parts = 1 + captures.count() // INDEX_LINES
    ordered = (captures.withColumn("key", F.concat_ws(" ", "surt", F.lpad(F.coalesce("page_id", F.lit("")), 20, " ")))
               .repartitionByRange(parts, "key", "archive", "offset").sortWithinPartitions("key", "archive", "offset"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(target)
        store.create_dir(f"{base}/index", recursive=True)
        name = f"index/{uuid.uuid4().hex}"
        directory: list[str] = []
        lines: list[str] = []
        out, size, count, first, last = None, 0, 0, "", ""

        def flush() -> None:
            nonlocal size, lines
            member = gzip.compress("".join(lines).encode(), 6, mtime=0)
            out.write(member)
            directory.append(f"{lines[0].split(chr(9), 1)[0]}\t{size}\t{len(member)}\n")
            size += len(member)
            lines = []

        for frame in frames:
            for key, kind, archive, offset, length in zip(frame["key"], frame["record_type"], frame["archive"],
                                                          frame["offset"], frame["length"]):
                if out is None:
                    out, first = store.open_output_stream(f"{base}/{name}.blocks", compression=None), key
                lines.append(f"{key}\t{kind}\t{archive}\t{offset}\t{length}\n")
                last = key
                count += 1
                if len(lines) == BLOCK_LINES:
                    flush()
        if out is None:
            return
        if lines:
            flush()
        out.close()
        with store.open_output_stream(f"{base}/{name}.directory", compression=None) as f:
            f.write("".join(directory).encode())
        yield pd.DataFrame({"first": [first], "last": [last], "shard": [name], "captures": [count]})

    narrow = ordered.select("key", "record_type", "archive", "offset", "length")
    return stored(narrow.mapInPandas(run, "first string, last string, shard string, captures long"), "warc-manifest")


class Recent(OrderedDict):
    """What was opened or read last; ``drop`` ends an entry that makes room."""

    def __init__(self, most: int, drop=None):
        super().__init__()
        self.most, self.drop = most, drop

    def get_or(self, key, make):
        if key in self:
            self.move_to_end(key)
            return self[key]
        if len(self) >= self.most:
            old = self.popitem(last=False)[1]
            if self.drop:
                self.drop(old)
        self[key] = made = make()
        return made


class Reader:
    """Finds captures by key below a root: binary searches, then range reads."""

    def __init__(self, root: str, manifest: list[tuple[str, str, str]]):
        self.store, self.base = fs.FileSystem.from_uri(local_path(root))
        self.manifest = sorted(manifest)
        self.firsts = [m[0] for m in self.manifest]
        self.directories: Recent = Recent(8)
        self.blocks: Recent = Recent(8)
        self.files: Recent = Recent(32, lambda f: f.close())

    def range(self, name: str, offset: int, length: int) -> bytes:
        f = self.files.get_or(name, lambda: self.store.open_input_file(f"{self.base}/{name}"))
        return bytes(f.read_at(length, offset))

    def directory(self, shard: str) -> tuple[list[str], list[tuple[int, int]]]:
        def read():
            with self.store.open_input_stream(f"{self.base}/{shard}.directory", compression=None) as f:
                rows = [x.split("\t") for x in f.read().decode().splitlines()]
            return [r[0] for r in rows], [(int(r[1]), int(r[2])) for r in rows]
        return self.directories.get_or(shard, read)

    def block(self, shard: str, place: tuple[int, int]) -> list[list[str]]:
        def read():
            data = gzip.decompress(self.range(f"{shard}.blocks", *place)).decode()
            return [x.split("\t") for x in data.split("\n")[:-1]]
        return self.blocks.get_or((shard, place), read)

    def find(self, key: str) -> Iterator[tuple[str, str, int, int]]:
        """(record type, archive, offset, length) of every capture of a key."""
        # shards and blocks from the last one that begins before the key
        shard = max(bisect.bisect_left(self.firsts, key) - 1, 0)
        while shard < len(self.manifest) and self.manifest[shard][0] <= key:
            if self.manifest[shard][1] >= key:
                firsts, places = self.directory(self.manifest[shard][2])
                k = max(bisect.bisect_left(firsts, key) - 1, 0)
                while k < len(firsts) and firsts[k] <= key:
                    lines = self.block(self.manifest[shard][2], places[k])
                    at = bisect.bisect_left(lines, [key])
                    while at < len(lines) and lines[at][0] == key:
                        _, kind, archive, offset, length = lines[at]
                        yield kind, archive, int(offset), int(length)
                        at += 1
                    k += 1
            shard += 1

    def read(self, archive: str, offset: int, length: int) -> dict:
        return parse(self.range(archive, offset, length))


#: Archived bytes that one task reads back, about.
READ_BYTES = 8_000_000

RESULT = "surt string, page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"


def page_of(urn: str | None) -> str | None:
    value = urn.removeprefix("<urn:page:").removesuffix(">") if urn else ""
    return value or None


def lookup(spark: SparkSession, root: str, manifest: DataFrame, keys: DataFrame, payload: bool = False,
           tasks: int | None = None) -> DataFrame:
    """Records of (surt, page_id) keys, read through the index. The manifest, a row for each index partition, goes
    to the tasks; directories are read as they are needed. ``tasks``: into how many the keys are dealt; by default Spark
    chooses by the size of the keys, which says nothing of the records that they stand for."""
    shards = spark.sparkContext.broadcast([(r["first"], r["last"], r["shard"]) for r in manifest.collect()])
    ordered = (keys.select(F.concat_ws(" ", "surt", F.lpad(F.coalesce("page_id", F.lit("")), 20, " ")).alias("key"))
               .distinct())
    ordered = (ordered.repartitionByRange("key") if tasks is None else ordered.repartitionByRange(tasks, "key")).sortWithinPartitions("key")
    schema = RESULT + (", payload binary" if payload else "")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(root, shards.value)
        for frame in frames:
            rows = []
            for key in frame["key"]:
                for _, archive, offset, length in reader.find(key):
                    r = reader.read(archive, offset, length)
                    body, kind = r["payload"], r["warc-type"]
                    digest = r["warc-payload-digest"].removeprefix("sha256:")
                    if kind == "response":
                        own = hashlib.sha256(body).hexdigest()
                        if own != digest:
                            raise ValueError(f"payload of {r['warc-record-id']} does not match its digest")
                    rows.append((key[:-21], page_of(r["warc-record-id"]), int(r["http"]["content-length"]), digest, kind,
                                 page_of(r.get("warc-refers-to")), body)[:7 if payload else 6])
            yield pd.DataFrame(rows, columns=[x.split(" ")[0] for x in schema.split(", ")])

    return ordered.mapInPandas(run, schema)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Writes all pages to archives with their index, and reads every record back through it: page_id,
    payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    root = scratch(spark, "warc")
    captures = write_archives(pages, root)
    manifest = write_index(captures, root)
    tasks = 1 + (captures.agg(F.sum("length")).first()[0] or 0) // READ_BYTES
    back = lookup(spark, root, manifest, captures.select("surt", "page_id"), tasks=tasks)
    return back.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast("long").alias("refers_to"))
