"""WARC archives as a Spark data source (format ``warc``), for reading and writing.

Writing: one gzip member a record, with the skip lengths (extra field ``sl``:
compressed and plain length) that the WARC standard's annex describes. A task
writes files under ``_temporary``; only the commit on the driver moves those of
successful tasks to their names, so a lost executor leaves no half archive.

Reading: files are cut into byte ranges, one a task; a range starts at the first
member whose header begins in it. A record's header block is inflated first
(its first ``HEAD`` bytes); predicates on the record type and the other header
columns are pushed down and judged on it, and unless the payload is wanted
(option ``payload``) and the record passes, the rest is skipped by its length.
Archives without skip lengths are read whole, one a task; plain ones skip by
Content-Length.

Defined results: a null payload is written as an empty one; null header values
are left out and read back as null; line breaks in header values are written
percent-encoded; an empty table gives an empty folder, which reads as no rows;
equal rows are separate records; columns other than the schema's are ignored.
"""

from __future__ import annotations

import base64
import json
import re
import struct
import uuid
import zlib
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    IsNotNull, IsNull, LessThan, LessThanOrEqual, StringStartsWith, WriterCommitMessage)

from gazetta.llm.util import materialise, read_table, scratch_path, ship

SCHEMA = ("record_id string, record_type string, target_uri string, date string, payload_digest string, "
          "payload_bytes long, refers_to string, payload binary")
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
ARROW = pa.schema([(c, pa.int64() if c == "payload_bytes" else pa.binary() if c == "payload" else pa.string()) for c in COLUMNS])
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: gzip header of a member with skip lengths; the two lengths follow.
MEMBER = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<H", 8)
#: Plain bytes that usually hold the WARC and HTTP headers.
HEAD = 2048
MIN_REVISIT_BYTES = 1000
#: Groups of equal payloads whose table is broadcast (some 60 bytes each).
BROADCAST_GROUPS = 200_000


# -- files -------------------------------------------------------------------

def _store(uri: str):
    """(file system, path) of a URI or path that Spark uses."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + unquote(uri[5:]).lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _clean(value: str) -> str:
    return re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", value)


def record(row: dict) -> bytes:
    """One record as a gzip member."""
    payload = row.get("payload") or b""
    size = row.get("payload_bytes")
    size = len(payload) if size is None else size
    kind = row.get("record_type") or "response"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {_clean(kind)}"]
    digest = row.get("payload_digest")
    for name, value in (
        ("WARC-Record-ID", row.get("record_id") and f"<{row['record_id']}>"), ("WARC-Date", row.get("date")),
        ("WARC-Target-URI", row.get("target_uri")),
        ("WARC-Payload-Digest", digest and "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("WARC-Refers-To", row.get("refers_to") and f"<{row['refers_to']}>"),
        ("WARC-Profile", PROFILE if kind == "revisit" else None),
    ):
        if value is not None:
            lines.append(f"{name}: {_clean(value)}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    plain = "\r\n".join(lines).encode() + block + b"\r\n\r\n"
    deflate = zlib.compressobj(3, zlib.DEFLATED, -15)
    body = deflate.compress(plain) + deflate.flush()
    return MEMBER + struct.pack("<II", len(MEMBER) + 8 + len(body) + 8, len(plain)) + body + struct.pack(
        "<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)


# -- parsing -----------------------------------------------------------------

def parse_head(head: bytes) -> tuple[dict, int, int] | None:
    """(header columns, where the block starts, where the HTTP body starts in
    the block) or None if the header block isn't complete in ``head``."""
    end = head.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in head[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    length = int(fields.get("content-length", 0))
    start = end + 4
    body, size = 0, length
    if fields.get("content-type", "").startswith("application/http"):
        stop = head.find(b"\r\n\r\n", start)
        if stop < 0 and len(head) < start + length:
            return None
        if stop >= 0:
            body = stop + 4 - start
            size = length - body
            said = re.search(rb"(?im)^content-length:\s*(\d+)", head[start:stop])
            if said and fields.get("warc-type") == "revisit":
                size = int(said[1])
    digest = fields.get("warc-payload-digest")
    if digest and digest.startswith("sha1:"):
        digest = base64.b32decode(digest[5:]).hex()
    strip = lambda x: x.strip("<>") if x else None
    return {"record_id": strip(fields.get("warc-record-id")), "record_type": fields.get("warc-type"),
            "target_uri": fields.get("warc-target-uri"), "date": fields.get("warc-date"), "payload_digest": digest,
            "payload_bytes": size, "refers_to": strip(fields.get("warc-refers-to")), "__length": length}, start, body


def _head_of(read_some) -> tuple[dict, int, int, bytes]:
    """Reads more and more until the header block is complete."""
    size, head = HEAD, b""
    while True:
        head = read_some(size)
        if (found := parse_head(head)) or len(head) < size:
            if not found:
                raise ValueError("truncated WARC record")
            return *found, head
        size *= 4


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.split = int(options.get("splitbytes", options.get("splitBytes", 64 << 20)))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        kinds = {EqualTo: "=", In: "in", IsNotNull: "some", IsNull: "none", StringStartsWith: "starts",
                 GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            if type(f) in kinds and len(f.attribute) == 1 and f.attribute[0] in COLUMNS and f.attribute[0] != "payload":
                self.tests.append((f.attribute[0], kinds[type(f)], getattr(f, "value", None)))
            else:
                yield f

    def _passes(self, row: dict) -> bool:
        for column, kind, value in self.tests:
            x = row[column]
            if kind in ("some", "none"):
                ok = (x is None) == (kind == "none")
            elif x is None:
                ok = False
            else:
                ok = {"=": lambda: x == value, "in": lambda: x in value, "starts": lambda: x.startswith(value), ">": lambda: x > value,
                      ">=": lambda: x >= value, "<": lambda: x < value, "<=": lambda: x <= value}[kind]()
            if not ok:
                return False
        return True

    def partitions(self):
        from pyarrow import fs

        store, path = _store(self.path)
        out = []
        for info in store.get_file_info(fs.FileSelector(path, allow_not_found=True)):
            if info.type != fs.FileType.File or info.base_name.startswith(("_", ".")):
                continue
            with store.open_input_file(info.path) as f:
                skips = f.read(len(MEMBER)) == MEMBER
            step = self.split if skips else max(1, info.size)
            out += [Range(info.path, at, min(at + step, info.size)) for at in range(0, info.size, step)]
        return out or [Range("", 0, 0)]

    def read(self, partition):
        if not partition.path:
            return
        store, _ = _store(self.path)
        rows, size = [], 0
        with store.open_input_file(partition.path) as f:
            f.seek(0)
            lead = f.read(len(MEMBER))
            records = self._members(f, partition) if lead == MEMBER else self._stream(f, gz=lead[:2] == b"\x1f\x8b")
            for row in records:
                rows.append(row)
                size += len(row["payload"] or b"") + 300
                if size > 8 << 20:
                    yield self._batch(rows)
                    rows, size = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], ARROW.field(c).type) for c in COLUMNS], schema=ARROW)

    def _members(self, f, part):
        at, window, fixed = part.start, 1 << 16, len(MEMBER) + 8
        if at:  # the first member that begins in the range
            while at < part.end:
                f.seek(at)
                found = f.read(window + len(MEMBER)).find(MEMBER)
                if found >= 0:
                    at += found
                    break
                at += window
        while at < part.end:
            f.seek(at)
            data = f.read(fixed + HEAD)
            size, _ = struct.unpack_from("<II", data, len(MEMBER))
            inflate, have = zlib.decompressobj(-15), len(data)

            def read_some(n, data=data, size=size):
                nonlocal have
                d = zlib.decompressobj(-15)
                plain = d.decompress(data[fixed: size], n)
                if len(plain) < n and have < size:
                    f.seek(at)
                    more = f.read(size)
                    have = size
                    d = zlib.decompressobj(-15)
                    plain = d.decompress(more[fixed:], n)
                return plain

            row, start, body, _ = _head_of(read_some)
            if self._passes(row):
                payload = None
                if self.payload and row["record_type"] != "revisit":
                    f.seek(at + fixed)
                    plain = inflate.decompress(f.read(size - fixed))
                    payload = plain[start + body: start + row["__length"]]
                yield row | {"payload": payload}
            at += size

    def _stream(self, f, gz):
        """Plain archives, and gzip ones without skip lengths."""
        source = pa.CompressedInputStream(f, "gzip") if gz else f
        if not gz:
            f.seek(0)
        else:
            f.seek(0)
        buffer = b""

        def fill(n):
            nonlocal buffer
            while len(buffer) < n and (more := source.read(max(n - len(buffer), 1 << 16))):
                buffer += more
            return buffer[:n]

        while True:
            while fill(2) == b"\r\n":
                buffer = buffer[2:]
            if not fill(1):
                return
            row, start, body, _ = _head_of(fill)
            wanted = self._passes(row)
            end = start + row["__length"]
            if wanted and self.payload and row["record_type"] != "revisit":
                yield row | {"payload": fill(end)[start + body: end]}
            elif wanted:
                yield row | {"payload": None}
            if len(buffer) >= end:
                buffer = buffer[end:]
            elif gz:
                fill(end)
                buffer = buffer[end:]
            else:  # skip without reading
                f.seek(f.tell() + end - len(buffer))
                buffer = b""


@dataclass
class Written(WriterCommitMessage):
    files: str


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.max_bytes = int(options.get("filebytes", options.get("fileBytes", 1 << 30)))

    def write(self, iterator):
        from pyspark import TaskContext

        store, path = _store(self.path)
        store.create_dir(f"{path}/_temporary", recursive=True)
        task = TaskContext.get()
        name, files, out = f"part-{task.partitionId():05d}-{uuid.uuid4().hex}", [], None
        for batch in iterator:
            for row in batch.to_pylist():
                if out is not None and out.tell() > self.max_bytes:
                    out.close()
                    out = None
                if out is None:
                    files.append(f"{name}-{len(files)}.warc.gz")
                    out = store.open_output_stream(f"{path}/_temporary/{files[-1]}", compression=None)
                out.write(record(row))
        if out is not None:
            out.close()
        return Written(json.dumps(files))

    def commit(self, messages):
        from pyarrow import fs

        store, path = _store(self.path)
        store.create_dir(path, recursive=True)
        old = [x.path for x in store.get_file_info(fs.FileSelector(path)) if x.type == fs.FileType.File] if self.overwrite else []
        for m in messages:
            for name in json.loads(m.files) if m else []:
                store.move(f"{path}/_temporary/{name}", f"{path}/{name}")
        for x in old:
            store.delete_file(x)
        store.create_dir(f"{path}/_temporary", recursive=True)
        store.delete_dir(f"{path}/_temporary")

    def abort(self, messages):
        store, path = _store(self.path)
        store.create_dir(f"{path}/_temporary", recursive=True)
        store.delete_dir(f"{path}/_temporary")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_warc(df: DataFrame, path: str, **options) -> None:
    """Write rows with (some of) the SCHEMA columns as WARC files."""
    register(df.sparkSession)
    have = set(df.columns)
    kinds = dict(c.split() for c in SCHEMA.split(", "))
    df.select(*(F.col(c).cast(t).alias(c) if c in have else F.lit(None).cast(t).alias(c) for c, t in kinds.items())).write.format(
        "warc").options(**options).mode("append").save(path)


def read_warc(spark: SparkSession, path: str, payload: bool = True, **options) -> DataFrame:
    """SCHEMA rows; with ``payload=False`` no payload is decoded (null)."""
    register(spark)
    return spark.read.format("warc").options(payload=str(payload).lower(), **options).load(path)


# -- pages -------------------------------------------------------------------

def page_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Records of (page_id, url, html) rows. Of equal payloads of at least
    ``min_bytes``, the largest page_id is a response and the others revisit it.

    Only digests are grouped; pages are not shuffled while the groups of two
    and more are few (they are counted), else they join by digest."""
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("digest"), F.length("payload").cast("long").alias("size"))
    same = (rows.where(F.col("size") >= min_bytes).groupBy(F.col("digest").alias("d"), F.col("size").alias("s"))
            .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    same = materialise(same, "payloads")
    groups = F.broadcast(same) if same.count() <= BROADCAST_GROUPS else same
    joined = rows.join(groups, (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s")), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("urn:x-page:"), F.col(c).cast("string"))
    return joined.select(
        name("page_id").alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"), F.lit(date).alias("date"), F.col("digest").alias("payload_digest"),
        F.col("size").alias("payload_bytes"), F.when(revisit, name("first")).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(page_records(read_table(spark, sf_dir, "pages")), path)
    records = read_warc(spark, path, payload=False).where(F.col("record_type").isin("response", "revisit"))
    number = lambda c: F.substring_index(c, ":", -1).cast("long")
    return records.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          number("refers_to").alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, strlen(t)::BIGINT AS payload_bytes, sha1(t) AS payload_digest FROM p),
g AS (SELECT payload_digest, payload_bytes, max(page_id) AS latest FROM d WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN g.latest IS NOT NULL AND g.latest <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.latest <> d.page_id THEN g.latest END AS refers_to
FROM d LEFT JOIN g ON g.payload_digest = d.payload_digest AND g.payload_bytes = d.payload_bytes
"""
