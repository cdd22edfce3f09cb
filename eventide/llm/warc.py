"""WARC archives as a PySpark Python data source.

Reading plans partitions from the files (small ones together), takes the
record-type and header predicates Spark pushes down, parses a record's headers
first and decodes its payload only if they pass and payloads are asked for.
Records are one gzip member each, and the writer notes a member's length in
its ``sl`` extra field, so an unwanted record is skipped by a seek without
inflating it; archives without that field, and plain ones, are read too.

Writing is safe against lost executors: every task writes files of its own
name, and the commit adds a manifest that lists the files of the tasks that
succeeded.  A folder with manifests is read by them alone.  Files are reached
through Arrow's file systems, so paths may name any store it supports.
"""

from __future__ import annotations

import gzip
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from eventide.session import scratch_path

from .common import materialize, ship_by_value, slices, table

ship_by_value()

SCHEMA = ("record_id string, record_type string, target_uri string, date string, content_type string, payload_digest string, "
          "payload_length long, refers_to string, headers map<string,string>, payload binary")
FILE_BYTES = 64 << 20           # after which a task begins another file
PARTITION_BYTES = 64 << 20      # of files read by one task
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_ARROW = pa.schema([(n, pa.string()) for n in ("record_id", "record_type", "target_uri", "date", "content_type", "payload_digest")]
                   + [("payload_length", pa.int64()), ("refers_to", pa.string()), ("headers", pa.map_(pa.string(), pa.string())),
                      ("payload", pa.binary())])
_HTTP_END = re.compile(rb"\r?\n\r?\n")


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"file:/", path):
        return pafs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _clean(value: str) -> str:
    """A header value on one line: control characters percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


# --- records -------------------------------------------------------------

def encode_record(row: dict, date: str, level: int = 6) -> bytes:
    """One gzip member with its ``sl`` field; the payload as an HTTP response."""
    payload, revisit = row.get("payload") or b"", row["record_type"] == "revisit"
    length = row.get("payload_length")
    length = len(payload) if length is None else length
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n").encode() + (b"" if revisit else payload)
    head = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{row['record_id']}>"), ("WARC-Date", row.get("date") or date),
            ("WARC-Target-URI", row.get("target_uri")), ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Payload-Digest", row.get("payload_digest") and "sha256:" + row["payload_digest"]), ("X-Payload-Length", str(length)),
            ("WARC-Refers-To", row.get("refers_to") and f"<{row['refers_to']}>"), ("WARC-Profile", PROFILE if revisit else None),
            *(row.get("headers") or ()), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {_clean(v)}\r\n" for k, v in head if v is not None) + "\r\n"
    whole = text.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"
    press = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = press.compress(whole) + press.flush()
    size = 10 + 2 + 12 + len(body) + 8
    if max(size, len(whole)) >= 1 << 32:        # the field holds 32 bits: left out
        return gzip.compress(whole, level, mtime=0)
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + (12).to_bytes(2, "little") + b"sl" + (8).to_bytes(2, "little") + size.to_bytes(4, "little")
            + len(whole).to_bytes(4, "little") + body + zlib.crc32(whole).to_bytes(4, "little") + len(whole).to_bytes(4, "little"))


def parse_headers(block: bytes) -> dict[str, str]:
    """Header fields by lower-case name; folded lines are joined."""
    lines = re.sub(r"\r?\n[ \t]+", " ", block.decode("utf-8", "replace")).splitlines()
    if not lines or not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {block[:40]!r}")
    out = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        out.setdefault(name.strip().lower(), value.strip())
    return out


def http_payload(block: bytes) -> bytes:
    """The entity of an HTTP response, chunks joined."""
    m = _HTTP_END.search(block)
    if not block.startswith(b"HTTP/") or not m:
        return block
    head, body = block[:m.start()].lower(), block[m.end():]
    if not re.search(rb"\ntransfer-encoding:[^\n]*chunked", head):
        return body
    out, at = [], 0
    while (end := body.find(b"\n", at)) >= 0:
        try:
            size = int(body[at:end].split(b";")[0].strip() or b"0", 16)
        except ValueError:
            break
        if not size:
            break
        out.append(body[end + 1:end + 1 + size])
        at = end + 1 + size + (2 if body[end + 1 + size:end + 3 + size] == b"\r\n" else 1)
    return b"".join(out)


def _skip_length(member: bytes) -> int | None:
    """The compressed length a gzip member states in its ``sl`` field."""
    if member[:3] != b"\x1f\x8b\x08" or not member[3] & 4:
        return None
    extra = member[12:12 + int.from_bytes(member[10:12], "little")]
    while len(extra) >= 4:
        n = int.from_bytes(extra[2:4], "little")
        if extra[:2] == b"sl" and n == 8:
            return int.from_bytes(extra[4:8], "little")
        extra = extra[4 + n:]
    return None


class _Stream:
    """Records of a plain byte stream, one after the other."""

    def __init__(self, f):
        self.f, self.held = f, b""

    def _fill(self) -> bool:
        more = self.f.read(1 << 16)
        self.held += more
        return bool(more)

    def take(self, n: int, keep: bool) -> bytes:
        out = [self.held[:n]]
        n, self.held = n - len(out[0]), self.held[n:]
        while n > 0 and (more := self.f.read(min(n, 1 << 20))):
            n -= len(more)
            if keep:
                out.append(more)
        if n > 0:
            raise ValueError("the archive ends inside a record")
        return b"".join(out) if keep else b""

    def records(self) -> Iterator[tuple[dict, object]]:
        while True:
            while not self.held.lstrip(b"\r\n") and self._fill():
                pass
            self.held = self.held.lstrip(b"\r\n")
            if not self.held:
                return
            while not (m := _HTTP_END.search(self.held)):
                if not self._fill():
                    raise ValueError("the archive ends inside a record's headers")
            head = parse_headers(self.held[:m.start()])
            self.held = self.held[m.end():]
            size, used = int(head.get("content-length", 0)), []

            def body(size=size, used=used):
                used.append(1)
                return self.take(size, True)

            yield head, body
            if not used:
                self.take(size, False)


class _From(io.RawIOBase):
    """The rest of a file as a readable object."""

    def __init__(self, f):
        self.f = f

    def readable(self):
        return True

    def readinto(self, into):
        got = self.f.read(len(into))
        into[:len(got)] = got
        return len(got)


def records(f, size: int) -> Iterator[tuple[dict, object]]:
    """``(headers, body)`` of every record; the block is inflated only when
    ``body()`` is called, at once."""
    at = 0
    while at < size:
        f.seek(at)
        first = f.read(4096)
        skip = _skip_length(first)
        if skip is None:
            f.seek(at)
            rest = io.BufferedReader(_From(f), 1 << 18)
            yield from _Stream(gzip.GzipFile(fileobj=rest) if first[:2] == b"\x1f\x8b" else rest).records()
            return
        inflate = zlib.decompressobj(31)
        text = inflate.decompress(first, 1 << 16)
        while not (m := _HTTP_END.search(text)):
            more = inflate.unconsumed_tail or f.read(1 << 16)
            if not more:
                raise ValueError("the archive ends inside a record's headers")
            text += inflate.decompress(more, 1 << 16)
        head = parse_headers(text[:m.start()])

        def body(text=text[m.end():], size=int(head.get("content-length", 0)), inflate=inflate):
            parts, have = [text], len(text)
            while have < size and not inflate.eof:
                more = inflate.unconsumed_tail or f.read(1 << 18)
                if not more:
                    raise ValueError("the archive ends inside a record")
                parts.append(inflate.decompress(more))
                have += len(parts[-1])
            return b"".join(parts)[:size]

        yield head, body
        at += skip


# --- reading ---------------------------------------------------------------

def _fields(head: dict[str, str]) -> dict:
    bare = lambda x: x and x.removeprefix("<").removesuffix(">")
    digest = head.get("warc-payload-digest")
    length = head.get("x-payload-length")
    return {"record_id": bare(head.get("warc-record-id")), "record_type": head.get("warc-type"), "target_uri": bare(head.get("warc-target-uri")),
            "date": head.get("warc-date"), "content_type": head.get("content-type"), "payload_digest": digest and digest.removeprefix("sha256:"),
            "payload_length": int(length) if length and length.isdigit() else None, "refers_to": bare(head.get("warc-refers-to"))}


_TESTS = {"EqualTo": lambda x, v: x is not None and x == v, "EqualNullSafe": lambda x, v: x == v,
          "GreaterThan": lambda x, v: x is not None and x > v, "GreaterThanOrEqual": lambda x, v: x is not None and x >= v,
          "LessThan": lambda x, v: x is not None and x < v, "LessThanOrEqual": lambda x, v: x is not None and x <= v,
          "In": lambda x, v: x is not None and x in v, "IsNull": lambda x, v: x is None, "IsNotNull": lambda x, v: x is not None,
          "StringStartsWith": lambda x, v: x is not None and x.startswith(v), "StringEndsWith": lambda x, v: x is not None and x.endswith(v),
          "StringContains": lambda x, v: x is not None and v in x}


@dataclass
class FilePart(ds.InputPartition):
    files: list       # (path, bytes)


class WarcReader(ds.DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payloads = str(options.get("payload", "true")).lower() == "true"
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.only = {k.lower().removeprefix("header:"): v for k, v in options.items() if k.lower().startswith("header:")}
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            name = type(f).__name__
            if name in _TESTS and len(f.attribute) == 1 and f.attribute[0] in _ARROW.names[:8]:
                self.tests.append((name, f.attribute[0], list(f.value) if name == "In" else getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        store, path = _store(self.path)
        found = {i.path: i.size for i in store.get_file_info(pafs.FileSelector(path, recursive=True))
                 if i.is_file} if store.get_file_info(path).type == pafs.FileType.Directory else {path: store.get_file_info(path).size}
        manifests = [p for p in found if re.search(r"_manifest-[^/]*\.json$", p)]
        if manifests:
            listed = [f"{path.rstrip('/')}/{name}" for m in manifests for name in json.loads(store.open_input_stream(m).read())]
            found = {p: found[p] for p in listed}
        parts, last = [], None
        for p, size in sorted((p, s) for p, s in found.items() if re.search(r"\.warc(\.gz)?$", p)):
            if last is None or sum(s for _, s in last.files) + size > self.partition_bytes:
                last = FilePart([])
                parts.append(last)
            last.files.append((p, size))
        return parts or [FilePart([])]

    def read(self, partition):
        store, _ = _store(self.path)
        held, used = [], 0
        early = [t for t in self.tests if t[1] != "payload_length"]
        late = [t for t in self.tests if t[1] == "payload_length"]      # foreign archives tell it by the payload alone
        for path, size in partition.files:
            with store.open_input_file(path) as f:
                for head, body in records(f, size):
                    row = _fields(head)
                    known = early if row["payload_length"] is None else self.tests
                    if not all(_TESTS[t](row[c], v) for t, c, v in known) or any(head.get(k) != v for k, v in self.only.items()):
                        continue
                    row["headers"] = list(head.items())
                    row["payload"] = None
                    if self.payloads and row["record_type"] != "revisit":
                        block = body()
                        row["payload"] = http_payload(block) if (row["content_type"] or "").startswith("application/http") else block
                        if row["payload_length"] is None:
                            row["payload_length"] = len(row["payload"])
                    if not all(_TESTS[t](row[c], v) for t, c, v in late):
                        continue
                    used += len(row["payload"] or b"")
                    held.append(row)
                    if len(held) >= 2000 or used >= 16 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
                        held, used = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=_ARROW)


# --- writing ---------------------------------------------------------------

@dataclass
class Written(ds.WriterCommitMessage):
    files: list


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        if overwrite:
            raise ValueError("archives are only added to: use mode('append')")
        self.path = options["path"]
        self.file_bytes = int(options.get("fileBytes", FILE_BYTES))
        self.level = int(options.get("level", 6))
        self.date = options.get("date") or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(self, iterator):
        store, path = _store(self.path)
        store.create_dir(path, recursive=True)
        files, out, size = [], None, 0
        for batch in slices(iterator, 64):
            for row in batch.to_pylist():
                if out is None:
                    files.append(f"{uuid.uuid4().hex}.warc.gz")
                    out, size = store.open_output_stream(f"{path.rstrip('/')}/{files[-1]}", compression=None), 0
                record = encode_record(row, self.date, self.level)
                out.write(record)
                size += len(record)
                if size >= self.file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages):
        store, path = _store(self.path)
        store.create_dir(path, recursive=True)
        with store.open_output_stream(f"{path.rstrip('/')}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps([f for m in messages if m is not None for f in m.files]).encode())

    def abort(self, messages):
        """Files no manifest lists are never read."""


class WarcSource(ds.DataSource):
    """``spark.read.format("warc").load(path)`` and ``df.write.format("warc")
    .mode("append").save(path)``.

    Read options: ``payload`` (false: headers only, no payload decoded),
    ``partitionBytes``, ``header:NAME`` (records whose header equals the
    value).  Write options: ``fileBytes``, ``level`` (gzip), ``date``.  Written
    columns: record_id, record_type, payload, and if there target_uri, date,
    payload_digest, payload_length, refers_to, headers; others are ignored.
    """

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
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# --- pages -------------------------------------------------------------------

def page_records(pages: DataFrame, least: int = 100) -> DataFrame:
    """Records of ``(page_id, url, html)``: of equal payloads of at least
    ``least`` bytes the one with the smallest page_id is a response and the
    others revisit it.  Null html is empty; rows without an id revisit one
    that has an id; rows that repeat the smallest id are all responses."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256)).withColumn("payload_length", F.octet_length("payload").cast("long"))
    # one row per payload that occurs more than once, map-side combined; written,
    # so that the join is of two plain exchanges and a hot payload is split
    first = materialize(rows.where(F.col("payload_length") >= least).groupBy("payload_digest")
                        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
                        .select("payload_digest", "first"), "first")
    rows = rows.join(first, "payload_digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("")))
    return rows.select(name(F.col("page_id")).alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"), "target_uri",
                       F.when(~again, F.col("payload")).alias("payload"), "payload_digest", "payload_length",
                       F.when(again, name(F.col("first"))).alias("refers_to"))


def archive_pages(pages: DataFrame, path: str, least: int = 100, **options) -> None:
    """Write the pages' records under ``path``; an empty table writes none."""
    register(pages.sparkSession)
    page_records(pages, least).write.format("warc").options(**options).mode("append").save(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, url``:
    responses by their decoded payload, revisits by their headers alone."""
    register(spark)
    page = lambda c: F.expr(f"try_cast(substring({c}, {len('urn:page:') + 1}) as bigint)")
    whole = spark.read.format("warc").load(path).where("record_type = 'response'")
    heads = spark.read.format("warc").option("payload", "false").load(path).where("record_type = 'revisit'")
    return whole.select(page("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
                        F.sha2("payload", 256).alias("payload_digest"), "record_type", page("refers_to").alias("refers_to"), F.col("target_uri").alias("url")
                        ).unionByName(heads.select(page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest",
                                                   "record_type", page("refers_to").alias("refers_to"), F.col("target_uri").alias("url")))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back."""
    path = scratch_path(spark, "llm-warc")
    archive_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"), path)
    return read_pages(spark, path)


ORACLE = """
with p as (select page_id, encode(coalesce(html, '')) b, sha256(coalesce(html, '')) d, url from pages),
     f as (select d, min(page_id) first from p where octet_length(b) >= 100 group by d)
select page_id, octet_length(b)::bigint as payload_bytes, d as payload_digest,
       case when first is not null and page_id <> first then 'revisit' else 'response' end as record_type,
       case when first is not null and page_id <> first then first end as refers_to, url
from p left join f using (d)
"""
