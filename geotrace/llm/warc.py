"""WARC archives as a Spark data source in Python: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading plans one partition for each split of a file. A record's header is parsed first; record-type and
header predicates (pushed-down filters, or the ``record_types`` option) decide on it alone, and an unwanted
record is left by its stored length without decoding its payload.

* gzip members carry the ``sl`` extra field of the WARC specification (compressed and plain length), so a
  member is skipped without inflating it; members of other writers are inflated to find their end. Plain
  ``.warc`` files are skipped by ``Content-Length``.
* Writing: every task writes a file of its own under a unique name, and only the files that the commit lists in
  ``_manifest-*.json`` are read, so retried, speculative or lost tasks leave nothing that counts. The
  manifest has split points every ``SPLIT`` bytes. Folders without one are read a file at a time.

Paths go through ``pyarrow.fs`` (local and shared file systems, hdfs, s3, gcs).
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition,
                                    IsNotNull, StringStartsWith, WriterCommitMessage)

from geotrace.llm.common import scratch

SPLIT = 8 << 20
BATCH = 8 << 20  # payload bytes of an Arrow batch
SCHEMA = ("record_type string, record_id string, target_uri string, warc_date string, refers_to string, payload_digest string, "
          "payload_length long, headers map<string,string>, payload binary")
_ARROW = pa.schema([(c, pa.string()) for c in ("record_type", "record_id", "target_uri", "warc_date", "refers_to", "payload_digest")]
                   + [("payload_length", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
#: Columns that the header alone decides, with their header names (lower case).
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "warc_date": "warc-date",
           "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _plain(name: str, value: str | None) -> str | None:
    """A header's value as the columns show it: ids without brackets, digests without their algorithm."""
    if value is None:
        return None
    if name in ("record_id", "refers_to"):
        return value.strip("<>")
    return value.removeprefix("sha1:") if name == "payload_digest" else value


def record(row: dict) -> bytes:
    """One uncompressed record; a row without payload has the HTTP header alone (as revisits do)."""
    payload = row.get("payload")
    length = row.get("payload_length")
    length = len(payload) if length is None and payload is not None else length or 0
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode() + (payload or b"")
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{row['record_id']}>", f"WARC-Date: {row['warc_date']}"]
    if row.get("target_uri") is not None:
        lines.append("WARC-Target-URI: " + " ".join(row["target_uri"].split()))
    if row["record_type"] == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    if row.get("refers_to") is not None:
        lines.append(f"WARC-Refers-To: <{row['refers_to']}>")
    if row.get("payload_digest") is not None:
        lines.append(f"WARC-Payload-Digest: sha1:{row['payload_digest']}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = 4) -> bytes:
    """A gzip member with its lengths in an ``sl`` field."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = 24 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sH", 12, b"sl", 8) + struct.pack("<II", size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class _View:
    """Reads of a file at any place, through one moving buffer."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.data = file, size, 0, b""

    def get(self, at: int, n: int) -> bytes:
        if not (self.at <= at and at + n <= self.at + len(self.data)):
            self.file.seek(at)
            self.at, self.data = at, self.file.read(min(self.size - at, max(n, 1 << 20)))
        return self.data[at - self.at : at - self.at + n]


class _Inflated:
    """A gzip member, inflated only as far as it is asked for."""

    def __init__(self, view: _View, at: int):
        self.view, self.start, self.next = view, at, at
        self.inflate, self.data = zlib.decompressobj(31), b""
        head = view.get(at, 24)
        self.length = None
        if len(head) == 24 and head[3] & 4 and head[12:14] == b"sl":
            self.length = struct.unpack("<I", head[16:20])[0] or None

    def more(self, step: int = 1 << 16) -> bool:
        if self.inflate.eof or self.next >= self.view.size:
            return False
        some = self.view.get(self.next, step)
        self.next += len(some)
        self.data += self.inflate.decompress(some)
        return bool(some)

    def upto(self, n: int) -> bytes:
        while len(self.data) < n and self.more():
            pass
        return self.data

    def end(self) -> int:
        if self.length and not self.inflate.eof:
            return self.start + self.length
        while not self.inflate.eof and self.more():
            self.data = b"" if not self.inflate.eof else self.data
        return self.next - len(self.inflate.unused_data)


def parse_header(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def records(view: _View, start: int, end: int, wanted: Callable[[dict], bool], decode: bool) -> Iterator[tuple[dict, bytes | None]]:
    """(header, block) of the wanted records that begin in start .. end; the block is None unless ``decode``,
    but for its HTTP header, which is always there up to its blank line."""
    at = start
    while at < end:
        zipped = view.get(at, 2) == b"\x1f\x8b"
        if zipped:
            source = _Inflated(view, at)
            head, ask = b"", 1 << 12
            while (cut := (head := source.upto(ask)).find(b"\r\n\r\n")) < 0 and len(head) >= ask:
                ask *= 4
        else:
            ask = 1 << 12
            while (cut := (head := view.get(at, min(ask, view.size - at))).find(b"\r\n\r\n")) < 0 and len(head) >= ask:
                ask *= 4
        if cut < 0:
            raise ValueError("a record's header doesn't end")
        header = parse_header(head[:cut])
        length = int(header["content-length"])
        if wanted(header):
            body = cut + 4
            need = body + (length if decode else min(length, 1 << 12))
            while True:
                data = source.upto(need) if zipped else view.get(at, need)
                # without the payload, read on until the HTTP header's blank line, however long that header is
                if decode or need == body + length or b"\r\n\r\n" in data[body:need] or len(data) < need:
                    break
                need = body + min(length, 4 * (need - body))
            if decode and len(data) < need:
                raise ValueError("a record is cut short")
            yield header, data[body:need]
        at = source.end() if zipped else at + cut + 4 + length + 4


def _listed(path: str) -> tuple[pyarrow.fs.FileSystem, list[tuple[str, int, int]]]:
    """(file system, splits): from the manifests if the folder has any, else a split for each file."""
    system, root = pyarrow.fs.FileSystem.from_uri(path)
    info = system.get_file_info(root)
    files = [info] if info.type == pyarrow.fs.FileType.File else system.get_file_info(pyarrow.fs.FileSelector(root))
    splits = []
    manifests = [f for f in files if f.base_name.startswith("_manifest-")]
    for f in manifests:
        for name, cuts in json.loads(system.open_input_stream(f.path).read()):
            splits += [(f"{root}/{name}", a, b) for a, b in zip(cuts, cuts[1:], strict=False)]
    if not manifests:
        splits = [(f.path, 0, f.size) for f in files if f.path.endswith((".warc", ".warc.gz"))]
    return system, sorted(splits)


class Part(InputPartition):
    def __init__(self, file: str, start: int, end: int):
        self.file, self.start, self.end = file, start, end


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "true") == "true"
        self.verify = options.get("verify", "false") == "true"
        self.tests: list[tuple[str, str, object]] = []
        if types := options.get("record_types"):
            self.tests.append(("record_type", "in", tuple(types.split(","))))

    def wanted(self, header: dict) -> bool:
        for name, kind, value in self.tests:
            own = _plain(name, header.get(HEADERS[name]))
            if own is None or kind == "in" and own not in value or kind == "starts" and not own.startswith(value):
                return False
        return True

    def partitions(self) -> list[InputPartition]:
        _, splits = _listed(self.path)
        return [Part(*s) for s in splits] or [Part("", 0, 0)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        system, _ = pyarrow.fs.FileSystem.from_uri(self.path)
        size = system.get_file_info(partition.file).size
        rows, held = [], 0
        with system.open_input_file(partition.file) as file:
            for header, block in records(_View(file, size), partition.start, partition.end, self.wanted, self.payload or self.verify):
                rows.append(self._row(header, block))
                held += len(rows[-1]["payload"] or b"") + 1000
                if held >= BATCH:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    def _row(self, header: dict, block: bytes) -> dict:
        row = {c: _plain(c, header.get(h)) for c, h in HEADERS.items()}
        http, blank, payload = block.partition(b"\r\n\r\n")
        length = None
        if header.get("content-type", "").startswith("application/http") and blank:
            said = [x for x in http.decode("latin-1").split("\r\n") if x.lower().startswith("content-length:")]
            length = int(said[0].partition(":")[2]) if said else int(header["content-length"]) - len(http) - 4
        else:
            payload, length = block, int(header["content-length"])
        if self.verify and row["record_type"] == "response" and row["payload_digest"] not in (None, base32_sha1(payload)):
            raise ValueError(f"payload digest of {row['record_id']} is wrong")
        full = self.payload and row["record_type"] != "revisit"
        return row | {"payload_length": length, "headers": list(header.items()), "payload": payload if full else None}


class PushedWarcReader(WarcReader):
    """The reader with filter push-down, which Spark only allows with spark.sql.python.filterPushdown.enabled."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in HEADERS and isinstance(f, EqualTo):
                self.tests.append((name, "in", (f.value,)))
            elif name in HEADERS and isinstance(f, In):
                self.tests.append((name, "in", tuple(f.value)))
            elif name in HEADERS and isinstance(f, StringStartsWith):
                self.tests.append((name, "starts", f.value))
            elif name in HEADERS and isinstance(f, IsNotNull):
                self.tests.append((name, "known", None))
            else:
                yield f


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, root = pyarrow.fs.FileSystem.from_uri(self.path)
        system.create_dir(root, recursive=True)
        name, at, cuts = f"part-{uuid.uuid4().hex}.warc.gz", 0, [0]
        with system.open_output_stream(f"{root}/{name}", compression=None) as out:
            for batch in iterator:
                for i in range(0, batch.num_rows, 200):
                    for row in batch.slice(i, 200).to_pylist():
                        data = member(record(row))
                        out.write(data)
                        at += len(data)
                        if at - cuts[-1] >= SPLIT:
                            cuts.append(at)
        if cuts[-1] != at:
            cuts.append(at)
        message = WriterCommitMessage()
        message.file = (name, cuts)
        return message

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root = pyarrow.fs.FileSystem.from_uri(self.path)
        with system.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps([m.file for m in messages if m is not None]).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root = pyarrow.fs.FileSystem.from_uri(self.path)
        for m in messages:
            if m is not None:
                system.delete_file(f"{root}/{m.file[0]}")


class WarcDataSource(DataSource):
    """Options for reading: ``path``, ``record_types`` (comma-separated), ``payload`` (false: leave payloads out),
    ``verify`` (true: check the digests of response payloads), ``pushdown`` (true: take filters; the session
    must have spark.sql.python.filterPushdown.enabled)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return PushedWarcReader(self.options) if self.options.get("pushdown") == "true" else WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only ever added to: use mode('append') and a new path")
        return WarcWriter(self.options)


def archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write a record for each row to ``path``.

    Of rows with equal payloads (UTF-8, null: empty) of at least ``min_bytes`` bytes, that with the largest id is
    the response and the others revisit it. Rows that share that id too, and rows without any id in their
    group, are responses. Payloads are compared by SHA-256; only (digest, id) is summed by key.
    """
    pages.sparkSession.dataSource.register(WarcDataSource)
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn("same", F.sha2("payload", 256))
    owners = rows.where(F.octet_length("payload") >= min_bytes).groupBy("same").agg(F.max("id").alias("owner"), F.count("*").alias("n"))
    owners = owners.where("n > 1").select("same", "owner")
    rows = rows.join(owners, "same", "left")
    again = F.col("owner").isNotNull() & ~F.col("id").eqNullSafe(F.col("owner"))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("")))
    digest = F.sha1("payload")
    out = rows.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), name(F.col("id")).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(date).alias("warc_date"), F.when(again, name(F.col("owner"))).alias("refers_to"),
        digest.alias("sha1"), F.octet_length("payload").cast("long").alias("payload_length"), F.when(~again, F.col("payload")).alias("payload"))

    def base32(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("sha1")
            text = pa.array([base64.b32encode(bytes.fromhex(x.as_py())).decode() for x in batch.column(at)], pa.string())
            yield batch.set_column(at, "payload_digest", text)

    kind = "record_type string, record_id string, target_uri string, warc_date string, refers_to string, payload_digest string, " \
           "payload_length long, payload binary"
    out.mapInArrow(base32, kind).write.format("warc").mode("append").save(path)


def read(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The records under ``path`` with filter push-down; see ``WarcDataSource`` for the options."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").options(**{"pushdown": "true"} | options).load(path)


def round_trip(pages: DataFrame, **params) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) as read back from freshly written archives,
    with the digest of every response payload checked."""
    spark = pages.sparkSession
    path = f"{scratch(spark)}/warc"
    archive(pages, path, **params)
    number = lambda c: F.expr(f"try_cast(substring({c}, {len('urn:page:') + 1}) AS bigint)")
    found = read(spark, path, payload="false", verify="true").where(F.col("record_type").isin("response", "revisit"))
    return found.select(
        number("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type",
        number("refers_to").alias("refers_to"))
