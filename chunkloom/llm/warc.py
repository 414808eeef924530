"""WARC archives as a Spark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading plans one partition per archive, small archives together. Record headers are parsed first; filters on
``record_type``, ``record_id`` and ``url`` (equality, membership, string prefix) are pushed into the reader, and a record
they refuse is passed over: its payload is not decoded, and where its gzip member tells its length (the ``sl`` extra
field, which this writer sets) it is not even inflated. The reader makes the columns of the schema it is given;
without ``payload`` and without the option ``verify`` no payload is decoded at all. With ``verify`` the SHA-1 of each
payload is compared with its header, and a difference is an error, as is a truncated archive.

Writing makes one or more archives per task, named for the attempt; a manifest written at commit lists those of
the attempts that counted, so files of lost or repeated attempts are never read. Columns: ``record_id``, ``url``,
``payload``, ``record_type``, ``refers_to``. A response holds an HTTP header and the payload; a revisit holds the HTTP
header only and names the record it repeats. Null url: no target header. Null payload: empty. White space and control
characters in a url are percent-encoded.

Files are opened through Arrow's file systems, so a path is a local or mounted folder, or a scheme they know.
"""

import base64
import hashlib
import json
import posixpath
import re
import struct
import uuid
import zlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    StringStartsWith,
    WriterCommitMessage,
)

from chunkloom.llm.stage import Stage

SCHEMA = (
    "record_type string, record_id string, url string, date string, refers_to string, "
    "payload_digest string, payload_bytes long, payload binary"
)
ROLL_BYTES = 256 << 20
_STEP = 1 << 13
_DATE = "2020-01-01T00:00:00Z"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- writing ----------------------------------------------------------------------------


def _member(data: bytes) -> bytes:
    """One gzip member that tells its compressed and uncompressed length."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    size = 10 + 14 + len(body) + 8
    if size > 0xFFFFFFFF or len(data) > 0xFFFFFFFF:
        return b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff" + body + tail
    extra = struct.pack("<H2sHII", 12, b"sl", 8, size, len(data))
    return b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + extra + body + tail


def record_bytes(record_id, url, payload, record_type, refers_to) -> bytes:
    """A WARC record; payload digest and length are those of the full payload in revisits too."""
    payload = payload or b""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if record_type == "revisit" else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {record_type}",
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {_DATE}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if record_type == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <{refers_to}>")
    head += [
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    files: list[str] = field(default_factory=list)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        if overwrite:
            raise ValueError("WARC archives are appended to; write to a new folder instead")
        self.path, self.roll = options["path"], int(options.get("rollbytes", ROLL_BYTES))

    def write(self, iterator) -> Written:
        system, root = _open(self.path)
        system.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            columns = [batch.column(c).to_pylist() for c in ("record_id", "url", "payload", "record_type", "refers_to")]
            for values in zip(*columns, strict=True):
                if out is None:
                    files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, size = system.open_output_stream(posixpath.join(root, files[-1]), compression=None), 0
                member = _member(record_bytes(*values))
                out.write(member)
                size += len(member)
                if size > self.roll:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages) -> None:
        system, root = _open(self.path)
        system.create_dir(root, recursive=True)
        names = sorted(name for m in messages if m is not None for name in m.files)
        with system.open_output_stream(posixpath.join(root, f"_manifest-{uuid.uuid4().hex}.json")) as f:
            f.write(json.dumps(names).encode())

    def abort(self, messages) -> None:
        system, root = _open(self.path)
        for message in messages:
            for name in message.files if message is not None else []:
                system.delete_file(posixpath.join(root, name))


# --- reading ----------------------------------------------------------------------------


class Archive:
    """Records of one archive, plain or gzip by member."""

    def __init__(self, source):
        self.source, self.buffer, self.at = source, b"", 0

    def _more(self) -> bool:
        got = self.source.read(1 << 20)
        self.buffer, self.at = self.buffer[self.at :] + got, 0
        return bool(got)

    def _skip(self, n: int) -> None:
        have = len(self.buffer) - self.at
        if n <= have:
            self.at += n
        else:
            self.source.seek(self.source.tell() + n - have)
            self.buffer, self.at = b"", 0

    def _gzip(self, wanted):
        if len(self.buffer) - self.at < 64:
            self._more()
        start = self.buffer[self.at : self.at + 24]
        size = None
        if start[3] == 4 and start[12:14] == b"sl" and struct.unpack_from("<H", start, 10)[0] == 12:
            size = struct.unpack_from("<I", start, 16)[0]
        inflate = zlib.decompressobj(31)
        out, head, used = bytearray(), None, 0
        while not inflate.eof:
            if self.at == len(self.buffer) and not self._more():
                raise ValueError("truncated archive")
            piece = self.buffer[self.at : self.at + _STEP]
            out += inflate.decompress(piece)
            took = len(piece) - len(inflate.unused_data)
            self.at += took
            used += took
            if head is None and (end := out.find(b"\r\n\r\n")) >= 0:
                head = parse_head(bytes(out[:end]))
                keep, decode = wanted(head)
                if not decode and size is not None and not inflate.eof:
                    self._skip(size - used)
                    return (head, None) if keep else None
        if head is None:
            raise ValueError("a record without a header")
        if not keep:
            return None
        return head, bytes(out[end + 4 : end + 4 + int(head["content-length"])]) if decode else None

    def _plain(self, wanted):
        while (end := self.buffer.find(b"\r\n\r\n", self.at)) < 0:
            if not self._more():
                raise ValueError("truncated archive")
        head = parse_head(self.buffer[self.at : end])
        self.at = end + 4
        size = int(head["content-length"])
        keep, decode = wanted(head)
        if not keep or not decode:
            self._skip(size + 4)
            return (head, None) if keep else None
        while len(self.buffer) - self.at < size + 4:
            if not self._more():
                raise ValueError("truncated archive")
        block = self.buffer[self.at : self.at + size]
        self.at += size + 4
        return head, block

    def records(self, wanted):
        """(header, block) of records; ``wanted`` tells from a header (keep it, decode it)."""
        while self.at < len(self.buffer) or self._more():
            gzip = self.buffer[self.at : self.at + 1] == b"\x1f"
            found = self._gzip(wanted) if gzip else self._plain(wanted)
            if found is not None:
                yield found


def parse_head(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    pairs = (line.partition(":") for line in lines[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _bare(value: str | None) -> str | None:
    return value[1:-1] if value and value.startswith("<") and value.endswith(">") else value


def _columns(head: dict) -> dict:
    found = head.get("warc-payload-digest")
    length = head.get("x-payload-length")
    return {
        "record_type": head.get("warc-type"),
        "record_id": _bare(head.get("warc-record-id")),
        "url": head.get("warc-target-uri"),
        "date": head.get("warc-date"),
        "refers_to": _bare(head.get("warc-refers-to")),
        "payload_digest": found.partition(":")[2] if found and ":" in found else found,
        "payload_bytes": int(length) if length else None,
        "payload": None,
    }


@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, schema, options: dict):
        self.schema, self.path = schema, options["path"]
        self.target = int(options.get("partitionbytes", 64 << 20))
        self.verify = options.get("verify", "false").lower() == "true"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            kind = {EqualTo: "equal", In: "in", StringStartsWith: "prefix"}.get(type(f))
            if column in ("record_type", "record_id", "url") and kind:
                self.tests.append((kind, column, f.value))
            else:
                yield f

    def partitions(self):
        system, root = _open(self.path)
        listed = system.get_file_info(fs.FileSelector(root))
        manifests = [x.path for x in listed if x.base_name.startswith("_manifest-")]
        named = {n for m in manifests for n in json.loads(system.open_input_stream(m).read())}
        files = [
            x for x in listed
            if x.is_file and re.search(r"\.warc(\.gz)?$", x.base_name) and (not manifests or x.base_name in named)
        ]
        groups, size = [[]], 0
        for x in sorted(files, key=lambda x: x.path):
            if groups[-1] and size + x.size > self.target:
                groups.append([])
                size = 0
            groups[-1].append(x.path)
            size += x.size
        return [Files(g) for g in groups]

    def _passes(self, row: dict) -> bool:
        for kind, column, value in self.tests:
            have = row[column]
            if have is None or not (
                have == value if kind == "equal" else have in value if kind == "in" else have.startswith(value)
            ):
                return False
        return True

    def read(self, partition: Files):
        system, _ = _open(self.path)
        names = self.schema.fieldNames()
        kinds = {"payload": pa.binary(), "payload_bytes": pa.int64()}
        schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])
        need = "payload" in names or self.verify

        def wanted(head):
            keep = self._passes(_columns(head))
            return keep, keep and need and head.get("warc-type") != "revisit"

        def made(rows):
            return pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in rows], schema=schema)

        for path in partition.paths:
            rows, size = [], 0
            with system.open_input_file(path) as source:
                for head, block in Archive(source).records(wanted):
                    row = _columns(head)
                    if block is not None:
                        http = "application/http" in head.get("content-type", "")
                        payload = block.partition(b"\r\n\r\n")[2] if http else block
                        if self.verify and row["payload_digest"] not in (None, digest(payload)):
                            raise ValueError(f"{path}: payload of {row['record_id']} differs from its digest")
                        row |= {"payload": payload, "payload_bytes": len(payload)}
                        size += len(payload)
                    rows.append(row)
                    if size > 8 << 20 or len(rows) == 4096:
                        yield made(rows)
                        rows, size = [], 0
            if rows:
                yield made(rows)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(schema, self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let it hand filters to Python sources."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# --- archives with one response per payload -------------------------------------------------


def deduplicated(
    stage: Stage, pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Records of pages as the writer takes them.

    Of pages with equal payloads of at least ``min_bytes`` bytes, those with the smallest id are responses and the
    others revisit it; smaller payloads are all responses. Null ids come last and are nobody's target; where no page of
    a payload has an id, all are responses. Rows that repeat id and payload are alike.
    """
    html = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "utf-8")
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), html.alias("payload")
    ).withColumn("same", F.sha2("payload", 256))
    repeated = (
        rows.where(F.length("payload") >= min_bytes).groupBy("same")
        .agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
        .select(F.col("same").alias("key"), "first")
    )
    repeated = stage.table(repeated, "payloads")
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.concat(F.lit("null:"), F.uuid())))
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    return rows.join(repeated, rows["same"] == repeated["key"], "left").select(
        name("id").alias("record_id"), "url", "payload",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, name("first")).alias("refers_to"),
    )


def page_of(record_id: Column) -> Column:
    """Page id of a record id made by ``deduplicated``; null where the page had none."""
    return F.regexp_extract(record_id, r"^urn:page:(-?[0-9]+)$", 1).try_cast("long")
