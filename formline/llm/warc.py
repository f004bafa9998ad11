"""WARC archives: a Python data source to write and read them, and revisit records for repeated payloads."""

from __future__ import annotations

import io
import json
import re
import struct
import uuid
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

#: Column of a header, in the order written. Fixed names of the WARC 1.1 format.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "warc_date": "WARC-Date",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "profile": "WARC-Profile",
    "content_type": "Content-Type",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"
SCHEMA = (
    ", ".join(f"{c} string" for c in HEADERS)
    + ", headers map<string,string>, content_length long, payload binary, file string, offset long"
)
MANIFEST = "_manifest.json"
TESTS = {
    EqualTo: lambda v, x: v is not None and v == x,
    In: lambda v, x: v is not None and v in x,
    GreaterThan: lambda v, x: v is not None and v > x,
    GreaterThanOrEqual: lambda v, x: v is not None and v >= x,
    LessThan: lambda v, x: v is not None and v < x,
    LessThanOrEqual: lambda v, x: v is not None and v <= x,
    StringStartsWith: lambda v, x: v is not None and v.startswith(x),
    StringEndsWith: lambda v, x: v is not None and v.endswith(x),
    StringContains: lambda v, x: v is not None and x in v,
    IsNull: lambda v, x: v is None,
    IsNotNull: lambda v, x: v is not None,
}


def file_system(path: str):
    """The file system of a path or URI, and the path there; what pyarrow can open, executors can."""
    from pyarrow import fs

    if re.match(r"file:", path):
        path = "file:///" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class Files(InputPartition):
    paths: tuple

    def __init__(self, paths):
        super().__init__(0)
        self.paths = tuple(paths)


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcDataSource(DataSource):
    """``format("warc")``: path, and the options

    * ``payload``: ``true`` (default) or ``false``, to leave all payloads undecoded;
    * ``partitionBytes``: files are planned together up to this size (64 MB);
    * ``fileBytes``: a task that writes begins a new file beyond it (256 MB);
    * ``level``: of compression (1).

    Reading an empty folder gives no rows. Headers that a record lacks are null.
    Several tasks may write a partition; only files named in the manifest, which
    the commit writes last, are read.
    """

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options), schema.names, overwrite)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options, self.wanted = options, []

    def pushFilters(self, filters):
        for f in filters:
            path = getattr(f, "attribute", ())  # Not has a child instead
            column = path[0] if len(path) == 1 else None
            if type(f) in TESTS and column in HEADERS:
                self.wanted.append((column, type(f).__name__, getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        from pyarrow import fs

        system, root = file_system(self.options["path"])
        infos = [i for i in system.get_file_info(fs.FileSelector(root, allow_not_found=True)) if i.is_file]
        if any(i.base_name == MANIFEST for i in infos):
            with system.open_input_stream(f"{root}/{MANIFEST}") as f:
                named = set(json.loads(f.read()))
            infos = [i for i in infos if i.base_name in named]
        infos = sorted((i for i in infos if re.search(r"\.warc(\.gz)?$", i.base_name)), key=lambda i: i.path)
        most, parts, room = int(self.options.get("partitionbytes", self.options.get("partitionBytes", 64 << 20))), [], 0
        for i in infos:
            if not parts or room + i.size > most:
                parts.append([])
                room = 0
            parts[-1].append(i.path)
            room += i.size
        return [Files(p) for p in parts] or [Files([])]

    def read(self, partition):
        import pyarrow as pa

        system, _ = file_system(self.options["path"])
        tests = {t.__name__: f for t, f in TESTS.items()}
        keep = lambda row: all(tests[kind](row[c], x) for c, kind, x in self.wanted)
        decode = str(self.options.get("payload", "true")).lower() == "true"
        kinds = [(c, pa.string()) for c in HEADERS]
        kinds += [("headers", pa.map_(pa.string(), pa.string())), ("content_length", pa.int64()), ("payload", pa.binary()), ("file", pa.string()), ("offset", pa.int64())]
        rows, size = [], 0
        for path in partition.paths:
            with system.open_input_file(path) as raw:
                for row in records(io.BufferedReader(raw, 1 << 20), keep, decode):
                    row["file"] = path
                    rows.append(row)
                    size += 500 + len(row["payload"] or b"")
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, pa.schema(kinds))


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, names: list, overwrite: bool):
        self.options, self.names, self.overwrite = options, names, overwrite

    def write(self, iterator):
        from pyspark import TaskContext

        system, root = file_system(self.options["path"])
        system.create_dir(root, recursive=True)
        most = int(self.options.get("filebytes", self.options.get("fileBytes", 256 << 20)))
        level = int(self.options.get("level", 1))
        files, out, size = [], None, 0
        try:
            for batch in iterator:
                for row in _rows(batch):
                    if out is None or size > most:
                        if out:
                            out.close()
                        files.append(f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz")
                        out = system.open_output_stream(f"{root}/{files[-1]}", compression=None)
                        info = {"record_type": "warcinfo", "record_id": f"<urn:uuid:{uuid.uuid4()}>", "content_type": "application/warc-fields"}
                        size = out.write(member(record_bytes(info, b"format: WARC File Format 1.1\r\n"), level))
                    size += out.write(member(row, level))
        finally:
            if out:
                out.close()
        return Written(files)

    def commit(self, messages):
        system, root = file_system(self.options["path"])
        system.create_dir(root, recursive=True)
        named = [f for m in messages if m for f in m.files]
        if not self.overwrite:
            try:
                with system.open_input_stream(f"{root}/{MANIFEST}") as f:
                    named = json.loads(f.read()) + named
            except FileNotFoundError:
                pass
        with system.open_output_stream(f"{root}/{MANIFEST}") as f:
            f.write(json.dumps(sorted(named)).encode())

    def abort(self, messages):
        system, root = file_system(self.options["path"])
        for m in messages:
            for name in m.files if m else []:
                system.delete_file(f"{root}/{name}")


def _rows(batch):
    columns = [batch[c] for c in batch.schema.names]
    for i in range(batch.num_rows):
        row = {name: c[i].as_py() for name, c in zip(batch.schema.names, columns, strict=True)}
        payload = row.pop("payload", None) or b""
        block = payload
        if (row.get("content_type") or HTTP) == HTTP and row["record_type"] in ("response", "revisit"):
            row["content_type"] = HTTP
            length = f"Content-Length: {len(payload)}\r\n" if row["record_type"] == "response" else ""
            block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{length}\r\n".encode() + payload
        yield record_bytes(row, block)


def record_bytes(row: dict, block: bytes) -> bytes:
    """One record: version, headers, block. Line breaks inside header values are percent-encoded."""
    lines = ["WARC/1.1"]
    row = {"warc_date": "1970-01-01T00:00:00Z"} | {k: v for k, v in row.items() if v is not None}
    for column, header in HEADERS.items():
        if row.get(column) is not None:
            lines.append(f"{header}: {str(row[column]).replace(chr(13), '%0D').replace(chr(10), '%0A')}")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """A gzip member of its own whose extra field (SL) gives its length, so readers can pass over it."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    length = 10 + 2 + 12 + len(body) + 8
    if length >= 2**32:
        return zlib.compress(data, level, 31)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 12) + b"SL" + struct.pack("<HII", 8, length, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _skip_length(head: bytes) -> int | None:
    if len(head) < 24 or not head[3] & 4:
        return None
    extra = head[12 : 12 + struct.unpack_from("<H", head, 10)[0]]
    while len(extra) >= 4:
        size = struct.unpack_from("<H", extra, 2)[0]
        if extra[:2] == b"SL" and size == 8:
            return struct.unpack_from("<I", extra, 4)[0]
        extra = extra[4 + size :]
    return None


def _parsed(head: bytes) -> dict:
    pairs = [line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line]
    headers = {k.strip(): v.strip() for k, v in pairs}
    lower = {k.lower(): v for k, v in headers.items()}
    row = {c: lower.get(h.lower()) for c, h in HEADERS.items()}
    return row | {"headers": list(headers.items()), "content_length": int(lower.get("content-length", 0)), "payload": None}


def _payload(row: dict, block: bytes) -> bytes:
    """What the record is about: an HTTP message's body, else the block."""
    if (row["content_type"] or "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


class _Plain:
    """Bytes of a file from a place on; what isn't wanted is passed over by a seek."""

    def __init__(self, f, at: int, end: int):
        self.f, self.at, self.end = f, at, end
        f.seek(at)

    def line(self) -> bytes:
        return self._read(self.f.readline())

    def take(self, size: int) -> bytes:
        return self._read(self.f.read(size))

    def _read(self, out: bytes) -> bytes:
        self.at += len(out)
        return out

    def skip(self, size: int) -> None:
        self.at = min(self.at + size, self.end)
        self.f.seek(self.at)

    def peek(self, size: int) -> bytes:
        out = self.f.read(2)
        self.f.seek(self.at)
        return b"" if out == b"\x1f\x8b" else out[:size]  # gzip members begin

    def rest(self) -> int:
        return self.at


class _Unpacked:
    """What gzip members unpack to, one after another, as a stream that holds a piece at a time.

    ``at`` is where the member that the next byte lies in begins in the file.
    """

    PIECE = 1 << 16

    def __init__(self, f, at: int, end: int):
        self.f, self.end, self.ready, self.passed = f, end, bytearray(), 0
        self.borders: list[tuple[int, int]] = []
        self.begin(at)

    def begin(self, at: int) -> None:
        self.read, self.unpack = at, zlib.decompressobj(31)
        self.borders.append((self.passed + len(self.ready), at))

    @property
    def at(self) -> int:
        while len(self.borders) > 1 and self.borders[1][0] <= self.passed:
            self.borders.pop(0)
        return self.borders[0][1]

    def rest(self) -> int:
        """Where the members read so far end in the file."""
        return self.read - len(self.unpack.unused_data)

    def more(self) -> bool:
        """Unpack one more piece, of the next member where this one has ended; false at the end of the members."""
        if self.unpack.eof:
            self.f.seek(self.rest())
            if self.f.read(2) != b"\x1f\x8b":
                return False
            self.begin(self.rest())
        piece = self.unpack.unconsumed_tail
        if not piece:
            self.f.seek(self.read)
            piece = self.f.read(self.PIECE)
            self.read += len(piece)
            if not piece:
                raise ValueError(f"the gzip member at byte {self.borders[-1][1]} isn't whole")
        self.ready += self.unpack.decompress(piece, 4 * self.PIECE)
        return True

    def peek(self, size: int) -> bytes:
        while len(self.ready) < size and self.more():
            pass
        return bytes(self.ready[:size])

    def take(self, size: int) -> bytes:
        out = self.peek(size)
        self._drop(len(out))
        return out

    def _drop(self, size: int) -> None:
        del self.ready[:size]
        self.passed += size

    def skip(self, size: int) -> None:
        while size > 0 and self.peek(1):
            some = min(size, len(self.ready))
            self._drop(some)
            size -= some

    def line(self) -> bytes:
        seen = 0
        while (found := self.ready.find(b"\n", seen)) < 0:
            seen = len(self.ready)
            if not self.more():
                found = seen - 1
                break
        return self.take(found + 1)


def records(f, keep=lambda row: True, decode: bool = True):
    """The records of an open file, plain or gzip, headers parsed first; blocks that aren't wanted are passed over.

    A plain record is skipped by its Content-Length. Gzip members are unpacked as
    one stream, however many records a member holds and wherever it begins; blocks
    that aren't wanted are dropped piece by piece. A member with an SL field is one
    record, and is left by its length as soon as its headers are read, unless its
    block is wanted. ``offset`` is where a plain record, or the member that a
    record begins in, begins in the file.
    """
    f.seek(0, 2)
    end, at = f.tell(), 0
    while at < end:
        f.seek(at)
        head = f.read(24)
        packed = head[:2] == b"\x1f\x8b"
        length = _skip_length(head) if packed else None
        source = (_Unpacked if packed else _Plain)(f, at, end)
        while blank := source.peek(1):
            if blank in b"\r\n":
                source.take(1)
                continue
            place, lines = source.at, []
            while (line := source.line()) not in (b"\r\n", b"\n", b""):
                lines.append(line)
            if not lines[0].startswith(b"WARC/"):
                raise ValueError(f"no WARC record at byte {place}")
            row = _parsed(b"".join(lines))
            wanted = keep(row)
            if wanted and decode:
                row["payload"] = _payload(row, source.take(row["content_length"]))
            elif length is None:
                source.skip(row["content_length"])
            if wanted:
                yield row | {"offset": place}
            if length is not None:
                break
        at = source.rest() if length is None else at + length


def register(spark: SparkSession) -> None:
    """Make ``format("warc")`` known to the session, with predicates pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def as_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", least_bytes: int = 100) -> DataFrame:
    """Pages as WARC records, one per row.

    Of rows with equal payloads of at least ``least_bytes`` bytes, the one with
    the smallest id is a response and the others revisit it, without a payload of
    their own; shorter payloads are all responses. Payloads are equal when their
    SHA-256 is. A null body is an empty payload. Rows with a null id revisit a row
    with one, or are responses; rows that repeat the smallest id are all
    responses. The smallest ids come from an aggregate, and a payload that a third
    of all rows share only makes a large, splittable join key.
    """
    body = F.coalesce(F.col(body_col), F.lit("")).cast("binary")
    base = pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"), body.alias("payload")).withColumn("__sha", F.sha2("payload", 256))
    first = (
        base.filter(F.octet_length("payload") >= least_bytes).groupBy("__sha").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
        .filter((F.col("__n") > 1) & F.col("__first").isNotNull()).drop("__n")
    )
    joined = base.join(first, "__sha", "left")
    revisit = F.col("__first").isNotNull() & ~F.col("__id").eqNullSafe(F.col("__first"))
    return joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        record_id(F.col("__id")).alias("record_id"), F.col("__url").alias("target_uri"),
        F.concat(F.lit("sha256:"), F.col("__sha")).alias("payload_digest"),
        F.when(revisit, record_id(F.col("__first"))).alias("refers_to"),
        F.when(revisit, F.lit(REVISIT_PROFILE)).alias("profile"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def record_id(col):
    """A record id that holds the page's id; without one, a random name."""
    return F.concat(F.lit("<urn:"), F.coalesce(F.concat(F.lit("page:"), col.cast("string")), F.concat(F.lit("uuid:"), F.uuid())), F.lit(">"))


def page_of(col):
    """The page id in a record id; null for others."""
    return F.regexp_extract(col, r"^<urn:page:(.*)>$", 1)


def write(records_: DataFrame, path: str, **options) -> None:
    register(records_.sparkSession)
    records_.write.format("warc").mode("append").options(**options).save(path)


def read(spark: SparkSession, path: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(**options).load(path)


def resolve_revisits(archive: DataFrame, bare: DataFrame | None = None) -> DataFrame:
    """``record_id, record_type, refers_to, payload_bytes, payload_digest`` of every response and revisit.

    Responses are measured on their payloads. Revisits are read without payloads
    (from ``bare``, the archive read with payload=false, if given) and take both
    figures from the record they refer to; where it isn't there, both are null.
    """
    responses = archive.filter("record_type = 'response'").select(
        "record_id", "record_type", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
    )
    named = responses.select(F.col("record_id").alias("refers_to"), "payload_bytes", "payload_digest").dropDuplicates(["refers_to"])
    revisits = (archive if bare is None else bare).filter("record_type = 'revisit'").select("record_id", "record_type", "refers_to")
    return responses.unionByName(revisits.join(named, "refers_to", "left"))
