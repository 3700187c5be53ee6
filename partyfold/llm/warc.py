"""WARC archives as a Spark data source, and the archiving of web pages.

`spark.dataSource.register(WarcSource)` makes `spark.read.format("warc")` and
`df.write.format("warc")` known; `register` does that and allows filters to be pushed down.

**Reading.** Files are planned into partitions by size. A partition reads a record's headers
first and tests the predicates pushed down on them (record type, ids, URI, date, digest);
a payload is decoded only for records that pass. Records that do not are stepped over: by
Content-Length in a plain file, and by the compressed length that the writer puts into each gzip
member's extra field in a compressed one, so their payloads are not even inflated. Members
without that field are inflated to find their end. With the option `payload` set to `false` no
payload is decoded at all.

**Writing.** Every task writes files of its own, with new names, and a file is closed at about
`file_bytes`. They appear in the folder's manifest only when the job commits, and readers
follow the manifest where there is one; so a task that fails or runs twice leaves
nothing that is read. A folder without a manifest is read by its file names.

**Pages.** Of pages with equal payloads of at least `least_bytes` the one with the smallest page_id is a
response and the others are revisits that refer to it; smaller payloads are always
responses. A null html is an empty payload, a null url leaves the target out. Rows that share the smallest
page_id are all responses. A page with a null page_id never takes the place of one
that has an id. An empty table gives an empty archive. Other columns are ignored.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from partyfold.llm.id_files import filesystem
from partyfold.llm.prefilter import with_ids, without_ids
from partyfold.llm.storage import shared_dir, written

SCHEMA = (
    "record_id string, record_type string, target_uri string, warc_date string, refers_to string, "
    "payload_digest string, payload_bytes bigint, payload binary"
)
MANIFEST = "_warc_manifest"  # the begin of the name: every write has a list of its own

#: Header names of the format, by column.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
}
_VERSION = b"WARC/1.1\r\n"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP_HEAD = struct.Struct("<4sIBBH")
_SKIP_FIELD = struct.Struct("<2sHII")  # "sl", its size, compressed and plain length


# Records


def _header_value(text: str) -> str:
    return text.replace("\r", "%0D").replace("\n", "%0A")


def record_bytes(row: dict) -> bytes:
    """One record; `payload_bytes` is the size of the payload, which a revisit leaves out."""
    payload = bytes(row.get("payload") or b"") if row["record_type"] != "revisit" else b""
    size = row.get("payload_bytes")
    block = payload
    lines = [f"{HEADERS[c]}: {_header_value(row[c])}" for c in HEADERS if row.get(c) is not None]
    if row["record_type"] in ("response", "revisit"):
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload) if size is None else size}\r\n\r\n"
        block = http.encode() + payload
        lines.append("Content-Type: application/http; msgtype=response")
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {_REVISIT_PROFILE}")
    lines.append(f"Content-Length: {len(block)}")
    return _VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 4) -> bytes:
    """A gzip member that tells its own length in its extra field."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    length = _GZIP_HEAD.size + _SKIP_FIELD.size + len(body) + 8
    return (
        _GZIP_HEAD.pack(b"\x1f\x8b\x08\x04", 0, 0, 255, _SKIP_FIELD.size)
        + _SKIP_FIELD.pack(b"sl", 8, length, len(data) & 0xFFFFFFFF)
        + body
        + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    )


def parse_headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    pairs = (line.partition(":") for line in lines[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


class _Plain:
    """Records of an uncompressed file."""

    def __init__(self, source, chunk: int = 1 << 16):
        self._source, self._chunk = source, chunk
        self._at, self._end = 0, source.size()

    def __iter__(self):
        while self._at < self._end:
            head, at = b"", self._at
            while b"\r\n\r\n" not in head:
                self._source.seek(at)
                more = self._source.read(self._chunk)
                if not more:
                    if head.strip():
                        raise ValueError("the file ends within a record's headers")
                    return
                head, at = head + more, at + len(more)
            raw, _, _ = head.partition(b"\r\n\r\n")
            headers = parse_headers(raw)
            begin = self._at + len(raw) + 4
            size = int(headers["content-length"])
            yield headers, lambda begin=begin, size=size: self._block(begin, size)
            self._at = begin + size + 4

    def _block(self, begin: int, size: int) -> bytes:
        self._source.seek(begin)
        return self._source.read(size)


class _Gzip:
    """Records of a file with one gzip member for each."""

    def __init__(self, source, chunk: int = 1 << 14):
        self._source, self._chunk, self._end = source, chunk, source.size()

    def __iter__(self):
        at = 0
        while at < self._end:
            member = _Member(self._source, at, self._chunk)
            head = member.until(b"\r\n\r\n")
            headers = parse_headers(head)
            size = int(headers["content-length"])
            yield headers, lambda m=member, skip=len(head) + 4, size=size: m.plain(skip + size)[skip:]
            at = member.end()


class _Member:
    """A gzip member, inflated only as far as asked for."""

    def __init__(self, source, at: int, chunk: int):
        self._source, self._at, self._chunk = source, at, chunk
        self._inflate = zlib.decompressobj(31)
        self._data = bytearray()
        self._next = at
        source.seek(at)
        head = source.read(_GZIP_HEAD.size + _SKIP_FIELD.size)
        self._length = None
        if len(head) >= _GZIP_HEAD.size + _SKIP_FIELD.size and head[3] & 4:
            mark, width, length, _ = _SKIP_FIELD.unpack(head[_GZIP_HEAD.size :])
            if mark == b"sl" and width == 8:
                self._length = length

    def _more(self) -> bool:
        if self._inflate.eof:
            return False
        self._source.seek(self._next)
        raw = self._source.read(self._chunk)
        if not raw:
            raise ValueError("the file ends within a record")
        self._data += self._inflate.decompress(raw)
        self._next += len(raw) - len(self._inflate.unused_data)
        return True

    def until(self, mark: bytes) -> bytes:
        while (found := self._data.find(mark)) < 0:
            if not self._more():
                raise ValueError("a record without headers")
        return bytes(self._data[:found])

    def plain(self, size: int) -> bytes:
        while len(self._data) < size and self._more():
            pass
        return bytes(self._data[:size])

    def end(self) -> int:
        if self._length is not None:
            return self._at + self._length
        while self._more():
            self._data.clear()
        return self._next


def records(source) -> Iterator:
    """(headers, function that decodes the block) of each record of an open file."""
    magic = source.read(2)
    source.seek(0)
    return iter(_Gzip(source) if magic == b"\x1f\x8b" else _Plain(source))


def split_http(block: bytes) -> tuple[int | None, bytes]:
    """Content-Length and payload of an HTTP response."""
    head, _, payload = block.partition(b"\r\n\r\n")
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            return int(value), payload
    return None, payload


# The data source


@dataclass
class _Files(InputPartition):
    paths: list[str] = field(default_factory=list)


_TESTS = {
    EqualTo: lambda f, v: v is not None and v == f.value,
    EqualNullSafe: lambda f, v: v == f.value,
    In: lambda f, v: v is not None and v in f.value,
    IsNotNull: lambda f, v: v is not None,
    StringStartsWith: lambda f, v: v is not None and v.startswith(f.value),
}


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.with_payload = options.get("payload", "true").lower() != "false"
        self.partition_bytes = int(options.get("partitionBytes", 64 << 20))
        self.pushed: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                self.pushed.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        """Files in order, as many in a partition as stay below the wanted size."""
        store, folder = filesystem(self.path)
        found = []
        info = store.get_file_info(folder)
        if info.type == pafs.FileType.File:
            found = [info]
        else:
            lists = _lists(store, folder)
            if lists:
                names = [f"{folder}/{n}" for own in lists.values() for n in own]
                found = store.get_file_info(names) if names else []
            else:
                every = store.get_file_info(pafs.FileSelector(folder, recursive=True))
                found = [f for f in every if f.path.endswith((".warc", ".warc.gz"))]
        result: list[_Files] = []
        held = 0
        for f in sorted(found, key=lambda f: f.path):
            if not result or held + f.size > self.partition_bytes:
                result.append(_Files([]))
                held = 0
            result[-1].paths.append(f.path)
            held += f.size
        return result or [_Files([])]

    def read(self, partition: _Files) -> Iterator[tuple]:
        store, _ = filesystem(self.path)
        for path in partition.paths:
            with store.open_input_file(path) as source:
                for headers, block in records(source):
                    row = {c: headers.get(name.lower()) for c, name in HEADERS.items()}
                    if all(_TESTS[type(f)](f, row[f.attribute[0]]) for f in self.pushed):
                        yield self._row(row, headers, block)

    def _row(self, row: dict, headers: dict, block) -> tuple:
        http = headers.get("content-type", "").startswith("application/http")
        size, payload = int(headers["content-length"]), None
        if http and (self.with_payload or row["record_type"] == "revisit"):
            told, payload = split_http(block())
            size = told if row["record_type"] == "revisit" else len(payload)
        elif http:
            size = None
        elif self.with_payload:
            payload = block()
        if row["record_type"] == "revisit" or not self.with_payload:
            payload = None
        return (*row.values(), size, payload)


@dataclass
class _Written(WriterCommitMessage):
    files: list[str] = field(default_factory=list)


class WarcWriter(DataSourceWriter):
    def __init__(self, options, overwrite: bool):
        self.path = options["path"]
        self.overwrite = overwrite
        self.compressed = options.get("compression", "gzip").lower() != "none"
        self.file_bytes = int(options.get("fileBytes", 128 << 20))

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        store, folder = filesystem(self.path)
        store.create_dir(folder, recursive=True)
        names: list[str] = []
        out, size = None, 0
        for row in iterator:
            if out is None or size >= self.file_bytes:
                if out is not None:
                    out.close()
                names.append(f"{uuid.uuid4().hex}.warc" + ".gz" * self.compressed)
                out, size = store.open_output_stream(f"{folder}/{names[-1]}", compression=None), 0
            data = record_bytes(row.asDict())
            data = gzip_member(data) if self.compressed else data
            out.write(data)
            size += len(data)
        if out is not None:
            out.close()
        return _Written(names)

    def commit(self, messages) -> None:
        store, folder = filesystem(self.path)
        store.create_dir(folder, recursive=True)
        names = [n for m in messages if m is not None for n in m.files]
        before = _lists(store, folder) if self.overwrite else {}
        # Nothing is changed in place: the list is there as a whole or not at all, and writers at the same time each add one.
        fresh = f"{folder}/{MANIFEST}-{uuid.uuid4().hex}"
        with store.open_output_stream(f"{fresh}.unfinished") as out:
            out.write(json.dumps(names).encode())
        store.move(f"{fresh}.unfinished", f"{fresh}.json")
        for path in before:
            store.delete_file(path)
        for name in [n for own in before.values() for n in own]:
            store.delete_file(f"{folder}/{name}")

    def abort(self, messages) -> None:
        store, folder = filesystem(self.path)
        for name in [n for m in messages if m is not None for n in m.files]:
            store.delete_file(f"{folder}/{name}")


def _lists(store: pafs.FileSystem, folder: str) -> dict[str, list[str]]:
    """The lists of written files, by path."""
    found = {}
    for info in store.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
        if info.base_name.startswith(MANIFEST) and info.base_name.endswith(".json"):
            with store.open_input_stream(info.path) as source:
                found[info.path] = json.loads(source.read())
    return found


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# Pages


def page_records(pages: DataFrame, least_bytes: int = 100, warc_date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """The records of `pages` (`page_id`, `url`, `html`), in the columns of `SCHEMA`.

    Payloads are not shuffled: pages without a copy pass a bitmap of the copied digests, copies meet the
    digests without their payloads, and of the pages that are first of their digest there is one for each.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    known = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("target_uri"),
        payload.alias("payload"),
    ).withColumns({"digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("bigint")})
    copies = written(
        known.where(F.col("payload_bytes") >= least_bytes).groupBy(F.col("digest").alias("copied"))
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select(
            "first_id", F.xxhash64("copied").alias("copied"), F.xxhash64("copied", "first_id").alias("first")
        ),
        "copies",
    )
    keyed = known.withColumns({"of": F.xxhash64("digest"), "own": F.xxhash64("digest", "page_id")})
    whole = without_ids(keyed, "of", copies.select("copied"), "copied").unionAll(
        with_ids(keyed, "own", copies.select("first"), "first")
    )
    light = with_ids(keyed.drop("payload"), "of", copies.select("copied", "first_id"), "copied", "inner")
    again = light.where(~F.col("page_id").eqNullSafe(F.col("first_id")))

    def records(rows: DataFrame, kind: str, refers_to: Column, payload: Column) -> DataFrame:
        return rows.select(
            page_urn("page_id").alias("record_id"),
            F.lit(kind).alias("record_type"),
            "target_uri",
            F.lit(warc_date).alias("warc_date"),
            refers_to.alias("refers_to"),
            F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
            "payload_bytes",
            payload.alias("payload"),
        )

    responses = records(whole, "response", F.lit(None).cast("string"), F.col("payload"))
    return responses.unionAll(records(again, "revisit", page_urn("first_id"), F.lit(None).cast("binary")))


def page_urn(column: str):
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))


def page_of(column: str):
    """The page_id in a record id."""
    number = F.regexp_extract(column, "^<urn:page:(-?[0-9]+)>$", 1)
    return F.when(number != "", number.cast("bigint"))


def archive(pages: DataFrame, **options) -> DataFrame:
    """Write `pages` as WARC files to the shared folder; returns the scan of them."""
    spark = pages.sparkSession
    register(spark)
    path = f"{shared_dir(spark)}/warc"
    page_records(pages, **options).write.format("warc").mode("append").save(path)
    return spark.read.format("warc").load(path)


def archived_pages(scan: DataFrame) -> DataFrame:
    """What the archives say about each page. A response's size and digest are taken from its payload."""
    response = F.col("record_type") == "response"
    return scan.where(F.col("record_type").isin("response", "revisit")).select(
        page_of("record_id").alias("page_id"),
        "payload_bytes",
        F.when(response, F.sha2("payload", 256))
        .otherwise(F.replace("payload_digest", F.lit("sha256:"), F.lit(""))).alias("payload_digest"),
        "record_type",
        page_of("refers_to").alias("refers_to"),
    )
