"""Token ids as binary files with Elias-Fano encoded document boundaries.

A file holds the ids of consecutive documents, one after another, and where each document ends.
The boundaries are an ascending sequence, stored as Elias and Fano do: the low bits of each
number in a packed array, the high bits as gaps in unary, about two bits and the low
bits for each document. The position of every `SAMPLE`-th one in the unary part is kept, so a boundary is
found by looking at a few bytes. The layout, all numbers little-endian:

    magic, version, width of an id in bytes, bits of a low part        8 + 3 x 4 bytes
    documents, ids, unary bits, samples                                4 x 8 bytes
    doc_ids, 8 bytes each; whether each is null, one bit each
    low parts; unary part; samples, 4 bytes each
    ids

Documents are sorted by doc_id, then by text, across and within files, a null doc_id first.
Each task writes files of a bounded number of ids, under new names, and returns a row for
each; these rows, written through Spark's own commit, are the manifest. A task that is run again
writes other files, and what no row names does not exist. The first id of a file follows from the
number of ids in those before it.

Null and empty texts have only the end id. Repeated rows are written one by one. An
empty table gives an empty manifest. Other columns are ignored.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partyfold.llm.byte_bpe import tokenizer
from partyfold.llm.storage import shared_dir, written

MAGIC = b"IDFILE\0\1"
SAMPLE = 256
_HEAD = struct.Struct("<8sIII4Q")


class EliasFano:
    """An ascending sequence of numbers from 0 in near-minimal space."""

    def __init__(self, count: int, low_bits: int, low: np.ndarray, high: np.ndarray, high_bits: int, samples: np.ndarray):
        self.count, self.low_bits, self.high_bits = count, low_bits, high_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        if len(values) and (values[0] < 0 or (np.diff(values) < 0).any()):
            raise ValueError("the sequence has to ascend from 0 or more")
        top = int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // max(1, len(values))).bit_length() - 1)
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> low_bits) + np.arange(len(values))
        unary = np.zeros(int(ones[-1]) + 1 if len(ones) else 0, np.uint8)
        unary[ones] = 1
        samples = ones[::SAMPLE].astype(np.uint32)
        return cls(len(values), low_bits, low, np.packbits(unary, bitorder="little"), len(unary), samples)

    def _low(self, first: int, end: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(end - first, np.int64)
        a, b = first * self.low_bits, end * self.low_bits
        bits = np.unpackbits(self.low[a // 8 : -(-b // 8)], bitorder="little")[a % 8 :][: b - a]
        return bits.reshape(-1, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits))

    def select(self, i: int) -> int:
        """Place of the i-th one in the unary part."""
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        while True:
            byte = at // 8
            bits = np.unpackbits(self.high[byte : byte + 64], bitorder="little")
            bits[: at % 8] = 0
            ones = np.flatnonzero(bits)
            if left < len(ones):
                return byte * 8 + int(ones[left])
            left -= len(ones)
            at = (byte + 64) * 8

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.count:
            raise IndexError(i)
        return (self.select(i) - i) << self.low_bits | int(self._low(i, i + 1)[0])

    def slice(self, first: int, end: int) -> np.ndarray:
        """The values of some places; only the bits between the first and the last of them are unpacked."""
        if end <= first:
            return np.zeros(0, np.int64)
        a, b = self.select(first), self.select(end - 1)
        start = a // 8 * 8
        ones = np.flatnonzero(np.unpackbits(self.high[a // 8 : b // 8 + 1], bitorder="little")) + start
        ones = ones[(ones >= a) & (ones <= b)]
        return ((ones - np.arange(first, end)) << self.low_bits) | self._low(first, end)

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little")[: self.high_bits])
        return ((ones - np.arange(self.count)) << self.low_bits) | self._low(0, self.count)


def write_file(out: io.IOBase, doc_ids: list[int | None], ends: np.ndarray, ids: np.ndarray, width: int) -> None:
    """One file: `ends` tells where the ids of each document end."""
    bounds = EliasFano.of(ends)
    missing = np.array([d is None for d in doc_ids], np.uint8)
    out.write(_HEAD.pack(MAGIC, 1, width, bounds.low_bits, len(doc_ids), len(ids), bounds.high_bits, len(bounds.samples)))
    out.write(np.array([d or 0 for d in doc_ids], "<i8").tobytes())
    out.write(np.packbits(missing, bitorder="little").tobytes())
    for part in (bounds.low, bounds.high, bounds.samples.astype("<u4"), ids.astype(f"<u{width}")):
        out.write(part.tobytes())


class IdFile:
    """A file opened for reading; documents are read one at a time or all in turn."""

    def __init__(self, source):
        self._source = source
        head = source.read(_HEAD.size)
        magic, version, self.width, low_bits, count, self.n_ids, high_bits, samples = _HEAD.unpack(head)
        if magic != MAGIC or version != 1:
            raise ValueError("not an id file")
        self.doc_ids = np.frombuffer(source.read(8 * count), "<i8")
        self.missing = np.unpackbits(
            np.frombuffer(source.read(-(-count // 8)), np.uint8), count=count, bitorder="little"
        ).astype(bool)
        low = np.frombuffer(source.read(-(-count * low_bits // 8)), np.uint8)
        high = np.frombuffer(source.read(-(-high_bits // 8)), np.uint8)
        sampled = np.frombuffer(source.read(4 * samples), "<u4")
        self.ends = EliasFano(count, low_bits, low, high, high_bits, sampled)
        self._data = source.tell()

    def bounds(self, i: int) -> tuple[int, int]:
        return (self.ends[i - 1] if i else 0), self.ends[i]

    def ids(self, first: int, end: int) -> np.ndarray:
        self._source.seek(self._data + first * self.width)
        return np.frombuffer(self._source.read((end - first) * self.width), f"<u{self.width}")


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


_MANIFEST = "task int, place int, file string, n_docs bigint, n_ids bigint"


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, file_ids: int = 1 << 24) -> DataFrame:
    """Write the ids of every text under `path`; returns the manifest with each file's first id.

    A file is closed at the document with which it has `file_ids` ids or more.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        encoder = tokenizer(tokenizer_path)
        width = 2 if max(encoder.size, end_id) < 1 << 16 else 4
        store, folder = filesystem(path)
        store.create_dir(folder, recursive=True)
        held: list = [[], [], []]
        rows = []

        def close() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.ids"
            ids = np.concatenate(held[2])
            with store.open_output_stream(f"{folder}/{name}") as out:
                write_file(out, held[0], np.cumsum(np.concatenate(held[1])), ids, width)
            row = [task, len(rows), name, len(held[0]), len(ids)]
            rows.append(row)
            for own in held:
                own.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                ["task", "place", "file", "n_docs", "n_ids"],
            )

        total = 0
        for batch in batches:
            for lo, hi in _portions(batch["text"]):
                texts = [t or "" for t in batch["text"].slice(lo, hi - lo).to_pylist()]
                ids, bounds = encoder.encode(texts)
                sizes = np.diff(bounds)
                with_end = np.insert(ids.astype(f"<u{width}"), bounds[1:], end_id)
                held[0] += batch["doc_id"].slice(lo, hi - lo).to_pylist()
                held[1].append(sizes + 1)
                held[2].append(with_end)
                total += len(with_end)
                if total >= file_ids:
                    yield close()
                    total = 0
        if held[0]:
            yield close()

    ordered = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    # Ranges are drawn by doc_id alone: the sample for them goes to the driver, and texts must not.
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = written(ordered.mapInArrow(write, _MANIFEST), "manifest")
    # One row per file, so this window sees a few rows for a great many documents.
    before = Window.orderBy("task", "place").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _portions(texts: pa.Array, max_bytes: int = 2 << 20) -> Iterator[tuple[int, int]]:
    sizes = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in texts])
    ends = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        limit = (ends[lo - 1] if lo else 0) + max_bytes
        hi = max(lo + 1, int(np.searchsorted(ends, limit, side="right")))
        yield lo, hi
        lo = hi


def read_ids(manifest: DataFrame, path: str, batch_ids: int = 1 << 22) -> DataFrame:
    """`doc_id, start, n_tokens, ids_crc32` of every document, read back from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = filesystem(path)
        for batch in batches:
            for name, first_id in zip(batch["file"].to_pylist(), batch["first_id"].to_pylist()):
                with store.open_input_file(f"{folder}/{name}") as source:
                    own = IdFile(source)
                    lo = 0
                    while lo < own.ends.count:
                        base, _ = own.bounds(lo)
                        hi = max(lo + 1, bisect_right(own.ends, base + batch_ids, lo, own.ends.count))
                        ends = own.ends.slice(lo, hi)
                        starts = np.concatenate([[base], ends[:-1]])
                        ids = own.ids(base, int(ends[-1])).astype("<u4")
                        view = memoryview(ids).cast("B")
                        crc = [
                            zlib.crc32(view[4 * (a - base) : 4 * (b - base)])
                            for a, b in zip(starts.tolist(), ends.tolist())
                        ]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(own.doc_ids[lo:hi], pa.int64(), mask=own.missing[lo:hi]),
                                pa.array(starts + first_id),
                                pa.array(ends - starts),
                                pa.array(crc, pa.int64()),
                            ],
                            ["doc_id", "start", "n_tokens", "ids_crc32"],
                        )
                        lo = hi

    spread = manifest.select("file", "first_id").repartition("file")
    return spread.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write the ids of `docs` to the shared folder and read them back."""
    path = f"{shared_dir(docs.sparkSession)}/ids"
    return read_ids(write_ids(docs, path, tokenizer_path, end_id), path)
