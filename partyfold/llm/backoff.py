"""Language-model scores by stupid backoff, with counts from the scored corpus itself.

The score of a word after a history is count(history, word) / count(history) where that n-gram
occurs at least `min_count` times in all documents; else it is `alpha` times the score after the history without its
first word. Without a history it is count(word) / words; a word below `min_count` counts
once. With 1, the default, every n-gram that occurs counts; more is a cutoff, which scores rare n-grams as unseen ones. A document's score is the sum of the logarithms over its words.

Where every n-gram counts, each one of a document is found at least in the document itself, and its score `log_score` never backs off.
`others_log_score` is the score by the counts of all other documents: what the document adds to a count, and
its words, are taken off first. N-grams that no other document has (`min_count` times) back off there, and a word that no other
document has counts once, of one word at least.

Exploded n-grams meet the count tables by hash, in packed form: documents are
portioned into chunks, each a row of its own, and for each chunk and hash bucket one row carries the chunk's
distinct n-grams of that bucket with their counts, eight bytes of hash each. A
bucket's rows meet in one task, which adds up the counts and answers each chunk with the sums of
its own n-grams, in the order in which they came, mostly one byte each; n-grams below `min_count` get 0. A frequent n-gram
therefore costs one entry per chunk, however often it occurs. The answers lie in the
shared folder by the task that made the chunk; scoring reads each chunk's texts and
answers and sums per document. Everything gathered from the corpus grows with it; the driver sees the number of words and nothing else.

Words are runs of characters between white space, A-Z in lower case. Null and empty texts
have no words and score 0. Every row gives a row, repeated ones too, and counts once for each time. Other columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partyfold.llm.buckets import Buckets
from partyfold.llm.id_files import filesystem
from partyfold.llm.storage import shared_dir
from partyfold.llm.words import U64, WHITE, Words, grams, pieces, words

_CHUNKS = "task int, chunk bigint, doc_ids array<bigint>, texts array<string>"
_PACKED = "task int, chunk bigint, size int, bucket bigint, keys binary, counts binary"
_ANSWERS = "task int, chunk bigint, size int, bucket bigint, counts binary, large binary, words bigint"
# Row groups of about 4 MB; the writer looks at its size after every chunk.
_SMALL_GROUPS = {
    "parquet.block.size": str(4 << 20),
    "parquet.block.size.row.check.min": "1",
    "parquet.block.size.row.check.max": "1",
    "parquet.page.size.row.check.min": "1",
}
_LARGE = 255  # a count of one byte that says: see the next large one


def _chunker(chunk_bytes: int):
    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for texts in pieces(batch["text"], chunk_bytes):
                own = batch.slice(texts.first_row, texts.count)
                whole = pa.array([0, texts.count], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([task], pa.int32()),
                        pa.array([number], pa.int64()),
                        pa.ListArray.from_arrays(whole, own["doc_id"]),
                        pa.ListArray.from_arrays(whole, own["text"]),
                    ],
                    ["task", "chunk", "doc_ids", "texts"],
                )
                number += 1

    return chunk


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.Array, Words, np.ndarray]]:
    """Task, number, doc_ids, words and word hashes of each chunk."""
    for batch in batches:
        for i in range(batch.num_rows):
            [texts] = pieces(batch["texts"][i].values, 1 << 62)
            found = words(texts, WHITE)
            yield batch["task"][i].as_py(), batch["chunk"][i].as_py(), batch["doc_ids"][i].values, found, found.hashes()


def _row_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in (c.split() for c in ddl.split(", "))])


def _counter(order: int, buckets: Buckets):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task, chunk, _, found, hashes in _chunk_rows(batches):
            for size in range(1, order + 1):
                every, _ = grams(hashes, found.of_text, size)
                keys, counts = np.unique(every, return_counts=True)
                place = buckets.of(keys)  # never falls from one key to the next larger one
                ends = (np.flatnonzero(np.diff(place, append=-1)) + 1).tolist()
                rows = [
                    (task, chunk, size, int(place[a]), buckets.pack(keys[a:b]), counts[a:b].astype("<u4").tobytes())
                    for a, b in zip([0, *ends], ends)
                ]
                yield _row_batch(rows, _arrow(_PACKED))

    return count


def _adder(min_count: int, buckets: Buckets):
    """Sums of a bucket, and the answers to the chunks; task -1 gets the number of words."""

    def flush(size, bucket, held):
        keys = [buckets.unpack(k) for _, _, k, _ in held]
        counts = np.concatenate([np.frombuffer(c, "<u4") for *_, c in held]).astype(np.int64)
        distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, inverse, counts)
        total[total < min_count] = 0
        rows, at = [], 0
        for (task, chunk, _, _), own in zip(held, keys):
            sums = total[inverse[at : at + len(own)]]
            at += len(own)
            short = np.minimum(sums, _LARGE).astype(np.uint8).tobytes()
            rows.append((task, chunk, size, bucket, short, sums[sums >= _LARGE].astype("<u8").tobytes(), 0))
        if size == 1:
            rows.append((-1, 0, size, bucket, b"", b"", int(counts.sum())))
        return _row_batch(rows, _arrow(_ANSWERS))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("size", "bucket", "task", "chunk", "keys", "counts")]
            for size, bucket, *row in zip(*columns):
                if (size, bucket) != now:
                    if held:
                        yield flush(*now, held)
                    now, held = (size, bucket), []
                held.append(row)
        if held:
            yield flush(*now, held)

    return add


def backoff_scores(
    counts: list[np.ndarray], firsts: np.ndarray, total: int | np.ndarray, min_count: int, alpha: float
) -> np.ndarray:
    """The logarithm for each word. `counts[n]` has for each word the count of the n + 1 words that end with
    it, 0 where it is rare; `firsts` has each word's place in its document. `total` is one number or one for each word."""
    score = np.log(np.maximum(counts[0], 1) / np.maximum(total, 1))
    for n in range(1, len(counts)):
        history = np.empty_like(counts[n - 1])
        history[1:] = counts[n - 1][:-1]
        known = (firsts >= n) & (counts[n] >= min_count)
        backed = score + log(alpha)
        higher = np.log(np.where(known, counts[n], 1) / np.where(known, history, 1))
        score = np.where(firsts >= n, np.where(known, higher, backed), score)
    return score


def _scorer(order: int, buckets: Buckets, path: str, total: int, min_count: int, alpha: float):
    def answers(store, folder, task: int, chunk: int) -> list[np.ndarray]:
        """The sums of the chunk's distinct n-grams of each size, in the order of their keys."""
        table = pads.dataset(f"{folder}/task={task}", filesystem=store, format="parquet").to_table(
            filter=pads.field("chunk") == chunk, columns=["size", "bucket", "counts", "large"]
        )
        found: list[list[np.ndarray]] = [[] for _ in range(order)]
        for size, _, counts, large in sorted(zip(*(table[c].to_pylist() for c in table.column_names))):
            sums = np.frombuffer(counts, np.uint8).astype(np.int64)
            sums[sums == _LARGE] = np.frombuffer(large, "<u8")
            found[size - 1].append(sums)
        return [np.concatenate([*own, np.zeros(0, np.int64)]) for own in found]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = filesystem(path)
        for task, chunk, doc_ids, found, hashes in _chunk_rows(batches):
            sizes = np.diff(found.of_text)
            firsts = np.arange(len(hashes)) - np.repeat(found.of_text[:-1], sizes)
            document = np.repeat(np.arange(len(sizes)), sizes)
            counts, others = [], []
            for n, sums in enumerate(answers(store, folder, task, chunk) if len(hashes) else []):
                every, _ = grams(hashes, found.of_text, n + 1)
                distinct, inverse = np.unique(every, return_inverse=True)
                if len(distinct) != len(sums):
                    raise ValueError(f"chunk {chunk} of task {task} has no full answer")
                every_word, elsewhere = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
                every_word[firsts >= n] = sums[inverse]
                # One number for each pair of a document and an n-gram: how often the document itself has it.
                pairs = document[firsts >= n] * len(distinct) + inverse
                _, pair, in_document = np.unique(pairs, return_inverse=True, return_counts=True)
                left = sums[inverse] - in_document[pair]
                elsewhere[firsts >= n] = np.where(left >= min_count, left, 0)
                counts.append(every_word)
                others.append(elsewhere)
            scores = []
            for known, words_there in ((counts, total), (others, total - np.repeat(sizes, sizes))):
                each = backoff_scores(known, firsts, words_there, min_count, alpha) if known else np.zeros(0)
                scores.append([float(each[a:b].sum()) for a, b in zip(found.of_text[:-1], found.of_text[1:])])
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(sizes, pa.int64()), *[pa.array(s, pa.float64()) for s in scores]],
                ["doc_id", "n_words", "log_score", "others_log_score"],
            )

    return score


def stupid_backoff(
    docs: DataFrame, order: int = 2, min_count: int = 1, alpha: float = 0.4,
    chunk_bytes: int = 3_900_000, bucket_bytes: int = 8 << 20,
) -> DataFrame:
    """`doc_id, n_words, log_score, others_log_score` for every row of `docs` (`doc_id`, `text`).

    `chunk_bytes` of text are one chunk, and there is one bucket for each `bucket_bytes` of text. Chunks are
    stored in row groups of a few each, so that a reader never holds many of them.
    """
    spark = docs.sparkSession
    path = shared_dir(spark)
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    writer = texts.mapInArrow(_chunker(chunk_bytes), _CHUNKS).write.option("compression", "zstd")
    for name, value in _SMALL_GROUPS.items():
        writer = writer.option(name, value)
    writer.parquet(f"{path}/chunks")
    chunks = spark.read.schema(_CHUNKS).parquet(f"{path}/chunks")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = Buckets(max(1, ceil(size / bucket_bytes)))
    packed = chunks.mapInArrow(_counter(order, buckets), _PACKED)
    (
        packed.repartition("size", "bucket").sortWithinPartitions("size", "bucket")
        .mapInArrow(_adder(min_count, buckets), _ANSWERS)
        .repartition("task").sortWithinPartitions("task", "chunk")
        .write.option("compression", "zstd").partitionBy("task").parquet(f"{path}/answers")
    )
    stored = spark.read.schema(_ANSWERS).parquet(f"{path}/answers")
    total = stored.where("task = -1").agg(F.sum("words")).first()[0] or 0
    return chunks.mapInArrow(
        _scorer(order, buckets, f"{path}/answers", total, min_count, alpha),
        "doc_id bigint, n_words bigint, log_score double, others_log_score double",
    )
