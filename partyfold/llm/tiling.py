"""Benchmark decontamination by greedy string tiling.

A benchmark item is found in a document if tiles cover at least `threshold` of its words.
A tile is a run of at least `min_match` words that item and document share. The longest
shared run of words not in a tile yet becomes a tile, again and again, until none is long
enough; so a passage is found in whatever order its parts stand in the document.

Words are runs of ASCII letters and digits and of all other characters above 0x7F, A-Z in
lower case. An item with fewer than `min_match` words takes no part.

Seeds are the runs of `min_match` words of the items, a table of (run, item, places). The runs of
every document are joined with it. Before that a bitmap of the seeds, of `filter_bits` bits whatever
the benchmark, leaves out most runs that are none; a set bit lets a run through to the join, which decides. Runs that
many documents share are dealt to several tasks. For each pair of document and item the words of the
item that shared seeds cover bound what tiles can cover, and only pairs that can reach the threshold are
tiled, from their shared seeds: a tile consists of them. The tiling finds the
longest run by Karp-Rabin hashes of windows, halving the interval of possible lengths, since
a shared run of some length holds shared runs of every smaller one.

Equal texts are looked at once, of documents as of items; texts are known by a 64-bit hash. Neither items
nor seeds pass through the driver, only the bitmap.

Null and empty texts have no words and give no rows. Repeated rows, of documents or
items, are reported one by one. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partyfold.llm.prefilter import free_name, with_ids, without_ids
from partyfold.llm.storage import written
from partyfold.llm.words import ALNUM, U64, SpanHash, grams, mix, pieces, signed, words
from partyfold.operators.joins import Spread, join_one

Tile = tuple[int, int, int]

def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """The word hashes of each text."""
    result = []
    for portion in pieces(pa.array(texts, pa.large_string())):
        found = words(portion, ALNUM)
        hashes = found.hashes()
        result += [hashes[a:b] for a, b in zip(found.of_text[:-1], found.of_text[1:])]
    return result


# Tiling


def _windows(hashes: SpanHash, marked: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows without a marked word."""
    if length > len(marked):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    before = np.concatenate([[0], np.cumsum(marked)])
    at = np.flatnonzero(before[length:] == before[:-length])
    return at, hashes.of(at, at + length)


def tiles(item: np.ndarray, doc: np.ndarray, min_match: int) -> list[Tile]:
    """(start in the item, start in the document, words) of each tile, longest first.

    Of equally long runs the one that begins first in the item wins, then the one that
    begins first in the document.
    """
    in_item, in_doc = np.zeros(len(item), bool), ~np.isin(doc, item)
    of_item, of_doc = SpanHash(mix(item)), SpanHash(mix(doc))
    result: list[Tile] = []
    longest = min(len(item), len(doc))
    while longest >= min_match:
        low, high, best = min_match, longest, 0
        while low <= high:
            middle = (low + high + 1) // 2
            _, a = _windows(of_item, in_item, middle)
            _, b = _windows(of_doc, in_doc, middle)
            if np.isin(a, b).any():
                best, low = middle, middle + 1
            else:
                high = middle - 1
        if not best:
            break
        at_item, a = _windows(of_item, in_item, best)
        at_doc, b = _windows(of_doc, in_doc, best)
        longest, before = best - 1, len(result)
        for i in np.flatnonzero(np.isin(a, b)):
            start = at_item[i]
            if in_item[start : start + best].any():
                continue
            for there in at_doc[b == a[i]]:
                if in_doc[there : there + best].any():
                    continue
                if (item[start : start + best] == doc[there : there + best]).all():
                    in_item[start : start + best] = in_doc[there : there + best] = True
                    result.append((int(start), int(there), best))
                    break
        if len(result) > before:
            longest = best  # else equal hashes were no equal words
    return result


# Seeds


def _runs_of(texts: pa.Array, size: int) -> Iterator[tuple]:
    """For each portion: row of each run, run, place in its text, word hashes, words of each text, first row."""
    for portion in pieces(texts):
        found = words(portion, ALNUM)
        hashes = found.hashes()
        runs, text = grams(hashes, found.of_text, size)
        place = np.arange(len(text)) - np.searchsorted(text, text)
        yield text, runs, place, hashes, found.of_text, portion.first_row


def _gathered(text: np.ndarray, runs: np.ndarray, place: np.ndarray) -> tuple:
    """Text and run of each pair of them, the index of its first run, and the places as lists."""
    order = np.lexsort((place, runs, text))
    text, runs, place = text[order], runs[order], place[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (runs[1:] != runs[:-1])
    first = np.flatnonzero(new)
    offsets = np.append(first, len(text)).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(place.astype(np.int32)))
    return text[first], runs[first], place[first], lists


def _seeder(size: int):
    """Seeds of the items: run, item, words of the item, places, and the words of the run."""

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, runs, place, hashes, of_text, row in _runs_of(batch["text"], size):
                text, runs, place, lists = _gathered(text, runs, place)
                at = (of_text[text] + place)[:, None] + np.arange(size)
                offsets = np.arange(len(text) + 1, dtype=np.int32) * size
                own = pa.array(signed(hashes[at].reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(runs)),
                        batch["item_key"].take(pa.array(row + text)),
                        pa.array(np.diff(of_text)[text].astype(np.int32)),
                        lists,
                        pa.ListArray.from_arrays(pa.array(offsets), own),
                    ],
                    ["seed", "item_key", "item_words", "item_places", "words"],
                )

    return seed


def _bitmap(seeds: DataFrame, bits: int) -> bytes:
    """One bit for each value of the first bits of a hash, packed; at most 2**bits / 8 bytes before packing."""
    place = F.shiftrightunsigned("seed", 64 - bits) + 1  # bitmaps begin with bit 1
    rows = seeds.groupBy(F.bitmap_bucket_number(place).alias("number")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    size = 4096  # bytes of one bitmap
    whole = np.zeros(max(1 << (bits - 3), size), np.uint8)
    for row in rows.collect():
        whole[(row["number"] - 1) * size : row["number"] * size] = np.frombuffer(row["bits"], np.uint8)
    return zlib.compress(whole.tobytes(), 1)


def _prober(size: int, packed: bytes, bits: int):
    """Runs of the texts that may be seeds: text, run and places."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_set = np.frombuffer(zlib.decompress(packed), np.uint8)
        for batch in batches:
            for text, runs, place, _, _, row in _runs_of(batch["text"], size):
                at = (runs >> U64(64 - bits)).astype(np.int64)
                maybe = (is_set[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                text, runs, _, lists = _gathered(text[maybe], runs[maybe], place[maybe])
                yield pa.RecordBatch.from_arrays(
                    [batch["text_key"].take(pa.array(row + text)), pa.array(signed(runs)), lists],
                    ["text_key", "seed", "doc_places"],
                )

    return probe


# Pairs


def _covered(places: Column, size: int) -> Column:
    """Words that runs of `size` words at these places cover."""
    start = F.struct(F.lit(0).alias("total"), F.lit(-size).alias("last"))

    def step(state: Column, place: Column) -> Column:
        new = F.least(F.lit(size), place - state["last"])
        return F.struct((state["total"] + new).alias("total"), place.alias("last"))

    return F.aggregate(F.array_sort(places), start, step, lambda state: state["total"])


def _spans(places: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Every word place that the runs cover, run by run, and the run's number."""
    counts = [len(p) for p in places]
    at = np.concatenate(places)[:, None] + np.arange(size)
    return at, np.repeat(np.arange(len(places)), counts)


def pair_tiles(shared: list[dict], item_words: int, size: int) -> list[Tile]:
    """Tiles of a document and an item from the runs that they share.

    Words outside shared runs are in no tile: they are 0 in the item, and one 1 for each gap in the document.
    """
    _, numbers = np.unique(np.array([s["words"] for s in shared], np.int64), return_inverse=True)
    numbers = numbers.reshape(len(shared), size).astype(np.uint64) + U64(2)
    item = np.zeros(item_words, np.uint64)
    at, run = _spans([np.array(s["item_places"], np.int64) for s in shared], size)
    item[at] = numbers[run]
    at, run = _spans([np.array(s["doc_places"], np.int64) for s in shared], size)
    places = np.unique(at)
    gap = np.zeros(len(places), np.int64)
    gap[1:] = np.diff(places) > 1
    index = np.arange(len(places)) + np.cumsum(gap)
    doc, back = np.ones(index[-1] + 1, np.uint64), np.zeros(index[-1] + 1, np.int64)
    doc[index[np.searchsorted(places, at)]] = numbers[run]
    back[index] = places
    return [(start, int(back[there]), length) for start, there, length in tiles(item, doc, size)]


_FOUND = (
    "text_key bigint, item_key bigint, item_words int, covered_words int, coverage double, "
    "tiles array<struct<item_start:int,doc_start:int,length:int>>"
)


def _tiler(size: int, threshold: float):
    tile_type = pa.struct([(n, pa.int32()) for n in ("item_start", "doc_start", "length")])
    schema = pa.schema(
        [
            ("text_key", pa.int64()), ("item_key", pa.int64()), ("item_words", pa.int32()),
            ("covered_words", pa.int32()), ("coverage", pa.float64()), ("tiles", pa.list_(tile_type)),
        ]
    )

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in range(batch.num_rows):
                total = batch["item_words"][row].as_py()
                own = pair_tiles(batch["shared"][row].as_py(), total, size)
                covered = sum(t[2] for t in own)
                if covered >= threshold * total:
                    rows.append(
                        {
                            "text_key": batch["text_key"][row].as_py(),
                            "item_key": batch["item_key"][row].as_py(),
                            "item_words": total,
                            "covered_words": covered,
                            "coverage": covered / total,
                            "tiles": [dict(zip(("item_start", "doc_start", "length"), t)) for t in own],
                        }
                    )
            yield pa.RecordBatch.from_pylist(rows, schema)

    return tile


# Over tables


def _text() -> Column:
    return F.col("text").cast("string")


def text_key() -> Column:
    """What a text is known by."""
    return F.xxhash64(_text())


def text_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = 4,
    threshold: float = 0.7,
    filter_bits: int = 26,
    rows_per_task: int = 200_000,
) -> DataFrame:
    """One row per different text of `docs` and different text of `benchmark` found in it, written.

    `filter_bits` is the binary logarithm of the bits of the bitmap; each Python worker holds it. `rows_per_task` is
    how many documents with a common run meet it in one task.
    """
    if min_match < 1 or not 0 < threshold <= 1 or not 15 <= filter_bits <= 32:
        raise ValueError("min_match is at least 1, threshold above 0 and at most 1, filter_bits 15 to 32")
    items = benchmark.select(text_key().alias("item_key"), _text().alias("text")).dropDuplicates(["item_key"])
    seeds = written(
        items.mapInArrow(
            _seeder(min_match),
            "seed bigint, item_key bigint, item_words int, item_places array<int>, words array<bigint>",
        ),
        "seeds",
    )
    probe = _prober(min_match, _bitmap(seeds, filter_bits), filter_bits)
    texts = docs.select(text_key().alias("text_key"), _text().alias("text"))
    runs = written(
        texts.mapInArrow(probe, "text_key bigint, seed bigint, doc_places array<int>")
        .groupBy("text_key", "seed").agg(F.first("doc_places").alias("doc_places")),  # once for equal texts
        "runs",
    )
    spread = Spread(by=["text_key"], rows_per_task=rows_per_task)
    shared = join_one(runs, seeds, ["seed"], ["seed"], "inner", spread=spread)
    pairs = shared.groupBy("text_key", "item_key", "item_words").agg(
        F.collect_list(F.struct("item_places", "doc_places", "words")).alias("shared")
    )
    places = F.flatten(F.transform("shared", lambda s: s["item_places"]))
    enough = pairs.where(_covered(places, min_match) >= F.lit(threshold) * F.col("item_words"))
    # Pairs are small and take long: tasks of a size in bytes would be few and slow.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    enough = enough.repartition(tasks, "text_key", "item_key")
    return written(enough.mapInArrow(_tiler(min_match, threshold), _FOUND), "hits")


def _named(hits: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The hits once for every row of the benchmark with the item's text."""
    names = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), text_key().alias("name_key"))
    return hits.join(names, F.col("item_key") == F.col("name_key")).drop("item_key", "name_key")


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document and item found in it, with the tiles.

    `docs` has `doc_id` and `text`, `benchmark` has `item_id` and `text`. The options are those of `text_hits`.
    """
    hits = _named(text_hits(docs, benchmark, **options), benchmark)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias("key"))
    return with_ids(rows, "key", hits, "text_key", "inner").select(
        "doc_id", "item_id", "item_words", "covered_words", "coverage", "tiles"
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` in whose own text no item is found, whatever their doc_id; all columns kept."""
    hits = text_hits(docs, benchmark, **options).select("text_key").distinct()
    key = free_name(docs, "__text_key")
    return without_ids(docs.withColumn(key, text_key()), key, hits, "text_key").select(*docs.columns)


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """`doc_id, n_items, item_id, coverage, contaminated` for every row of `docs`.

    `item_id` is the item with the highest coverage, the smallest of equal ones. Rows with
    one doc_id count as one document: what is found in any of them holds for all. Rows without a
    doc_id are judged each by its own text.
    """
    hits = _named(text_hits(docs, benchmark, **options), benchmark).select("text_key", "item_id", "coverage")
    doc_id = F.col("doc_id").cast("bigint")
    rows = docs.select(
        doc_id.alias("doc_id"), F.when(doc_id.isNull(), text_key()).alias("unnamed"), text_key().alias("key")
    )
    per_doc = (
        with_ids(rows, "key", hits, "text_key", "inner")
        .groupBy(F.col("doc_id").alias("hit"), F.col("unnamed").alias("hit_text"))
        .agg(
            F.count_distinct("item_id").alias("n_items"),
            F.max("coverage").alias("coverage"),
            F.min(F.struct(-F.col("coverage"), "item_id"))["item_id"].alias("item_id"),
        )
    )
    same = F.col("doc_id").eqNullSafe(F.col("hit")) & F.col("unnamed").eqNullSafe(F.col("hit_text"))
    return rows.join(per_doc, same, "left").select(
        "doc_id",
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        "item_id",
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.col("n_items").isNotNull().alias("contaminated"),
    )
