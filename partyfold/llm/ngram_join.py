"""N-gram Jaccard join: documents linked by the similarity of their shingle sets.

A document's set holds its distinct shingles of `words` words; a document with fewer words
has one shingle, all of them; one without words has an empty set and links with nothing.
Two documents link when the intersection is at least `num / den` of the union.

**Candidates.** Sets whose similarity reaches the threshold and whose sizes lie in one size
range differ in at most H shingles. Each set is dealt by hash into somewhat more than H parts, so
some parts are the same in both; a hash of a part's contents is a signature. Sizes of
neighbouring ranges meet because the larger sets of a range also sign for the next one. A part
that is empty would be a poor signature and is none; sets with so many empty parts that
all equal ones could be empty sign once more with another seed. Shingles that are common in a
sample of the texts count only with the last seed, or texts with a line in common would be candidates. No link
can be missed, and documents without a near copy share no signature.

The same count tells how many signatures two linked sets share at least, often dozens. Signatures
travel in packed form, once for each set of a portion, to the task of a hash bucket. A
signature with few sets makes a list of them, one with many sets ties every set to the first, so that neither takes
more room than the sets do. Lists go on to the task of their first set, where those that share enough with it are tied
to it. Pairs are made of the rest only, and pairs that share fewer signatures than linked sets do are no candidates.

**Search.** Documents that share signatures, directly or through others, form a candidate
component, which is gathered once, in blocks of a bounded number of shingles. Within a block,
or between two blocks, each document is a T-occurrence query against the inverted lists of
the others: DivideSkip keeps the longest lists apart, merges the others with a heap that
skips ids which cannot reach the threshold any more, and probes the long lists by binary
search for the survivors only.

Equal sets are one node from the start; of links inside a block only those that join two
groups of it are returned, so a group of copies never becomes a table of pairs. Set equality
and shingles are judged by 64-bit hashes.

Null texts count as empty. Repeated rows are copies like any others. A null doc_id gives a
row; it never names a component that has another id. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from math import ceil, exp, log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partyfold.llm.buckets import Buckets
from partyfold.llm.components import components
from partyfold.llm.prefilter import with_ids
from partyfold.llm.storage import Workspace, written
from partyfold.llm.words import U64, WHITE, grams, mix, pieces, signed, words

_SEEDS = 3


# Sets


def shingle_sets(
    column: pa.Array, size: int, portion: int = 1_900_000
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Portions of (first row, sorted distinct shingle hashes, offsets of the documents)."""
    for texts in pieces(column, portion):
        found = words(texts, WHITE)
        hashes = found.hashes()
        of_runs, text = grams(hashes, found.of_text, size)
        counts = np.diff(found.of_text)
        bounds = np.searchsorted(text, np.arange(texts.count + 1))
        sets = []
        for i in range(texts.count):
            if 0 < counts[i] < size:
                at = found.of_text[i : i + 1]
                whole = mix(np.full(1, counts[i], U64))
                for k in range(counts[i]):
                    whole = mix(whole + hashes[at + k])
                sets.append(whole)
                continue
            own = np.sort(of_runs[bounds[i] : bounds[i + 1]])
            keep = np.empty(len(own), bool)
            if len(own):
                keep[0] = True
                np.not_equal(own[1:], own[:-1], out=keep[1:])
            sets.append(own[keep])
        sizes = np.array([len(s) for s in sets])
        yield texts.first_row, np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)])


def per_document(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups, some of them empty."""
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def node_hash(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A hash of each whole set."""
    return mix(per_document(mix(hashes), offsets) + np.diff(offsets).astype(U64))


# Signatures


@cache
def _ranges(num: int, den: int) -> list[int]:
    """Upper ends of the size ranges; each is at least two thresholds wide."""
    ends = [1]
    while ends[-1] < 1 << 40:
        ends.append(max(ends[-1] + 1, -(-ends[-1] * den * den // (num * num))))
    return ends


def _difference(end: int, num: int, den: int) -> int:
    """The largest difference of two linked sets of at most `end` shingles."""
    return 2 * end * (den - num) // (den + num)


@cache
def _parts(place: int, num: int, den: int) -> int:
    """Parts for the sets of a size range, and for those of the range before that reach it.

    More than the difference, by as many as may be empty even in the smallest of these sets,
    so that few sets have to sign with a second seed; small sets cannot have that with
    certainty and get the fewest parts with which it is likely.
    """
    ends = _ranges(num, den)
    most = _difference(ends[place], num, den)
    if not most:
        return 1
    smallest = max(1, (ends[place - 1] if place else 1) * num // den)
    for deviations in (3, 1, 0):
        parts = most + 1
        while parts < 2 * most + 2:
            empty = parts * exp(-smallest / parts)
            if parts - most >= 1 + empty + deviations * sqrt(empty):
                return parts
            parts += 1 + parts // 100
    return most + 1


def signatures(
    hashes: np.ndarray, offsets: np.ndarray, num: int, den: int,
    chosen: np.ndarray | None = None, common: np.ndarray | None = None,
) -> tuple[np.ndarray, ...]:
    """Signatures of the documents of a portion, or of the `chosen` ones.

    For each signature its document, its value, a label of size range and seed, and how many
    signatures of that label a linked document shares at least; of two documents the larger
    number holds. `common` has sorted shingles that count only with the last seed.
    """
    sizes = np.diff(offsets)
    rare = np.ones(len(hashes), bool)
    if common is not None and len(common) and len(hashes):
        rare = common[np.minimum(np.searchsorted(common, hashes), len(common) - 1)] != hashes
    if chosen is not None:
        asked = np.zeros(len(sizes), bool)
        asked[chosen] = True
        signing = asked & (sizes > 0)
    else:
        signing = sizes > 0
    ends = np.array(_ranges(num, den))
    own = np.searchsorted(ends, sizes)
    meets_next = sizes * den > ends[own] * num
    docs = np.concatenate([np.flatnonzero(signing), np.flatnonzero(signing & meets_next)])
    ranges = np.concatenate([own[signing], own[signing & meets_next] + 1])
    known = range(int(ranges.max(initial=0)) + 1)
    parts = np.array([_parts(k, num, den) for k in known])
    sure = parts - np.array([_difference(int(ends[k]), num, den) for k in known])
    docs, ranges = docs[parts[ranges] > 1], ranges[parts[ranges] > 1]
    found: list[tuple[np.ndarray, ...]] = []
    for seed in range(_SEEDS):
        if not len(docs):
            break
        last = seed == _SEEDS - 1
        base = np.concatenate([[0], np.cumsum(parts[ranges])])
        lengths = sizes[docs]
        at = np.repeat(offsets[docs] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        at = at + np.arange(lengths.sum())
        entry = np.repeat(np.arange(len(docs)), lengths)
        if not last:
            at, entry = at[rare[at]], entry[rare[at]]
        values = mix(hashes[at] + U64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
        slot = base[entry] + (values % parts[ranges][entry].astype(U64)).astype(np.int64)
        total = np.zeros(base[-1], U64)
        np.add.at(total, slot, mix(values))
        filled = np.full(base[-1], last)
        filled[slot] = True
        entry = np.repeat(np.arange(len(docs)), parts[ranges])
        part = np.arange(base[-1]) - base[entry]
        label = ranges * _SEEDS + seed
        value = mix(total + mix((label[entry] * (1 << 40) + part).astype(U64)))
        # Two linked sets agree in `sure` parts, of which only those can be empty that are so in both.
        empty = np.bincount(entry[~filled], minlength=len(docs))
        need = sure[ranges] - empty
        kept = entry[filled]
        found.append((docs[kept], value[filled], label[kept], need[kept]))
        docs, ranges = docs[need < 1], ranges[need < 1]
    if not found:
        return (np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    return tuple(np.concatenate(column) for column in zip(*found))


def _noder(size: int):
    """Set size and node of every row."""

    def node(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, hashes, offsets in shingle_sets(batch["text"], size):
                sizes = np.diff(offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(row, len(sizes)),
                        batch["row_key"].slice(row, len(sizes)),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(signed(node_hash(hashes, offsets))),
                    ],
                    ["doc_id", "row_key", "n_shingles", "node"],
                )

    return node


def _common_shingles(
    texts: DataFrame, rows: DataFrame, size: int, sample: int, least: int = 4, most: int = 500_000
) -> np.ndarray:
    """Shingles that several texts of a sample hold, sorted; of at most `sample` texts, at most `most`.

    Parts made of such shingles alone would tie texts that share a line. Which shingles these are
    is no matter for the result: any set of them gives the same links.
    """

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, hashes, _ in shingle_sets(batch["text"], size):
                yield pa.RecordBatch.from_arrays([pa.array(signed(hashes))], ["shingle"])

    keys = (
        rows.groupBy("node").agg(F.min("row_key").alias("chosen"))
        .orderBy(F.xxhash64("chosen")).limit(sample).select("chosen")
    )
    chosen = texts.join(F.broadcast(keys), F.col("row_key") == F.col("chosen")).select("text")
    held = chosen.mapInArrow(shingles, "shingle bigint").groupBy("shingle").count()
    found = held.where(F.col("count") >= least).orderBy(F.desc("count"), "shingle").limit(most)
    return np.sort(np.array([r["shingle"] for r in found.collect()], np.int64).view(U64))


def _signer(size: int, num: int, den: int, buckets: Buckets, common: np.ndarray):
    """Signatures of all rows in packed form: for each bucket nodes, signatures of each node, signatures."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, hashes, offsets in shingle_sets(batch["text"], size):
                nodes = node_hash(hashes, offsets)
                _, first = np.unique(nodes, return_index=True)
                docs, values, label, need = signatures(hashes, offsets, num, den, np.sort(first), common)
                place = buckets.of(values)
                order = np.lexsort((label, docs, place))
                docs, label, need, place = docs[order], label[order], need[order], place[order]
                begin = np.flatnonzero(_changes(place, docs, label))
                count = np.diff(np.append(begin, len(docs)))
                columns = [_narrow(x) for x in (label[begin], np.maximum(need[begin], 0), count)]
                columns, widths = [nodes[docs[begin]].astype("<u8"), *columns], bytes(c.itemsize for c in columns)
                short = _shortened(values[order])
                edge = np.flatnonzero(_changes(place[begin]))
                bounds = list(zip(edge.tolist(), [*edge[1:].tolist(), len(begin)]))
                ends = np.append(begin, len(docs)).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(place[begin[edge]], pa.int64()),
                        pa.array([widths + b"".join(c[i:j].tobytes() for c in columns) for i, j in bounds], pa.binary()),
                        pa.array([short[ends[i] : ends[j]].tobytes() for i, j in bounds], pa.binary()),
                    ],
                    ["bucket", "entries", "signatures"],
                )

    return sign


_ENTRY = np.dtype([("node", "<u8"), ("label", "<u4"), ("need", "<u4"), ("count", "<u4")])
_MEMBER = np.dtype([("node", "<u8"), ("need", "<u4")])
_LISTS = "deal bigint, label int, shared int, members binary"
_PAIRS = "a bigint, b bigint, label int, need int, shared int"
_TIED = -1  # the label of lists whose first member is tied to each of the others
_SHORT = 5


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Which of some rows differ from the one before."""
    fresh = np.ones(len(columns[0]), bool)
    fresh[1:] = False
    for x in columns:
        fresh[1:] |= x[1:] != x[:-1]
    return fresh


def _narrow(x: np.ndarray) -> np.ndarray:
    most = int(x.max(initial=0))
    return x.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4")


def _shortened(values: np.ndarray) -> np.ndarray:
    """The low 40 bits of signatures, which bucket and label add to. Two that are alike by chance make a pair to look at."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_SHORT])


def _unpacked(raw_entries: bytes, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Signatures under their labels, and the entry of each."""
    widths = raw_entries[:3]
    n, at = (len(raw_entries) - 3) // (8 + sum(widths)), 3
    head = np.empty(n, _ENTRY)
    for name, width in zip(_ENTRY.names, (8, *widths)):
        head[name] = np.frombuffer(raw_entries, f"<u{width}", n, at)
        at += n * width
    entry = np.repeat(head, head["count"])
    values = np.zeros((len(entry), 8), np.uint8)
    values[:, :_SHORT] = np.frombuffer(raw, np.uint8).reshape(-1, _SHORT)
    return values.view("<u8").ravel().astype(U64) | (entry["label"].astype(U64) << U64(8 * _SHORT)), entry


class _Bucket:
    """The signatures of a bucket that few nodes share, and the first node of those that many share."""

    def __init__(self, small: int):
        self.small = small
        self.key, self.entry = np.zeros(0, U64), np.zeros(0, _ENTRY)
        self.large, self.center = np.zeros(0, U64), np.zeros(0, U64)

    def settle(self, key: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Add signatures; returns ties of nodes to the first of many."""
        ties = []
        if len(self.large):
            at = np.minimum(np.searchsorted(self.large, key), len(self.large) - 1)
            many = self.large[at] == key
            ties.append(np.stack([self.center[at[many]], entry["node"][many]], axis=1))
            key, entry = key[~many], entry[~many]
        key, entry = np.concatenate([self.key, key]), np.concatenate([self.entry, entry])
        order = np.lexsort((entry["node"], key))
        key, entry = key[order], entry[order]
        fresh = _changes(key, entry["node"])
        key, entry = key[fresh], entry[fresh]
        first = np.flatnonzero(_changes(key))
        size = np.diff(np.append(first, len(key)))
        many = np.repeat(size > self.small, size)
        ties.append(np.stack([np.repeat(entry["node"][first], size)[many], entry["node"][many]], axis=1))
        large = first[size > self.small]
        at = np.searchsorted(self.large, key[large])
        self.large, self.center = np.insert(self.large, at, key[large]), np.insert(self.center, at, entry["node"][large])
        self.key, self.entry = key[~many], entry[~many]
        found = np.concatenate(ties)
        return np.unique(found[found[:, 0] != found[:, 1]], axis=0)

    def lists(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The nodes that share a signature, by number of nodes: labels, signatures with these nodes, entries."""
        key, entry = self.key, self.entry
        first = np.flatnonzero(_changes(key))
        size = np.diff(np.append(first, len(key)))
        for n in range(2, self.small + 1):
            own = first[size == n]
            if not len(own):
                continue
            rows = entry[own[:, None] + np.arange(n)]
            rows = rows[rows["need"].max(axis=1) > 0]  # else all have signed again with another seed
            whole = mix(rows["label"][:, 0])
            for k in range(n):
                whole = mix(whole + rows["node"][:, k])
            _, at, times = np.unique(whole, return_index=True, return_counts=True)
            if len(at):
                yield rows["label"][at, 0], times, rows[at]


def _tier(buckets: Buckets, small: int, at_once: int = 500_000):
    """Lists of nodes that share signatures of a bucket, with their number, and ties where many nodes share one.

    A list is dealt by its first node, ties by their center and a hash of the other node.
    """

    def table(deal, label, shared, members: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        ends = np.concatenate([[0], np.cumsum(count * _MEMBER.itemsize)]).astype(np.int32)
        packed = pa.Array.from_buffers(pa.binary(), len(count), [None, pa.py_buffer(ends), pa.py_buffer(members.tobytes())])
        columns = [pa.array(signed(np.ascontiguousarray(deal, U64)))]
        columns += [pa.array(np.ascontiguousarray(x, np.int32)) for x in (label, shared)]
        return pa.RecordBatch.from_arrays([*columns, packed], ["deal", "label", "shared", "members"])

    def tied(pair: np.ndarray) -> pa.RecordBatch:
        center, node = pair[:, 0], pair[:, 1]
        part = mix(node) >> U64(58)
        order = np.lexsort((node, part, center))
        center, node, part = center[order], node[order], part[order]
        first = np.flatnonzero(_changes(center, part))
        count = np.diff(np.append(first, len(node)))
        members = np.zeros(len(node) + len(first), _MEMBER)
        heads = first + np.arange(len(first))
        others = np.ones(len(members), bool)
        others[heads] = False
        members["node"][heads], members["node"][others] = center[first], node
        return table(
            mix(center[first] + mix(part[first])), np.full(len(first), _TIED), np.ones(len(first)), members, count + 1
        )

    def listed(own: _Bucket) -> Iterator[pa.RecordBatch]:
        for label, times, rows in own.lists():
            members = np.empty(rows.shape, _MEMBER)
            members["node"], members["need"] = rows["node"], rows["need"]
            yield table(rows["node"][:, 0], label, times, members, np.full(len(rows), rows.shape[1]))

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, _Bucket(small)
        keys, entries, held = [], [], 0
        for batch in batches:
            for bucket, raw_entries, raw in zip(*(batch[c].to_pylist() for c in ("bucket", "entries", "signatures"))):
                if (bucket != now or held > at_once) and keys:
                    yield tied(own.settle(np.concatenate(keys), np.concatenate(entries)))
                    keys, entries, held = [], [], 0
                if bucket != now:
                    yield from listed(own)
                    now, own = bucket, _Bucket(small)
                key, entry = _unpacked(raw_entries, raw)
                keys.append(key)
                entries.append(entry)
                held += len(key)
        if keys:
            yield tied(own.settle(np.concatenate(keys), np.concatenate(entries)))
        yield from listed(own)

    return tie


def _weighed(label: np.ndarray, shared: np.ndarray, count: np.ndarray, members: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Ties and pairs of some lists, as columns of `_PAIRS`.

    Where the lists alone show that a node shares enough with the first of its list, the two are tied. Pairs of
    nodes that are both tied to the first of their list need not be counted in it; of the others
    each pair is there with the signatures it shares in all these lists.
    """
    head = np.cumsum(count) - count
    row = np.repeat(np.arange(len(count)), count)
    other = np.ones(len(members), bool)
    other[head] = False
    node, need, center = members["node"], members["need"].astype(np.int64), members["node"][head][row]

    def ties(which: np.ndarray) -> tuple[np.ndarray, ...]:
        n = len(which)
        return center[which], node[which], np.full(n, _TIED), np.zeros(n, int), np.ones(n, int)

    simple = label[row] == _TIED
    found = [ties(np.flatnonzero(simple & other))]
    at = np.flatnonzero(~simple & other)
    at = at[np.lexsort((label[row[at]], node[at], center[at]))]
    together = ~other | simple
    if len(at):
        pair = np.flatnonzero(_changes(center[at], node[at]))
        own = np.flatnonzero(_changes(center[at], node[at], label[row[at]]))
        needed = np.maximum(need[at[own]], need[head[row[at[own]]]])
        enough = (needed > 0) & (np.add.reduceat(shared[row[at]], own) >= needed)
        strong = np.logical_or.reduceat(enough, np.searchsorted(own, pair))
        found.append(ties(at[pair[strong]]))
        together[at] = np.repeat(strong, np.diff(np.append(pair, len(at))))
    loose = np.unique(row[~together])
    both = []
    for n in np.unique(count[loose]).tolist():
        rows = loose[count[loose] == n]
        for i in range(n):
            for j in range(i):
                one, two = head[rows] + j, head[rows] + i
                most = np.maximum(need[one], need[two])
                keep = (most > 0) & ~(together[one] & together[two])
                both.append((node[one[keep]], node[two[keep]], label[rows[keep]], most[keep], shared[rows[keep]]))
    if both:
        a, b, kind, most, times = (np.concatenate(x) for x in zip(*both))
        order = np.lexsort((kind, b, a))
        a, b, kind, most, times = a[order], b[order], kind[order], most[order], times[order]
        own = np.flatnonzero(_changes(a, b, kind))
        if len(own):
            found.append((a[own], b[own], kind[own], most[own], np.add.reduceat(times, own)))
    return found


def _weigher(at_once: int = 500_000):
    """Ties and pairs of lists that are sorted by `deal`, some at a time and those of one first node together."""

    def table(columns: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        a, b, *rest = (np.concatenate(x) for x in zip(*columns))
        arrays = [pa.array(signed(np.ascontiguousarray(x, U64))) for x in (a, b)]
        arrays += [pa.array(x.astype(np.int32)) for x in rest]
        return pa.RecordBatch.from_arrays(arrays, ["a", "b", "label", "need", "shared"])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = batch["members"].to_pylist()
            count = np.array([len(x) for x in raw]) // _MEMBER.itemsize
            plain = [batch[c].to_numpy() for c in ("deal", "label", "shared")]
            held.append((*plain, count, np.frombuffer(b"".join(raw), _MEMBER)))
            size += len(held[-1][-1])
            if size > at_once:
                deal, label, shared, count, members = (np.concatenate(x) for x in zip(*held))
                edge = np.flatnonzero(_changes(deal))[-1] or len(deal)
                place = int(count[:edge].sum())
                yield table(_weighed(label[:edge], shared[:edge], count[:edge], members[:place]))
                held = [(deal[edge:], label[edge:], shared[edge:], count[edge:], members[place:])]
                size = len(members) - place
        if size:
            yield table(_weighed(*(np.concatenate(x) for x in list(zip(*held))[1:])))

    return weigh


# Search


def required(query: int, other: int, num: int, den: int) -> int:
    """The smallest intersection with which sets of these sizes link."""
    return -(-num * (query + other) // (num + den))


def merge_skip(lists: list[list[int]], bar: int) -> dict[int, int]:
    """Ids in at least `bar` of the sorted lists, and in how many, by a heap over their heads."""
    heap = [(own[0], i, 0) for i, own in enumerate(lists) if own]
    heapify(heap)
    found: dict[int, int] = {}
    while len(heap) >= bar:
        top = heap[0][0]
        same = []
        while heap and heap[0][0] == top:
            same.append(heappop(heap))
        if len(same) >= bar:
            found[top] = len(same)
            for _, i, at in same:
                if at + 1 < len(lists[i]):
                    heappush(heap, (lists[i][at + 1], i, at + 1))
            continue
        # No id below the new top can occur in enough of the lists taken off.
        while heap and len(same) < bar - 1:
            same.append(heappop(heap))
        if not heap:
            break
        goal = heap[0][0]
        for _, i, at in same:
            at = bisect_left(lists[i], goal, at)
            if at < len(lists[i]):
                heappush(heap, (lists[i][at], i, at))
    return found


def divide_skip(
    lists: list[np.ndarray], least: int, need: Callable[[np.ndarray], np.ndarray], weight: float = 0.001
) -> dict[int, int]:
    """Ids that occur in enough of the sorted lists, with the number of lists.

    `need` tells how many lists each of some ids has to be in, never fewer than `least`. The longest lists are
    set aside, as many as pays; an id has to occur in `least - set aside` of the others to
    be looked up in them at all, and the search for it ends when it cannot reach its need.
    """
    if least < 1 or len(lists) < least:
        return {}
    lists = sorted(lists, key=len)
    aside = min(least - 1, int(least / (weight * log2(max(2, len(lists[-1]))) + 1)))
    merged, probed = lists[: len(lists) - aside], lists[len(lists) - aside :]
    found = merge_skip([own.tolist() for own in merged], least - aside)
    ids, times = np.array(list(found), np.int64), np.array(list(found.values()), np.int64)
    wanted = need(ids)
    for left, own in zip(range(len(probed), -1, -1), [*probed, None]):
        alive = times + left >= wanted
        if not alive.all():
            ids, times, wanted = ids[alive], times[alive], wanted[alive]
        if not len(ids) or own is None:
            break
        at = np.minimum(np.searchsorted(own, ids), len(own) - 1)
        times = times + (own[at] == ids)
    return dict(zip(ids.tolist(), times.tolist()))


class _Forest:
    """Groups of the documents of a block."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def links_within(
    sets: list[np.ndarray], is_query: np.ndarray, is_indexed: np.ndarray, num: int, den: int
) -> Iterator[tuple[int, int]]:
    """Links between queries and indexed sets, without those that follow from others."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets) if sets else np.zeros(0, U64)
    indexed = is_indexed[owner]
    order = np.argsort(values[indexed], kind="stable")
    keys, ids = values[indexed][order], owner[indexed][order]
    distinct, first = np.unique(keys, return_index=True)
    last = np.append(first[1:], len(keys))
    sizes = np.array([len(s) for s in sets])
    forest = _Forest(len(sets))

    def need(others: np.ndarray) -> np.ndarray:
        return -(-num * (len(own) + sizes[others]) // (num + den))

    for q in np.flatnonzero(is_query).tolist():
        own = sets[q]
        if not len(own) or not len(distinct):
            continue
        smallest = -(-num * len(own) // den)
        least = required(len(own), smallest, num, den)
        at = np.minimum(np.searchsorted(distinct, own), len(distinct) - 1)
        at = at[distinct[at] == own]
        begin, end = first[at], last[at]
        if is_indexed[q]:
            begin, end = begin[end - begin > 1], end[end - begin > 1]
        if len(begin) < least:
            continue
        lists = [ids[a:b] for a, b in zip(begin.tolist(), end.tolist())]
        if is_indexed[q]:  # a pair is found by the later of the two
            lists = [own[: np.searchsorted(own, q)] for own in lists if own[0] < q]
        for other in divide_skip(lists, least, need):
            if forest.join(q, other):
                yield q, other


def _searcher(size: int, num: int, den: int):
    def flush(nodes: list[int], sides: list[int], sets: list[np.ndarray]):
        node, side = np.array(nodes), np.array(sides)
        one_block = not side.any()
        pairs = links_within(sets, side == 0, np.full(len(side), True) if one_block else side == 1, num, den)
        found = [(node[a], node[b]) for a, b in pairs]
        return pa.RecordBatch.from_arrays(
            [pa.array([int(p[k]) for p in found], pa.int64()) for k in (0, 1)], ["a", "b"]
        )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, sides, sets, seen = None, [], [], [], set()
        for batch in batches:
            keys = list(zip(*(batch[c].to_pylist() for c in ("label", "x", "y"))))
            node, side = batch["node"].to_pylist(), batch["side"].to_pylist()
            for row, hashes, offsets in shingle_sets(batch["text"], size):
                own = signed(node_hash(hashes, offsets))
                for i in range(len(offsets) - 1):
                    at = row + i
                    if own[i] != node[at]:
                        continue  # another row with the same key
                    if keys[at] != key:
                        if len(sets) > 1:
                            yield flush(nodes, sides, sets)
                        key, nodes, sides, sets, seen = keys[at], [], [], [], set()
                    if node[at] in seen:
                        continue
                    seen.add(node[at])
                    nodes.append(node[at])
                    sides.append(side[at])
                    sets.append(hashes[offsets[i] : offsets[i + 1]])
        if len(sets) > 1:
            yield flush(nodes, sides, sets)

    return search


# The join


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    num: int = 80,
    den: int = 100,
    block_shingles: int = 150_000,
    bucket_shingles: int = 700_000,
    sample: int = 4000,
    small: int = 24,
) -> DataFrame:
    """`doc_id, n_shingles, component_id` for every row of `docs` (`doc_id`, `text`).

    `component_id` is the smallest doc_id that links lead to. `block_shingles` bounds what a
    search task holds; a candidate component with more is searched block by block.
    There is one bucket of signatures for each `bucket_shingles`. A `sample` of texts tells which
    shingles are common, and up to `small` sets with one signature are compared by how many they
    share; both change the number of candidates, not the result.
    """
    columns = ["doc_id", "n_shingles", "component_id"]
    return _grouped(docs, columns, words, num, den, block_shingles, bucket_shingles, sample, small)


def near_duplicate_rows(
    docs: DataFrame,
    words: int = 5,
    num: int = 80,
    den: int = 100,
    block_shingles: int = 150_000,
    bucket_shingles: int = 700_000,
    sample: int = 4000,
    small: int = 24,
) -> DataFrame:
    """`doc_id, n_shingles, row_key, label` for every row of `docs`; rows with one label are linked.

    `row_key` is that of the row, see there; the label of a row without words is null.
    """
    columns = ["doc_id", "n_shingles", "row_key", "label"]
    return _grouped(docs, columns, words, num, den, block_shingles, bucket_shingles, sample, small)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A hash of id and text: the same for repeated rows alone, also where the id is null."""
    return F.xxhash64(F.col(doc_id).cast("bigint"), F.col(text).cast("string"))


def _grouped(
    docs: DataFrame, columns: list[str], words: int, num: int, den: int,
    block_shingles: int, bucket_shingles: int, sample: int, small: int,
) -> DataFrame:
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("row_key", row_key())
    with Workspace(docs.sparkSession) as space:
        rows = space.written(
            texts.mapInArrow(
                _noder(words), "doc_id bigint, row_key bigint, n_shingles bigint, node bigint"
            ),
            "rows",
        )
        nodes = space.written(
            rows.where("n_shingles > 0").groupBy("node").agg(
                F.min("doc_id").alias("first"),
                F.min("row_key").alias("key"),
                F.first("n_shingles").alias("size"),
            ),
            "nodes",
        )
        shingles = nodes.agg(F.sum("size")).first()[0] or 0
        buckets = Buckets(max(1, ceil(shingles / bucket_shingles)))
        common = _common_shingles(texts, rows, words, sample)
        packed = texts.mapInArrow(
            _signer(words, num, den, buckets, common),
            "bucket bigint, entries binary, signatures binary",
        )
        lists = packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
            _tier(buckets, small), _LISTS
        )
        shared = lists.repartition("deal").sortWithinPartitions("deal").mapInArrow(_weigher(), _PAIRS)
        ties = (
            shared.groupBy("a", "b", "label")
            .agg(F.max("need").alias("need"), F.sum("shared").alias("shared"))
            .where("shared >= need").select("a", "b")
        )
        candidates = components(ties, space)
        links = _searched(texts, nodes, candidates, words, num, den, block_shingles, space)
        linked = components(links, space)
        named = nodes.join(linked, "node", "left").select(
            "node", "first", F.coalesce("label", "node").alias("label")
        )
        smallest = named.groupBy("label").agg(F.min("first").alias("component_id"))
        classes = named.join(smallest, "label").select("node", "label", "component_id")
        own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
        return written(
            rows.join(classes, "node", "left").withColumn("component_id", own).select(*columns),
            "groups",
        )


def _searched(
    texts: DataFrame, nodes: DataFrame, candidates: DataFrame, size: int, num: int, den: int,
    block: int, space: Workspace,
) -> DataFrame:
    members = nodes.join(candidates, "node")
    weight = members.groupBy("label").agg(
        F.ceil(F.sum("size") / F.lit(block)).cast("int").alias("blocks")
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = space.written(
        members.join(weight, "label").select(
            "key", "node", "label", "blocks", own.alias("block")
        ),
        "placed",
    )
    # A document stands in one row per block that its own block is searched against.
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    found = with_ids(texts, "row_key", placed, "key", "inner")
    dealt = found.select("node", "label", "block", "text", every).select(
        "label",
        F.least("block", "other").alias("x"),
        F.greatest("block", "other").alias("y"),
        F.when(F.col("block") > F.col("other"), 1).otherwise(0).alias("side"),
        "node",
        "text",
    )
    return space.written(
        dealt.repartition("label", "x", "y").sortWithinPartitions("label", "x", "y")
        .mapInArrow(_searcher(size, num, den), "a bigint, b bigint"),
        "links",
    )
