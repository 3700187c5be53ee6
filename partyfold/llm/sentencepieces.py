"""SentencePiece encoding and decoding: batched Viterbi over the pieces and scores of a model file.

The segmentation with the highest sum of scores wins, as in the library's unigram models;
of equal sums the one whose last piece is longest. The file's pieces and scores are taken
as they are. For a file of another kind (one made by merging pairs) the result is the
best segmentation by those scores, which is not always the one the merges lead to.

A space is put in front of a text that is not empty, spaces become U+2581, nothing else is normalised.
No piece holds that mark after another character, so text falls into words that begin
with marks and each is segmented by itself. A character that is no piece costs ten more than
the lowest score and becomes the byte pieces of its UTF-8 form.

All distinct words of a portion advance together, byte by byte. Substring hashes probe the
sorted keys of the pieces, one pass for each piece length; at each place a maximum over the
pieces that end there is taken for all words at once and its length stored. Backpointers are
followed for all words at once as well. Words of more than `LONG` bytes go one by one
over the same matches.

Decoding joins pieces and bytes, turns marks into spaces and drops the first space; bytes
that are no UTF-8 become U+FFFD. Text comes back as it was, but for U+2581, which comes back as a space.

A null text gives null ids, an empty one none. Control ids decode to nothing, ids outside the model are an
error. Repeated rows change nothing. Other columns stay, but for those
with the names of new ones, which are replaced. An empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partyfold.llm.memo import Memo, slices
from partyfold.llm.words import SpanHash, Texts, U64, _byte_values, pieces

LONG = 64
_MARK = "▁"
_UNKNOWN_PENALTY = 10.0
_FILTER_BITS = 22


class Pieces:
    """The pieces of a model file, sorted by hash."""

    def __init__(self, path: str, remember: int = 300_000):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.size = size
        self.bytes: list[bytes] = [b""] * size
        self.byte_id = np.full(256, -1, np.int32)
        scores = np.zeros(size)
        ordinary = []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.bytes[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.bytes[i] = piece.replace(_MARK, " ").encode()
                scores[i] = model.get_score(i)
                ordinary.append(i)
        if max(map(len, self.bytes)) >= LONG:
            raise ValueError("a piece is too long")
        if any(_MARK in model.id_to_piece(i).lstrip(_MARK) for i in ordinary):
            raise ValueError("a piece reaches over the begin of a word")
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte pieces")
        self.unknown = scores[ordinary].min() - _UNKNOWN_PENALTY
        flat = np.frombuffer(b"".join(self.bytes[i] for i in ordinary), np.uint8)
        ends = np.cumsum([len(self.bytes[i]) for i in ordinary])
        starts = ends - [len(self.bytes[i]) for i in ordinary]
        hashes = SpanHash(_byte_values(), flat).of(starts, ends)
        order = np.argsort(hashes)
        self.keys = hashes[order]
        self.ids = np.array(ordinary, np.int32)[order]
        self.scores = scores[self.ids]
        self.lengths = np.unique(ends - starts)
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[self.keys >> U64(64 - _FILTER_BITS)] = True
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.sizes = np.array([len(b) for b in self.bytes])
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])
        self.seen = Memo(remember)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place among the hashes, place among the keys) of those that are pieces."""
        at = np.flatnonzero(self.maybe[hashes >> U64(64 - _FILTER_BITS)])
        key = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        real = self.keys[key] == hashes[at]
        return at[real], key[real]


@cache
def model(path: str) -> Pieces:
    """Read once in each worker process."""
    return Pieces(path)


def _char_bytes(first: np.ndarray) -> np.ndarray:
    """Bytes of the UTF-8 character with each first byte; 0 inside a character."""
    return np.select([first < 0x80, first < 0xC0, first < 0xE0, first < 0xF0], [1, 0, 2, 3], 4)


def _prepared(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets with marks as spaces and a space before each text that is not empty."""
    parts = []
    raw = texts.data.tobytes()
    marked = _MARK.encode() in raw
    for a, b in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist()):
        own = raw[a:b]
        if own:
            parts.append(b" " + (own.replace(_MARK.encode(), b" ") if marked else own))
        else:
            parts.append(b"")
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), offsets


def _word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    space = data == 0x20
    start = space.copy()
    start[1:] &= ~space[:-1]
    start[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(start)


def segment(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, p: Pieces):
    """Ids of some words and how many each has.

    All arrays below have one entry for each place in a word, its end included: `slot` of a
    word is its start plus its number, so the words stand one after another.
    """
    count = ends - starts
    number = np.arange(len(starts))
    slot = np.concatenate([[0], np.cumsum(count + 1)[:-1]])
    total = int((count + 1).sum())
    word = np.repeat(number, count)
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = starts[word] + place
    room = count[word] - place
    spans = SpanHash(_byte_values(), data)
    width = _char_bytes(data[at])
    single = np.zeros(len(at), bool)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []
    live = np.flatnonzero(width > 0)
    for length in p.lengths.tolist():
        live = live[room[live] >= length]
        if not len(live):
            break
        hit, key = p.find(spans.of(at[live], at[live] + length))
        own = live[hit]
        single[own] |= width[own] == length
        found.append((own, p.ids[key], p.scores[key], length))
    for length in range(1, 5):
        own = np.flatnonzero((width == length) & ~single)
        if len(own):
            found.append((own, np.full(len(own), -1, np.int32), np.full(len(own), p.unknown), length))

    source = np.concatenate([f[0] for f in found])
    ids = np.concatenate([f[1] for f in found])
    gain = np.concatenate([f[2] for f in found])
    length = np.concatenate([np.full(len(f[0]), f[3]) for f in found])
    end = place[source] + length
    target = slot[word[source]] + end
    best = np.full(total, -np.inf)
    best[slot] = 0.0
    back, chosen, pieces_to = np.zeros(total, np.int64), np.zeros(total, np.int32), np.zeros(total, np.int64)

    # Ends in order, at each end the longest pieces first: they win where sums are equal.
    is_long = count[word[source]] > LONG
    short = np.flatnonzero(~is_long)
    key = (end[short] * 64 + 63 - length[short]).astype(np.uint16)
    order = np.argsort(key, kind="stable")
    short, key = short[order], key[order]
    for group in np.split(short, np.flatnonzero(np.diff(key)) + 1) if len(short) else []:
        to, size = target[group], int(length[group[0]])
        value = best[to - size] + gain[group]
        better = value > best[to]
        to = to[better]
        best[to], back[to], chosen[to] = value[better], size, ids[group[better]]
    rest = np.flatnonzero(is_long)
    for k in rest[np.lexsort((-length[rest], target[rest]))].tolist():
        to = target[k]
        value = best[to - length[k]] + gain[k]
        if value > best[to]:
            best[to], back[to], chosen[to] = value, length[k], ids[k]

    # Follow the backpointers of all words at once, twice: to count, then to write.
    width_of = np.where(chosen < 0, back, 1)
    pieces_in = np.zeros(len(starts), np.int64)
    here, who = slot + count, number
    steps = []
    while len(here):
        moving = back[here] > 0
        here, who = here[moving], who[moving]
        if not len(here):
            break
        steps.append((here, who))
        pieces_in[who] += width_of[here]
        here = here - back[here]
    offset = np.concatenate([[0], np.cumsum(pieces_in)])
    result = np.zeros(offset[-1], np.int32)
    cursor = offset[1:].copy()
    for here, who in steps:
        cursor[who] -= width_of[here]
        known = chosen[here] >= 0
        result[cursor[who[known]]] = chosen[here[known]]
        for h, w in zip(here[~known].tolist(), who[~known].tolist()):
            first = int(starts[w]) + (h - int(slot[w])) - int(back[h])
            raw = data[first : first + int(back[h])]
            result[cursor[w] : cursor[w] + len(raw)] = p.byte_id[raw]
    return result, pieces_in


def encode_portion(texts: Texts, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a portion, and the offsets of each text."""
    data, offsets = _prepared(texts)
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(texts.count + 1, np.int64)
    starts = _word_starts(data, offsets)
    ends = np.append(starts[1:], len(data))
    hashes = SpanHash(_byte_values(), data).of(starts, ends)
    distinct, first, word = np.unique(hashes, return_index=True, return_inverse=True)
    new = p.seen.missing(distinct)
    if new.any():
        p.seen.learn(distinct[new], *segment(data, starts[first[new]], ends[first[new]], p))
    flat, before = p.seen.lists(distinct, word)
    return flat, before[np.searchsorted(starts, offsets)]


def decode_ids(ids: np.ndarray, offsets: np.ndarray, p: Pieces) -> list[str]:
    """The text of each range of ids."""
    if len(ids) and (ids.min() < 0 or ids.max() >= p.size):
        raise ValueError("an id is outside the model")
    data = slices(p.flat, p.offsets[ids], p.sizes[ids]).tobytes()
    size = np.concatenate([[0], np.cumsum(p.sizes[ids])])[offsets]
    return [
        data[a:b].removeprefix(b" ").decode("utf-8", "replace")
        for a, b in zip(size[:-1].tolist(), size[1:].tolist())
    ]


# Over tables


def _others(docs: DataFrame, *names: str | None) -> list[str]:
    """The columns that stay. Columns with the names of new ones are replaced."""
    gone = {n.lower() for n in names if n}
    return [c for c in docs.columns if c.lower() not in gone]


def encoded(
    docs: DataFrame,
    path: str,
    text: str = "text",
    ids: str = "ids",
    checksum: str | None = None,
    portion: int = 900_000,
) -> DataFrame:
    """The rows of `docs` with the ids of the text column in place of it.

    `checksum` names a column for the unsigned crc32 of the ids as little-endian 32-bit numbers.
    About `portion` bytes of text are worked on at a time.
    """
    columns = _others(docs, text, ids, checksum)
    names = [*columns, ids, *([checksum] if checksum else [])]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = model(path)
        for batch in batches:
            for texts in pieces(batch[text], portion):
                flat, offsets = encode_portion(texts, p)
                own = batch.slice(texts.first_row, texts.count)
                missing = pc.is_null(own[text])
                lists = pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(flat)).cast(
                    pa.list_(pa.int32())
                )
                arrays = [own[c] for c in columns] + [pc.if_else(missing, None, lists)]
                if checksum:
                    view = memoryview(np.ascontiguousarray(flat, "<u4")).cast("B")
                    crc = [
                        zlib.crc32(view[4 * a : 4 * b])
                        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())
                    ]
                    arrays.append(pc.if_else(missing, None, pa.array(crc, pa.int64())))
                yield pa.RecordBatch.from_arrays(arrays, names)

    added = [F.lit(None).cast("array<int>").alias(ids)]
    if checksum:
        added.append(F.lit(None).cast("bigint").alias(checksum))
    schema = docs.select(*columns, *added).schema
    return docs.withColumn(text, F.col(text).cast("string")).mapInArrow(encode, schema)


def decoded(
    docs: DataFrame, path: str, ids: str = "ids", text: str = "text", portion: int = 1 << 20
) -> DataFrame:
    """The rows of `docs` with the text of the id column in place of it, `portion` ids at a time."""
    columns = _others(docs, ids, text)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = model(path)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch[ids]), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            lo = 0
            while lo < len(sizes):
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - sizes[lo] + portion, side="right")))
                own = batch.slice(lo, hi - lo)
                flat = own[ids].flatten().to_numpy(zero_copy_only=False)
                bounds = np.concatenate([[0], ends[lo:hi] - ends[lo] + sizes[lo]]).astype(np.int64)
                texts = pa.array(decode_ids(flat, bounds, p), pa.string())
                texts = pc.if_else(pc.is_null(own[ids]), None, texts)
                yield pa.RecordBatch.from_arrays([own[c] for c in columns] + [texts], [*columns, text])
                lo = hi

    schema = docs.select(*columns).withColumn(text, F.lit(None).cast("string")).schema
    return docs.mapInArrow(decode, schema)

