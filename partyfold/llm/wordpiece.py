"""Token counts: greedy word pieces counted by a linear longest-match automaton.

Each word is cut into the longest piece of the vocabulary that begins it, then the longest
continuation piece that begins the rest, and so on; a word that cannot be cut to its end
counts as one unknown token. Only the number of pieces is wanted, and none is built.

The automaton is a trie of the first pieces and one of the continuation pieces, over bytes,
with failure links. A link leads from a node to the node of the continuation trie that is
reached after as many longest pieces as possible have been popped off the node's string, and
the number of popped pieces is stored with it. A word is read once, byte by byte: where no
edge fits, the count of the node is added and its link followed. Every byte and every link
is followed once, so the time is linear in the length of the word.

All distinct words of a portion of texts are read together, one byte of each at a time; an
edge is found in a sorted array of (node, byte) keys. A count then goes to all places of its
word.

Words are runs of characters between white space; each ASCII punctuation character is a
word by itself. Null and empty texts have no words. Every row gives a row, repeated ones
too; extra columns are ignored. Texts and words are read whole, however long.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partyfold.llm.words import SpanHash, Texts, _byte_values, pieces

#: White space, and the ASCII characters that are words by themselves.
WHITE_SPACE = b" \t\n\v\f\r"
PUNCTUATION = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())

_NONE = -1
LONG = 256  # bytes


class Automaton:
    """Tries of first and continuation pieces with failure links and counts of popped pieces."""

    FIRST, NEXT = 0, 1

    def __init__(self, first: Iterable[bytes], following: Iterable[bytes]):
        edges: list[dict[int, int]] = [{}, {}]
        is_piece = [False, False]
        parent, letter, depth = [_NONE, _NONE], [0, 0], [0, 0]
        for root, vocabulary in ((self.FIRST, first), (self.NEXT, following)):
            for piece in vocabulary:
                node = root
                for byte in piece:
                    if byte not in edges[node]:
                        edges[node][byte] = len(edges)
                        edges.append({})
                        is_piece.append(False)
                        parent.append(node)
                        letter.append(byte)
                        depth.append(depth[node] + 1)
                    node = edges[node][byte]
                if piece:
                    is_piece[node] = True
        size = len(edges)
        link, popped = [_NONE] * size, [0] * size
        for node in sorted(range(2, size), key=depth.__getitem__):
            if is_piece[node]:
                link[node], popped[node] = self.NEXT, 1
                continue
            back, count = link[parent[node]], popped[parent[node]]
            while back != _NONE and letter[node] not in edges[back]:
                count += popped[back]
                back = link[back]
            if back != _NONE:
                link[node], popped[node] = edges[back][letter[node]], count
        keys = [(node << 8 | byte, to) for node, own in enumerate(edges) for byte, to in own.items()]
        keys.sort()
        self.keys = np.array([k for k, _ in keys] or [-1], np.int64)
        self.to = np.array([t for _, t in keys] or [_NONE], np.int64)
        self.link, self.popped = np.array(link), np.array(popped)
        self.edges, self.links, self.pops = dict(keys), link, popped

    def step(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        key = nodes << 8 | letters
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], _NONE)

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of each word, and whether it is unknown; an unknown word counts one.

        Words up to `LONG` bytes are read side by side, the few longer ones one after another.
        """
        counts, unknown = np.empty(len(starts), np.int64), np.empty(len(starts), bool)
        length = ends - starts
        for i in np.flatnonzero(length > LONG).tolist():
            counts[i], unknown[i] = self._walk(data[starts[i] : ends[i]].tobytes())
        short = np.flatnonzero(length <= LONG)
        counts[short], unknown[short] = self._count_short(data, starts[short], length[short])
        return counts, unknown

    def _walk(self, word: bytes) -> tuple[int, bool]:
        """The same for one word."""
        node, count, edges, link, popped = self.FIRST, 0, self.edges, self.links, self.pops
        for letter in word:
            to = edges.get(node << 8 | letter)
            while to is None:
                back = link[node]
                if back == _NONE:
                    return 1, True
                count += popped[node]
                node = back
                to = edges.get(node << 8 | letter)
            node = to
        while node != self.NEXT:
            back = link[node]
            if back == _NONE:
                return 1, True
            count += popped[node]
            node = back
        return count, False

    def _count_short(self, data: np.ndarray, starts: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(-length, kind="stable")
        first, size = starts[order], length[order]
        falling = -size
        node = np.full(len(order), self.FIRST)
        pieces_in = np.zeros(len(order), np.int64)
        lost = np.zeros(len(order), bool)
        for k in range(int(size[0]) if len(size) else 0):
            reading = np.flatnonzero(~lost[: np.searchsorted(falling, -k, side="left")])
            if not len(reading):
                break
            self._read(reading, data[first[reading] + k].astype(np.int64), node, pieces_in, lost)
        # What is left at the end has to be popped down to the root of the continuations.
        waiting = np.flatnonzero(~lost & (node != self.NEXT))
        while len(waiting):
            back = self.link[node[waiting]]
            lost[waiting[back == _NONE]] = True
            waiting, back = waiting[back != _NONE], back[back != _NONE]
            pieces_in[waiting] += self.popped[node[waiting]]
            node[waiting] = back
            waiting = waiting[back != self.NEXT]
        counts, unknown = np.empty(len(order), np.int64), np.empty(len(order), bool)
        counts[order], unknown[order] = np.where(lost, 1, pieces_in), lost
        return counts, unknown

    def _read(self, reading, letters, node, pieces_in, lost) -> None:
        while len(reading):
            to = self.step(node[reading], letters)
            fits = to != _NONE
            node[reading[fits]] = to[fits]
            reading, letters = reading[~fits], letters[~fits]
            back = self.link[node[reading]]
            lost[reading[back == _NONE]] = True
            reading, letters, back = (a[back != _NONE] for a in (reading, letters, back))
            pieces_in[reading] += self.popped[node[reading]]
            node[reading] = back


@cache
def from_model(path: str) -> Automaton:
    """The vocabulary of a SentencePiece file: pieces marked as word begins, and all others."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    mark = "▁"
    begins = [n[1:].encode() for n in names if n.startswith(mark) and not n[1:].startswith(mark)]
    return Automaton(begins, [n.encode() for n in names if not n.startswith(mark)])


def split(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the range of each text."""
    kind = np.zeros(256, np.uint8)
    kind[list(WHITE_SPACE)] = 1
    kind[list(PUNCTUATION)] = 2
    kinds = kind[texts.data]
    begin = np.ones(len(kinds), bool)
    begin[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == 2)
    begin[texts.offsets[:-1][texts.offsets[:-1] < len(kinds)]] = True
    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], len(kinds))
    solid = kinds[starts] != 1 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[solid], ends[solid]
    return starts, ends, np.searchsorted(starts, texts.offsets)


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """`doc_id, n_words, n_tokens, n_unknown` for every row of `docs` (`doc_id`, `text`)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = from_model(path)
        for batch in batches:
            for texts in pieces(batch["text"]):
                starts, ends, of_text = split(texts)
                hashes = SpanHash(_byte_values(), texts.data).of(starts, ends)
                _, first, word = np.unique(hashes, return_index=True, return_inverse=True)
                tokens, unknown = automaton.count(texts.data, starts[first], ends[first])

                def per_text(values):
                    sums = np.concatenate([[0], np.cumsum(values[word])])
                    return pa.array(sums[of_text[1:]] - sums[of_text[:-1]], pa.int64())

                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(texts.first_row, texts.count),
                        pa.array(np.diff(of_text), pa.int64()),
                        per_text(tokens),
                        per_text(unknown.astype(np.int64)),
                    ],
                    ["doc_id", "n_words", "n_tokens", "n_unknown"],
                )

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(count, "doc_id bigint, n_words bigint, n_tokens bigint, n_unknown bigint")
