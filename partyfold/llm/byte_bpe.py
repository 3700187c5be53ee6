"""Ids of a byte-level BPE tokenizer file for whole batches of texts.

The tokenizers library turns text into ids; it is asked only once for each distinct pretoken
of a portion. Pretokens never influence each other in such a tokenizer, so the ids
of a text are those of its pretokens, one after another. Texts are split here, for a portion at
once, by the classes of their characters. Texts with a character outside the ranges below,
or with the name of an added token, go to the library whole.
"""

from __future__ import annotations

import os
import unicodedata
from functools import cache
from itertools import chain

import numpy as np

from partyfold.llm.memo import Memo
from partyfold.llm.words import U64, SpanHash, mix

_LETTER, _NUMBER, _SPACE, _OTHER, _BORDER, _UNSURE = range(6)
_LIMIT = 0x2070
_SEPARATOR = "\U0010ffff"

#: What follows an apostrophe in a contraction.
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")


@cache
def _classes() -> np.ndarray:
    """The class of each character below the limit; unsure where versions of Unicode could differ."""
    table = np.full(_LIMIT + 1, _UNSURE, np.uint8)
    for code in (*range(0x20, 0x7F), 0x09, 0x0A, 0x0D, *range(0xA0, 0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F)):
        kind = unicodedata.category(chr(code))[0]
        space = chr(code).isspace()
        table[code] = _SPACE if space else {"L": _LETTER, "N": _NUMBER}.get(kind, _OTHER)
    return table


def _starts(codes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where pretokens begin. Texts end with a border, which is a pretoken by itself."""
    begin = np.ones(len(codes), bool)
    begin[1:] = kinds[1:] != kinds[:-1]
    solid = (kinds == _LETTER) | (kinds == _NUMBER) | (kinds == _OTHER)
    run = np.flatnonzero(begin & solid)
    run = run[run > 0]
    after_space = run[kinds[run - 1] == _SPACE]
    begin[after_space - 1] = True  # the last white space before a run stands apart,
    begin[after_space[codes[after_space - 1] == 0x20]] = False  # or leads it, if it is a blank
    quote = np.flatnonzero((codes == 0x27) & begin)
    size = len(codes)
    for tail in CONTRACTIONS:
        at = quote[quote + len(tail) < size]
        for k, letter in enumerate(tail, 1):
            at = at[codes[at + k] == ord(letter)]
        begin[at + 1] = False
        rest = at[at + len(tail) + 1 < size] + len(tail) + 1
        begin[rest] = True
    return np.flatnonzero(begin)


class ByteBpe:
    def __init__(self, path: str, remember: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._added = [t.content for t in self._library.get_added_tokens_decoder().values()]
        self.size = self._library.get_vocab_size()
        self._seen = Memo(remember, np.uint32)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        new = self._whole(texts)
        size = np.fromiter(map(len, new), np.int64, len(new))
        self._seen.learn(keys, np.fromiter(chain.from_iterable(new), np.uint32, int(size.sum())), size)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin."""
        joined = _SEPARATOR.join(texts) + _SEPARATOR
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kinds = _classes()[np.minimum(codes, _LIMIT)]
        kinds = np.where(codes == ord(_SEPARATOR), np.uint8(_BORDER), kinds)
        borders = np.flatnonzero(kinds == _BORDER)
        odd = np.zeros(len(texts), bool)
        if len(borders) != len(texts):
            odd[:] = True
        else:
            unsure = np.flatnonzero(kinds == _UNSURE)
            odd[np.searchsorted(borders, unsure)] = True
            for added in self._added:
                if added in joined:
                    odd |= np.array([added in t for t in texts])
        parts: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        whole = np.flatnonzero(odd)
        for i, ids in zip(whole.tolist(), self._whole([texts[i] for i in whole])):
            parts[i] = np.array(ids, np.uint32)
        if not odd.all():
            starts = _starts(codes, kinds)
            text = np.searchsorted(borders, starts)
            ends = np.append(starts[1:], len(codes))
            keep = (kinds[starts] != _BORDER) & ~odd[text]
            starts, ends, text = starts[keep], ends[keep], text[keep]
            hashes = SpanHash(mix(codes.astype(U64) + U64(1))).of(starts, ends)
            distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            new = self._seen.missing(distinct)
            at = first[new].tolist()
            self._learn(distinct[new], [joined[starts[k] : ends[k]] for k in at])
            flat, before = self._seen.lists(distinct, inverse)
            bounds = before[np.searchsorted(text, np.arange(len(texts) + 1))]
            if not len(whole):
                return flat, bounds
            for i in np.flatnonzero(~odd).tolist():
                parts[i] = flat[bounds[i] : bounds[i + 1]]
        return np.concatenate([*parts, np.zeros(0, np.uint32)]), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


@cache
def tokenizer(path: str) -> ByteBpe:
    """Read once in each worker process."""
    return ByteBpe(path)
