"""Licence scans: ordered signature rules behind a keyword prefilter.

Words are runs of ASCII letters and digits and of all other characters above 0x7F, A-Z in lower
case. The words of all texts are hashed at once and looked up among the keywords of the rules; only
texts that hold every keyword of a rule are searched for it.

A detection is an interval of words. One that lies within the interval of a
detection of higher priority, or of the same priority and greater length, is suppressed;
of equal intervals of equal priority the earlier rule stays. Detections of base
phrases are always reported; `suppressed` tells whether another one holds them.

The score of a text is the largest weight among its detections that are not suppressed, 0
without any. Null texts count as empty; empty ones have no words and no detections. Every row gives a row,
repeated ones too; extra columns are ignored. Texts are scanned whole, however long.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partyfold.llm.license_rules import Rule, rules
from partyfold.llm.tiling import word_hashes
from partyfold.llm.words import ALNUM, Words, pieces, words

_FIELDS = [
    ("label", pa.string()), ("rule", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()),
    ("priority", pa.int32()), ("weight", pa.float64()), ("base", pa.bool_()), ("suppressed", pa.bool_()),
]
_DETECTION = (
    "struct<label:string,rule:string,first_word:bigint,end_word:bigint,"
    "priority:int,weight:double,base:boolean,suppressed:boolean>"
)


class Prefilter:
    """Which rules can match which texts."""

    def __init__(self, all_rules: tuple[Rule, ...]):
        names = sorted({k for r in all_rules for k in r.keywords})
        hashes = np.array([h[0] for h in word_hashes(names)], np.uint64)
        order = np.argsort(hashes)
        self.keys = hashes[order]
        place = {names[n]: rank for rank, n in enumerate(order.tolist())}
        self.rules = [(r, frozenset(place[k] for k in r.keywords)) for r in all_rules]

    def __call__(self, found: Words) -> Iterator[tuple[int, list[Rule]]]:
        hashes = found.hashes()
        if not len(hashes):
            return
        key = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[key] == hashes)
        text = np.searchsorted(found.of_text, hit, side="right") - 1
        pairs = np.unique(text * np.int64(len(self.keys)) + key[hit])
        text, key = np.divmod(pairs, len(self.keys))
        for own in np.split(np.arange(len(text)), np.flatnonzero(np.diff(text)) + 1) if len(text) else []:
            present = set(key[own].tolist())
            tried = [r for r, needs in self.rules if needs <= present]
            if tried:
                yield int(text[own[0]]), tried


def detections(text_words: list[bytes], tried: list[Rule]) -> list[dict]:
    """What the rules find in the words of a text, in order of the words."""
    text = b" ".join(text_words).decode("utf-8")
    starts = [0]
    for own in text_words:
        starts.append(starts[-1] + len(own.decode("utf-8")) + 1)
    found = []
    for order, rule in enumerate(tried):
        for match in rule.pattern.finditer(text):
            first = bisect_left(starts, match.start())
            end = bisect_left(starts, match.end() + 1)
            found.append((-rule.priority, first - end, order, first, end, rule))
    kept: list[tuple[int, int]] = []
    result = []
    for _, _, _, first, end, rule in sorted(found, key=lambda f: f[:4]):
        held = any(a <= first and end <= b for a, b in kept)
        if not held:
            kept.append((first, end))
        if not held or rule.base:
            values = (rule.label, rule.name, first, end, rule.priority, rule.weight, rule.base, held)
            result.append(dict(zip((f[0] for f in _FIELDS), values)))
    return sorted(result, key=lambda d: (d["first_word"], -d["end_word"], d["rule"]))


def license_detections(docs: DataFrame, extra: tuple[Rule, ...] = ()) -> DataFrame:
    """`doc_id, n_words, detections` for every row of `docs` (`doc_id`, `text`)."""
    kind = pa.list_(pa.struct(_FIELDS))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefilter = Prefilter(rules() + extra)
        for batch in batches:
            for texts in pieces(batch["text"]):
                found = words(texts, ALNUM)
                own: list[list[dict]] = [[] for _ in range(texts.count)]
                symbols = found.symbols.tobytes()
                for text, tried in prefilter(found):
                    lo, hi = found.of_text[text], found.of_text[text + 1]
                    spans = zip(found.starts[lo:hi].tolist(), found.ends[lo:hi].tolist())
                    own[text] = detections([symbols[a:b] for a, b in spans], tried)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(texts.first_row, texts.count),
                        pa.array(np.diff(found.of_text).astype(np.int64)),
                        pa.array(own, kind),
                    ],
                    ["doc_id", "n_words", "detections"],
                )

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(scan, f"doc_id bigint, n_words bigint, detections array<{_DETECTION}>")


def license_summary(docs: DataFrame) -> DataFrame:
    """Counts, places, labels and a score for every row of `docs`."""
    base = F.filter("detections", lambda d: d["base"])
    standing = F.filter("detections", lambda d: ~d["suppressed"] | d["base"])

    def labels(found):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"]))), ",")

    places = F.transform(base, lambda d: d["first_word"])
    weights = F.transform(F.filter("detections", lambda d: ~d["suppressed"]), lambda d: d["weight"])
    return license_detections(docs).select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(standing).alias("labels"),
        F.coalesce(F.array_max(weights), F.lit(0.0)).alias("score"),
        F.size("detections").alias("n_detections"),
    )
