"""Queries over all documents of the smallest tables against plain accounts."""

import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import DATA
from plain import ALNUM_WORDS, WHITE_WORDS, groups, lower
from tokenizers import Tokenizer

from partyfold.llm import license_rules, queries

SMALL = str(DATA / "sf0.001")


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


def rows(spark, name, *columns):
    return Counter(tuple(r[c] for c in columns) for r in queries.QUERIES[name](spark, SMALL).collect())


def test_shingle_groups(spark, documents):
    found = rows(spark, "op1_ngram_jaccard_join", "doc_id", "n_shingles", "component_id")
    assert found == groups(documents, 3, 90, 100)


def test_license_phrases(spark, documents):
    expected = Counter()
    for i, text in documents:
        words, places, labels = ALNUM_WORDS.findall(lower(text)), [], set()
        for phrase, label in license_rules.BASE_PHRASES:
            own = phrase.split()
            here = [k for k in range(len(words)) if words[k : k + len(own)] == own]
            places += here
            labels |= {label} if here else set()
        expected[i, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))] += 1
    columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert rows(spark, "op3_license_scan", *columns) == expected


def test_pieces_come_back(spark, documents):
    found = rows(spark, "op7_sentencepiece", "doc_id", "n_chars", "round_trip")
    assert found == Counter((i, len(t or ""), True) for i, t in documents)


def test_items_are_found(spark, documents):
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    found = {r["doc_id"]: r["contaminated"] for r in queries.QUERIES["op8_benchmark_decontamination"](spark, SMALL).collect()}
    whole = {i for i, t in documents if any(item in t for item in items)}
    assert whole and all(found[i] for i in whole)
    assert len(found) == len(documents)


def test_token_ids(spark, documents):
    library, expected, start = Tokenizer.from_file(str(queries.BYTE_BPE)), Counter(), 0
    for i, text in sorted(documents):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        expected[i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        start += len(ids)
    assert rows(spark, "op10_token_id_files", "doc_id", "start", "n_tokens", "ids_crc32") == expected


def test_word_counts_of_the_mix(spark, documents):
    found = rows(spark, "op11_source_mix", "doc_id", "size")
    assert found == Counter((i, len(WHITE_WORDS.findall(t or ""))) for i, t in documents)
