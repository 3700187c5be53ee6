"""Words that a polynomial modulo 2**64 takes for one another, through every operator that hashes words."""

import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from plain import docs, groups

from partyfold.llm import backoff, id_files, ngram_join, queries, sentencepieces, tiling, wordpiece
from partyfold.llm.words import WHITE, SpanHash, mix, pieces, words

ONE = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
TWO = ONE.translate(str.maketrans("ab", "ba"))
ROWS = [(1, ONE), (2, TWO), (3, f"x {ONE} y"), (4, f"x {TWO} y"), (5, ONE)]


def hashes(*texts):
    [portion] = pieces(pa.array(texts, pa.large_string()))
    return words(portion, WHITE).hashes()


def test_hashes_tell_them_apart():
    assert len(set(hashes(ONE, TWO, ONE[:2048], TWO[:2048], ONE[:64], TWO[:64], ONE[:65], TWO[:65]).tolist())) == 8


def test_a_span_has_one_hash_wherever_it_stands():
    rng = np.random.default_rng(1)
    values = mix(rng.integers(0, 4, 3000).astype(np.uint64))
    for size in (1, 63, 64, 65, 128, 129, 1000):
        many = np.concatenate([values[7 : 7 + size], values[:100], values[7 : 7 + size]])
        found = SpanHash(many).of(np.array([0, size + 100]), np.array([size, 2 * size + 100]))
        assert found[0] == found[1]
        assert SpanHash(values).of(np.array([7]), np.array([7 + size]))[0] == found[0]


def test_shingles(spark):
    found = ngram_join.near_duplicates(docs(spark, ROWS), words=3, num=90, den=100).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found} == set(groups(ROWS, 3, 90, 100))


def test_byte_ids(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(str(queries.BYTE_BPE))
    found = {r["doc_id"]: r for r in id_files.round_trip(docs(spark, ROWS), queries.BYTE_BPE, end_id=2).collect()}
    for i, text in ROWS:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pieces_come_back(spark):
    ids = sentencepieces.encoded(docs(spark, ROWS).select("doc_id", "text"), queries.PIECES)
    assert {(r["doc_id"], r["text"]) for r in sentencepieces.decoded(ids, queries.PIECES).collect()} == set(ROWS)


def test_token_counts(spark):
    found = {r["doc_id"]: r["n_tokens"] for r in wordpiece.token_counts(docs(spark, ROWS), queries.PIECES).collect()}
    for i, text in ROWS:
        [alone] = wordpiece.token_counts(docs(spark, [(i, text)]), queries.PIECES).collect()
        assert found[i] == alone["n_tokens"]


def test_scores(spark):
    found = {r["doc_id"]: r["log_score"] for r in backoff.stupid_backoff(docs(spark, ROWS)).collect()}
    # ONE occurs 3 times of 9 words, TWO twice.
    assert found[1] == found[5] == pytest.approx(np.log(3 / 9)) and found[2] == pytest.approx(np.log(2 / 9))


def test_contamination(spark):
    item = " ".join([ONE, "and", "some", "more", "words", "of", "an", "item", "to", "be", "found", "in", "a", "text"])
    table = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    rows = [(1, f"see {item} here"), (2, ONE), (3, item.replace(ONE, TWO)), (None, item), (None, "clean"), (None, None)]
    found = tiling.contamination(docs(spark, rows), table, threshold=1.0).collect()
    assert {(r["doc_id"], r["contaminated"]) for r in found} == {(1, True), (2, False), (3, False), (None, True), (None, False)}
    assert sum(r["contaminated"] for r in found) == 2 and len(found) == 6


@pytest.mark.parametrize("long", ["ab" * 500_000, "x" * 1_000_000, "🙂" * 100_000])
def test_a_long_word_beside_many_short_ones(long):
    automaton = wordpiece.from_model(public_tokenizers.path("piece_bpe_32k.model"))
    text = " ".join([long, *(f"w{i}" for i in range(40_000))])
    [portion] = pieces(pa.array([text], pa.large_string()))
    starts, ends, _ = wordpiece.split(portion)
    begin = time.perf_counter()
    counts, unknown = automaton.count(portion.data, starts, ends)
    assert time.perf_counter() - begin < 4
    short = long[:200]
    for word in (short, short[:7]):
        [own] = pieces(pa.array([word], pa.large_string()))
        side = automaton.count(own.data, *(np.array([x]) for x in (0, len(own.data))))
        assert automaton._walk(word.encode()) == (side[0][0], side[1][0])
    assert len(counts) == len(unknown) == 40_001
