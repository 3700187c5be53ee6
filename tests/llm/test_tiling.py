import random
from collections import Counter

import numpy as np
import pytest
from plain import ALNUM_WORDS, ODD_ROWS, docs, lower, string_tiles

from partyfold.llm import tiling


def codes(words):
    return np.array([hash(w) & (2**63 - 1) for w in words], np.uint64)


@pytest.mark.parametrize("least", [1, 2, 3])
def test_tiles_are_the_greedy_ones(least):
    rng = random.Random(least)
    for _ in range(150):
        item, doc = ([rng.choice("abcd") for _ in range(rng.randrange(1, 14))] for _ in range(2))
        assert tiling.tiles(codes(item), codes(doc), least) == string_tiles(item, doc, least)


def benchmark(spark, rows):
    return spark.createDataFrame([(i, t, 0) for i, t in rows], "item_id bigint, text string, doc_id int")


def brute(rows, items, least, threshold):
    found = set()
    for doc_id, text in rows:
        doc = ALNUM_WORDS.findall(lower(text))
        for item_id, item_text in items:
            item = ALNUM_WORDS.findall(lower(item_text))
            covered = sum(t[2] for t in string_tiles(item, doc, least))
            if len(item) >= least and covered >= threshold * len(item):
                found.add((doc_id, item_id, covered, len(item)))
    return found


def test_hits_are_those_of_plain_tiling_whatever_the_bitmap_lets_through(spark):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(25)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 20)))) for i in range(12)]
    rows = []
    for d in range(60):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randrange(20)))]
        if d % 2:
            own = rng.choice(items)[1].split()
            cut = rng.randrange(len(own) + 1)
            parts += [" ".join(own[cut:]), rng.choice(words), " ".join(own[:cut])]
        rows.append((d, ". ".join(parts)))
    for bits in (26, 15):
        hits = tiling.benchmark_hits(
            docs(spark, rows), benchmark(spark, items), min_match=3, threshold=0.7, filter_bits=bits, rows_per_task=5
        ).collect()
        found = {(r["doc_id"], r["item_id"], r["covered_words"], r["item_words"]) for r in hits}
        assert found == brute(rows, items, 3, 0.7) and len(found) == len(hits)
        for r in hits:
            item = ALNUM_WORDS.findall(lower(dict(items)[r["item_id"]]))
            doc = ALNUM_WORDS.findall(lower(dict(rows)[r["doc_id"]]))
            assert [tuple(t) for t in r["tiles"]] == string_tiles(item, doc, 3)


def test_the_shared_runs_alone_give_the_tiles():
    rng = random.Random(5)
    for size in (1, 2, 3):
        for _ in range(100):
            item, doc = ([rng.choice("abcdef") for _ in range(rng.randrange(3, 16))] for _ in range(2))
            places = {}
            for side, tokens in (("item_places", item), ("doc_places", doc)):
                for k in range(len(tokens) - size + 1):
                    places.setdefault(tuple(tokens[k : k + size]), {}).setdefault(side, []).append(k)
            shared = [{"words": codes(run).astype(np.int64), **at} for run, at in places.items() if len(at) == 2]
            if shared:
                assert tiling.pair_tiles(shared, len(item), size) == string_tiles(item, doc, size)


def test_repeated_documents_and_items_are_reported_one_by_one(spark):
    item = "one two three four five six seven"
    rows = [(1, item), (1, item), (None, f"so {item}"), (2, "one two three")]
    items = [(7, item), (8, item), (7, item), (None, item)]
    hits = tiling.benchmark_hits(docs(spark, rows), benchmark(spark, items)).collect()
    assert Counter((r["doc_id"], r["item_id"]) for r in hits) == {
        (1, 7): 4, (1, 8): 2, (1, None): 2, (None, 7): 2, (None, 8): 1, (None, None): 1
    }
    table = tiling.contamination(docs(spark, rows), benchmark(spark, items)).collect()
    assert Counter((r["doc_id"], r["n_items"]) for r in table) == {(1, 2): 2, (None, 2): 1, (2, 0): 1}


def test_a_run_that_all_documents_share_is_found_in_each_when_dealt_out(spark, settings):
    settings({"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"})
    item = "one two three four"
    rows = [(i, f"x{i} {item}") for i in range(400)]
    seen = tiling.text_hits(docs(spark, rows), benchmark(spark, [(1, item)]), rows_per_task=20)
    assert seen.count() == 400


def test_a_reordered_passage_is_found_and_a_partial_one_is_not(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (1, "Say: seven EIGHT nine, ten eleven twelve! Then one two three four five six."),
        (2, "one two three four five six and nothing else"),
        (3, None),
    ]
    table = tiling.contamination(docs(spark, rows), benchmark(spark, [(7, item), (5, item)]))
    found = {r["doc_id"]: (r["n_items"], r["item_id"], r["coverage"], r["contaminated"]) for r in table.collect()}
    assert found == {1: (2, 5, 1.0, True), 2: (0, None, 0.0, False), 3: (0, None, 0.0, False)}


def test_odd_rows_and_empty_tables(spark):
    items = [(1, None), (None, "a a a a a a"), (2, ""), (3, "word " * 50)]
    found = tiling.contamination(docs(spark, ODD_ROWS), benchmark(spark, items)).collect()
    assert len(found) == len(ODD_ROWS)
    assert {r["doc_id"] for r in found if r["contaminated"]} == {4, 7}
    for rows, own in (([], items), (ODD_ROWS, [])):
        assert not tiling.contamination(docs(spark, rows), benchmark(spark, own)).where("contaminated").count()
