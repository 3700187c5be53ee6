import math
from collections import Counter

import pytest
from conftest import DATA
from plain import ODD_ROWS, WHITE_WORDS, docs, lower

from partyfold.llm import backoff, queries


def plain(rows, order, least, alpha):
    texts = [(i, WHITE_WORDS.findall(lower(t))) for i, t in rows]
    counts = Counter(
        tuple(w[k : k + n]) for _, w in texts for n in range(1, order + 1) for k in range(len(w) - n + 1)
    )
    total = sum(len(w) for _, w in texts)

    def score(history, word):
        if not history:
            return (counts[(word,)] if counts[(word,)] >= least else 1) / total
        if counts[(*history, word)] >= least:
            return counts[(*history, word)] / counts[history]
        return alpha * score(history[1:], word)

    return [
        (i, len(w), sum(math.log(score(tuple(w[max(0, k - order + 1) : k]), w[k])) for k in range(len(w))))
        for i, w in texts
    ]


ROWS = [*ODD_ROWS, *[(100 + k, f"the cat {k % 3} sat on the mat number {k % 7}. The END") for k in range(40)]]


@pytest.mark.parametrize(("order", "least"), [(1, 2), (2, 2), (3, 1), (3, 3)])
@pytest.mark.parametrize(("chunk", "bucket"), [(8 << 20, 8 << 20), (300, 200)])
def test_scores_are_those_of_plain_counting(spark, order, least, chunk, bucket):
    table = docs(spark, ROWS).repartition(3)
    found = backoff.stupid_backoff(table, order, least, 0.4, chunk, bucket).collect()
    expected = plain(ROWS, order, least, 0.4)
    key = lambda r: (str(r[0]), r[1], round(r[2], 6))
    assert sorted(map(key, found)) == sorted(map(key, expected))


def test_pairs_that_occur_once_are_seen_ones(spark):
    key = lambda r: (str(r[0]), r[1], round(r[2], 6))
    found = backoff.stupid_backoff(docs(spark, ROWS)).collect()
    assert sorted(map(key, found)) == sorted(map(key, plain(ROWS, 2, 1, 0.4)))
    small = str(DATA / "sf0.001")
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    found = queries.op9_stupid_backoff(spark, small).collect()
    assert sorted(map(key, found)) == sorted(map(key, plain(rows, 2, 1, 0.4)))


def plain_others(rows, order, least, alpha):
    """The same by the counts of all other documents."""
    texts = [(i, WHITE_WORDS.findall(lower(t))) for i, t in rows]

    def counted(w):
        return Counter(tuple(w[k : k + n]) for n in range(1, order + 1) for k in range(len(w) - n + 1))

    whole, total = sum((counted(w) for _, w in texts), Counter()), sum(len(w) for _, w in texts)

    def scored(w):
        own = counted(w)
        there = lambda gram: whole[gram] - own[gram]

        def score(history, word):
            if not history:
                return (there((word,)) if there((word,)) >= least else 1) / max(total - len(w), 1)
            if there((*history, word)) >= least:
                return there((*history, word)) / there(history)
            return alpha * score(history[1:], word)

        return sum(math.log(score(tuple(w[max(0, k - order + 1) : k]), w[k])) for k in range(len(w)))

    return [(i, len(w), scored(w)) for i, w in texts]


@pytest.mark.parametrize(("order", "least"), [(1, 1), (2, 1), (2, 2), (3, 1)])
@pytest.mark.parametrize(("chunk", "bucket"), [(8 << 20, 8 << 20), (300, 200)])
def test_scores_by_the_other_documents(spark, order, least, chunk, bucket):
    table = docs(spark, ROWS).repartition(3)
    found = backoff.stupid_backoff(table, order, least, 0.4, chunk, bucket).collect()
    key = lambda r: (str(r[0]), r[1], round(r[2], 6))
    others = [(r["doc_id"], r["n_words"], r["others_log_score"]) for r in found]
    assert sorted(map(key, others)) == sorted(map(key, plain_others(ROWS, order, least, 0.4)))


def test_backing_off_changes_the_query(spark, tmp_path):
    rows = [(1, "a b c"), (2, "a b d"), (3, "b a"), (4, "a b c"), (5, "")]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r["doc_id"]: r for r in queries.op9_stupid_backoff(spark, str(tmp_path)).collect()}
    # Of the 8 words of the others 3 are a, 2 of these stand before b, and none is d.
    assert found[2]["others_log_score"] == pytest.approx(math.log(3 / 8) + math.log(2 / 3) + math.log(0.4 * 1 / 8))
    assert found[3]["others_log_score"] == pytest.approx(math.log(3 / 9) + math.log(0.4 * 3 / 9))
    assert found[5]["others_log_score"] == 0
    plain_score = math.log(4 / 11) + math.log(3 / 4) + math.log(1 / 4)
    assert found[2]["log_score"] == pytest.approx(plain_score)


def test_empty_table(spark):
    assert backoff.stupid_backoff(docs(spark, [])).count() == 0


@pytest.mark.parametrize("count", [1, 7, 1 << 16, 1 << 17])
def test_packed_hashes_come_back(count):
    import numpy as np

    hashes = np.random.default_rng(count).integers(0, 2**63, 500).astype(np.uint64) * np.uint64(2)
    buckets = backoff.Buckets(count)
    places = buckets.of(hashes)
    assert places.min() >= 0 and places.max() < count
    assert (np.diff(buckets.of(np.sort(hashes))) >= 0).all()
    assert (buckets.unpack(buckets.pack(hashes)) == hashes).all()
