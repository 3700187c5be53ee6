import zlib

import numpy as np
import pytest
from conftest import DATA
from plain import ODD_ROWS, docs
from pyspark.sql import functions as F

from partyfold.llm import toxicity


def plain_marginals(emissions, pair):
    move, forward = np.exp(pair), [np.array([1.0, 0.0])]
    for x in emissions:
        now = forward[-1] @ move * np.array([1, np.exp(x)])
        forward.append(now / now.sum())
    back, result = np.ones(2), [0.0] * len(emissions)
    for k in range(len(emissions) - 1, -1, -1):
        both = forward[k + 1] * back
        result[k] = both[1] / both.sum()
        back = move @ (back * np.array([1, np.exp(emissions[k])]))
        back /= back.sum()
    return result


def test_marginals_over_segments_are_those_of_one_pass():
    rng = np.random.default_rng(0)
    for bounds in ([0, 0, 5, 300, 301, 700, 1000], [0, 128, 256, 257], [0, 0], [0, 1]):
        of_text = np.array(bounds)
        emissions, pair = rng.normal(size=of_text[-1]) * 3, rng.normal(size=(2, 2))
        expected = [p for a, b in zip(bounds, bounds[1:]) for p in plain_marginals(emissions[a:b], pair)]
        assert np.allclose(toxicity.marginals(emissions, of_text, pair), expected, atol=1e-12)


def test_gradients_are_those_of_the_likelihood():
    rng = np.random.default_rng(1)
    emissions, pair = rng.normal(size=(4, 6)), rng.normal(size=(2, 2))
    mask = np.arange(6) < np.array([6, 2, 4, 1])[:, None]
    states = ((rng.random((4, 6)) < 0.5) & mask).astype(int)
    by_emission, by_pair, value = toxicity.log_likelihood(emissions, states, mask, pair)
    step = 1e-6
    for at in np.ndindex(4, 6):
        moved = emissions.copy()
        moved[at] += step
        slope = (toxicity.log_likelihood(moved, states, mask, pair)[2] - value) / step
        assert slope == pytest.approx(by_emission[at], abs=1e-4)
    for at in np.ndindex(2, 2):
        moved = pair.copy()
        moved[at] += step
        slope = (toxicity.log_likelihood(emissions, states, mask, moved)[2] - value) / step
        assert slope == pytest.approx(by_pair[at], abs=1e-4)


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(str(DATA / "sf0.1" / f"{n}.parquet")) for n in ("documents", "labels")]


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.fit(*tables)


def test_held_out_documents(tables, model):
    documents, labels = tables
    scored = toxicity.toxic_spans(documents, model).join(labels, "doc_id").where(toxicity.fold(F.col("doc_id")) == 0)
    rows = scored.select("doc_id", "score", "toxic", "spans").collect()
    assert len(rows) > 500 and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    right = sum((r["score"] >= 0.5) == (r["toxic"] == 1) for r in rows)
    assert right / len(rows) >= 0.98
    assert all(r["spans"] for r in rows if r["toxic"] and r["score"] >= 0.5)


def test_spans_are_characters_and_texts_are_whole(spark, model):
    text = "Ñandú über alles " * 3000 + "you moron, scum! é"
    [row] = toxicity.toxic_spans(docs(spark, [(1, text)]), model).collect()
    assert row["score"] >= 0.5
    assert any("moron" in text[s["start"] : s["end"]] for s in row["spans"])


def test_odd_rows_and_empty_tables(spark, model):
    found = toxicity.toxic_spans(docs(spark, ODD_ROWS), model).collect()
    assert len(found) == len(ODD_ROWS)
    assert all(0 <= r["score"] < 0.5 for r in found)
    assert toxicity.toxic_spans(docs(spark, []), model).count() == 0


def test_rejected_rows_go_with_all_columns_kept(spark, model):
    table = docs(spark, [(1, "moron idiot scum"), (2, "fine words"), (None, None)])
    kept = toxicity.without_toxic(table, model)
    assert kept.schema == table.schema
    assert {r["doc_id"] for r in kept.collect()} == {2, None}


def test_labels_without_both_classes_give_no_scores(spark):
    rows = docs(spark, [(i, f"word {i}") for i in range(30)])
    for labels in ([], [(i, 0) for i in range(30)], [(1, None), (2, 7), (None, 1)]):
        own = spark.createDataFrame(labels, "doc_id bigint, toxic int")
        model = toxicity.fit(rows, own)
        assert {r["score"] for r in toxicity.toxic_spans(rows, model).collect()} == {0.0}


def test_held_out_labels_change_nothing(spark):
    bad, good = "vile awful words", "kind plain words"
    rows = [(i, bad if i % 2 else good) for i in range(80)]
    labels = [(i, i % 2) for i in range(80)]
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    models = [toxicity.fit(docs(spark, rows), spark.createDataFrame(own, "doc_id bigint, toxic int")) for own in (labels, turned)]
    assert np.array_equal(models[0].weights, models[1].weights)
    assert models[0].calibration == models[1].calibration
