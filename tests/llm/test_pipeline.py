import numpy as np
import pytest
from conftest import DATA
from plain import shingles
from pyspark.sql import functions as F

import corpus_pipeline
from partyfold.llm import queries, sentencepieces, tiling, toxicity

SMALL = str(DATA / "sf0.001")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, component_id int, id int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1, 0, 0) for i, t in rows], DOCS)


def ids(df):
    return sorted(r["doc_id"] for r in df.collect() if r["doc_id"] is not None)


def test_every_operator_has_a_query():
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in queries.QUERIES)] == []
    assert queries.ORACLES.keys() <= queries.QUERIES.keys()


def test_one_of_each_group_stays(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen"
    rows = [(4, text), (9, text), (4, text), (7, text + " more"), (8, "something else is here and stays as well"), (3, ""), (5, None), (None, text)]
    kept = corpus_pipeline.one_of_each_group(spark, table(spark, rows), SMALL)
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")]
    assert ids(kept) == [3, 4, 5, 8]


def test_contaminated_documents_go(spark):
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").first()["text"]
    rows = [(1, f"before {item} after"), (2, "clean words only"), (3, None)]
    assert ids(corpus_pipeline.drop_contaminated(spark, table(spark, rows), SMALL)) == [2, 3]


def test_contamination_is_judged_row_by_row(spark):
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").limit(2).collect()]
    rows = [(None, f"see {items[0]} there"), (1, f"and {items[1]}"), (1, "clean words only"), (None, "clean too"), (2, None)]
    kept = corpus_pipeline.drop_contaminated(spark, table(spark, rows), SMALL)
    assert {(r["doc_id"], r["text"]) for r in kept.collect()} == {*rows[2:]} and kept.count() == 3


def test_contaminated_rows_go_whatever_the_bitmap_lets_through(spark):
    items = [(i, " ".join(f"w{i}x{k}" for k in range(8))) for i in range(12)]
    own = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [*[(None, f"a {t} b") for _, t in items], (None, "clean"), (3, None)]
    kept = tiling.without_contaminated(table(spark, rows), own, filter_bits=15, rows_per_task=1)
    assert {(r["doc_id"], r["text"]) for r in kept.collect()} == {(None, "clean"), (3, None)}


def test_near_duplicates_are_judged_row_by_row(spark):
    one, two, three = (" ".join(f"{w}{k}" for k in range(13)) for w in "abc")
    rows = [
        (None, one), (None, one), (4, one), (9, one + " more"),  # one group with an id
        (None, two), (None, two), (None, two + " more"),  # one without
        (4, three), (2, three), (9, "another text of the same id stays here"),  # ids shared by texts of other groups
        (None, None), (None, None), (None, ""), (5, ""), (5, ""), (5, None),  # no words
    ]
    kept = corpus_pipeline.one_of_each_group(spark, table(spark, rows), SMALL).collect()
    left = sorted(((r["doc_id"], r["text"]) for r in kept), key=str)
    of_two = [x for x in left if x[0] is None and x[1]]
    assert len(of_two) == 1 and of_two[0][1].startswith(two)
    others = [(4, one), (2, three), rows[9], (None, None), (None, None), (None, ""), (5, ""), (5, None)]
    assert left == sorted([*others, *of_two], key=str)


def test_the_whole_pipeline_against_plain_accounts(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    result = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    model = toxicity.fit(documents, spark.read.parquet(f"{SMALL}/labels.parquet"))
    scores = toxicity.toxic_spans(documents, model).where(F.col("score") < 0.5).select("doc_id")
    clean = {r["doc_id"] for r in scores.collect()}
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    sets = {i: shingles(texts[i], 5) for i in sorted(clean)}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if b < a and sets[a] and sets[b]:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    x, y = root(a), root(b)
                    up[max(x, y)] = min(x, y)
    first = {i for i in sets if root(i) == i}
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    hit = {i for i in first if any(t in texts[i] for t in items)}
    assert first - set(result) >= hit
    assert set(result) <= first
    assert len(first - hit - set(result)) <= 1  # a reordered passage at most
    pieces = sentencepieces.Pieces(corpus_pipeline.PIECES)
    for i, row in result.items():
        back = sentencepieces.decode_ids(np.array(row["ids"], np.int64), np.array([0, len(row["ids"])]), pieces)
        assert back == [texts[i]] and row["n_tokens"] == len(row["ids"])


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stages_take_odd_rows_and_empty_tables(spark, name, stage):
    rows = [(1, None), (2, ""), (None, "a b c"), (3, "x" * 5000), (3, "x" * 5000), (4, "ñ 漢 🙂")]
    kept = stage(spark, table(spark, rows), SMALL)
    assert ids(kept.distinct() if name != "sentencepiece" else kept.select("doc_id").distinct()) == [1, 2, 3, 4]
    assert stage(spark, table(spark, []), SMALL).count() == 0


@pytest.mark.parametrize("name", [q for q in queries.QUERIES])
def test_every_query_runs_over_the_small_tables(spark, name):
    result = queries.QUERIES[name](spark, SMALL)
    assert result.count() >= 1
