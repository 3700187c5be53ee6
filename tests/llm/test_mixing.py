import random
from collections import defaultdict
from fractions import Fraction

import pytest
from compare import connect, differences
from conftest import DATA
from plain import ODD_ROWS, WHITE_WORDS
from pyspark.sql import functions as F

from partyfold.llm import mixing, queries

DOCS = "doc_id bigint, text string, source string, size int, target int, shard int, copies int, number int"
WEIGHTS, SHARE, MOST = (5, 2, 1), Fraction(3, 2), 2


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, 0, 0, 0, 0, 0) for i, t, s in rows], DOCS)


def plain_targets(sizes):
    """Round by round: what is above its bound stops there, the rest is shared again."""
    names = sorted(sizes, key=lambda s: (s is None, [] if s is None else [ord(c) for c in s]))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = SHARE * total - sum(MOST * sizes[s] for s in stopped)
        among = sum(weight[s] for s in names if s not in stopped)
        target = {s: Fraction(MOST * sizes[s]) if s in stopped else left * weight[s] / among for s in names}
        above = {s for s in names if target[s] > MOST * sizes[s]}
        if not above:
            return target
        stopped |= above


def sainte_lague(weights, seats):
    """Seat by seat to the highest quotient, ties to the first."""
    held = dict.fromkeys(weights, 0)
    for _ in range(seats):
        best = max(weights, key=lambda c: Fraction(weights[c]) / (2 * held[c] + 1))
        held[best] += 1
    return held


def some_rows(seed, n=60, sources=("b", "a", "é", "z", None)):
    rng = random.Random(seed)
    text = lambda: " ".join(["w"] * rng.choice([0, 1, 3, 40, 200]))
    return [(i, text(), rng.choice(sources[: 1 + i % len(sources)])) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"block": 3, "rows_per_shard": 7}, {"block": 1, "rows_per_shard": 1}])
@pytest.mark.parametrize("seed", [1, 2])
def test_targets_quotas_and_words(spark, seed, options):
    rows = some_rows(seed)
    found = mixing.mix_plan(docs(spark, rows), **options).collect()
    block, shards = options.get("block", 16), options.get("rows_per_shard", 2048)
    assert sorted((r["doc_id"], r["source"] or "", r["size"]) for r in found) == sorted(
        (i, s or "", len(WHITE_WORDS.findall(t))) for i, t, s in rows
    )
    sizes, words, by_shard = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in found:
        sizes[r["source"]] += r["size"]
        words[r["source"]] += r["taken"]
        by_shard[r["source"], r["shard"], r["shard_quota"]] += r["size"]
        assert 0 <= r["taken"] <= 2 * r["size"]
        spans = [(s["first"], s["words"]) for s in r["spans"] or []]
        assert sum(n for _, n in spans) == r["taken"]
        assert all(n > 0 and a >= 0 and a + n <= r["size"] for a, n in spans)
    targets = plain_targets(sizes)
    seats = int(SHARE * sum(sizes.values()) / block + Fraction(1, 2))
    quotas = sainte_lague({s: targets[s] for s in sorted(sizes, key=lambda s: (s is None, s or ""))}, seats)
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(float(targets[r["source"]]), rel=1e-12)
        assert r["source_quota"] == min(quotas[r["source"]], -(-2 * sizes[r["source"]] // block))
    for source in sizes:
        own = {shard: (quota, size) for (s, shard, quota), size in by_shard.items() if s == source}
        given = sainte_lague({k: own[k][1] for k in sorted(own)}, next(
            r["source_quota"] for r in found if r["source"] == source)) if sizes[source] else {}
        for shard, (quota, size) in own.items():
            assert quota == min(given.get(shard, 0), -(-2 * size // block))
        assert abs(words[source] - targets[source]) <= block * (1 + len(own))
    assert shards != 2048 or len(by_shard) == len(sizes)


def test_no_word_twice_before_all_once(spark):
    rows = [(i, "w " * 50, "a") for i in range(40)] + [(100 + i, "w " * 50, "b") for i in range(400)]
    found = mixing.mix_plan(docs(spark, rows), share=Fraction(1), rows_per_shard=1000).collect()
    for r in found:
        spans = sorted((s["first"], s["words"]) for s in r["spans"])
        if r["source"] == "b":  # below its words: nothing again but in the block over the line's end
            again = sum(max(0, a + n - b) for (a, n), (b, _) in zip(spans, spans[1:]))
            assert again <= 16
        else:
            assert r["taken"] == 2 * r["size"]


def test_reruns_and_partitions_agree(spark):
    rows = some_rows(3) * 2
    bag = lambda df: sorted(map(str, df.collect()))
    first = bag(mixing.mix_plan(docs(spark, rows), rows_per_shard=9))
    random.Random(1).shuffle(rows)
    assert first == bag(mixing.mix_plan(docs(spark, rows).repartition(7), rows_per_shard=9))


def test_odd_rows(spark):
    rows = [(i, t, s) for s in ("a", "", None) for i, t in ODD_ROWS] + [(7, "copy of one", "hot")] * 3000
    found = mixing.mix_plan(docs(spark, rows), rows_per_shard=50).collect()
    assert len(found) == len(rows)
    assert {r["source"] for r in found} == {"a", "", None, "hot"}
    assert all(r["taken"] == 0 and r["size"] == 0 for r in found if r["doc_id"] == 0)
    hot = [r["shard"] for r in found if r["source"] == "hot"]
    assert max(map(hot.count, set(hot))) <= 2 * 1024  # copies stand in portions of 1024


def test_no_words_and_no_rows(spark):
    nothing = mixing.mix_plan(docs(spark, [(1, None, "a"), (2, " ", None), (2, "", None)])).collect()
    assert {(r["doc_id"], r["target"], r["taken"]) for r in nothing} == {(1, 0.0, 0), (2, 0.0, 0)} and len(nothing) == 3
    assert mixing.mix_plan(docs(spark, [])).collect() == []


def test_main_path_has_no_python_workers(spark):
    plan = mixing.mix_plan(docs(spark, some_rows(1)))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_query_agrees_with_sql(spark, sf):
    sf_dir = str(DATA / sf)
    with connect(sf_dir) as duck:
        df = queries.QUERIES["op11_source_mix"](spark, sf_dir)
        assert differences(df, duck, queries.ORACLES["op11_source_mix"]) == []


def test_distributed_numbers(spark):
    from partyfold.llm.numbering import numbered

    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("x"), F.lit(1).alias("part")).repartition(13)
    found = numbered(df, ["x"]).collect()
    assert [r["x"] for r in sorted(found, key=lambda r: r["number"])] == sorted(r["x"] for r in found)
    assert sorted(r["number"] for r in found) == list(range(1000))
