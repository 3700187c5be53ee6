"""Centroid clustering, vector codes, and the search they share."""

import math
import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from compare import connect, differences
from conftest import DATA
from pyspark.sql import functions as F

from partyfold.llm import centroids, queries, vector_codes
from partyfold.llm.codebooks import SumOrder, bound

VECTORS = "vec_id bigint, embedding array<float>, label int, vector int, cluster int, numbers int, part int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 0, 0, 0, 0) for r in rows], VECTORS)


def whole(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def nearest(point, entries):
    return min((sum((a - b) ** 2 for a, b in zip(point, e)), i) for i, e in enumerate(entries))


def lloyd(points, entries, rounds):
    entries = [list(e) for e in entries]
    for _ in range(rounds):
        own = defaultdict(list)
        for p in points:
            own[nearest(p, entries)[1]].append(p)
        for i, members in own.items():
            entries[i] = [sum(c) // len(members) for c in zip(*members)]
    return entries


def joined(rows):
    return ",".join(str(x) for row in rows for x in row)


def plain_clusters(rows, dims, clusters, rounds):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v, _ in rows if whole(v) and len(v) == dims]
    draw = lambda i: (i is None, sha256(f"1:{i}".encode()).hexdigest())
    first = [v for _, v in sorted(kept, key=lambda r: (draw(r[0]), r[1]))[:clusters]]
    ends = lloyd([v for _, v in kept], first, rounds)
    found = [(i, *reversed(nearest(v, ends))) for i, v in kept]
    sums = Counter()
    for _, c, d in found:
        sums[c] += d
    return Counter(
        (i, c, d, sums[c], sums.total(), sha256(joined([ends[c]]).encode()).hexdigest()) for i, c, d in found
    )


def plain_codes(rows, dims, parts, entries, rounds):
    kept = [(i, [math.floor(4096 * x) for x in v], l) for i, v, l in rows if whole(v) and len(v) == dims]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width, books = dims // parts, []
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    for p in range(parts):
        own = [cut(v)[p] for _, v, _ in kept]
        books.append(lloyd(own, own[:entries], rounds))
    digest = sha256(",".join(joined(b) for b in books).encode()).hexdigest()
    coded = []
    for i, v, label in kept:
        near = [nearest(x, b) for x, b in zip(cut(v), books)]
        coded.append((i, "".join(f"{e:02x}" for _, e in near), sum(d for d, _ in near), label))
    sums = Counter()
    for *_, error, label in coded:
        sums[label] += error
    return Counter((i, code, error, sums[label], digest) for i, code, error, label in coded)


def some_rows(n, dims, seed=0):
    rng = random.Random(seed)
    value = lambda: rng.choice([0.0, 0.25, -0.25, rng.gauss(0, 1)])
    return [(rng.choice([i, i, i // 2]), [value() for _ in range(dims)], rng.choice([None, 1, 2])) for i in range(n)]


ODD = [
    (1, None, 1), (2, [None] * 8, 1), (3, [float("nan")] + [0.0] * 7, 1), (4, [float("inf")] + [0.0] * 7, 1),
    (5, [], 1), (6, [0.5], 1), (7, [0.5] * 9, 1), (8, [0.1] * 8, None), (8, [0.1] * 8, None), (None, [0.2] * 8, 3),
    (9, [-0.01] * 8, None), (0, [0.0] * 8, 2),
]


@pytest.mark.parametrize("deviation", [False, True])
@pytest.mark.parametrize("dims", [1, 3, 8, 64])
def test_search_finds_the_first_nearest_entry(dims, deviation):
    rng = np.random.default_rng(dims)
    most = bound(dims)
    for entries, points in [
        (rng.integers(-3, 4, (20, dims)), rng.integers(-3, 4, (300, dims))),
        (rng.integers(-1000, 1000, (50, dims)), rng.integers(-1200, 1200, (300, dims))),
        (np.repeat(rng.integers(-2, 2, (3, dims)), 5, axis=0), rng.integers(-2, 2, (100, dims))),
        (np.array([[most] * dims, [-most] * dims]), np.array([[-most] * dims, [most] * dims, [0] * dims])),
    ]:
        number, distance = SumOrder(entries, deviation).nearest(points)
        wide = points[:, None, :].astype(object) - entries[None].astype(object)
        all_of = (wide**2).sum(axis=2)
        assert number.tolist() == [int(np.argmin(row)) for row in all_of]
        assert distance.tolist() == all_of.min(axis=1).tolist()


def test_search_looks_at_few_entries():
    rng = np.random.default_rng(1)
    entries = rng.normal(0, 200, (512, 8)) + rng.normal(0, 400, (512, 1))
    points = entries[rng.integers(0, 512, 2000)] + rng.normal(0, 5, (2000, 8))
    order = SumOrder(np.floor(entries).astype(np.int64), True)
    looked, einsum = [], np.einsum

    def counted(form, a, b):
        looked.append(len(a))
        return einsum(form, a, b)

    np.einsum = counted
    try:
        order.nearest(np.floor(points).astype(np.int64))
    finally:
        np.einsum = einsum
    assert sum(looked) < 0.2 * 2000 * 512


@pytest.mark.parametrize("rows,dims", [(some_rows(90, 8), 8), (some_rows(5, 8, 1), 8), (ODD, 8), (some_rows(40, 3, 2), 3)])
def test_clusters(spark, rows, dims):
    found = centroids.cluster_report(table(spark, rows).repartition(3), dims=dims, clusters=7)
    columns = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    assert Counter(tuple(r[c] for c in columns) for r in found.collect()) == plain_clusters(rows, dims, 7, 3)


@pytest.mark.parametrize("rows,dims,parts", [(some_rows(90, 8), 8, 4), (some_rows(5, 8, 1), 8, 8), (ODD[1:], 8, 2), (some_rows(40, 3, 2), 3, 1)])
def test_codes(spark, rows, dims, parts):
    found = vector_codes.compression_report(table(spark, rows).repartition(3), parts=parts, entries=6)
    columns = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert Counter(tuple(r[c] for c in columns) for r in found.collect()) == plain_codes(rows, dims, parts, 6, 6)


def test_restored_vectors_are_what_the_error_says(spark):
    rows = [(i, v, l) for i, v, l in some_rows(60, 8)]
    coded, books = vector_codes.compressed(table(spark, rows), parts=4, entries=16)
    back = vector_codes.restored(coded, books).collect()
    given = Counter((i, tuple(math.floor(4096 * x) for x in v)) for i, v, _ in rows)
    assert len(back) == len(rows)
    for r in back:
        stands_for = [math.floor(4096 * x) for x in r["vector"]]
        assert any(
            i == r["vec_id"] and sum((a - b) ** 2 for a, b in zip(v, stands_for)) == r["error"] for i, v in given
        )


def test_huge_components_and_empty_tables(spark):
    rows = [(i, [3e38 * (-1) ** i] * 64, 1) for i in range(4)] + [(9, [1.0] * 64, None)]
    assert {r["distance"] for r in centroids.cluster_report(table(spark, rows), clusters=8).collect()} == {0}
    assert {r["error"] for r in vector_codes.compression_report(table(spark, rows)).collect()} == {0}
    for nothing in ([], [(1, None, None)], [(1, [], None)]):
        assert centroids.cluster_report(table(spark, nothing)).collect() == []
        assert vector_codes.compression_report(table(spark, nothing)).collect() == []
    assert vector_codes.compression_report(table(spark, [(1, [0.5] * 9, None)])).collect() == []


@pytest.mark.parametrize("name", ["op12_centroid_clusters", "op13_vector_codes"])
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_queries_agree_with_sql(spark, name, sf):
    sf_dir = str(DATA / sf)
    with connect(sf_dir) as duck:
        assert differences(queries.QUERIES[name](spark, sf_dir), duck, queries.ORACLES[name]) == []


def test_labels_share_one_error(spark):
    found = vector_codes.compression_report(table(spark, ODD[7:]), parts=2)
    assert found.where(F.col("label_error").isNull()).count() == 0
