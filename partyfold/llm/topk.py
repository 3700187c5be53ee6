"""Exact top-k search by inner product: columnar branch and bound.

Vectors are integers. Queries and vectors are dealt by hash into blocks of bounded size, and
every block of queries meets every block of vectors in one task. There a block of vectors is laid out
vertically, one row for each dimension, and inner products grow dimension block by
dimension block, those with the most mass first. After each block the mass that is left,
the product of the norms over the remaining dimensions, bounds what a score can still
gain or lose; vectors whose upper bound is below the k-th lower bound are out, and the
survivors are compacted. Partial sums are integers held exactly in floating point; where
they could pass 2**53 the block is done with Python's integers instead.

Each task returns k rows for each query, and a window over them keeps the best k.

Vectors that are null or hold null or non-finite components take no part; vectors meet only
vectors of their own length; the empty vector scores 0. Scores beyond the range of a
bigint are set to its end. Repeated rows are candidates one by one, but a repeated query
is one query. A null id takes no part as a query; as a candidate it counts as the largest id. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LAST_ID = (1 << 63) - 1
_EXACT = float(1 << 53)


def quantised(vector: Column, factor: int = 256) -> Column:
    """`floor(factor * x)` of each component; null for a vector that takes no part."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(wide, lambda x: F.floor(x * F.lit(float(factor))).cast("bigint")))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _exact_block(queries: np.ndarray, vectors: np.ndarray) -> list[np.ndarray]:
    rows = vectors.astype(object)
    limit = 1 << 63
    return [
        np.array([min(max(int(s), -limit), limit - 1) for s in rows @ q.astype(object)], object)
        for q in queries
    ]


def search_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int,
    width: int = 16, batch: int = 64,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, places of its best vectors, their scores), the query's own id left out."""
    n, dims = vectors.shape
    sizes = [np.abs(a.astype(np.float64)).max(initial=0) for a in (queries, vectors)]
    if sizes[0] * sizes[1] * max(dims, 1) >= _EXACT:
        for i, scores in enumerate(_exact_block(queries, vectors)):
            own = np.flatnonzero(ids != query_ids[i])
            order = sorted(own.tolist(), key=lambda j: (-scores[j], ids[j]))[:k]
            yield i, np.array(order, np.int64), scores[order]
        return
    order = np.argsort(-(vectors.astype(np.float64) ** 2).sum(axis=0), kind="stable")
    columns = np.ascontiguousarray(vectors[:, order].T, np.float64)
    q = queries[:, order].astype(np.float64)
    cuts = [*range(0, dims, width), dims] if dims else [0, 0]

    def rest(squares: np.ndarray, axis: int) -> list[np.ndarray]:
        """Norms over the dimensions from each cut on."""
        return [np.sqrt(squares.take(range(c, dims), axis).sum(axis=axis)) for c in cuts]

    rest_q, rest_v = rest(q**2, 1), rest(columns**2, 0)
    for lo in range(0, len(q), batch):
        own = q[lo : lo + batch]
        first = own[:, : cuts[1]] @ columns[: cuts[1]]
        for i in range(len(own)):
            there = np.flatnonzero(ids != query_ids[lo + i])
            scores = first[i, there]
            for a, b in zip(cuts[1:], [*cuts[2:], dims]):
                at = cuts.index(a)
                bound = rest_q[at][lo + i] * rest_v[at][there] * (1 + 1e-9)
                if len(there) > k:
                    floor = np.partition(scores - bound, len(there) - k)[len(there) - k]
                    alive = scores + bound >= floor
                    if alive.sum() < 0.9 * len(there):
                        there, scores = there[alive], scores[alive]
                if a < b:
                    scores = scores + own[i, a:b] @ columns[a:b, there]
            best = _best(scores, ids[there], k)
            yield lo + i, there[best], scores[best]


def _searcher(k: int):
    def flush(sides, keys, ids, vectors):
        side, key, number = np.array(sides), np.array(keys), np.array(ids)
        table = np.array(vectors, np.int64).reshape(len(vectors), -1)
        is_query = side == 0
        rows = [[], [], [], []]
        found = search_block(number[is_query], table[is_query], number[~is_query], table[~is_query], k)
        for i, places, scores in found:
            rows[0] += [int(number[is_query][i])] * len(places)
            rows[1] += [int(key[is_query][i])] * len(places)
            rows[2] += number[~is_query][places].tolist()
            rows[3] += [int(s) for s in scores]
        return pa.RecordBatch.from_arrays(
            [pa.array(r, pa.int64()) for r in rows], ["query_id", "query_key", "vec_id", "score"]
        )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [], [], [])
        for batch in batches:
            cells = list(zip(*(batch[c].to_pylist() for c in ("dims", "query_block", "block"))))
            columns = [batch[c].to_pylist() for c in ("side", "query_key", "id")]
            vectors = batch["vector"]
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum([c[0] for c in cells])])
            for i, cell in enumerate(cells):
                if cell != now:
                    if 0 in held[0] and 1 in held[0]:
                        yield flush(*held)
                    now, held = cell, ([], [], [], [])
                for own, column in zip(held, columns):
                    own.append(column[i])
                held[3].append(flat[at[i] : at[i + 1]])
        if 0 in held[0] and 1 in held[0]:
            yield flush(*held)

    return search


def top_k(
    queries: DataFrame, vectors: DataFrame, k: int = 5, query_block: int = 2048, block: int = 8192
) -> DataFrame:
    """`query_id, rank, vec_id, score`: the k best vectors of each query.

    `queries` has `query_id` and `vector`, `vectors` has `vec_id` and `vector`, both arrays of bigint.
    """
    asked = (
        queries.select(F.col("query_id").cast("bigint").alias("id"), "vector")
        .where("id is not null and vector is not null").distinct()
        .withColumn("query_key", F.xxhash64("id", "vector"))
    )
    there = vectors.select(
        F.coalesce(F.col("vec_id").cast("bigint"), F.lit(_LAST_ID)).alias("id"), "vector"
    ).where("vector is not null")
    n_queries = max(1, ceil(asked.count() / query_block))
    n_blocks = max(1, ceil(there.count() / block))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    asked = asked.select(
        F.size("vector").alias("dims"), F.pmod("query_key", F.lit(n_queries)).cast("int").alias("query_block"),
        every(n_blocks).alias("block"), F.lit(0).alias("side"), "query_key", "id", "vector",
    )
    there = there.select(
        F.size("vector").alias("dims"), F.lit(0).cast("bigint").alias("query_key"), "id", "vector",
        F.pmod(F.xxhash64("id", "vector"), F.lit(n_blocks)).cast("int").alias("block"), every(n_queries).alias("query_block"),
    ).select("dims", "query_block", "block", F.lit(1).alias("side"), "query_key", "id", "vector")
    cells = ("dims", "query_block", "block")
    found = (
        asked.unionAll(there).repartition(*cells).sortWithinPartitions(*cells)
        .mapInArrow(_searcher(k), "query_id bigint, query_key bigint, vec_id bigint, score bigint")
    )
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.nullif("vec_id", F.lit(_LAST_ID)).alias("vec_id"), "score"
    )
