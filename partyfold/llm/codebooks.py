"""Rounds of assignment and averaging over integer vectors, with an exact search by sums.

A codebook is a small table of integer entries, one for each part of a vector. The entries stand in
the order of their component sums. From the place of a point's own sum the search goes outward, each
time to the entry with the smaller gap between the sums. The squared gap over the dimension is a
lower bound of the squared distance (the components' means differ by at least that much), and it
only grows from there: a point is done once it strictly exceeds the best distance. With `deviation` an
entry is also passed over if its bound by mean and standard deviation together exceeds it.
What is left is compared in integers; ties go to the smaller number. All points of an Arrow batch take a step at a time.

Integers are bounded by `bound(dims)`, so that sums, squared gaps and distances are exact in 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NONE = np.int64(1 << 32)  # a gap beyond the end of the entries
_ROUNDING = 1e-9
_BATCH = 4096

Codebooks = list[np.ndarray]


def bound(dims: int) -> int:
    """The largest component that `dims` of them may have: squares of gaps of sums stay below 2**62."""
    return (1 << 30) // max(dims, 1)


def whole_vector(vector: Column) -> Column:
    """Whether a vector is there with all its components finite numbers."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def floors(vector: Column, factor: int, dims: int) -> Column:
    """`floor(factor * x)` of each component, set to the ends of what `bound(dims)` allows."""
    most = float(bound(dims))
    scaled = lambda x: F.floor(F.least(F.greatest(x.cast("double") * float(factor), F.lit(-most)), F.lit(most)))
    return F.transform(vector, lambda x: scaled(x).cast("int"))


class SumOrder:
    """The entries of one part in the order of their sums."""

    def __init__(self, entries: np.ndarray, deviation: bool = False):
        entries = np.asarray(entries, np.int64)
        self.number = np.argsort(entries.sum(axis=1), kind="stable")
        self.entries = entries[self.number]
        self.sums = self.entries.sum(axis=1)
        self.dims = max(entries.shape[1], 1)
        self.deviation = deviation
        self.widths = self._width(self.entries, self.sums)

    def _width(self, rows: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """The root of the sum of squared differences from the mean."""
        return np.sqrt((self.dims * (rows * rows).sum(axis=1) - sums * sums) / self.dims)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest entry of each point."""
        points = np.asarray(points, np.int64)
        n, k, dims = len(points), len(self.sums), self.dims
        sums = points.sum(axis=1)
        widths = self._width(points, sums)
        best = np.full(n, (1 << 62) // dims, np.int64)
        chosen = np.full(n, k, np.int64)
        at = np.arange(n)
        high = np.searchsorted(self.sums, sums)
        low = high - 1
        while len(at):
            below = np.where(low >= 0, sums[at] - self.sums[np.maximum(low, 0)], _NONE)
            above = np.where(high < k, self.sums[np.minimum(high, k - 1)] - sums[at], _NONE)
            down = below <= above
            gap = np.minimum(below, above)
            open_ = (gap < _NONE) & (gap * np.where(gap < _NONE, gap, 0) <= best[at] * dims)
            at, low, high, down, gap = (x[open_] for x in (at, low, high, down, gap))
            entry = np.where(down, low, high)
            low, high = low - down, high + ~down
            look = np.arange(len(at))
            if self.deviation:
                apart = widths[at] - self.widths[entry]
                least = gap.astype(np.float64) ** 2 / dims + apart**2
                slack = _ROUNDING * (least + (widths[at] + self.widths[entry]) * np.abs(apart) + 1)
                look = np.flatnonzero(least - slack <= best[at])
            point, entry = at[look], entry[look]
            gaps = points[point] - self.entries[entry]
            distance = np.einsum("ij,ij->i", gaps, gaps)
            number = self.number[entry]
            nearer = (distance < best[point]) | ((distance == best[point]) & (number < chosen[point]))
            point = point[nearer]
            best[point], chosen[point] = distance[nearer], number[nearer]
        return chosen, best


def assign(orders: Sequence[SumOrder], vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry numbers and squared distances, a column for each part."""
    found = [o.nearest(p) for o, p in zip(orders, np.split(vectors, len(orders), axis=1))]
    return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def vectors_of(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch["vector"].flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, _BATCH):
            yield batch.slice(start, _BATCH)


def _sums(codebooks: Codebooks, dims: int, deviation: bool):
    """Of the points of a partition: for every entry their number and the sums of their components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = [SumOrder(c, deviation) for c in codebooks]
        sums = [np.zeros(c.shape, np.int64) for c in codebooks]
        counts = [np.zeros(len(c), np.int64) for c in codebooks]
        for batch in _portions(batches):
            vectors = vectors_of(batch, dims)
            numbers, _ = assign(orders, vectors)
            for part, own in enumerate(np.split(vectors, len(orders), axis=1)):
                np.add.at(sums[part], numbers[:, part], own)
                counts[part] += np.bincount(numbers[:, part], minlength=len(counts[part]))
        for part, (total, count) in enumerate(zip(sums, counts)):
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(used), pa.int32()), pa.array(used, pa.int32()),
                 pa.array(count[used]), pa.array(list(total[used]), pa.list_(pa.int64()))],
                ["part", "entry", "points", "sums"],
            )

    return run


def averaged(points: DataFrame, codebooks: Codebooks, dims: int, rounds: int, deviation: bool = False) -> Codebooks:
    """The codebooks after `rounds` of assignment and averaging; entries that no point uses stay.

    An average is the floor of sum over number, component by component. `points` has
    `vector`, an array of `dims` ints. A partition sends a row for each entry, and the
    driver sees a number for each component of each entry.
    """
    codebooks = [np.array(c, np.int64) for c in codebooks]
    for _ in range(rounds):
        partial = points.select("vector").mapInArrow(
            _sums(codebooks, dims, deviation), "part int, entry int, points bigint, sums array<bigint>"
        )
        wide = F.col("total").cast("decimal(38,0)")
        totals = (
            partial.select("part", "entry", "points", F.posexplode("sums").alias("place", "total"))
            .groupBy("part", "entry", "place").agg(F.sum("points").alias("points"), F.sum(wide).alias("total"))
        )
        for row in totals.collect():
            codebooks[row["part"]][row["entry"], row["place"]] = int(row["total"]) // row["points"]
    return codebooks


def assigned(
    points: DataFrame, codebooks: Codebooks, dims: int, deviation: bool = False
) -> DataFrame:
    """`points` with `numbers` and `distances`, arrays with an element for each part."""
    kept = [c for c in points.columns if c != "vector"]
    schema = points.select(*kept).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = [SumOrder(c, deviation) for c in codebooks]
        for batch in _portions(batches):
            numbers, distances = assign(orders, vectors_of(batch, dims))
            yield pa.RecordBatch.from_arrays(
                [*[batch[c] for c in kept], pa.array(list(numbers.astype(np.int32)), pa.list_(pa.int32())),
                 pa.array(list(distances), pa.list_(pa.int64()))],
                [*kept, "numbers", "distances"],
            )

    schema = schema.add("numbers", T.ArrayType(T.IntegerType())).add("distances", T.ArrayType(T.LongType()))
    return points.mapInArrow(run, schema)


def decimal_text(entries: np.ndarray) -> str:
    return ",".join(map(str, np.asarray(entries).ravel().tolist()))
