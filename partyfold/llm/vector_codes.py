"""Vector code compression with an equal-average search.

Components become integers `floor(factor * x)`, vectors are cut into equal consecutive parts, and
every part has a codebook of its own. It starts as that part of the vectors with the smallest ids, is averaged
for some rounds, and then each part is coded by its nearest entry. The search (`codebooks`) walks the entries
outward from the part's component sum until the squared gap over the dimension strictly exceeds the best distance.

Vectors that are null or hold null or non-finite components have no row. The vector that comes first,
by id and then by components, sets the length; vectors of another length, or all if it is not a multiple of the
number of parts or zero, have no row either. Components beyond 2**30 over a part's length are set to that bound. Repeated rows and ids are vectors
one by one; a null id comes after all others. With fewer vectors than entries each is one. An empty
table gives an empty result. Other columns are ignored.

The driver sees the codebooks and a sum for each component; their size is set by parameters.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partyfold.llm.codebooks import Codebooks, assigned, averaged, decimal_text, floors, whole_vector
from partyfold.llm.storage import written
from partyfold.operators.joins import Spread, left_join_one


def compressed(
    vectors: DataFrame, parts: int = 8, factor: int = 4096, entries: int = 16, rounds: int = 6
) -> tuple[DataFrame, Codebooks]:
    """Coded vectors, and the codebooks that give them back.

    `vectors` has `vec_id`, `label` and `embedding`. The table has `vec_id, label, numbers, code, error`: entry
    numbers by part, the same in two hex digits each, and the squared distance to what the code stands for.
    """
    if not 1 <= entries <= 256:
        raise ValueError("two hex digits number 1 to 256 entries")
    by_id = [F.col("vec_id").asc_nulls_last(), "embedding"]
    whole = vectors.where(whole_vector(F.col("embedding"))).select("vec_id", "label", "embedding")
    first = whole.orderBy(*by_id).select(F.size("embedding").alias("dims")).first()
    dims = first["dims"] if first and first["dims"] % parts == 0 else 0
    usable = whole.where((F.size("embedding") == dims) & F.lit(dims > 0))
    ints = floors(F.col("embedding"), factor, max(dims // parts, 1))
    points = written(usable.select("vec_id", "label", ints.alias("vector")), "vectors")
    leading = points.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    numbers = "array<int>"
    if not leading:
        none = points.select("vec_id", "label", F.lit(None).cast(numbers).alias("numbers"))
        return none.selectExpr("*", "'' AS code", "0L AS error").limit(0), []
    start = np.array([r["vector"] for r in leading], np.int64)
    codebooks = averaged(points, np.split(start, parts, axis=1), dims, rounds)
    found = assigned(points, codebooks, dims)
    code = F.array_join(F.transform("numbers", lambda i: F.lpad(F.lower(F.hex(i)), 2, "0")), "")
    error = F.aggregate("distances", F.lit(0).cast("bigint"), lambda a, d: a + d)
    return found.select("vec_id", "label", "numbers", code.alias("code"), error.alias("error")), codebooks


def restored(coded: DataFrame, codebooks: Codebooks, factor: int = 4096) -> DataFrame:
    """The coded vectors with `vector`, the middle of what their codes stand for."""
    if not codebooks:
        return coded.withColumn("vector", F.lit(None).cast("array<double>"))
    tables = F.array(*[F.array(*[F.array(*[F.lit(int(x)) for x in e]) for e in c]) for c in codebooks])
    middle = lambda x: (x + F.lit(0.5)) / F.lit(float(factor))
    pieces = F.zip_with(tables, "numbers", lambda book, i: F.get(book, i))
    return coded.withColumn("vector", F.transform(F.flatten(pieces), middle))


def compression_report(vectors: DataFrame, **options) -> DataFrame:
    """`vec_id, code, error, label_error, codebooks_sha256` of each vector; null labels are one label."""
    coded, codebooks = compressed(vectors, **options)
    digest = sha256(",".join(map(decimal_text, codebooks)).encode()).hexdigest()
    label = F.col("label").cast("string")
    key = F.when(label.isNull(), "-").otherwise(F.concat(F.lit("="), label))
    coded = written(coded.select("vec_id", key.alias("__label"), "code", "error"), "coded")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    most = F.lit((1 << 63) - 1)
    sums = coded.groupBy(F.col("__label").alias("__of")).agg(F.least(total, most).cast("bigint").alias("label_error"))
    joined = left_join_one(coded, sums, ["__label"], ["__of"], Spread(by=["vec_id", "code"]))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
