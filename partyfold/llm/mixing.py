"""Mixing sources to target weights by Sainte-Laguë apportionment.

1. A document's size is its number of words. Sources weigh in turn `weights`, in the order of
   their code points, the null source last, and share `share` times all words by weight. A
   target stops at `most` times the words of its source; what it leaves is shared by weight among
   the others, until none is above.
2. The targets' words are a number of blocks of `block` words each. Blocks go to sources by
   the highest quotients target / 1, target / 3, target / 5 and so on, ties to the source that
   comes first. Nearly all seats are certain from the divisor; only the few between two
   bounds of it, some for each source, are ranked.
3. A source is dealt into shards of about `rows_per_shard` documents by a seeded digest, and its blocks
   go to its shards by the same rule, by the shards' words.
4. The documents of a shard stand in the order of their digests on a line of words, which is
   walked `most` times. The line is cut into blocks, the earlier laps are used up first, and of
   the lap that is used in part a systematic sample with a seeded phase takes the quota. Which blocks
   are taken before any place is a closed formula, so blocks are never made into rows.

Only the last block of a line is shorter than the others. A shard's quota stops at the blocks its line has; this and
rounding leave a source's words within a block for each shard of its target.

Everything is DataFrame work. The texts are read once; afterwards rows hold an id, a
source and a number. Copies, rows alike in id, source and size, are counted before the
shuffle and dealt out in portions, so neither a source nor an id that many rows share lands in one task.

A null text or one without words has size 0 and takes nothing. A null source is a source of its own,
a null id an id like any other. If all texts are empty all targets are 0; an empty table gives an
empty result. The result has a row for each row; rows alike in id, source and size can stand for one another.
Reruns agree, whatever the partitions. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partyfold.llm.numbering import numbered
from partyfold.llm.storage import written
from partyfold.operators.joins import Spread, left_join_one

_WORD = r"[^\x20\x09-\x0D]+"
_PORTION = 1024  # copies of a document that stand together


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def _draw(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def _ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + F.lit(b - 1)) / F.lit(b)).cast("bigint")


def source_targets(
    sources: DataFrame, weights: Sequence[int], share: Fraction, most: int
) -> tuple[DataFrame, Fraction, int]:
    """`sources` with `weight` and `target`, the sum of all targets, and the number of sources.

    Every round is one sum over the sources; the rounds end when no further source stops at its bound.
    """
    place = (F.col("number") % len(weights)).cast("int") + 1
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place).cast("bigint"))
    total, weight, n = weighed.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0)), F.count("*")
    ).first()
    amount = min(share, Fraction(most)) * total
    full_size, full_weight, full = 0, 0, 0
    wide = "decimal(38,0)"
    while True:
        left = share.numerator * total - share.denominator * most * full_size
        among = share.denominator * (weight - full_weight)
        bound = F.col("source_size").cast(wide) * F.lit(most * among).cast(wide)
        is_full = bound <= F.col("weight").cast(wide) * F.lit(left).cast(wide)
        sums = weighed.where(is_full).agg(
            F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0)), F.count("*")
        ).first()
        if sums[2] == full or full == n:
            break
        full_size, full_weight, full = sums
    part = F.lit(float(left)) * F.col("weight") / F.lit(float(max(among, 1)))
    at_bound = (F.col("source_size") * most).cast("double")
    return weighed.withColumn("target", F.when(is_full, at_bound).otherwise(part)), amount, n


def apportioned(
    cells: DataFrame, weight: Column, total: Column, count: Column, seats: Column,
    order: Sequence[str], group: str | None = None, name: str = "quota",
) -> DataFrame:
    """The cells with the number of seats that the highest quotients weight / (2k + 1) give them.

    `total`, `count` and `seats` are the sum of the weights, a bound of the number of cells, and the
    seats, of a cell's group; `order` settles ties and tells the cells of a group apart.
    """
    share, half = weight / total, count / 2
    reach = lambda seats: F.floor(share * seats + 0.5).cast("bigint")
    certain = F.greatest(F.lit(0).cast("bigint"), reach(F.greatest(seats - half, F.lit(0.0))) - 1)
    known = cells.withColumns(
        {"__certain": F.when(weight > 0, certain).otherwise(0), "__most": F.when(weight > 0, reach(seats + half) + 1)}
    )
    keys = [group, *order] if group else [*order]
    quotient = weight / (F.col("__seat") * 2 + 1)
    contested = known.where(weight > 0).withColumn(
        "__seat", F.explode(F.sequence(F.col("__certain"), F.col("__most")))
    ).select(*keys, "__seat", (-quotient).alias("__rank"), seats.alias("__seats"))
    by = [*([group] if group else []), "__rank", *order, "__seat"]
    ranked = numbered(contested, by, "__number")
    if group:
        firsts = ranked.groupBy(F.col(group).alias("__group")).agg(F.min("__number").alias("__first"))
        given = known.groupBy(F.col(group).alias("__group")).agg(F.sum("__certain").alias("__given"))
        starts = firsts.join(given, "__group")
        ranked = left_join_one(ranked, starts, [group], ["__group"], Spread(by=["__number"]))
    else:
        given = known.agg(F.coalesce(F.sum("__certain"), F.lit(0))).first()[0]
        ranked = ranked.withColumns({"__first": F.lit(0), "__given": F.lit(given)})
    won = ranked.where(F.col("__number") - F.col("__first") < F.col("__seats") - F.col("__given"))
    more = won.groupBy(*[F.col(k).alias(f"__own_{k}") for k in keys]).agg(F.count("*").alias("__more"))
    quota = F.col("__certain") + F.coalesce(F.col("__more"), F.lit(0))
    joined = left_join_one(known, more, keys, [f"__own_{k}" for k in keys])
    return joined.select(*cells.columns, quota.alias(name))


def _lap(size: Column, lap: int, block: int) -> Column:
    """The number of the first block that starts in a lap."""
    return _ceil_div(size * lap, block)


def _laps(cells: DataFrame, block: int, most: int, seed: int) -> DataFrame:
    """For every lap its first block, its blocks, those taken, and the phase of the sample."""
    size, quota, fields = F.col("shard_size"), F.col("quota"), []
    phase = _number(_draw(F.lit(seed), F.col("source_key"), F.col("shard")))
    for lap in range(most):
        first = _lap(size, lap, block)
        blocks = _lap(size, lap + 1, block) - first
        taken = F.least(F.greatest(quota - first, F.lit(0)), blocks)
        some = F.greatest(blocks, F.lit(1))
        fields.append(F.struct(first.alias("first"), blocks.alias("blocks"), taken.alias("taken"),
                               some.alias("some"), F.pmod(phase, some).alias("phase")).alias(f"lap_{lap}"))
    return cells.select("source_key", "shard", "shard_size", "quota", F.struct(*fields).alias("laps"))


def _taken_before(block_number: Column, most: int) -> Column:
    """Blocks of a line that are taken before a block."""
    total = F.lit(0).cast("bigint")
    for lap in range(most):
        own = F.col("laps")[f"lap_{lap}"]
        inside = F.least(F.greatest(block_number - own["first"], F.lit(0)), own["blocks"])
        total = total + F.call_function("div", inside * own["taken"] + own["phase"], own["some"])
    return total


def _is_taken(block_number: Column, most: int) -> Column:
    return _taken_before(block_number + 1, most) - _taken_before(block_number, most)


def _words_before(place: Column, block: int, most: int) -> Column:
    """Words of a line that are taken before a place."""
    number = F.call_function("div", place, F.lit(block).cast("bigint"))
    return _taken_before(number, most) * block + (place - number * block) * _is_taken(number, most)


def _spans(start: Column, size: Column, length: Column, block: int, most: int) -> Column:
    """The stretches of a document that are taken, as first word and number of words."""
    def lap_spans(at: Column) -> Column:
        end = at + size
        first, last = (F.call_function("div", x, F.lit(block).cast("bigint")) for x in (at, end - 1))
        taken = F.filter(F.sequence(first, last), lambda b: _is_taken(b, most) > 0)

        def span(b: Column) -> Column:
            begin = F.greatest(b * block, at)
            return F.struct((begin - at).alias("first"), (F.least((b + 1) * block, end) - begin).alias("words"))

        return F.transform(taken, span)

    found = [lap_spans(start + length * lap) for lap in range(most)]
    return F.when(size > 0, F.flatten(F.array(*found)))


def mix_plan(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: Fraction = Fraction(3, 2),
    most: int = 2,
    block: int = 16,
    rows_per_shard: int = 2048,
    seed: int = 1,
) -> DataFrame:
    """What the mix takes of each document.

    `doc_id, source, size, source_size, target, taken`, then `source_quota` (blocks), `shard`,
    `shard_quota` and `spans`: the stretches taken, as first word and number of words, those taken again listed again.
    """
    if not weights or min(weights) < 1 or most < 1 or block < 1 or rows_per_shard < 1 or share < 0:
        raise ValueError("weights, most, block and rows_per_shard are at least 1, share is not negative")
    source = F.col("source").cast("string")
    key = F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source))
    runs = written(
        docs.select(key.alias("source_key"), "doc_id", word_count(F.col("text")).alias("size"))
        .groupBy("source_key", "doc_id", "size").agg(F.count("*").alias("copies")),
        "sizes",
    )
    sources = runs.groupBy("source_key").agg(
        F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.sum("copies").alias("rows")
    )
    targets, amount, n = source_targets(numbered(sources, ["source_key"]), weights, share, most)
    seats = int(amount / block + Fraction(1, 2))
    quotas = apportioned(
        targets, F.col("target"), F.lit(max(float(amount), 1.0)), F.lit(n), F.lit(seats).cast("bigint"), ["source_key"]
    ).select(
        F.col("source_key").alias("__source"), "source_size", "target",
        F.least("quota", _lap(F.col("source_size"), most, block)).alias("source_quota"),
        _ceil_div(F.col("rows"), rows_per_shard).alias("shards"),
    )
    quotas = written(quotas, "quotas")

    joined = left_join_one(runs, quotas, ["source_key"], ["__source"], Spread(by=["doc_id", "size"]))
    portions = F.sequence(F.lit(0).cast("bigint"), _ceil_div(F.col("copies"), _PORTION) - 1)
    own = [F.lit(seed), F.col("source_key"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("size"), F.col("portion")]
    placed = (
        joined.withColumn("portion", F.explode(portions))
        .withColumn("copies", F.least(F.lit(_PORTION), F.col("copies") - F.col("portion") * _PORTION))
        .withColumn("draw", _draw(*own))
        .withColumn("shard", _number(F.col("draw")) % F.col("shards"))
    )
    fixed = ["source_size", "source_quota", "shards"]
    shards = placed.groupBy("source_key", "shard", *fixed).agg(F.sum(F.col("size") * F.col("copies")).alias("shard_size"))
    dealt = apportioned(
        shards, F.col("shard_size"), F.greatest(F.col("source_size"), F.lit(1)), F.col("shards"), F.col("source_quota"),
        ["shard"], group="source_key",
    )
    lines = _laps(dealt.withColumn("quota", F.least("quota", _lap(F.col("shard_size"), most, block))), block, most, seed)
    lines = lines.withColumnsRenamed({"source_key": "__source", "shard": "__shard", "quota": "shard_quota"})

    before = Window.partitionBy("source_key", "shard").orderBy("draw").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("size") * F.col("copies")).over(before), F.lit(0))
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1))
    laid = left_join_one(
        placed.withColumn("start", start), lines, ["source_key", "shard"], ["__source", "__shard"]
    ).withColumn("copy", copy).withColumn("start", F.col("start") + F.col("copy") * F.col("size"))
    at, size, length = F.col("start"), F.col("size"), F.col("shard_size")
    taken = F.lit(0).cast("bigint")
    for lap in range(most):
        begin = at + length * lap
        taken = taken + _words_before(begin + size, block, most) - _words_before(begin, block, most)
    name = F.when(F.col("source_key") != "1", F.expr("substring(source_key, 2)"))
    return laid.select(
        "doc_id", name.alias("source"), "size", "source_size", "target", taken.alias("taken"), "source_quota",
        "shard", "shard_quota", _spans(at, size, length, block, most).alias("spans"),
    )
