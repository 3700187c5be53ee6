"""Laws that hold for any input, on generated rows."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rows import bag

from partyfold import functions as fn
from partyfold import operators as op



@pytest.fixture(autouse=True, params=[False, True], ids=["plain", "spread"])
def spread(request):
    """Every law holds as well where each row is a salt of its own."""
    return op.Spread(by=["v", "n"], rows_per_task=1) if request.param else None


SCHEMA = "k string, v string, n int"
KEYS = st.sampled_from(["a", "a ", "b", "", None])
ROWS = st.lists(
    st.tuples(KEYS, st.sampled_from(["x", "y", None]), st.sampled_from([1, 2, None])), max_size=12
)
few = settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def null_first(row):
    return [(value is not None, value or 0 if not isinstance(value, str) else value) for value in row]


@few
@given(rows=ROWS)
def test_first_per_key_is_the_smallest_row_of_each_key(frame, rows):
    best = {}
    for row in rows:
        best.setdefault(row[0], []).append(row)
    expected = Counter(min(group, key=null_first) for group in best.values())
    df = frame(rows, SCHEMA)
    assert bag(op.first_per_key(df, ["k"])) == expected
    assert bag(op.first_per_key(frame(rows[::-1], SCHEMA).repartition(3), ["k"])) == expected


@few
@given(rows=ROWS, keys=ROWS)
def test_matched_and_unmatched_make_the_whole(frame, spread, rows, keys):
    table, other = frame(rows, SCHEMA), frame(keys, SCHEMA)
    matched = bag(op.matched_rows(table, other, ["k"], spread=spread))
    known = {row[0] for row in keys} - {None}
    assert matched == Counter(row for row in rows if row[0] in known)
    assert matched + bag(op.unmatched_rows(table, other, ["k"], spread=spread)) == Counter(rows)


@few
@given(base=ROWS, delta=ROWS)
def test_upsert_twice_is_upsert_once(frame, spread, base, delta):
    changed = {row[0] for row in delta}
    expected = Counter(row for row in base if row[0] not in changed) + Counter(delta)
    once = op.delta_upsert(frame(base, SCHEMA), frame(delta, SCHEMA), ["k"], spread)
    assert bag(once) == expected
    assert bag(op.delta_upsert(once, frame(delta, SCHEMA), ["k"], spread)) == expected


@few
@given(source=ROWS, target=ROWS)
def test_adjusted_target_has_no_gaps(frame, spread, source, target):
    source_df, target_df = frame(source, SCHEMA), frame(target, SCHEMA)
    adjusted = op.gap_adjust(target_df, source_df, ["k"], spread)
    assert op.gap_rows(source_df, adjusted, ["k"], spread).count() == 0
    assert bag(adjusted) >= Counter(target)


@few
@given(left=ROWS, one=ROWS, two=ROWS)
def test_fanout_is_the_size_of_the_join(frame, left, one, two):
    counts = [Counter(row[0] for row in rows) for rows in (left, one, two)]
    expected = Counter()
    for key, n in counts[0].items():
        a, b = (0 if key is None else c[key] for c in counts[1:])
        expected[(key, n * max(a, 1) * max(b, 1))] = 1
    l, a, b = (frame(rows, SCHEMA) for rows in (left, one, two))
    assert bag(op.chain_fanout(l, "k", [(a, "k"), (b, "k")])) == expected


@few
@given(texts=st.lists(st.text(alphabet="ab#\t Ñ\n", max_size=8), min_size=1, max_size=20))
def test_clean_text_is_as_defined_and_idempotent(frame, texts):
    df = frame([(t,) for t in texts], "t string")
    once = df.select(fn.clean_text(F.col("t")).alias("t"))
    found = [row[0] for row in once.collect()]
    assert found == [t.replace("\t", " ").replace("#", "Ñ").strip(" ") for t in texts]
    assert [row[0] for row in once.select(fn.clean_text(F.col("t"))).collect()] == found
