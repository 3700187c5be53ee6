import random
import time

import numpy as np
import pyarrow as pa
import pytest
from plain import ODD_ROWS, docs, groups

from partyfold.llm import ngram_join
from partyfold.llm.buckets import Buckets
from partyfold.llm.components import components
from partyfold.llm.storage import Workspace
from rows import bag


def near_copies(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.6:
            words = rng.choice(rows)[1].split()
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words.append(rng.choice(vocabulary))
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 90))]
        rows.append((i, " ".join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("size", "num"), [(3, 90), (5, 80)])
@pytest.mark.parametrize("block", [400, 100_000])
def test_components_are_those_of_all_pairs(spark, size, num, block):
    rows = near_copies(num)
    small = 2 if block == 400 else 24
    found = ngram_join.near_duplicates(docs(spark, rows), size, num, 100, block, 3000, 20, small)
    assert bag(found) == groups(rows, size, num, 100)


def test_odd_rows(spark):
    assert bag(ngram_join.near_duplicates(docs(spark, ODD_ROWS), 3, 90, 100)) == groups(ODD_ROWS, 3, 90, 100)


def test_empty_table(spark):
    assert ngram_join.near_duplicates(docs(spark, [])).count() == 0


def test_copies_are_one_group_of_one_node(spark):
    rows = [(i, "one two three four five six") for i in range(200, 0, -1)]
    assert {r["component_id"] for r in ngram_join.near_duplicates(docs(spark, rows)).collect()} == {1}


def linked_sets(rng, size):
    base = rng.choice(1 << 40, size, replace=False).astype(np.uint64)
    most = size * 2 // 19
    gone = rng.integers(0, most + 1)
    return np.sort(base), np.sort(np.concatenate([base[gone // 2 + gone % 2 :], rng.choice(1 << 40, gone // 2).astype(np.uint64)]))


@pytest.mark.parametrize("size", [1, 2, 9, 10, 11, 19, 20, 57, 100, 333])
def test_linked_sets_share_a_signature(size):
    rng = np.random.default_rng(size)
    for _ in range(40):
        a, b = linked_sets(rng, size)
        inside = len(np.intersect1d(a, b))
        if len(np.array_equal(a, b) * [1]) or 100 * inside < 90 * (len(a) + len(b) - inside):
            continue
        values, offsets = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
        doc, signature, label, need = ngram_join.signatures(values, offsets, 90, 100)
        enough = []
        for own in set(label.tolist()):
            one, two = (signature[(doc == k) & (label == own)] for k in (0, 1))
            least = max(need[label == own].max(), 1)
            enough.append(len(one) and len(two) and len(set(one) & set(two)) >= least)
        assert any(enough)


def test_divide_skip_finds_what_counting_finds():
    rng = random.Random(5)
    for _ in range(200):
        lists = [np.array(sorted(rng.sample(range(40), rng.randrange(1, 30)))) for _ in range(rng.randrange(1, 12))]
        times = {}
        for own in lists:
            for x in own.tolist():
                times[x] = times.get(x, 0) + 1
        least = rng.randrange(1, len(lists) + 1)
        for weight in (0.001, 0.5, 100):
            found = ngram_join.divide_skip(lists, least, lambda ids: np.full(len(ids), least), weight)
            assert found == {x: n for x, n in times.items() if n >= least}


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(20)] + [(100, k) for k in range(101, 140)] + [(7, 7), (300, 301), (301, 300)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint"), Workspace(spark)).collect()
    label = {r["node"]: r["label"] for r in found}
    assert len(label) == len(found) == 21 + 40 + 2
    assert len({label[k] for k in range(21)}) == len({label[k] for k in range(100, 140)}) == 1
    assert len(set(label.values())) == 3
    assert components(spark.createDataFrame([], "a bigint, b bigint"), Workspace(spark)).count() == 0


def test_copies_of_a_text_take_no_more_room_than_their_signatures():
    words = [f"w{k}" for k in range(400)]
    copies = pa.record_batch({"text": [" ".join([f"copy{i}", *words]) for i in range(20)]})
    buckets, none = Buckets(200), np.zeros(0, np.uint64)
    sign = ngram_join._signer(5, 80, 100, buckets, none)
    signed = [row for k in range(20) for row in sign(iter([copies.slice(k, 1)]))]
    table = pa.Table.from_batches(signed).sort_by("bucket")
    sent = sum(len(x) for c in ("entries", "signatures") for x in table[c].to_pylist())
    dealt = list(ngram_join._tier(buckets, 24)(iter(table.to_batches())))
    assert sum(b.nbytes for b in dealt) <= 1.5 * sent
    pairs = list(ngram_join._weigher()(iter(pa.Table.from_batches(dealt).sort_by("deal").to_batches())))
    assert 19 <= sum(b.num_rows for b in pairs) < 20 * 20


@pytest.mark.parametrize("at_once", [1, 40, 100_000])
def test_pairs_that_share_enough_are_tied_or_counted_in_full(at_once):
    rng = random.Random(at_once)
    for _ in range(30):
        need = {(node, label): rng.randrange(6) for node in range(1, 9) for label in range(2)}
        rows, shared = [], {}
        for _ in range(rng.randrange(1, 60)):
            label, times = rng.randrange(2), rng.randrange(1, 3)
            nodes = sorted(rng.sample(range(1, 9), rng.randrange(2, 6)))
            members = np.array([(x, need[x, label]) for x in nodes], ngram_join._MEMBER)
            rows.append({"deal": nodes[0], "label": label, "shared": times, "members": members.tobytes()})
            for b in nodes:
                for a in nodes:
                    if a < b:
                        shared[a, b, label] = shared.get((a, b, label), 0) + times
        table = pa.Table.from_pylist(sorted(rows, key=lambda r: r["deal"]))
        counted, up = {}, list(range(9))
        for batch in ngram_join._weigher(at_once)(iter(table.to_batches(max_chunksize=7))):
            for r in batch.to_pylist():
                key = r["a"], r["b"], r["label"]
                counted[key] = counted.get(key, 0) + r["shared"]
        wanted = {k: max(need[k[0], k[2]], need[k[1], k[2]]) for k in shared}
        assert all(counted[k] <= shared[k] for k in counted if k[2] >= 0)
        ties = {k[:2] for k in counted if k[2] < 0 or counted[k] >= wanted[k]}
        assert ties <= {k[:2] for k in shared if shared[k] >= wanted[k] > 0}
        for a, b in ties:
            up = [up[a] if x == up[b] else x for x in up]
        assert all(up[k[0]] == up[k[1]] for k in shared if shared[k] >= wanted[k] > 0)


def test_shuffle_files_go_when_a_table_is_written(spark):
    def files():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {blocks.apply(k).name() for k in range(blocks.size()) if blocks.apply(k).isShuffle()}

    before = files()
    with Workspace(spark) as space:
        table = space.written(spark.range(1000).repartition("id"))
        until = time.time() + 20
        while files() - before and time.time() < until:
            time.sleep(0.1)
        assert files() <= before and table.count() == 1000
