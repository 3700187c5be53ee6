import base64
import json
from datetime import date, datetime
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from rows import bag

from partyfold import fixed, operators as op, plans
from partyfold import sources as io

DAY = date(2024, 1, 31)
PAIRS = "k int, v string"


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "layer")


def test_missing_and_empty_paths_are_errors(spark, root, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        io.read_table(spark, root, "nothing")
    empty = tmp_path / "layer" / "empty" / "data"
    empty.mkdir(parents=True)
    stated = T.StructType([T.StructField("k", T.IntegerType())])
    with pytest.raises(AnalysisException):
        io.read_table(spark, root, "empty", expected=stated)


def test_a_table_of_many_files_is_read_by_folder_or_by_glob(spark, frame, root):
    df = frame([(n, str(n)) for n in range(20)], PAIRS)
    df.repartition(5).write.parquet(io.table_path(root, "t"))
    assert bag(io.read_table(spark, root, "t")) == bag(df)
    assert bag(io.read_dataset(spark, io.table_path(root, "t") + "/*.parquet")) == bag(df)


def test_expected_schema_is_checked(frame):
    df = frame([("a", 1, 2.0)], "V string, k int, other double")
    wanted = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    assert io.require_columns(df, wanted).columns == ["k", "v"]
    wrong = T.StructType([T.StructField("k", T.LongType()), T.StructField("x", T.StringType())])
    with pytest.raises(ValueError, match="k is int, expected bigint; x is missing"):
        io.require_columns(df, wrong)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_overwrite_replaces_everything(spark, frame, root, fmt):
    path = io.table_path(root, "t")
    io.overwrite_dataset(frame([(1, "a"), (2, "b")], PAIRS), path, fmt, compression="none")
    io.overwrite_dataset(frame([(3, "c")], PAIRS), path, fmt, compression="none")
    assert bag(io.read_dataset(spark, path, fmt).select("k", "v")) == {(3, "c"): 1}


def test_the_format_is_passed_on_to_spark(frame, root):
    with pytest.raises(Exception, match="nosuchformat"):
        io.overwrite_dataset(frame([(1, "a")], PAIRS), root, "nosuchformat")


def test_an_overwrite_may_read_what_it_replaces(spark, frame, root, tmp_path):
    path = io.table_path(root, "t")
    io.overwrite_dataset(frame([(1, "a"), (2, "b")], PAIRS), path)
    for _ in range(3):
        base = io.read_dataset(spark, path)
        io.overwrite_dataset(op.delta_upsert(base, frame([(2, "x"), (3, "y")], PAIRS), ["k"]), path)
        assert bag(io.read_dataset(spark, path)) == {(1, "a"): 1, (2, "x"): 1, (3, "y"): 1}
    names = [p.name for p in (tmp_path / "layer" / "t" / "data").iterdir()]
    versions = [n for n in names if n.startswith("version-")]
    assert len(versions) == 2  # the current one and the one before
    assert "_current" in names


def broken(df):
    return df.select(F.raise_error(F.lit("broken")).alias("k"))


def everything(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*"))


def test_a_failed_overwrite_leaves_the_old_data_and_nothing_else(spark, frame, root, tmp_path):
    path = io.table_path(root, "t")
    io.overwrite_dataset(frame([(1, "a")], PAIRS), path)
    before = everything(tmp_path)
    with pytest.raises(Exception, match="broken"):
        io.overwrite_dataset(broken(io.read_dataset(spark, path)), path)
    assert everything(tmp_path) == before
    assert bag(io.read_dataset(spark, path)) == {(1, "a"): 1}
    with pytest.raises(Exception, match="broken"):
        io.overwrite_dataset(broken(frame([(1, "a")], PAIRS)), io.table_path(root, "fresh"))
    assert not (tmp_path / "layer" / "fresh" / "data").exists()


def test_a_plain_dataset_is_read_and_replaced(spark, frame, root):
    path = io.table_path(root, "plain")
    frame([(1, "a")], PAIRS).write.parquet(path)
    with pytest.raises(Exception, match="broken"):
        io.overwrite_dataset(broken(io.read_dataset(spark, path)), path)
    assert bag(io.read_dataset(spark, path)) == {(1, "a"): 1}
    for value in ("b", "c"):
        io.overwrite_dataset(frame([(1, value)], PAIRS), path)
        assert bag(io.read_dataset(spark, path)) == {(1, value): 1}


TYPED = "a decimal(10,2), d date, t timestamp, n timestamp_ntz, x binary"


@pytest.mark.parametrize("table", [None, "typed_load"])
def test_replace_load_keeps_all_types(spark, frame, root, table):
    at = datetime(2024, 1, 2, 3, 4, 5, 678901)
    df = frame([(Decimal("1.10"), date(2024, 1, 2), at, at, b"z"), (None,) * 5], TYPED)
    path = io.table_path(root, "typed")
    try:
        io.replace_load(df.limit(1), path, table)
        stored = io.replace_load(df, path, table)
        assert [f.dataType for f in stored.schema] == [f.dataType for f in df.schema]
        assert bag(stored.drop("x")) == bag(df.drop("x"))
    finally:
        spark.sql("DROP TABLE IF EXISTS typed_load")


def test_replace_load_refuses_a_format_that_loses_types(frame, root):
    df = frame([(Decimal("1.10"),)], "a decimal(10,2)")
    with pytest.raises(TypeError, match="changed the schema"):
        io.replace_load(df, root, fmt="json")


def test_copy_takes_the_place_of_the_old_copy(spark, frame, root):
    a, b, copy = (io.table_path(root, n) for n in ("a", "b", "copy"))
    io.overwrite_dataset(frame([(1, "a")], PAIRS), a)
    io.overwrite_dataset(frame([(2.5,)], "z double"), b)
    io.copy_dataset(spark, a, copy)
    assert bag(io.copy_dataset(spark, b, copy)) == {(2.5,): 1}


def test_a_copy_keeps_codes_and_folders(spark, frame, root):
    rows = [("0123", 1), ("007", 2), (None, 3)]
    source, copy = io.table_path(root, "by_product"), io.table_path(root, "copy")
    io.write_by_product(frame(rows, "product string, n int"), source, "product")
    copied = io.copy_dataset(spark, source, copy)
    assert bag(copied.select("product", "n")) == {r: 1 for r in rows}
    assert io.partition_columns(spark, copy) == ["product"]


def test_a_copy_keeps_columns_that_only_some_files_have(spark, frame, root):
    source, copy = io.table_path(root, "evolved"), io.table_path(root, "copy")
    frame([(1,)], "id int").coalesce(1).write.parquet(source)
    frame([(2, "x")], "id int, added string").coalesce(1).write.mode("append").parquet(source)
    assert bag(io.copy_dataset(spark, source, copy)) == {(1, None): 1, (2, "x"): 1}
    frame([(3, 4)], "id int, added int").write.mode("append").parquet(source)
    with pytest.raises(Exception, match="(?i)merg"):
        io.copy_dataset(spark, source, copy)
    assert bag(io.read_whole(spark, copy)) == {(1, None): 1, (2, "x"): 1}


def test_snapshot_then_adjustment(spark, frame, root):
    io.overwrite_dataset(frame([(1, "a")], PAIRS), io.table_path(root, "t"))
    source = frame([(1, "z"), (2, "b")], PAIRS)
    adjust = lambda before: op.gap_adjust(before, source, ["k"])
    adjusted = io.adjust_after_snapshot(spark, root, "t", adjust)
    whole = {(1, "a"): 1, (2, "b"): 1}
    assert bag(adjusted) == whole
    assert bag(io.read_table(spark, root, "t", part=fixed.SNAPSHOT_DIR)) == {(1, "a"): 1}
    assert bag(io.adjust_after_snapshot(spark, root, "t", adjust)) == whole
    assert bag(io.read_table(spark, root, "t", part=fixed.SNAPSHOT_DIR)) == whole


def test_failed_adjustment_leaves_table_and_snapshot(spark, frame, root):
    io.overwrite_dataset(frame([(1, "a")], PAIRS), io.table_path(root, "t"))
    with pytest.raises(Exception, match="broken"):
        io.adjust_after_snapshot(spark, root, "t", broken)
    assert bag(io.read_table(spark, root, "t")) == {(1, "a"): 1}
    assert bag(io.read_table(spark, root, "t", part=fixed.SNAPSHOT_DIR)) == {(1, "a"): 1}


def test_dated_backup_of_a_layer(spark, frame, root, tmp_path):
    io.overwrite_dataset(frame([(1, "a")], PAIRS), io.table_path(root, "one"))
    io.overwrite_dataset(frame([(2.5,)], "z double"), io.table_path(root, "domain/two"))
    io.snapshot(spark, root, "one")
    frame([("x", 1)], "p string, n int").write.partitionBy("p").parquet(f"{root}/plain")
    for _ in range(2):
        copies = io.backup_layer(spark, root, "delta", DAY)
        assert {n: bag(df) for n, df in copies.items()} == {
            "domain/two/data": {(2.5,): 1},
            "one/data": {(1, "a"): 1},
            "one/data_bk": {(1, "a"): 1},
            "plain": {(1, "x"): 1},
        }
    assert sorted(p.name for p in tmp_path.iterdir()) == ["layer", "layer-respaldo-delta-20240131"]
    with pytest.raises(ValueError, match="load mode"):
        io.backup_layer(spark, root, "weekly", DAY)
    with pytest.raises(ValueError, match="nothing to back up"):
        io.backup_layer(spark, str(tmp_path / "none"), "full", DAY)


def test_a_backup_is_whole_or_not_there(spark, frame, root, tmp_path):
    io.overwrite_dataset(frame([(1, "a")], PAIRS), io.table_path(root, "one"))
    bad = tmp_path / "layer" / "bad" / "data"
    bad.mkdir(parents=True)
    (bad / "part.parquet").write_text("not a table")
    with pytest.raises(Exception):
        io.backup_layer(spark, root, "full", DAY)
    assert [p.name for p in tmp_path.iterdir()] == ["layer"]


def test_manifest_holds_each_event_once(spark, frame, root):
    path = io.table_path(root, "manifest")
    rows = [('say "hi"',), ("policy_object",), ("policy_object",)]

    def events(stamp):
        named = frame(rows, "name string")
        return io.load_events(named, F.col("name"), F.lit("full"), F.lit(stamp))

    for stamp in ("20240101", "20240101", "20240102"):
        io.append_manifest(events(stamp), path)
    stored = io.read_manifest(spark, path)
    expected = {
        (name, "full", stamp): 1
        for name in ('say "hi"', "policy_object")
        for stamp in ("20240101", "20240102")
    }
    assert bag(stored.select(*fixed.LOAD_EVENT_FIELDS)) == expected
    assert bag(io.decode_messages(stored)) == expected
    assert io.partition_columns(spark, path) == ["date"]


def test_messages_decode_with_plain_json_and_base64(frame):
    long_name = "A_TABLE_WITH_QUITE_A_LONG_NAME_" * 4
    df = io.load_events(
        frame([(long_name,)], "name string"), F.col("name"), F.lit("delta"), F.lit("20240101")
    )
    message = df.first()["message"]
    assert "\n" not in message
    assert json.loads(base64.b64decode(message)) == {
        "table": long_name,
        "tipo_carga": "delta",
        "date": "20240101",
    }


@pytest.mark.parametrize("text", ["1.0.1\n02.2\n\n3.x\n", "1.0.1\n02.2\n3.x", "1.0.1\r\n02.2\r\n3.x"])
def test_product_list(spark, tmp_path, text):
    path = tmp_path / "products.txt"
    path.write_bytes(text.encode())
    products = io.read_product_list(spark, str(path))
    assert bag(products) == {("101",): 1, ("022",): 1, ("3x",): 1}


def test_products_keep_their_codes_through_directories(spark, frame, root):
    rows = [("0123", n) for n in range(50)] + [("7", 1), ("a b/c", 2)]
    df = frame(rows, "product string, n int")
    path = io.table_path(root, "by_product")
    io.write_by_product(df, path, "product")
    assert bag(io.read_by_product(spark, path, df)) == bag(df)


def test_an_empty_product_is_refused(frame, root):
    df = frame([("", 1), ("7", 2)], "product string, n int")
    with pytest.raises(Exception, match="an empty product"):
        io.write_by_product(df, io.table_path(root, "by_product"), "product")


def test_loads(frame):
    schema = "k int, v string, at date"
    old, new = date(2024, 1, 1), date(2024, 1, 30)
    base = frame([(1, "base", old), (2, "base", old), (4, "base", old)], schema)
    source = frame([(1, "src", old), (2, "src", new), (2, "more", old), (3, "src", new)], schema)

    def load(mode):
        return bag(plans.loaded_table(mode, base, source, ["k"], "at", DAY, days=2).drop("at"))

    assert load("full") == bag(source.drop("at"))
    assert load("delta") == {
        (1, "base"): 1,
        (4, "base"): 1,
        (2, "src"): 1,
        (2, "more"): 1,
        (3, "src"): 1,
    }
    with pytest.raises(ValueError, match="load mode"):
        load("both")


def test_what_a_delta_run_leaves_out():
    assert plans.runs_whole_history("full") and not plans.runs_whole_history("delta")


def test_scratch_lies_in_the_folder_the_cluster_names():
    def cluster(**conf):
        get = lambda key, default: conf.get(key.split(".")[1], default)
        return SimpleNamespace(conf=SimpleNamespace(get=get))

    named = cluster(checkpoint="hdfs:///shared/")
    assert io.scratch_dir(named).startswith("hdfs:///shared/tables-")
    assert io.scratch_dir(named) != io.scratch_dir(named)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        io.scratch_dir(cluster())


def test_scratch_is_removed_whatever_happens(spark, frame):
    with pytest.raises(RuntimeError), io.scratch(spark) as folder:
        frame([(1, "a")], PAIRS).write.parquet(f"{folder}/t")
        assert io.Files(spark).exists(folder)
        raise RuntimeError
    assert not io.Files(spark).exists(folder)


def test_the_job_checks_its_inputs(spark, frame, root):
    text = lambda columns: ", ".join(f"{c} string" for c in columns)
    master = [fixed.MASTER_KEY, *fixed.MASTER_COLUMNS]
    tables = {
        "policy_object": "num_poliza bigint, num_version int, cve_filiacion string",
        "party_master": text(master),
        "contact_data": text([fixed.CONTACT_KEY, *fixed.CONTACT_COLUMNS]),
    }
    for name, schema in tables.items():
        io.overwrite_dataset(frame([], schema), io.table_path(root, name))
    assert plans.run_insured(spark, root, root).count() == 0
    io.overwrite_dataset(frame([], text(master[:-1])), io.table_path(root, "party_master"))
    with pytest.raises(ValueError, match="tscdc is missing"):
        plans.run_insured(spark, root, root)
    retyped = text(master).replace("cdrfc string", "cdrfc int")
    io.overwrite_dataset(frame([], retyped), io.table_path(root, "party_master"))
    with pytest.raises(ValueError, match="cdrfc is int, expected string"):
        plans.run_insured(spark, root, root)


def test_views_for_sql_text(spark, frame):
    plans.register_views({"fold_left": frame([(1, "a"), (2, "b")], PAIRS)})
    assert spark.sql("SELECT v FROM FOLD_LEFT WHERE K = 2").first()[0] == "b"
