"""Load events: one record for every table that a run has finished.

The records go to a manifest table instead of a message broker. Branches of a run, and runs, append at
the same time: each appends a batch in folders of its own and then commits it by a small file that
appears in one step. Readers take the batches that are committed and every event once, whoever
wrote it. Compaction merges batches: its commit names those that it stands for, and they go when
no reader can still be at work on them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partyfold import fixed
from partyfold.operators.joins import unmatched_rows
from partyfold.sources.files import Files
from partyfold.sources.tables import PARQUET

_COMMITS = "_commits"
_BATCH = "__batch"


def load_events(finished: DataFrame, table: Column, mode: Column, stamp: Column) -> DataFrame:
    """One event per table, load mode and day stamp, with its message.

    The message is the event as JSON in base64. Repeated rows are one event.
    """
    name, kind, day = fixed.LOAD_EVENT_FIELDS
    fields = zip((table, mode, stamp), (name, kind, day))
    events = finished.select(*[value.cast("string").alias(field) for value, field in fields]).distinct()
    body = F.to_json(F.struct(*fixed.LOAD_EVENT_FIELDS))
    lines = F.base64(F.encode(body, "UTF-8"))  # broken after 76 characters
    return events.withColumn("message", F.replace(lines, F.lit("\r\n"), F.lit("")))


def decode_messages(events: DataFrame) -> DataFrame:
    """The fields of the messages, read back from base64 and JSON."""
    schema = ", ".join(f"`{field}` string" for field in fixed.LOAD_EVENT_FIELDS)
    body = F.decode(F.unbase64("message"), "UTF-8")
    return events.select(F.from_json(body, schema).alias("event")).select("event.*")


def _commits(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The committed batches, and for each those that it stands for."""
    files, folder = Files(spark), f"{path.rstrip('/')}/{_COMMITS}"
    names = [n for n, _ in files.list(folder) if "." not in n]
    return {n: json.loads(files.read_text(f"{folder}/{n}")) for n in names}


def _commit(spark: SparkSession, path: str, batch: str, replaces: list[str]) -> None:
    Files(spark).replace_text(f"{path.rstrip('/')}/{_COMMITS}/{batch}", json.dumps(replaces))


def committed_batches(spark: SparkSession, path: str) -> list[str]:
    """Batches that readers take: committed, and no other one stands for them."""
    commits = _commits(spark, path)
    replaced = {old for olds in commits.values() for old in olds}
    return sorted(commits.keys() - replaced)


def _batches(spark: SparkSession, path: str, batches: list[str], fmt: str) -> DataFrame:
    """The rows of some batches. The days stay text, although they are names of folders."""
    schema = ", ".join(f"`{c}` string" for c in (*fixed.LOAD_EVENT_FIELDS, "message"))
    if not batches:
        return spark.createDataFrame([], schema)
    base, (*_, day) = path.rstrip("/"), fixed.LOAD_EVENT_FIELDS
    files = Files(spark)
    folders = [f for b in batches for f in files.find(base, f"{day}=*/{_BATCH}={b}")]
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, `{_BATCH}` string").format(fmt).option("basePath", base)
    return rows.load([f"{base}/{f}" for f in folders]).drop(_BATCH)


def read_manifest(spark: SparkSession, path: str, fmt: str = PARQUET) -> DataFrame:
    """All events of a manifest, each once."""
    return _batches(spark, path, committed_batches(spark, path), fmt).distinct()


def _write_batch(events: DataFrame, path: str, replaces: list[str], fmt: str) -> None:
    """Write and commit a batch; a failure before the commit leaves nothing that readers see.

    Every batch is written by a job of its own folder first, as jobs that write to one folder at once
    remove each other's work, and its folders are then moved in place.
    """
    spark, (*_, day) = events.sparkSession, fixed.LOAD_EVENT_FIELDS
    files, base, batch = Files(spark), path.rstrip("/"), uuid.uuid4().hex
    staging = f"{base}/_staging-{batch}"
    moved: list[str] = []
    try:
        gathered = events.hint("rebalance", day)  # a file for a day, unless it is a large one
        gathered.withColumn(_BATCH, F.lit(batch)).write.format(fmt).partitionBy(day, _BATCH).save(staging)
        for folder in files.find(staging, f"*/{_BATCH}={batch}"):
            files.make_folder(f"{base}/{folder.rpartition('/')[0]}")
            files.rename(f"{staging}/{folder}", f"{base}/{folder}")
            moved.append(folder)
        _commit(spark, base, batch, replaces)
    except BaseException:
        for folder in moved:
            files.remove(f"{base}/{folder}")
        raise
    finally:
        files.remove(staging)


def append_manifest(events: DataFrame, path: str, fmt: str = PARQUET) -> None:
    """Append the events that the manifest does not hold yet, so a repeated run adds none.

    The manifest has one folder per day, and only the days of the new events are compared. Any number of
    runs may append at once: what two of them both append is read once.
    """
    spark = events.sparkSession
    *_, day = fixed.LOAD_EVENT_FIELDS
    batches = committed_batches(spark, path)
    if batches:
        days = [r[0] for r in events.select(day).distinct().collect()]  # a few: the days of a run
        known = _batches(spark, path, batches, fmt).where(F.col(day).isin(days))
        events = unmatched_rows(events, known, fixed.LOAD_EVENT_FIELDS, null_safe=True)
    _write_batch(events, path, [], fmt)


def compact_manifest(spark: SparkSession, path: str, fmt: str = PARQUET) -> None:
    """Merge the committed batches into one, each event once.

    Runs may append meanwhile; their batches stay as they are. Batches that an earlier compaction
    has replaced are removed now, those replaced by this one stay for readers that are at work.
    """
    *_, day = fixed.LOAD_EVENT_FIELDS
    files, base = Files(spark), path.rstrip("/")
    commits = _commits(spark, path)
    batches = committed_batches(spark, path)
    if len(batches) > 1:
        merged = _batches(spark, path, batches, fmt).distinct()
        _write_batch(merged, path, batches, fmt)
    for batch in {old for olds in commits.values() for old in olds}:
        for folder in files.find(base, f"{day}=*/{_BATCH}={batch}"):
            files.remove(f"{base}/{folder}")
        files.remove(f"{base}/{_COMMITS}/{batch}")
