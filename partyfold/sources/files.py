"""Path operations on whatever file system a path belongs to."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


class Files:
    """A thin handle on the cluster's file systems; works on names, never on data."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _of(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._of(path).exists(self._path(path))

    def list(self, path: str) -> list[tuple[str, bool]]:
        """Names in a folder, and whether each is a folder; empty if there is no such folder."""
        if not self.exists(path):
            return []
        found = self._of(path).listStatus(self._path(path))
        return sorted((s.getPath().getName(), s.isDirectory()) for s in found)

    def find(self, base: str, pattern: str) -> list[str]:
        """Paths under a folder that match a pattern, relative to it."""
        fs, root = self._of(base), self._path(base)
        start = len(fs.makeQualified(root).toString().rstrip("/")) + 1
        found = fs.globStatus(self._path(f"{base.rstrip('/')}/{pattern}")) or []
        return sorted(s.getPath().toString()[start:] for s in found)

    def rename(self, old: str, new: str) -> None:
        if not self._of(old).rename(self._path(old), self._path(new)):
            raise OSError(f"could not rename {old} to {new}")

    def make_folder(self, path: str) -> None:
        self._of(path).mkdirs(self._path(path))

    def remove(self, path: str) -> None:
        self._of(path).delete(self._path(path), True)

    def read_text(self, path: str) -> str:
        """The text of a small file, such as a pointer."""
        stream = self._of(path).open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace_text(self, path: str, text: str) -> None:
        """Replace a small file in one step: readers find the old text or the new one."""
        fresh = f"{path}.{uuid.uuid4().hex}"
        stream = self._of(fresh).create(self._path(fresh), True)  # makes the folders above as well
        stream.write(text.encode())
        stream.close()
        options = self._jvm.org.apache.hadoop.fs.Options.Rename
        how = self._jvm.java.lang.reflect.Array.newInstance(options.OVERWRITE.getClass(), 1)
        how[0] = options.OVERWRITE
        where = self._path(path)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._of(path).makeQualified(where).toUri(), self._conf
        )
        context.rename(
            self._of(fresh).makeQualified(self._path(fresh)), self._of(path).makeQualified(where), how
        )


def scratch_dir(spark: SparkSession) -> str:
    """A new folder that all executors can reach, for intermediate tables.

    It lies under the folder the cluster names in `spark.checkpoint.dir`; without that
    setting there is none. Whoever asked for it removes it, see `scratch`.
    """
    shared = spark.conf.get(_CHECKPOINT_DIR, None)
    if shared is None:
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that all executors share")
    return f"{shared.rstrip('/')}/tables-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A scratch folder that is gone afterwards, whatever happened."""
    path = scratch_dir(spark)
    try:
        yield path
    finally:
        Files(spark).remove(path)
