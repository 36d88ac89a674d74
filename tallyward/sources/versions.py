"""Datasets that change as a whole: new folders are written aside, then one small file names them all.

Readers follow the newest file of ``_versions``. A writer that fails before its last step
leaves only folders that nothing names. Two writers at once both succeed, one after the
other: each version's file can be made only once, and the later one builds on the earlier.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_ATTEMPTS = 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only for a local session that names none."""
    base = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {_SETTING} to a folder that the driver and all executors share")
    return "file://" + tempfile.mkdtemp(prefix="shared-")


class Versions:
    """The versions of what lies under a folder; each is a dictionary that names paths."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def new_folder(self, purpose: str) -> str:
        return f"{self.base}/_data/{purpose}-{uuid.uuid4().hex}"

    def _path(self, *parts: str):
        return self._hadoop.Path("/".join([self.base, *parts]))

    def _files(self):
        return self._path().getFileSystem(self._conf)

    def _newest(self) -> tuple[int, dict]:
        files, folder = self._files(), self._path("_versions")
        if not files.exists(folder):
            return 0, {}
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_"))]
        if not numbers:
            return 0, {}
        stream = files.open(self._path("_versions", f"{max(numbers):09d}.json"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return max(numbers), json.loads(text)

    def current(self) -> dict:
        """What the newest version names; empty before the first commit."""
        return self._newest()[1]

    def commit(self, change: Callable[[dict], dict]) -> dict:
        """Make the next version out of the newest one. ``change`` runs again if another writer was first."""
        for _ in range(_ATTEMPTS):
            number, before = self._newest()
            after = change(json.loads(json.dumps(before)))
            staged = self._path("_versions", f"_{uuid.uuid4().hex}")
            stream = self._files().create(staged)
            try:
                stream.write(json.dumps(after, ensure_ascii=False, sort_keys=True).encode())
            finally:
                stream.close()
            try:
                self._rename(staged, self._path("_versions", f"{number + 1:09d}.json"))
            except Py4JJavaError as error:
                if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                    raise
                self._files().delete(staged, False)
            else:
                return after
        raise RuntimeError(f"{self.base}: other writers were first {_ATTEMPTS} times")

    def _rename(self, old, new) -> None:
        """Fails where the new name is taken."""
        options = self.spark.sparkContext._gateway.new_array(self._hadoop.Options.Rename, 0)
        self._hadoop.FileContext.getFileContext(old.getFileSystem(self._conf).getUri(), self._conf).rename(old, new, options)

    def expire(self) -> int:
        """Delete the folders that the newest version does not name, for use while nobody writes; returns how many."""
        files, kept = self._files(), json.dumps(self.current(), ensure_ascii=False)
        if not files.exists(self._path("_data")):
            return 0
        stale = [s.getPath() for s in files.listStatus(self._path("_data")) if s.getPath().getName() not in kept]
        for path in stale:
            files.delete(path, True)
        return len(stale)
