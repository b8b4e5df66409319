"""A commit log of small JSON files, one for each version, of which only one writer can create each.

A version is written whole to a hidden file and then given its name by a step that fails if the name is taken: a hard link
on a local file system, a rename that does not overwrite elsewhere (as of HDFS). Readers see a version whole or not at
all. Versions lie in folders of a thousand, so finding the newest lists one short folder, however long the log is.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

PER_FOLDER = 1000


class Conflict(RuntimeError):
    """Another writer committed this version first."""


def _path(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def local_path(spark: SparkSession, path: str) -> str | None:
    """Where ``path`` lies on the local file system; None if it lies in another store."""
    target, fs = _path(spark, path)
    return fs.makeQualified(target).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder that do not start with a dot or an underscore; none if it is not there."""
    path, fs = _path(spark, folder)
    if not fs.exists(path):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(path)]
    return [n for n in found if n[:1] not in "._"]


def read_text(spark: SparkSession, path: str) -> str:
    path, fs = _path(spark, path)
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with this text; False, and nothing changed, if there is one of this name."""
    target, fs = _path(spark, path)
    hidden = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(hidden, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if fs.getUri().getScheme() != "file":
            return not fs.exists(target) and fs.rename(hidden, target)
        local = [spark._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, hidden)]
        try:
            spark._jvm.java.nio.file.Files.createLink(*local)
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False
        return True
    finally:
        if fs.exists(hidden):
            fs.delete(hidden, False)


class CommitLog:
    """Versions 1, 2, ... under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _file(self, version: int) -> str:
        return f"{self.root}/{version // PER_FOLDER:09d}/{version:012d}.json"

    def newest(self) -> int:
        """The newest version; 0 without any."""
        for folder in sorted((n for n in names(self.spark, self.root) if n.isdigit()), reverse=True):
            found = [int(n[:-5]) for n in names(self.spark, f"{self.root}/{folder}") if n.endswith(".json")]
            if found:
                return max(found)
        return 0

    def read(self, version: int) -> dict:
        return json.loads(read_text(self.spark, self._file(version)))

    def commit(self, version: int, content: dict) -> None:
        """Create ``version``; Conflict if another writer did."""
        if not put_if_absent(self.spark, self._file(version), json.dumps(content)):
            raise Conflict(f"another writer committed version {version} of {self.root}")
