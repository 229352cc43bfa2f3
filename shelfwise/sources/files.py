"""Questions about stored files, and what writing them leaves behind."""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK = threading.Lock()
# sessions in which writes are running: how many, and what the session's own setting was
_WRITING: dict[str, tuple[int, str | None]] = {}


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """A write in here leaves no shuffle files: they are deleted when it ends.

    Otherwise they stay until the driver happens to collect its garbage, and the shuffles of
    a load and of later writes add up on disk. Only for writes: a DataFrame that is itself run twice
    would have to be shuffled again. The session's setting is put back by the last of concurrent writes.
    """
    session = spark._jsparkSession.sessionUUID()
    with _LOCK:
        writers, own = _WRITING.get(session) or (0, spark.conf.get(RELEASE, None))
        _WRITING[session] = (writers + 1, own)
        spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        with _LOCK:
            writers, own = _WRITING.pop(session)
            if writers > 1:
                _WRITING[session] = (writers - 1, own)
            elif own is None:
                spark.conf.unset(RELEASE)
            else:
                spark.conf.set(RELEASE, own)


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists and holds anything but hidden entries; storage errors are raised."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(context._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in system.listStatus(folder))


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Digest of the names, lengths and write times of the files at ``paths`` (files or folders of files)."""
    context = spark.sparkContext
    digest = hashlib.sha1()
    for path in paths:
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        system = target.getFileSystem(context._jsc.hadoopConfiguration())
        found = [(str(f.getPath()), f.getLen(), f.getModificationTime()) for f in system.listStatus(target)]
        digest.update(repr(sorted(found)).encode())
    return digest.hexdigest()


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of this package's own making with all it holds."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
