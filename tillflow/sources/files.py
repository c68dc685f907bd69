"""Files of tables by Hadoop's file system, whatever store a table lies in."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True, order=True)
class FileMark:
    """A file as it is now: its path, bytes and time of change."""

    path: str
    bytes: int
    modified: int


def _at(spark: SparkSession, path: str):  # noqa: ANN202
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def name_of(path: str) -> str:
    return path.rstrip("/").rpartition("/")[2]


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _at(spark, path)
    return store.exists(place)


def listing(spark: SparkSession, folder: str, recursive: bool = False) -> list[FileMark]:
    """Data files of a folder (or the file itself), without hidden ones; none if it is missing."""
    store, place = _at(spark, folder)
    if not store.exists(place):
        return []
    found, top = [], store.makeQualified(place).toString().rstrip("/")
    each = store.listFiles(place, recursive)
    while each.hasNext():
        status = each.next()
        path = status.getPath().toString()
        inner = path.removeprefix(top).strip("/") or name_of(path)
        if not any(part[:1] in ("_", ".") and "=" not in part for part in inner.split("/")):
            found.append(FileMark(path, status.getLen(), status.getModificationTime()))
    return sorted(found)


def move(spark: SparkSession, path: str, target: str) -> bool:
    """Rename one file; a repeated call finishes what an earlier one began.

    False if there is nothing at ``path`` (any more).  Where a rename is a copy and a deletion,
    both files can be there after a failure: a target of the same length is then taken as
    complete, any other is replaced.
    """
    store, here = _at(spark, path)
    _, there = _at(spark, target)
    if not store.exists(here):
        return False
    if store.exists(there):
        if store.getFileStatus(there).getLen() == store.getFileStatus(here).getLen():
            return store.delete(here, False)
        store.delete(there, False)
    store.mkdirs(there.getParent())
    if not store.rename(here, there):
        raise OSError(f"{path} could not be renamed to {target}")
    return True


def delete(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete files or whole folders; missing ones are skipped."""
    for path in paths:
        store, place = _at(spark, path)
        store.delete(place, True)


def write_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> bool:
    """Write a small file; False if it is there already and must not be replaced.

    Without ``replace`` creation is exclusive, so of several writers one succeeds.  With it,
    the text goes to a hidden file first, so that no reader sees half of it.
    """
    store, place = _at(spark, path)
    store.mkdirs(place.getParent())
    if replace:
        _, draft = _at(spark, f"{path.rpartition('/')[0]}/.{name_of(path)}.draft")
        _put(spark, store.create(draft, True), text)
        store.delete(place, False)
        return store.rename(draft, place)
    try:
        out = store.create(place, False)
    except Exception:
        if store.exists(place):
            return False
        raise
    _put(spark, out, text)
    return True


def _put(spark: SparkSession, out, text: str) -> None:  # noqa: ANN001
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if it is missing."""
    store, place = _at(spark, path)
    if not store.exists(place):
        return None
    stream = store.open(place)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
