"""Stored copies that follow the files of their source.

Beside a copy lies a manifest: for each delta of it the source files it was made from, with
their bytes and times.  Asked for again, a copy that has them all is read as it is; new files
are added as one more delta, made from them alone; where a file is gone or was changed, a new
generation is made from all files.  A delta counts once its line of the manifest is there, so
one that broke off is made again and leaves nothing but an unread folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillflow.session import built, discard_at_exit
from tillflow.sources import files

#: Deltas beyond this number are merged into one, if the copy says how.
MOST_DELTAS = 16

Add = Callable[[list[str], str], None]
Merge = Callable[[list[str], str], None]


def follow(spark: SparkSession, source: str, root: str, add: Add, merge: Merge | None = None) -> list[str]:
    """The folders that make up the copy of ``source`` (a file or folder) below ``root`` now.

    ``add`` writes what it makes of some source files into a folder, ``merge`` the rows of
    several of the copy's folders into one with the same meaning.
    """
    while True:
        now = {(f.path, f.bytes, f.modified) for f in files.listing(spark, source, recursive=True)}
        generation, deltas = _manifest(spark, root)
        known = {mark for d in deltas for mark in d["files"]}
        if known - now:  # what the copy holds isn't all there any more
            generation, deltas, known = generation + 1, [], set()
        new = sorted(now - known)
        if not new and (deltas or not now):
            return [d["folder"] for d in deltas]
        folder = _new_folder(root, generation)
        add([path for path, _, _ in new], folder)
        if merge and len(deltas) >= MOST_DELTAS:
            merged = _new_folder(root, generation + 1)
            merge([*(d["folder"] for d in deltas), folder], merged)
            generation, folder, new, deltas = generation + 1, merged, sorted(now), []
        line = json.dumps({"folder": folder, "files": new})
        if files.write_text(spark, f"{root}/manifest/{generation:06d}.{len(deltas):06d}", line):
            _forget(spark, root, generation)
        else:  # another follower was faster
            files.delete(spark, [folder])


def _new_folder(root: str, generation: int) -> str:
    return f"{root}/gen-{generation}/delta=d{uuid.uuid4().hex[:12]}"


def stored(spark: SparkSession, folders: list[str]) -> DataFrame:
    """The rows of a copy's folders, with the partition columns they have inside."""
    base = folders[0].rpartition("/")[0] if folders else ""
    return spark.read.option("basePath", base).parquet(*folders).drop("delta")


def _manifest(spark: SparkSession, root: str) -> tuple[int, list[dict]]:
    """The newest generation and its deltas."""
    names = [f.path for f in files.listing(spark, f"{root}/manifest")]
    generation = max((int(files.name_of(n).split(".")[0]) for n in names), default=0)
    out = []
    for name in sorted(n for n in names if int(files.name_of(n).split(".")[0]) == generation):
        line = json.loads(files.read_text(spark, name))
        out.append(line | {"files": {tuple(mark) for mark in line["files"]}})
    return generation, out


def _forget(spark: SparkSession, root: str, generation: int) -> None:
    """Delete what is older than the generation before; that one may still be read."""
    old = [f.path for f in files.listing(spark, f"{root}/manifest")
           if int(files.name_of(f.path).split(".")[0]) < generation - 1]
    gone = {int(files.name_of(p).split(".")[0]) for p in old}
    files.delete(spark, [*old, *(f"{root}/gen-{g}" for g in gone)])


def copy_of(spark: SparkSession, source: str, purpose: str, add: Add, merge: Merge | None = None) -> DataFrame:
    """The copy of a source that this application keeps in its shared folder, brought up to date."""
    root = built(spark, source, purpose, lambda path: None)
    folders = follow(spark, source, root, add, merge)
    discard_at_exit(spark, root)
    return stored(spark, folders)
