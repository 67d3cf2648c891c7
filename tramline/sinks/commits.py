"""Appending a batch to a table of day folders so that it is there whole or not at all, and once.

A batch is written to a staging folder first. Then its plan, the list of its
files with the places they go to, appears under the table's open plans in one
rename; from then on the batch is decided, and publishing moves the files one by
one under names that begin with the batch's own. When all are moved the plan is
renamed to the done ones. Whoever takes the batch again finds it done, or
finishes the moves of its open plan, or, without a plan, stages it anew. Readers
leave out files of open plans (``unpublished``), so half a batch is never seen.

Nothing is searched in the table itself, whatever days a batch has, none
included. Plans list files, of which a batch has one or a few per day.
"""

from __future__ import annotations

import hashlib
import json
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

#: Files from which on some are moved at the same time.
MANY, MOVERS = 32, 8
OPEN, DONE, STAGED = "_plans/open", "_plans/done", "_plans/staged"


class Folder:
    """The file system that a path lies on."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._jvm = spark._jvm
        self._system = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._system.listStatus(self._path(path)))

    def age(self, path: str) -> float:
        """Seconds since the file was written."""
        return time.time() - self._system.getFileStatus(self._path(path)).getModificationTime() / 1000

    def files(self, path: str) -> list[str]:
        """The data files below a folder, as paths relative to it."""
        top = self._system.makeQualified(self._path(path)).toString()
        found, out = self._system.listFiles(self._path(path), True), []
        while found.hasNext():
            name = found.next().getPath().toString()[len(top) + 1:]
            if not any(part.startswith(("_", ".")) for part in name.split("/")):
                out.append(name)
        return sorted(out)

    def move(self, source: str, target: str) -> None:
        self._system.mkdirs(self._path(target).getParent())
        if not self._system.rename(self._path(source), self._path(target)) and not self.exists(target):
            raise OSError(f"{source} could not be moved to {target}")

    def write(self, path: str, text: str) -> None:
        out = self._system.create(self._path(path), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, path: str) -> str:
        stream = self._system.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        self._system.delete(self._path(path), True)


def batch_name(batch_id: str) -> str:
    return "b" + hashlib.sha256(batch_id.encode()).hexdigest()[:24]


def stage(rows: DataFrame, root: str, table: str, batch_id: str, write) -> bool:
    """Writes a batch aside and decides it; False if it was decided before. ``write(rows, folder)`` writes Parquet."""
    spark, name = rows.sparkSession, batch_name(batch_id)
    disk = Folder(spark, root)
    if any(disk.exists(f"{root}/{state}/{table}/{name}") for state in (DONE, OPEN)):
        return False
    staged = f"{root}/{STAGED}/{table}/{name}"
    disk.delete(staged)
    write(rows, staged)
    plan = {"batch_id": batch_id, "files": disk.files(staged)}
    disk.write(f"{staged}/_plan", json.dumps(plan))
    disk.move(f"{staged}/_plan", f"{root}/{OPEN}/{table}/{name}")
    return True


def publish(spark: SparkSession, root: str, table: str, name: str, most: int | None = None) -> None:
    """Finishes an open plan, or moves ``most`` of its files; files that were moved before are left as they are."""
    disk = Folder(spark, root)
    plan = f"{root}/{OPEN}/{table}/{name}"
    if not disk.exists(plan):
        return
    files = json.loads(disk.read(plan))["files"]

    def place(file: str) -> None:
        folder, _, last = file.rpartition("/")
        source, target = f"{root}/{STAGED}/{table}/{name}/{file}", f"{root}/{table}/{folder}/{name}-{last}"
        if not disk.exists(target):
            disk.move(source, target)

    # Which files come first does not matter; those of many days are moved by a few threads.
    if len(files) < MANY:
        for file in files[:most]:
            place(file)
    else:
        with ThreadPoolExecutor(MOVERS) as pool:
            list(pool.map(place, files[:most]))
    if most is None or most >= len(files):
        disk.move(plan, f"{root}/{DONE}/{table}/{name}")
        disk.delete(f"{root}/{STAGED}/{table}/{name}")


def append(rows: DataFrame, root: str, table: str, batch_id: str, write) -> bool:
    """Adds a batch to a table; False if the table has it already or an earlier attempt had decided it, which is finished."""
    fresh = stage(rows, root, table, batch_id, write)
    publish(rows.sparkSession, root, table, batch_name(batch_id))
    return fresh


def unpublished(spark: SparkSession, root: str, table: str) -> list[str]:
    """Beginnings of the names of files whose batch is not whole yet; mostly none."""
    return Folder(spark, root).names(f"{root}/{OPEN}/{table}")


def finish(spark: SparkSession, root: str, table: str) -> int:
    """Publishes the batches of open plans, for a store whose writer does not come back; returns how many."""
    names = unpublished(spark, root, table)
    for name in names:
        publish(spark, root, table, name)
    return len(names)


def forget(spark: SparkSession, root: str, table: str, older_than_days: float) -> int:
    """Deletes done plans of batches so old that no stream takes them again; returns how many."""
    disk, folder = Folder(spark, root), f"{root}/{DONE}/{table}"
    old = [n for n in disk.names(folder) if disk.age(f"{folder}/{n}") > older_than_days * 86400]
    for name in old:
        disk.delete(f"{folder}/{name}")
    return len(old)
