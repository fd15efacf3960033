"""Files that appear at once: versions of a folder, published by renaming, and identities of stored data."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# A file in a published folder that names its version; readers of tables pass it over.
VERSION_FILE = "_version"


class Files:
    """The few file-system calls that a folder's versions need, on whatever system its path names."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm = spark._jvm
        self.system = self._place(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _place(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.system.exists(self._place(path))

    def changed_at(self, path: str) -> int:
        return self.system.getFileStatus(self._place(path)).getModificationTime()

    def names(self, path: str) -> list[str]:
        """Names in a folder, the oldest change first."""
        if not self.exists(path):
            return []
        found = self.system.listStatus(self._place(path))
        return [s.getPath().getName() for s in sorted(found, key=lambda s: s.getModificationTime())]

    def delete(self, path: str) -> None:
        self.system.delete(self._place(path), True)

    def move(self, source: str, target: str) -> None:
        """Rename to a name that must be free: a rename onto a folder would go inside it."""
        self.system.mkdirs(self._place(target).getParent())
        if self.exists(target) or not self.system.rename(self._place(source), self._place(target)):
            raise OSError(f"{source} could not be renamed to {target}")

    def write(self, path: str, text: str) -> None:
        """A small file, complete or not there at all."""
        part = f"{path}.part-{uuid.uuid4().hex}"
        out = self.system.create(self._place(part), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.move(part, path)

    def read(self, path: str) -> str | None:
        if not self.exists(path):
            return None
        stream = self.system.open(self._place(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


@contextmanager
def removed_on_failure(remove: Callable[[], None]) -> Iterator[None]:
    """Leaves nothing behind of a write that failed, and raises what made it fail."""
    try:
        yield
    except BaseException:
        try:
            remove()
        except Exception:  # the first error is the one to report
            pass
        raise


class StagedFolder:
    """A table's folder below ``root``: written beside it, published by a rename.

    The version before stays under ``_old`` until the next write, for readers that have begun. A
    run that dies between the two renames leaves it there, and it is what is read then.
    """

    def __init__(self, spark: SparkSession, root: str, name: str) -> None:
        self.files, self.root = Files(spark, root), root.rstrip("/")
        self.target, self.before = f"{self.root}/{name}", f"{self.root}/_old/{name}"
        self.staged = f"{self.root}/_staged/{name}-{uuid.uuid4().hex}"

    def current(self) -> str:
        """Where the table lies."""
        if not self.files.exists(self.target) and (old := self.files.names(self.before)):
            return f"{self.before}/{old[-1]}"
        return self.target

    def replace(self, write: Callable[[str], None]) -> None:
        """Runs ``write`` on a new folder and puts that in the place of the table."""
        with removed_on_failure(lambda: self.files.delete(self.staged)):
            write(self.staged)
            self.files.write(f"{self.staged}/{VERSION_FILE}", uuid.uuid4().hex)
        outdated, kept = self.files.names(self.before), None
        if self.files.exists(self.target):
            kept = f"{self.before}/{uuid.uuid4().hex}"
            self.files.move(self.target, kept)
        try:
            self.files.move(self.staged, self.target)
        except BaseException:
            if kept:
                self.files.move(kept, self.target)
            raise
        for name in outdated if kept else []:
            self.files.delete(f"{self.before}/{name}")

    def version(self) -> str | None:
        """The version published here; None for what others have written."""
        place = self.current()
        found = self.files.read(f"{place}/{VERSION_FILE}")
        return f"{found}-{self.files.changed_at(place)}" if found else None


def listed_version(spark: SparkSession, paths: Sequence[str]) -> str | None:
    """An identity of the files at ``paths``: names, lengths and times, listed by Spark; None if there are none."""
    if not paths:
        return None
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    row = files.select("path", "length", "modificationTime").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("x"),
        F.bit_xor(F.xxhash64("modificationTime", "length", "path")).alias("y"),
    ).first()
    return f"{row['n']}-{row['x']}-{row['y']}" if row["n"] else None
