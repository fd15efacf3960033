"""Storage layers: a folder of files per table, or a catalog schema of tables."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from lodgemart.sources.staging import Files, StagedFolder, listed_version, removed_on_failure

# Formats without a log of their own, whose overwrite deletes before it writes.
FILE_FORMATS = ("parquet", "orc", "csv", "json", "avro", "text")
VERSION = "lodgemart.version"

def canonical(spark: SparkSession, path: str) -> str:
    """A path as the file system names it: with scheme, without dots and double slashes."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    full = urlsplit(system.makeQualified(place).toString())
    return f"{full.scheme}://{full.netloc}{posixpath.normpath(full.path)}"


def overlapping(left: str, right: str) -> bool:
    """Whether two canonical places are equal or one holds the other."""
    return left == right or f"{right}/".startswith(f"{left}/") or f"{left}/".startswith(f"{right}/")


def input_places(df: DataFrame) -> set[str]:
    """The root folders and files that a frame reads."""
    found, leaves = set(), df._jdf.queryExecution().analyzed().collectLeaves().iterator()
    while leaves.hasNext():
        leaf = leaves.next()
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            relation = leaf.relation()
            if relation.getClass().getSimpleName() == "HadoopFsRelation":
                roots = relation.location().rootPaths().iterator()
                while roots.hasNext():
                    found.add(canonical(df.sparkSession, roots.next().toString()))
    return found


def refuse_own_input(df: DataFrame, target: str) -> None:
    """A write replaces its target, so a frame must not read it."""
    for place in input_places(df):
        if overlapping(place, target):
            raise ValueError(f"the frame reads {place}, which writing {target} would delete")


@dataclass(frozen=True)
class PathLayer:
    """One folder per table, each write replacing the whole table.

    Writes go to a folder of their own, which takes the table's place when it is complete: a
    write that fails leaves the table as it was. The version before is kept under ``_old`` until
    the next write.
    """

    spark: SparkSession
    root: str
    fmt: str = "parquet"

    def places(self) -> list[str]:
        """Canonical names of where this layer lies."""
        return [canonical(self.spark, self.root)]

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def prepare(self) -> None:
        """Folders appear with the first write."""

    def read(self, name: str) -> DataFrame:
        return self.spark.read.format(self.fmt).load(StagedFolder(self.spark, self.root, name).current())

    def write(self, df: DataFrame, name: str, seen: Observation | None = None, *counts: Column) -> None:
        """Replace a table; ``counts`` over its rows go to ``seen`` while writing."""
        refuse_own_input(df, canonical(self.spark, self.path(name)))
        if seen is not None:
            df = df.observe(seen, *counts)
        StagedFolder(self.spark, self.root, name).replace(df.write.format(self.fmt).save)

    def version(self, name: str) -> str | None:
        """An identity of what the table holds now; None if there is no table."""
        folder = StagedFolder(self.spark, self.root, name)
        if not folder.files.exists(folder.current()):
            return None
        return folder.version() or listed_version(self.spark, [folder.current()])


@dataclass(frozen=True)
class TableLayer:
    """A catalog schema whose tables are replaced as a whole, schema included.

    ``fmt`` may be any table format on the class path; parquet needs no extra jar.
    ``bucket_by`` maps a table to its join key: bucketed tables join on that key
    without a shuffle. Each bucket is written by its own tasks, an oversized one by
    several, so the number of files does not grow with the number of input tasks. A bucket
    is read by one task, so bucket only keys without very frequent values, or read such a
    table with ``spark.sql.sources.bucketing.enabled=false`` and let the join shuffle.

    A table of files is written under a name of its own, which is changed when it is complete, so
    a write that fails leaves the table as it was; the version before is ``<name>__old``
    until the next write. Formats with a log of their own replace a table at once anyway.

    ``statistics`` measures row counts and column statistics after each write, for cost-based
    join orders (``spark.sql.cbo.enabled``); it reads the table once more.
    """

    spark: SparkSession
    schema: str
    catalog: str | None = None
    fmt: str = "parquet"
    location: str | None = None
    bucket_by: tuple[tuple[str, str], ...] = ()
    buckets: int = 0
    statistics: bool = False

    @property
    def identity(self) -> str:
        return f"{self.catalog}.{self.schema}" if self.catalog else self.schema

    def places(self) -> list[str]:
        """The full name of the schema and the folder it lies in."""
        catalog = self.catalog or self.spark.catalog.currentCatalog()
        name = f"{catalog}.{self.schema}"
        if self.spark.conf.get("spark.sql.caseSensitive") != "true":
            name = name.lower()
        if self.location:
            folder = self.location
        elif self.spark.catalog.databaseExists(self.identity):
            folder = self.spark.catalog.getDatabase(self.identity).locationUri
        else:
            folder = f"{self.spark.conf.get('spark.sql.warehouse.dir')}/{self.schema.lower()}.db"
        return [f"schema:{name}", canonical(self.spark, folder)]

    def prepare(self) -> None:
        where = f" LOCATION '{self.location}'" if self.location else ""
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.identity}{where}")

    def use(self) -> None:
        """Make this the current catalog and schema."""
        if self.catalog:
            self.spark.catalog.setCurrentCatalog(self.catalog)
        self.spark.catalog.setCurrentDatabase(self.schema)

    def _has(self, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.identity}.{name}")

    def _current(self, name: str) -> str:
        """The table's full name; that of the version before if a run died while changing names."""
        if not self._has(name) and self._has(f"{name}__old"):
            name = f"{name}__old"
        return f"{self.identity}.{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self._current(name))

    def write(self, df: DataFrame, name: str, seen: Observation | None = None, *counts: Column) -> None:
        """Replace a table; ``counts`` over its rows go to ``seen`` while writing."""
        for folder in self.places()[1:]:
            refuse_own_input(df, f"{folder}/{name.lower()}")
        key = dict(self.bucket_by).get(name) if self.buckets else None
        if key:
            df = df.hint("rebalance", self.buckets, key)
        if seen is not None:  # behind the shuffle: what stands before one may run twice
            df = df.observe(seen, *counts)
        writer = df.write.format(self.fmt).mode("overwrite").option("overwriteSchema", "true")
        if key:
            writer = writer.bucketBy(self.buckets, key).sortBy(key)
        if self.fmt.lower() not in FILE_FORMATS:
            writer.saveAsTable(f"{self.identity}.{name}")
            return
        staged = f"{name}__staged_{uuid.uuid4().hex[:12]}".lower()

        def remove() -> None:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.identity}.{staged}")
            for folder in self.places()[1:]:  # files of a table that was never created
                Files(self.spark, folder).delete(f"{folder}/{staged}")

        with removed_on_failure(remove):
            writer.saveAsTable(f"{self.identity}.{staged}")
            self.spark.sql(f"ALTER TABLE {self.identity}.{staged} SET TBLPROPERTIES ('{VERSION}'='{uuid.uuid4().hex}')")
            if self.statistics:
                self.spark.sql(f"ANALYZE TABLE {self.identity}.{staged} COMPUTE STATISTICS FOR ALL COLUMNS")
            self._publish(staged, name)

    def _publish(self, staged: str, name: str) -> None:
        def rename(one: str, other: str) -> None:
            self.spark.sql(f"ALTER TABLE {self.identity}.{one} RENAME TO {self.schema}.{other}")

        there = self._has(name)
        if there:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.identity}.{name}__old")
            rename(name, f"{name}__old")
        try:
            rename(staged, name)
        except BaseException:
            if there:
                rename(f"{name}__old", name)
            raise

    def version(self, name: str) -> str | None:
        """An identity of what the table holds now; None if there is no table or it can't be told."""
        table = self._current(name)
        if not self.spark.catalog.tableExists(table):
            return None
        found = [r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {table}").collect() if r["key"] == VERSION]
        if found:
            return found[0]
        folders = sorted({f.rsplit("/", 1)[0] for f in self.spark.table(table).inputFiles()})
        return listed_version(self.spark, folders)


Layer = PathLayer | TableLayer


def require_distinct(layers: Sequence[Layer], files: Iterable[str] = ()) -> None:
    """Refuse layers that share or contain each other's location, or one of ``files``.

    Every write replaces its target, so a job that reads the folder it writes would
    destroy its input before reading it.
    """
    places = [layer.places() for layer in layers]
    if layers:
        places += [[canonical(layers[0].spark, f)] for f in files]
    for i, mine in enumerate(places[: len(layers)]):
        for others in places[i + 1 :]:
            for left in mine:
                for right in others:
                    if overlapping(left, right):
                        raise ValueError(f"layers overlap: {left} and {right}")
