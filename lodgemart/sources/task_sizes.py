"""Shuffles that are read in tasks small enough to sort in memory, however large the input is."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

#: Shuffled bytes that a task reads; sorting compressed rows takes five to eight times that in memory.
TASK_BYTES = 16 << 20
#: Every map task writes a block for each part of a shuffle, so their number has an end.
MOST_PARTS = 10_000

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PARTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def listed_bytes(spark: SparkSession, paths: Sequence[str]) -> int:
    """The length of all files at ``paths``, listed by Spark."""
    if not paths:
        return 0
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.agg(F.sum("length").alias("n")).first()["n"] or 0


@contextmanager
def small_tasks(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Adaptive execution deals shuffles over tasks of ``TASK_BYTES``, from enough parts for an input of this size.

    A sort that outgrows its task's memory writes its rows to disk once more, wide rows too. What
    the session sets itself is kept, and its settings are put back afterwards.
    """
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(-(-input_bytes // TASK_BYTES), MOST_PARTS))
    own = {k: v for k, v in ((ADVISORY, TASK_BYTES), (PARTS, parts)) if spark.conf.get(k, None) is None}
    for key, value in own.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key in own:
            spark.conf.unset(key)
