"""Foreign keys of several tables checked together, with what a lost parent means for its children.

Tables are taken parents first. For each parent one aggregation over its keys and all keys that
refer to it finds the references that fail: no such row, or only rows that are lost themselves.
Child rows stay where they are; what meets them is the list of failed keys, which is sent to
all tasks where its counted size allows it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgemart.operators.skew import left_lookup
from lodgemart.sources.scratch import scratch_path

#: Failed keys that may be sent to all tasks; more are joined by shuffling.
BROADCAST_KEYS = 200_000


@dataclass(frozen=True)
class ForeignKey:
    """``child.key`` refers to ``parent.parent_key``; ``mark`` names the column that tells failures.

    A null key is a failure unless ``null_passes``.
    """

    child: str
    key: str
    parent: str
    parent_key: str
    mark: str
    null_passes: bool = False


def in_order(keys: Sequence[ForeignKey]) -> list[str]:
    """All tables of the keys, parents before children; keys that go round in a circle are refused."""
    sorter: TopologicalSorter[str] = TopologicalSorter()
    for key in keys:
        sorter.add(key.child, key.parent)
    try:
        return list(sorter.static_order())
    except CycleError as error:
        raise ValueError(f"foreign keys go round in a circle: {error.args[1]}") from None


def _failed(tables: Mapping[str, DataFrame], parent: str, column: str, keys: Sequence[ForeignKey], lost: Column) -> DataFrame:
    """(_failed, _absent): keys that children refer to in vain; absent ones have no row, others lost ones."""
    none = F.lit(None).cast("boolean")
    asked = [tables[k.child].select(F.col(k.key).alias("_failed"), none.alias("_ok")) for k in keys]
    known = tables[parent].select(F.col(column).alias("_failed"), (~lost).alias("_ok"))
    both = reduce(DataFrame.unionAll, [known, *asked]).where(F.col("_failed").isNotNull())
    found = both.groupBy("_failed").agg(
        F.max("_ok").alias("_ok"), F.count("_ok").alias("_rows"), F.count_if(F.col("_ok").isNull()).alias("_asked")
    )
    return found.where("_asked > 0 and not coalesce(_ok, false)").select("_failed", (F.col("_rows") == 0).alias("_absent"))


def _marked(child: DataFrame, failed: DataFrame, few: bool, key: ForeignKey, cascade: str) -> DataFrame:
    """``child`` with the mark of one key, and whether this or an earlier key makes it lost."""
    column = F.col(f"`{key.key}`")
    if few:
        met = child.join(F.broadcast(failed), column == F.col("_failed"), "left")
    else:
        met = left_lookup(child, failed, key.key, "_failed")
    missing = F.lit(False) if key.null_passes else column.isNull()
    gone = F.col("_failed").isNotNull() | missing
    names = [F.col(f"`{c}`") for c in child.columns if c != cascade]
    before = F.col(cascade) if cascade in child.columns else F.lit(False)
    return met.select(*names, F.coalesce("_absent", missing).alias(key.mark), (before | gone).alias(cascade))


def check_keys(
    tables: Mapping[str, DataFrame],
    keys: Sequence[ForeignKey],
    lost: Mapping[str, Column] | None = None,
    cascade: str = "dq_cascade",
) -> dict[str, DataFrame]:
    """All tables, those with foreign keys with their marks and ``cascade``.

    A mark tells that there is no parent. ``cascade`` tells that the row is lost: a parent is
    missing, or all parent rows of that key are lost themselves. ``lost`` gives conditions under
    which rows of a table count as lost from the start. Every row comes out exactly once, whatever
    repeats there are among parents; a repeated parent holds as long as one of its rows does.

    The failed keys of each parent are written to the scratch folder when this is called.
    """
    out, lost = dict(tables), lost or {}
    for parent in in_order(keys):
        frame = out[parent]
        own = F.coalesce(lost[parent], F.lit(False)) if parent in lost else F.lit(False)
        if cascade in frame.columns:
            own = own | F.col(cascade)
        referring = [k for k in keys if k.parent == parent]
        for column in sorted({k.parent_key for k in referring}):
            same = [k for k in referring if k.parent_key == column]
            path = scratch_path(frame.sparkSession, "failed-keys")
            failed = _failed(out, parent, column, same, own)
            failed.write.parquet(path)
            failed = frame.sparkSession.read.schema(failed.schema).parquet(path)
            few = failed.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
            for key in same:
                out[key.child] = _marked(out[key.child], failed, few, key, cascade)
    return out
