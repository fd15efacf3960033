"""Checks of child rows against their parent table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgemart.functions.quality import holds
from lodgemart.operators.skew import left_lookup


def one_row_per_key(parent: DataFrame, key: str, carry: Mapping[str, str]) -> DataFrame:
    """(_parent_key, carried columns) with one row per non-null key.

    A repeated key would multiply child rows, so it is collapsed to the repeat with the
    largest carried values.
    """
    keyed = parent.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_parent_key"))
    if not carry:
        return keyed.agg(F.count(F.lit(1)).alias("_repeats")).drop("_repeats")
    if len(carry) == 1:
        ((source, name),) = carry.items()
        return keyed.agg(F.max(source).alias(name))
    best = F.max(F.struct(*[F.col(s).alias(n) for s, n in carry.items()]))
    return keyed.agg(best.alias("_best")).select("_parent_key", "_best.*")


def flag_orphans(
    child: DataFrame,
    parent: DataFrame,
    child_key: str,
    parent_key: str,
    carry: Mapping[str, str],
    flag: str,
    splits: int = 1,
) -> DataFrame:
    """Mark child rows without a parent and bring the parent's ``carry`` columns along.

    ``carry`` maps parent columns to their names in the result. A null child key is an
    orphan. Every child row comes out exactly once. ``splits``: see ``left_lookup``.
    """
    known = one_row_per_key(parent, parent_key, carry)
    joined = left_lookup(child, known, child_key, "_parent_key", splits)
    return joined.select(
        *child.columns, *carry.values(), F.col("_parent_key").isNull().alias(flag)
    )


def flag_over(df: DataFrame, amount: str, limit: str, orphan: str, flag: str) -> DataFrame:
    """Mark rows that have a parent and whose amount exceeds the parent's limit."""
    return df.withColumn(flag, holds(~F.col(orphan) & (F.col(amount) > F.col(limit))))
