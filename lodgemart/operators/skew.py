"""Joining a large table to a keyed parent when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgemart.schemas import comparable

# Rows without a key match nothing; they are dealt over so many places instead of one.
KEYLESS_PLACES = 1_024


def row_hash(df: DataFrame) -> Column:
    """A number that depends on the row alone, so that a repeated task deals rows as before."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if comparable(f.dataType)])


def left_lookup(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, splits: int = 1
) -> DataFrame:
    """``child`` left join ``parent``, whose key must be unique and not null; parent names must be new.

    Each side is read once. Rows meet by key and place: rows without a key are spread over
    many places, and both sides come out of a shuffle of the join's own, which adaptive
    execution can split where a key has too many rows. With ``splits`` above 1 every key is
    dealt over that many places and each parent row is repeated for them, which needs no
    adaptive execution.
    """
    key, dealt = F.col(f"`{child_key}`"), row_hash(child)
    place = F.when(key.isNull(), F.pmod(dealt, F.lit(KEYLESS_PLACES))).otherwise(
        F.pmod(dealt, F.lit(splits))
    )
    if splits > 1:
        parent_place = F.explode(F.array(*[F.lit(n).cast("bigint") for n in range(splits)]))
    else:  # always 0, but not for the optimizer, which would drop it from the key
        parent_place = F.pmod(F.xxhash64(parent_key), F.lit(1))
    placed = child.withColumn("_place", place)
    known = parent.withColumn("_parent_place", parent_place)
    same = (key == F.col(f"`{parent_key}`")) & (F.col("_place") == F.col("_parent_place"))
    return placed.join(known, same, "left").drop("_place", "_parent_place")
