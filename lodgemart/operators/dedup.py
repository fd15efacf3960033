"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodgemart.schemas import comparable


def _orderable(df: DataFrame, skip: Sequence[str]) -> list[str]:
    left_out = {c.lower() for c in skip}
    return [f.name for f in df.schema if f.name.lower() not in left_out and comparable(f.dataType)]


def keep_latest(
    df: DataFrame, keys: Sequence[str], order_col: str, tie_break: Sequence[str] | None = None
) -> DataFrame:
    """The newest row of each key; null keys form one group.

    Ties go to the highest ``tie_break`` values, by default all other columns, so a
    repeated run keeps the same row. The rank filter is applied before the shuffle
    too: each task sends at most one row per key, however many a key has.
    """
    if tie_break is None:
        tie_break = _orderable(df, [*keys, order_col])
    newest_first = Window.partitionBy(*keys).orderBy(
        F.col(order_col).desc(), *[F.col(c).desc() for c in tie_break]
    )
    return (
        df.withColumn("_rank", F.row_number().over(newest_first))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def keep_any(df: DataFrame, keys: Sequence[str], deterministic: bool = False) -> DataFrame:
    """Some row of each key; null keys form one group.

    ``deterministic`` keeps the row with the highest remaining values, at the price of
    comparing them.
    """
    rest = _orderable(df, keys)
    if not deterministic or not rest:
        return df.dropDuplicates(list(keys))
    return keep_latest(df, keys, rest[0], rest[1:])
