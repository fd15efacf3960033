"""Expressions that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Fixed value: all ASCII characters but digits and letters.
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else unchanged."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words_of(text: Column) -> Column:
    """Lower-cased words of a text, in order; punctuation separates them."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def size_checked(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most so many rows; counted by reading one more at most."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def row_key(id_col: str, text: str) -> list[Column]:
    """128 bits that rows of equal id and text share."""
    return [
        F.xxhash64(F.col(id_col), F.col(text)).alias("k1"),
        F.xxhash64(F.lit(5), F.col(text), F.col(id_col)).alias("k2"),
    ]
