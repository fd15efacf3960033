"""Data-quality column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodgemart.schemas import BLANK_TOKENS


def holds(condition: Column) -> Column:
    """``condition`` as a flag that is never null: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def unless(condition: Column, value: Column) -> Column:
    """``value``, or null where ``condition`` holds; unknown keeps the value."""
    return F.when(~holds(condition), value)


def is_blank(text: Column, tokens: Sequence[str] = BLANK_TOKENS) -> Column:
    return F.trim(text).isin(*tokens)


def outside(value: Column, valid: Sequence[str]) -> Column:
    """Not one of ``valid``, exact in case and spaces; unknown for null."""
    return ~value.isin(*valid)
