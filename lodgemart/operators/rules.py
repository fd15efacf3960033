"""Cleaning rules and the chain that applies them.

Every rule is one narrow projection or filter, so a whole chain stays in the scan's
stage and Catalyst folds it into one generated loop.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgemart.functions.quality import holds, is_blank, outside, unless
from lodgemart.schemas import BLANK_TOKENS, column_type, find_column


class MissingColumnsError(ValueError):
    """A strict chain met a table without the columns one of its rules needs."""


@dataclass(frozen=True)
class Rule:
    name: str
    needs: tuple[str, ...]
    apply: Callable[[DataFrame], DataFrame]


def apply_rules(df: DataFrame, rules: Sequence[Rule], strict: bool = False) -> DataFrame:
    """Apply ``rules`` in order, passing over those whose columns are absent.

    ``strict`` raises instead of passing over.
    """
    for rule in rules:
        missing = [c for c in rule.needs if find_column(df, c) is None]
        if not missing:
            df = df.transform(rule.apply)
        elif strict:
            raise MissingColumnsError(f"{rule.name}: no column {', '.join(missing)}")
    return df


def drop_sentinel(df: DataFrame, col: str, value: str) -> DataFrame:
    """Keep rows known to differ from ``value``; a null is unknown and goes too."""
    return df.filter(F.col(col) != value)


def blank_to_null(df: DataFrame, col: str, tokens: Sequence[str] = BLANK_TOKENS) -> DataFrame:
    """Null where the trimmed text is one of ``tokens``; other text stays untrimmed."""
    text = F.col(col)
    return df.withColumn(find_column(df, col), unless(is_blank(text, tokens), text))


def parse_date(df: DataFrame, col: str, flag: str | None = None) -> DataFrame:
    """Text to date, null where it is malformed; other types pass unchanged.

    ``flag`` adds a mark for text that was present but not a date.
    """
    if not isinstance(column_type(df, col), T.StringType):
        return df.withColumn(flag, F.lit(False)) if flag else df
    parsed = F.try_to_date(F.col(col))
    out = {find_column(df, col): parsed}
    if flag:
        out[flag] = F.col(col).isNotNull() & parsed.isNull()
    return df.withColumns(out)


def parse_amount(df: DataFrame, col: str, kind: T.DataType, flag: str | None = None) -> DataFrame:
    """Text to an amount of type ``kind``, null where it is malformed or too large.

    Other types pass unchanged. ``flag`` adds a mark for text that was present but no such amount.
    """
    if not isinstance(column_type(df, col), T.StringType):
        return df.withColumn(flag, F.lit(False)) if flag else df
    text = F.col(col)
    parsed = text.try_cast(kind)
    out = {find_column(df, col): parsed}
    if flag:
        out[flag] = text.isNotNull() & (F.trim(text) != "") & parsed.isNull()
    return df.withColumns(out)


def swap_inverted(df: DataFrame, lo: str, hi: str, flag: str) -> DataFrame:
    """Put an inverted pair in order and mark it; the pair moves behind the flag.

    A single missing bound takes the other bound's value.
    """
    lo, hi = find_column(df, lo), find_column(df, hi)
    return df.select(
        *[c for c in df.columns if c not in (lo, hi)],
        holds(F.col(lo) > F.col(hi)).alias(flag),
        F.least(lo, hi).alias(lo),
        F.greatest(lo, hi).alias(hi),
    )


def null_where(df: DataFrame, col: str, bad: Column, flag: str) -> DataFrame:
    """Null ``col`` where ``bad`` holds and mark the row."""
    return df.withColumns({flag: holds(bad), find_column(df, col): unless(bad, F.col(col))})


def null_negative(df: DataFrame, col: str, flag: str) -> DataFrame:
    return null_where(df, col, F.col(col) < 0, flag)


def check_domain(df: DataFrame, col: str, valid: Sequence[str], flag: str) -> DataFrame:
    return null_where(df, col, outside(F.col(col), valid), flag)
