"""Table scans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    infer: bool = False,
    as_text: tuple[type, ...] = (),
    options: Mapping[str, str] | None = None,
    rejects: str | None = None,
) -> DataFrame:
    """CSV with a header row: typed by ``schema``, inferred, or all strings.

    ``schema`` is matched to the header by name, ignoring case, so column order does
    not matter and undeclared columns stay strings. Only the header line is read to do
    so; inference would scan the whole input once more. Files whose header differs from
    the first one fail instead of being read by position.

    Columns of a declared type in ``as_text`` stay strings: the reader nulls what does not
    parse without a trace, a rule that parses them can mark it.

    ``options`` are the reader's: ``multiLine`` for quoted values with line breaks, whose files
    are then read by one task each, ``sep``, ``quote``, ``escape`` and so on.

    ``rejects`` names a column that holds the whole record where a value does not parse as
    its declared type, or where there are more or fewer values than the header has; null
    elsewhere. It needs a ``schema``.
    """
    reader = spark.read.options(**(options or {})).option("header", True)
    if schema is None:
        if rejects:
            raise ValueError("rejects need a declared schema")
        return reader.option("inferSchema", infer).csv(path)
    declared = {
        field.name.lower(): T.StringType() if isinstance(field.dataType, as_text) else field.dataType
        for field in schema
    }
    header = reader.csv(path).columns
    aligned = [T.StructField(c, declared.get(c.lower(), T.StringType()), True) for c in header]
    if rejects:
        aligned.append(T.StructField(rejects, T.StringType(), True))
        # A pruned read looks at fewer values, so it would reject fewer records.
        reader = reader.option("columnNameOfCorruptRecord", rejects).option("columnPruning", False)
    return reader.schema(T.StructType(aligned)).option("enforceSchema", False).csv(path)
