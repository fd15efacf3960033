"""The report's tables: two ordered series and two top lists."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgemart.schemas import BookingColumns
from lodgemart.sources.layers import Layer

TOP_ROWS = 20

# The error conditions of a table that is not there.
ABSENT = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def top_by(df: DataFrame, metric: str, key: str, n: int = TOP_ROWS) -> DataFrame:
    """The ``n`` rows with the highest ``metric``; NaN and null last, ties by ``key``."""
    known = F.when(~F.isnan(F.col(metric).cast("double")), F.col(metric))
    return df.orderBy(known.desc_nulls_last(), key).limit(n)


def report_sections(cols: BookingColumns = BookingColumns()) -> dict[str, tuple[str, Callable[[DataFrame], DataFrame]]]:
    """Section name to (gold table, ordering of that table)."""
    return {
        "daily_revenue": ("daily_revenue", lambda t: t.orderBy("date")),
        "cancellation_rate": (
            "cancellation_rate_by_source",
            lambda t: t.orderBy(F.desc_nulls_last("cancellation_rate_pct"), cols.source),
        ),
        "top_collection": (
            "collection_rate",
            lambda t: top_by(t, "collection_rate", cols.hotel),
        ),
        "top_customers": (
            "customer_value_enriched",
            lambda t: top_by(t, "revenue_sum", cols.customer),
        ),
    }


def write_report(
    gold: Layer,
    report: Layer,
    cols: BookingColumns = BookingColumns(),
    around: Callable[[str, str, Callable[[], None]], None] | None = None,
) -> dict[str, str]:
    """Write the sections whose table exists; returns the reason per skipped section.

    Anything else that goes wrong is raised. ``around`` (section, gold table, write) may leave a
    write out or record it.
    """
    report.prepare()
    skipped = {}
    for section, (table, order) in report_sections(cols).items():
        try:
            found = gold.read(table)
        except AnalysisException as error:
            if (error.getCondition() or "").split(".")[0] not in ABSENT:
                raise
            skipped[section] = str(error)
            continue
        write = partial(report.write, order(found), section)
        around(section, table, write) if around else write()
    return skipped
