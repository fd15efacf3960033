"""Key figures over clean bookings and payments.

Amounts are summed as they are: EUR, USD and GBP are not converted, and rows whose
currency was nulled still count. The names of the result columns are fixed values: readers of
the gold tables know them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgemart.operators.intervals import overlaps
from lodgemart.operators.skew import left_lookup
from lodgemart.schemas import (
    STATUS_CANCELLED,
    STATUS_CONFIRMED,
    BookingColumns,
    PaymentColumns,
    column_type,
    sum_type,
)

PAYMENT_FLAGS = ("dq_orphan_payment", "dq_invalid_currency", "dq_over_amount")


def has_total(bookings: DataFrame, cols: BookingColumns = BookingColumns()) -> DataFrame:
    return bookings.filter(F.col(cols.total).isNotNull())


def valid_payments(
    payments: DataFrame, cols: PaymentColumns = PaymentColumns(), status_in: Sequence[str] | None = None
) -> DataFrame:
    """Payments with an amount and no quality mark; ``status_in`` narrows further."""
    passed = F.col(cols.amount).isNotNull()
    for flag in PAYMENT_FLAGS:
        passed = passed & ~F.col(flag)
    if status_in is not None:
        passed = passed & F.col(cols.status).isin(*status_in)
    return payments.filter(passed)


def daily_revenue(
    bookings: DataFrame, cols: BookingColumns = BookingColumns(), confirmed: str = STATUS_CONFIRMED
) -> DataFrame:
    """Revenue and distinct bookings per check-in date, confirmed bookings only."""
    return (
        has_total(bookings, cols)
        .filter(F.col(cols.status) == confirmed)
        .groupBy(F.col(cols.checkin).alias("date"))
        .agg(
            F.sum(cols.total).alias("gross_revenue"),
            F.countDistinct(cols.booking).alias("bookings_count"),
        )
    )


def cancellation_rate(
    bookings: DataFrame, cols: BookingColumns = BookingColumns(), cancelled: str = STATUS_CANCELLED
) -> DataFrame:
    """Share of cancelled bookings per source in percent. Key figures are unordered; the report sorts."""
    share = F.col("cancelled") / F.col("total_bookings") * 100
    return (
        bookings.groupBy(cols.source)
        .agg(
            F.count(F.lit(1)).alias("total_bookings"),
            F.count_if(F.col(cols.status) == cancelled).alias("cancelled"),
        )
        .withColumn("cancellation_rate_pct", F.round(share, 2))
    )


def _ratio(part: Column, whole: Column, digits: int) -> Column:
    """Rounded ratio, null unless ``whole`` is positive."""
    return F.when(whole > 0, F.round(part / whole, digits))


def collection_rate(
    bookings: DataFrame,
    payments: DataFrame,
    cols: BookingColumns = BookingColumns(),
    status_in: Sequence[str] | None = None,
    paid_cols: PaymentColumns = PaymentColumns(),
) -> DataFrame:
    """Valid payments over booked value, per hotel.

    Payments are summed per booking before they meet the bookings, so a booking with very
    many payments arrives as one row, and one left join and one aggregation give both
    totals. A repeated booking counts its payments once per repeat, as a row-level join would.
    """
    booked_type = sum_type(column_type(bookings, cols.total))
    paid_type = sum_type(column_type(payments, paid_cols.amount))
    booked = has_total(bookings, cols).select(cols.booking, cols.hotel, cols.total)
    paid = (
        valid_payments(payments, paid_cols, status_in)
        .filter(F.col(paid_cols.booking).isNotNull())
        .groupBy(F.col(paid_cols.booking).alias("_paid_booking"))
        .agg(F.sum(paid_cols.amount).alias("_paid"))
    )
    # Payments of bookings without a hotel are attributed to no one.
    credited = F.when(F.col(cols.hotel).isNotNull(), F.col("_paid"))
    totals = (
        left_lookup(booked, paid, cols.booking, "_paid_booking")
        .groupBy(cols.hotel)
        .agg(
            F.sum(cols.total).cast(booked_type).alias("total_bookings_value"),
            F.coalesce(F.sum(credited).cast(paid_type), F.lit(0).cast(paid_type)).alias(
                "total_payments_value"
            ),
        )
    )
    rate = _ratio(F.col("total_payments_value"), F.col("total_bookings_value"), 4)
    return totals.withColumn("collection_rate", rate)


def overbooking_alerts(
    bookings: DataFrame,
    cols: BookingColumns = BookingColumns(),
    exclude_status: Sequence[str] = (),
    bucket_days: float | None = None,
    null_bounds: str = "drop",
) -> DataFrame:
    """Pairs of bookings of one room whose stays overlap.

    Cancelled bookings take part unless ``exclude_status`` names their status.
    """
    if exclude_status:
        kept = ~F.coalesce(F.col(cols.status).isin(*exclude_status), F.lit(False))
        bookings = bookings.filter(kept)
    return overlaps(
        bookings, cols.room, cols.booking, cols.checkin, cols.checkout,
        bucket_days, null_bounds,
    )


def customer_value(
    bookings: DataFrame,
    cols: BookingColumns = BookingColumns(),
    confirmed_only: bool = False,
    confirmed: str = STATUS_CONFIRMED,
) -> DataFrame:
    """Distinct bookings, revenue and mean ticket per customer, cancelled ones included."""
    rows = has_total(bookings, cols)
    if confirmed_only:
        rows = rows.filter(F.col(cols.status) == confirmed)
    return rows.groupBy(cols.customer).agg(
        F.countDistinct(cols.booking).alias("bookings_count"),
        F.sum(cols.total).alias("revenue_sum"),
        F.round(F.avg(cols.total), 2).alias("avg_ticket"),
    )
