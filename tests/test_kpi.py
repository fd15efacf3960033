from datetime import date
from decimal import Decimal

import pytest

from conftest import rows
from lodgemart.plans import kpi
from lodgemart.plans.top_lists import top_by
from lodgemart.schemas import BookingColumns

BOOKINGS = (
    "booking_id string, customer_id string, hotel_id string, checkin_date date, "
    "total_amount decimal(12,2), status string, source string"
)
PAYMENTS = (
    "booking_id string, amount decimal(12,2), status string, dq_orphan_payment boolean, "
    "dq_over_amount boolean, dq_invalid_currency boolean"
)
D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def dec(text):
    return None if text is None else Decimal(text)


@pytest.fixture(scope="module")
def bookings(spark):
    cases = [
        ("b1", "c1", "h1", D1, "100.00", "confirmed", "web"),
        ("b1", "c1", "h1", D1, "100.00", "confirmed", "web"),
        ("b2", "c1", "h1", D1, "50.25", "cancelled", "web"),
        ("b3", "c2", "h1", D2, None, "confirmed", "web"),
        ("b4", "c2", "h2", None, "0.00", "confirmed", "desk"),
        ("b5", "c3", "h3", D2, "30.01", None, "desk"),
        ("b6", None, None, D2, "10.00", "confirmed", None),
    ]
    return spark.createDataFrame([(*c[:4], dec(c[4]), *c[5:]) for c in cases], BOOKINGS)


@pytest.fixture(scope="module")
def payments(spark):
    ok = (False, False, False)
    cases = [
        ("b1", "40.00", "paid", *ok),
        ("b1", "10.00", "failed", *ok),
        ("b2", "5.00", "paid", *ok),
        ("b2", None, "paid", *ok),
        ("b2", "7.00", "paid", True, False, False),
        ("b2", "7.00", "paid", False, True, False),
        ("b2", "7.00", "paid", False, False, True),
        ("b3", "8.00", "paid", *ok),
        ("b6", "9.00", "paid", *ok),
        (None, "9.00", "paid", *ok),
    ]
    return spark.createDataFrame([(c[0], dec(c[1]), *c[2:]) for c in cases], PAYMENTS)


def test_daily_revenue(bookings):
    out = kpi.daily_revenue(bookings)
    assert rows(out) == [
        (None, dec("0.00"), 1), (D1, dec("200.00"), 1), (D2, dec("10.00"), 1),
    ]
    assert out.columns == ["date", "gross_revenue", "bookings_count"]


def test_cancellation_rate(bookings):
    out = kpi.cancellation_rate(bookings)
    assert rows(out) == [(None, 1, 0, 0.0), ("desk", 2, 0, 0.0), ("web", 4, 1, 25.0)]


def test_collection_rate_counts_payments_once_per_booking_row(bookings, payments):
    out = kpi.collection_rate(bookings, payments)
    assert rows(out) == [
        (None, dec("10.00"), dec("0.00"), dec("0.0000")),
        ("h1", dec("250.25"), dec("105.00"), dec("0.4196")),
        ("h2", dec("0.00"), dec("0.00"), None),
        ("h3", dec("30.01"), dec("0.00"), dec("0.0000")),
    ]
    kinds = dict(out.dtypes)
    assert kinds["total_bookings_value"] == kinds["total_payments_value"] == "decimal(22,2)"
    assert kinds["collection_rate"] == "decimal(27,4)"


def test_collection_rate_by_payment_status(bookings, payments):
    out = rows(kpi.collection_rate(bookings, payments, status_in=["paid"]))
    assert out[1] == ("h1", dec("250.25"), dec("85.00"), dec("0.3397"))


def test_collection_rate_of_doubles(bookings, payments):
    as_double = (
        bookings.withColumn("total_amount", bookings.total_amount.cast("double")),
        payments.withColumn("amount", payments.amount.cast("double")),
    )
    assert rows(kpi.collection_rate(*as_double))[1] == ("h1", 250.25, 105.0, 0.4196)


def test_customer_value(bookings):
    out = kpi.customer_value(bookings)
    assert rows(out) == [
        (None, 1, dec("10.00"), dec("10.00")),
        ("c1", 2, dec("250.25"), dec("83.42")),
        ("c2", 1, dec("0.00"), dec("0.00")),
        ("c3", 1, dec("30.01"), dec("30.01")),
    ]
    confirmed = rows(kpi.customer_value(bookings, confirmed_only=True))
    assert confirmed[1] == ("c1", 1, dec("200.00"), dec("100.00"))
    assert "c3" not in {r[0] for r in confirmed}


def test_other_column_names(bookings):
    renamed = bookings.withColumnsRenamed({"source": "channel", "status": "state"})
    out = kpi.cancellation_rate(renamed, BookingColumns(source="channel", status="state"))
    assert rows(out)[2] == ("web", 4, 1, 25.0)


def test_top_by_puts_unknown_last(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("b", None), ("c", float("nan")), ("d", 3.0), ("e", 1.0)], "k string, v double"
    )
    assert [r.k for r in top_by(df, "v", "k").collect()] == ["d", "a", "e", "b", "c"]
    assert [r.k for r in top_by(df, "v", "k", 2).collect()] == ["d", "a"]
    plan = top_by(df, "v", "k")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
