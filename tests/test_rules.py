from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from lodgemart.operators.rules import (
    MissingColumnsError,
    Rule,
    apply_rules,
    blank_to_null,
    check_domain,
    drop_sentinel,
    null_negative,
    parse_date,
    swap_inverted,
)
from lodgemart.plans.cleaning import clean_bookings, clean_hotels, clean_payments
from lodgemart.schemas import BOOKINGS

spark_property = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
D1, D2 = date(2024, 1, 1), date(2024, 1, 5)


def test_blank_to_null_keeps_other_text_untrimmed(spark):
    cases = ["", "  ", "null", "NULL", "Null", " null ", " a@b ", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, email string")
    out = dict(rows(blank_to_null(df, "email")))
    assert [out[i] for i in range(8)] == [None, None, None, None, "Null", None, " a@b ", None]


@spark_property
@given(values=st.lists(st.one_of(st.none(), st.sampled_from(["", " ", "null", "NULL", "x", " x"])), min_size=1))
def test_blank_to_null_is_idempotent(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    once = blank_to_null(df, "v")
    assert rows(once) == rows(blank_to_null(once, "v"))


@pytest.mark.parametrize("header", ["country", "Country", "COUNTRY"])
def test_sentinel_goes_with_nulls_whatever_the_letter_case(spark, header):
    df = spark.createDataFrame([("a", "XX"), ("b", "IT"), ("c", None)], f"id string, {header} string")
    assert rows(drop_sentinel(df, "country", "XX"), "id") == [("b",)]
    assert rows(clean_hotels(df), "id") == [("b",)]


def test_parse_date_nulls_and_marks_malformed_text(spark):
    cases = ["2024-01-01", "01/02/2024", "", None, " 2024-01-05 "]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, d string")
    out = rows(parse_date(df, "d", "bad"))
    assert out == [(0, D1, False), (1, None, True), (2, None, True), (3, None, False), (4, D2, False)]


def test_parse_date_passes_dates(spark):
    df = spark.createDataFrame([(D1,)], "d date")
    assert parse_date(df, "d").schema == df.schema
    assert rows(parse_date(df, "d", "bad")) == [(D1, False)]


def test_swap_inverted(spark):
    cases = [(D1, D2), (D1, D1), (D2, D1), (None, D2), (D1, None), (None, None)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, lo date, hi date")
    out = swap_inverted(df, "lo", "hi", "swapped")
    assert out.columns == ["i", "swapped", "lo", "hi"]
    assert rows(out) == [
        (0, False, D1, D2),
        (1, False, D1, D1),
        (2, True, D1, D2),
        (3, False, D2, D2),
        (4, False, D1, D1),
        (5, False, None, None),
    ]


days = st.one_of(st.none(), st.dates(date(2000, 1, 1), date(2030, 1, 1)))


@spark_property
@given(pairs=st.lists(st.tuples(days, days), min_size=1))
def test_swap_orders_every_pair_and_is_idempotent(spark, pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, lo date, hi date")
    once = swap_inverted(df, "lo", "hi", "f1")
    twice = swap_inverted(once.drop("f1"), "lo", "hi", "f1")
    assert rows(once.drop("f1")) == rows(twice.drop("f1"))
    assert all(not r.f1 for r in twice.collect())
    assert all(r.f1 is not None and (r.lo is None or r.lo <= r.hi) for r in once.collect())


def test_null_negative_keeps_zero(spark):
    df = spark.sql("select * from values (0, -0.01), (1, 0.00), (2, 5.00), (3, null) as t(i, x)")
    out = [(i, None if x is None else float(x), f) for i, x, f in rows(null_negative(df, "x", "neg"))]
    assert out == [(0, None, True), (1, 0.0, False), (2, 5.0, False), (3, None, False)]


def test_check_domain_is_exact_and_spares_null(spark):
    cases = ["EUR", "XXX", "eur", " EUR", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string")
    out = rows(check_domain(df, "c", ("EUR", "USD"), "bad"))
    assert out == [(0, "EUR", False), (1, None, True), (2, None, True), (3, None, True), (4, None, False)]


def test_missing_columns_skip_or_fail(spark):
    df = spark.createDataFrame([(1,)], "x int")
    rule = Rule("needs y", ("y",), lambda t: t.withColumn("z", t.y))
    assert apply_rules(df, [rule]).columns == ["x"]
    with pytest.raises(MissingColumnsError, match="needs y"):
        apply_rules(df, [rule], strict=True)


def test_case_sensitive_sessions_compare_exactly(spark):
    df = spark.createDataFrame([("XX",)], "Country string")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert clean_hotels(df).count() == 1
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_bookings_chain_schema_and_one_narrow_pass(spark):
    out = clean_bookings(spark.createDataFrame([], BOOKINGS), strict=True)
    assert out.columns == [
        "booking_id", "customer_id", "hotel_id", "room_id", "created_at", "nights", "currency",
        "total_amount", "status", "source", "dq_swapped_dates", "checkin_date", "checkout_date",
        "dq_negative_total", "dq_invalid_currency",
    ]
    assert out.schema["total_amount"].dataType == BOOKINGS["total_amount"].dataType
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_bookings_chain_without_currency_or_dates(spark):
    df = spark.createDataFrame([("b", -1.0)], "booking_id string, total_amount double")
    assert rows(clean_bookings(df)) == [("b", None, True)]


def test_payments_chain_without_booking_totals(spark):
    payments = spark.createDataFrame([("p", "b", "ZZZ")], "payment_id string, booking_id string, currency string")
    bookings = spark.createDataFrame([("b",)], "booking_id string")
    assert clean_payments(payments, bookings).columns == [
        "payment_id", "booking_id", "currency", "dq_invalid_currency",
    ]
    with pytest.raises(MissingColumnsError):
        clean_payments(payments, bookings, strict=True)
